"""Repair of text from scanned pages.

Counts over the whole corpus give a lexicon (words of at least a set relative
frequency, so it has a bounded number of words), the words of names and dates, words that
stand with a hyphen of their own before another, and lines that recur inside
sentences. Words outside the lexicon that a small change makes one inside tell which
characters are misread for which, dropped, added or run together. An averaged perceptron is
then trained on lexicon words, misread and cut at line ends in these ways, to edit
characters: keep, replace, delete, insert, join over a line end. Words outside the lexicon
are edited by the best path over its scores among all that spell a word of the lexicon.

Furniture is found by position: running titles by how often a page number is at their
line, and page numbers by a second perceptron over what a line looks like, where in the
letter it stands and what stands around it, trained on a sample of lines between
which a sentence goes on or that are beside a title.
"""

from __future__ import annotations

import random
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.nametext import distance, one_slip
from quillgraph.llm.skeleton import skeleton
from quillgraph.session import checkpointed

#: Least share of all words (lines) a word of the lexicon (a running title) has; the tables broadcast have at most one over this many entries.
WORD_SHARE, TITLE_SHARE = 1.5e-5, 1.5e-4
LEAST_WORDS, LEAST_TITLES = 3, 3
#: Share of a running title's lines that have a page number of their own or next to them, at least.
AT_PAGE = 0.25
TRAINING_WORDS, EPOCHS = 6000, 4
#: Letters whose lines the perceptron of furniture is trained on, at most, spread by a hash of the text.
TRAINING_LETTERS = 2000
#: A confusion of one printed letter has at least this share of the types of the most usual one; one of two letters, or of none, the second share, as words of a language are often a letter apart.
CONFUSION_SHARE, CHANGE_SHARE, LEAST_TYPES = 0.03, 0.2, 5

_HYPHENS = "-‐‑¬­"
_EDGE = ".,;:?!()[]\"”„»«'’"
# Characters that scanning commonly takes for others, as (printed, read).
COMMON = [("o", "0"), ("о", "0"), ("i", "1"), ("l", "1"), ("i", "!"), ("l", "|"), ("s", "5"), ("s", "$"), ("a", "@"), ("z", "2"), ("b", "6"), ("б", "6"), ("g", "9"), ("ч", "4"), ("з", "3"), ("e", "c"), ("t", "f"), ("m", "rn"), ("d", "cl"), ("u", "ii"), ("h", "li"), ("n", "ri"), ("и", "н"), ("л", "п"), ("ш", "щ"), ("š", "§"), ("č", "é")]
_LETTER = re.compile(r"[^\W\d_]")
_PAGE = re.compile(r"^[\W_]*(?:(?:str|s|p|pag|seite|page|стр|с)\.?\s*)?\d{1,4}[\W_]*$", re.IGNORECASE)
_CUT = re.compile(rf"([^\W\d_][\w@$§|!]*)[{_HYPHENS}]\s*$")


def title_key(line: str) -> str:
    """Letters of a line without digits of their own, spacing, case and common misreadings: what a running title is known by."""
    s = re.sub(r"(?<!\w)[\d–—-]+(?!\w)", " ", line.lower())
    for right, wrong in (("i", "1"), ("o", "0"), ("s", "5"), ("s", "$"), ("a", "@"), ("s", "§")):
        s = s.replace(wrong, right)
    return "".join(c for c in s if c.isalpha())


def is_page_number(line: str) -> bool:
    return bool(_PAGE.match(line)) and any(c.isdigit() for c in line)


_LOW = re.compile(r"[^\W\d_]{4}")
_ALONE = re.compile(r"(?<![\w@$§|!])\d+(?![\w@$§|!])")


def may_be_page(line: str) -> bool:
    """A line with a number of its own and no word of four letters."""
    return bool(_ALONE.search(line)) and not _LOW.search(line)


def line_features(lines: list[str], i: int, titles: list[bool]) -> list[str]:
    """What a line looks like, where it stands and what is around it."""
    line = lines[i].strip()
    digits = sum(c.isdigit() for c in line)
    form = re.sub(r"\d+", "0", line.lower())
    before, after = (lines[i - 1].rstrip() if i else ""), (lines[i + 1].strip() if i + 1 < len(lines) else "")
    place = "first" if i == 0 else "later"
    groups, letters = len(re.findall(r"\d+", line)), sum(c.isalpha() for c in line)
    end = before[-1:] if before[-1:] in ".!?:," or before[-1:] in _HYPHENS else "x" if before else ""
    begin = "small" if after[:1].islower() else "large" if after[:1].isupper() else "other" if after else ""
    near = (i > 0 and titles[i - 1]) or (i + 1 < len(lines) and titles[i + 1])
    return ["b", f"n{min(digits, 6)}", f"f{form}", f"fn{form}{min(digits, 6)}", f"g{groups}", f"a{min(letters, 6)}", f"ga{groups}{letters > 0}", f"p{place}", f"e{end}", f"es{end}{begin}", f"t{near}", f"tp{near}{place}", f"w{min(len(line) // 4, 8)}"]


@dataclass
class Perceptron:
    """Averaged perceptron over sparse features, one weight for each feature and action."""

    weights: dict[str, dict[str, float]] = field(default_factory=dict)

    def score(self, features: list[str], actions: list[str]) -> dict[str, float]:
        out = dict.fromkeys(actions, 0.0)
        for f in features:
            own = self.weights.get(f)
            if own:
                for a in actions:
                    if a in own:
                        out[a] += own[a]
        return out

    def train(self, examples: list[tuple[list[str], str, list[str]]], epochs: int, seed: int = 7, margin: float = 0.0) -> None:
        """Learn also from what is right by less than ``margin``."""
        total: dict[tuple[str, str], float] = defaultdict(float)
        since: dict[tuple[str, str], int] = defaultdict(int)
        now, chance = 0, random.Random(seed)
        for _ in range(epochs):
            chance.shuffle(examples)
            for features, right, actions in examples:
                now += 1
                scores = self.score(features, actions)
                guess = max(actions, key=lambda a: (scores[a], a))
                if guess == right:
                    if not margin:
                        continue
                    guess = max((a for a in actions if a != right), key=lambda a: (scores[a], a))
                    if scores[right] - scores[guess] >= margin:
                        continue
                for f in features:
                    own = self.weights.setdefault(f, {})
                    for a, step in ((right, 1.0), (guess, -1.0)):
                        total[f, a] += (now - since[f, a]) * own.get(a, 0.0)
                        since[f, a] = now
                        own[a] = own.get(a, 0.0) + step
        for f, own in self.weights.items():
            for a in own:
                own[a] = (total[f, a] + (now - since[f, a]) * own[a]) / max(1, now)


def _features(s: str, i: int) -> list[str]:
    p = f"^^{s}$$"
    i += 2
    c = p[i]
    return ["b", f"0{c}", f"1{p[i - 1]}{c}", f"2{c}{p[i + 1]}", f"3{p[i - 2 : i + 1]}", f"4{p[i : i + 3]}", f"5{p[i - 1]}{c}{p[i + 1]}", f"6{p[i - 2 : i]}{p[i + 1 : i + 3]}"]


def _action(printed: str, read: str) -> str:
    """The first action of a change: what is read becomes what is printed, and further read characters go."""
    return "delete" if not printed else f"replace {printed}" if len(read) <= 1 else f"replace {printed} delete"


@dataclass
class Editor:
    """What workers need: lexicon, suspended words, running titles, confusions, words of one letter and the perceptron."""

    lexicon: dict[str, int]
    suspended: set[str]
    titles: set[str]
    confusions: dict[str, list[str]]
    letters: set[str] = field(default_factory=set)
    model: Perceptron = field(default_factory=Perceptron)
    furniture: Perceptron = field(default_factory=Perceptron)

    def __post_init__(self):
        self.prefixes: set[str] = set()
        self.starts: dict[str, list[tuple[str, str]]] = defaultdict(list)
        self.dropped = [printed for printed, reads in self.confusions.items() if "" in reads]
        for printed, reads in self.confusions.items():
            for read in reads:
                if read:
                    self.starts[read[0]].append((printed, read))
        self.known: dict[str, tuple[str, tuple[int, ...]] | None] = {}
        self.by_size: dict[int, list[str]] = defaultdict(list)
        for t in self.titles:
            self.by_size[len(t)].append(t)
        self.title_known: dict[str, bool] = {}
        self.longest = max(map(len, self.titles), default=0)
        self.tokens: dict[str, tuple[str, tuple[int, ...]] | None] = {}

    def actions(self, s: str, i: int) -> list[tuple[int, str, str]]:
        """(characters read, what they become, first action) that are possible at a place."""
        out = [(1, s[i], "keep")]
        for printed, read in self.starts.get(s[i], ()):
            if s.startswith(read, i):
                out.append((len(read), printed, _action(printed, read)))
        for printed in self.dropped:
            out.append((1, printed + s[i], f"insert {printed}"))
            if i == len(s) - 1:
                out.append((1, s[i] + printed, f"append {printed}"))
        return out

    def begins(self, made: str) -> bool:
        """Whether a word of the lexicon begins so."""
        if not self.prefixes:
            self.prefixes = {w[:n] for w in self.lexicon for n in range(len(w) + 1)}
        return made in self.prefixes or (made[:1].isupper() and made[0].lower() + made[1:] in self.prefixes)

    def correct(self, word: str) -> tuple[str, tuple[int, ...]] | None:
        """The lexicon's word that a word outside it is misread from, and the places of the edits; none if there is none."""
        if word in self.known:
            return self.known[word]
        if len(self.known) > 300_000:
            self.known.clear()
        # of all ways to spell the same beginning the best, at each place
        paths: dict[int, dict[str, tuple[float, tuple[int, ...]]]] = defaultdict(dict)
        paths[0][""] = (0.0, ())
        for i in range(len(word)):
            if i not in paths:
                continue
            options = self.actions(word, i)
            scores = self.model.score(_features(word, i), [a for *_, a in options]) if len(options) > 1 else {"keep": 0.0}
            for made, (score, places) in paths.pop(i).items():
                for n, text, action in options:
                    to = made + text
                    if text and not self.begins(to):
                        continue
                    own = paths[i + n]
                    if to not in own or own[to][0] < score + scores[action]:
                        own[to] = (score + scores[action], places if action == "keep" else (*places, i))
        best = None
        for made, (_, places) in sorted(paths[len(word)].items(), key=lambda x: (-x[1][0], x[0])):
            if places and made and self.has(made):
                best = made, places
                break
        self.known[word] = best
        return best

    def has(self, word: str) -> bool:
        return word in self.lexicon or (word[:1].isupper() and word[0].lower() + word[1:] in self.lexicon)

    def misread(self, token: str) -> tuple[str, tuple[int, ...]] | None:
        """A token's correction and the places of its edits, or none if it is no misread word; remembered by token."""
        if token not in self.tokens:
            if len(self.tokens) > 300_000:
                self.tokens.clear()
            self.tokens[token] = self._misread(token)
        return self.tokens[token]

    def _misread(self, token: str) -> tuple[str, tuple[int, ...]] | None:
        for word in dict.fromkeys((token.strip(_EDGE), token.strip(".,;:?()[]\"”„»«'’").rstrip(".,"))):
            letters = [c for c in word if c.isalpha()]
            if len(word) < 2 or not letters or self.has(word):
                continue
            if all(c.isupper() for c in letters) and len(letters) > 1:
                continue
            if any(c.isupper() for c in word[1:]):
                continue
            found = self.correct(word)
            if found:
                at = token.find(word)
                return found[0], tuple(at + p for p in found[1])
        return None

    def is_title(self, line: str) -> bool:
        """Whether a line is a running title, with or without a page number, perhaps misread or without its last letter."""
        # letters, and room for a page number, years and a slip
        if len(line) < 6 or len(line) - line.count(" ") > self.longest + 16 or line[0].islower():
            return False
        key = title_key(line)
        if key in self.titles:
            return True
        if len(key) < 6:
            return False
        if key not in self.title_known:
            if len(self.title_known) > 300_000:
                self.title_known.clear()
            slips = 2 if len(key) > 9 else 1
            near = [t for n in range(len(key) - slips, len(key) + slips + 1) for t in self.by_size.get(n, ())]
            self.title_known[key] = any(one_slip(key, t) or distance(key, t, slips) <= slips for t in near)
        return self.title_known[key]

    def is_page(self, lines: list[str], i: int, titles: list[bool]) -> bool:
        """Whether a line is a page number: the perceptron's choice from its looks, place and neighbours."""
        scores = self.furniture.score(line_features(lines, i, titles), ["page", "body"])
        return scores["page"] > scores["body"]

    def joins(self, left: str, right: str) -> bool:
        """Whether a word cut before a line end goes on in the next line: the perceptron's choice at the hyphen."""
        scores = self.model.score(self.join_features(left, right), ["keep", "join"])
        return scores["join"] > scores["keep"]

    def join_features(self, left: str, right: str) -> list[str]:
        whole, alone = self.has(left + right), right in self.letters or self.has(right)
        hangs = left.lower() + "-" in self.suspended
        return ["j", f"j1{whole}", f"j2{hangs}", f"j3{whole}{hangs}", f"j4{alone}{whole}", f"j8{alone}{hangs}{whole}", f"j5{right[:1].islower()}", f"j6{left[-2:]}-{right[:2]}", f"j7{right}" if len(right) < 5 else "j7"]

    def read(self, lines: list[str]) -> tuple[list[set[str]], list[str]]:
        """Kinds of noise of each line, and the lines repaired; furniture becomes empty, a cut word moves up whole."""
        kinds: list[set[str]] = [set() for _ in lines]
        fixed = list(lines)
        body = []
        titles = [self.is_title(line) for line in lines]
        for i, line in enumerate(lines):
            if may_be_page(line) and self.is_page(lines, i, titles):
                kinds[i].add("page")
                fixed[i] = ""
            elif titles[i]:
                kinds[i].add("header")
                fixed[i] = ""
            elif line.strip():
                body.append(i)
        tokens = {i: lines[i].split() for i in body}
        skip: set[tuple[int, int]] = set()
        for i, j in zip(body, body[1:]):
            m = _CUT.search(lines[i])
            if not m or not tokens[j]:
                continue
            last, first = tokens[i][-1], tokens[j][0]
            left = last.rstrip(_HYPHENS)
            if not left or not _LETTER.match(first[:1]) and not first[:1] in "@$|!01345692§":
                continue
            right = first.rstrip(_EDGE)
            bare = left.lstrip(_EDGE)
            upper = right[:1].isupper() and not (bare.isupper() or bare[-1:].isupper())
            if upper or not self.joins(bare, right):
                continue
            kinds[i].add("break")
            skip |= {(i, len(tokens[i]) - 1), (j, 0)}
            whole = left + first
            wrong = self.misread(whole)
            if wrong:
                for p in wrong[1]:
                    kinds[i if p < len(left) else j].add("char")
                whole = _replaced(whole, wrong[0])
            tokens[i][-1], tokens[j][0] = whole, ""
        known = self.tokens
        for i in body:
            for k, token in enumerate(tokens[i]):
                wrong = known[token] if token in known else self.misread(token)
                if wrong and (i, k) not in skip:
                    kinds[i].add("char")
                    tokens[i][k] = _replaced(token, wrong[0])
            fixed[i] = " ".join(t for t in tokens[i] if t)
        return kinds, fixed

    def paragraphs(self, text: str) -> str:
        """The letter as continuous paragraphs: a line goes on if a sentence does, or if the next word had no room in it."""
        raw = text.split("\n")
        _, fixed = self.read(raw)
        kept = [i for i, line in enumerate(fixed) if line]
        out: list[str] = []
        for n, i in enumerate(kept):
            if n and self._goes_on(raw, fixed, kept, n - 1):
                out[-1] += " " + fixed[i]
            else:
                out.append(fixed[i])
        return "\n".join(out)

    @staticmethod
    def _goes_on(raw: list[str], fixed: list[str], kept: list[int], n: int) -> bool:
        i, j = kept[n], kept[n + 1]
        if any(not x.strip() for x in raw[i + 1 : j]):
            return False
        if fixed[j][0].islower() and fixed[i][-1] not in ".!?":
            return True
        # greetings, signatures and addresses have few words in small letters
        prose = [sum(w[0].islower() for w in fixed[k].split()) > 1 for k in (i, j)]
        if not prose[1]:
            return False
        if prose[0] and fixed[i][-1] not in ".!?:,":
            return True
        width = max(len(raw[k]) for k in kept[max(0, n - 2) : n + 4])
        return len(raw[i].rstrip()) + 1 + len(raw[j].split()[0]) > width


def _replaced(token: str, word: str) -> str:
    """A token with its word replaced, punctuation around it kept."""
    lead = token[: len(token) - len(token.lstrip(_EDGE))]
    tail = token[len(token.rstrip(".,;:?()[]\"”„»«'’")) :]
    return lead + word + tail


def _tokens(text: Column) -> Column:
    """Words of a text, without those cut at line ends, edges bare of punctuation."""
    whole = F.regexp_replace(text, rf"(?<!\p{{L}})\p{{L}}++[{_HYPHENS}][^\S\n]*+\n\s*+\p{{L}}++", " ")
    return F.explode(F.split(whole, r"[\s ]+"))


def _bare(word: Column) -> Column:
    return F.trim(word, F.lit(_EDGE))


def _confusions(lexicon: dict[str, int], others: DataFrame) -> dict[str, list[str]]:
    """Characters read for others, by all words (w) outside the lexicon that one change makes a word inside."""
    shared = others.sparkSession.sparkContext.broadcast(list(lexicon))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # what a word has between a beginning and an end: nothing, a letter or two
        around: dict[tuple[str, str], set[str]] = defaultdict(set)
        whole = set(shared.value)
        for v in whole:
            for i in range(len(v)):
                around[v[:i], v[i + 1 :]].add(v[i])
                if i + 1 < len(v):
                    around[v[:i], v[i + 2 :]].add(v[i : i + 2])
        for batch in batches:
            found: list[tuple[str, str]] = []
            for w in batch.column(0).to_pylist():
                met = {(o, w[i : i + k]) for i in range(len(w) + 1) for k in (0, 1, 2) if i + k <= len(w) for o in around.get((w[:i], w[i + k :]), ()) if len(o) == 1 or k == 1}
                met |= {("", w[i]) for i in range(len(w)) if w[:i] + w[i + 1 :] in whole}
                found += [(o, s) for o, s in met if not (o and s and (s[0] == o[0] or s[-1] == o[-1])) and skeleton(s) != skeleton(o)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.string()) for i in (0, 1)], ["printed", "read"])

    types = others.select("w").mapInArrow(run, "printed string, read string").groupBy("printed", "read").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_TYPES).collect()
    usual = lambda r: len(r["printed"]) == 1 and r["read"] != ""
    most = max((r["n"] for r in types if usual(r)), default=0) or max((r["n"] for r in types), default=0)
    found = {(r["printed"], r["read"]) for r in types if r["n"] >= (CONFUSION_SHARE if usual(r) else CHANGE_SHARE) * most} | set(COMMON)
    out: dict[str, list[str]] = defaultdict(list)
    for printed, read in sorted(found):
        out[printed].append(read)
    return dict(out)


def _examples(editor: Editor, words: list[str], seed: int = 11) -> list[tuple[list[str], str, list[str]]]:
    """Character actions from words misread and cut on purpose, and words left as they are."""
    chance = random.Random(seed)
    out: list[tuple[list[str], str, list[str]]] = []
    for word in words:
        read, right, at, lost = "", [], 0, ""
        while at < len(word):
            # a change that begins here, of one printed letter or two, or an added letter
            may = [(printed, r) for printed in (word[at], word[at : at + 2], "") for r in editor.confusions.get(printed, ())] if chance.random() < 0.25 else []
            printed, r = chance.choice(may) if may else (word[at], word[at])
            if printed and not r:
                lost, at = printed, at + 1
                continue
            action = "keep" if printed == r else _action(printed, r)
            if lost and action == "keep":
                action, lost = f"insert {lost}", ""
            right.append((len(read), action))
            read += r
            at += len(printed)
        if lost and right and right[-1][1] == "keep":
            right[-1] = (right[-1][0], f"append {lost}")
        for i, action in right:
            options = [a for *_, a in editor.actions(read, i)]
            if action not in options:
                options.append(action)
            if len(options) > 1:
                out.append((_features(read, i), action, options))
        if len(word) > 3:
            at = chance.randint(2, len(word) - 1)
            out.append((editor.join_features(word[:at], word[at:]), "join", ["keep", "join"]))
            if chance.random() < 0.2:  # a cut name, in no lexicon
                out.append((editor.join_features(word[:at] + "zr", "zr" + word[at:]), "join", ["keep", "join"]))
    after = [*sorted(editor.letters), *[w for w in words if len(w) < 5][:60]] or ["i"]
    for left in sorted(editor.suspended):
        for right in after:
            out.append((editor.join_features(left[:-1], right), "keep", ["keep", "join"]))
    return out


def fit(letters: DataFrame, mentions: DataFrame | None = None, text_col: str = "text", mention_col: str = "text") -> Editor:
    """Lexicon, titles and confusions over the whole corpus, and the trained perceptron.

    ``mentions`` has names and dates as found in the text; words that mostly stand in them
    are not in the lexicon.
    """
    texts = letters.select(F.col(text_col).alias("text")).where("text is not null")
    words = texts.select(_tokens(F.col("text")).alias("w")).select(_bare(F.col("w")).alias("w")).where("length(w) > 0").groupBy("w").agg(F.count("*").alias("n"))
    if mentions is not None:
        # distinct spellings first, as one name may have a tenth of all mentions
        spelled = mentions.select(F.col(mention_col).alias("text")).where("text is not null").groupBy("text").agg(F.count("*").alias("m"))
        named = spelled.select(F.explode(F.split("text", r"[\s ]+")).alias("w"), "m").select(_bare(F.col("w")).alias("w"), "m").groupBy("w").agg(F.sum("m").alias("named"))
        words = words.join(named, "w", "left")
    else:
        words = words.withColumn("named", F.lit(None).cast("bigint"))
    words = checkpointed(words)
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    least = max(LEAST_WORDS, WORD_SHARE * total)
    frequent = words.where((F.col("n") >= least) & F.col("w").rlike(r"^[\p{L}\p{M}'’-]+$")).select("w", "n", F.coalesce("named", F.lit(0)).alias("named")).collect()
    suspended = {r["w"].lower() for r in frequent if r["w"].endswith("-") and r["w"][0].isalpha()}
    letters_ = {r["w"] for r in frequent if len(r["w"]) == 1}
    lexicon = {r["w"]: r["n"] for r in frequent if len(r["w"]) > 1 and r["named"] < 0.5 * r["n"] and not r["w"].endswith("-") and not (r["w"].isupper() and len(r["w"]) > 1)}
    unknown = words.where((F.col("n") < least) & F.col("named").isNull() & (F.length("w") > 1) & F.col("w").rlike(r"^\p{Ll}|[^\p{L}\p{M}]"))
    confusions = _confusions(lexicon, unknown)
    editor = Editor(lexicon, suspended, _titles(texts), confusions, letters_)
    chosen = sorted(lexicon, key=lambda w: (-lexicon[w], w))[:TRAINING_WORDS]
    editor.model.train(_examples(editor, [w for w in chosen if w.isalpha()]), EPOCHS)
    editor.furniture.train(_furniture_examples(editor, _sampled(texts)), EPOCHS, margin=2.0)
    return editor


def _sampled(texts: DataFrame, bound: int = TRAINING_LETTERS) -> list[str]:
    """At most ``bound`` texts, spread by a hash; only for fitting."""
    share = min(1.0, 0.9 * bound / max(1, texts.count()))
    rows = texts.where((F.xxhash64("text") / F.lit(2.0**63)).between(-1.0, 2 * share - 1)).limit(bound)
    return sorted(r["text"] for r in rows.collect())


def _furniture_examples(editor: Editor, texts: list[str]) -> list[tuple[list[str], str, list[str]]]:
    """Lines that are a number in the midst of a sentence or beside a title, and lines with digits that are no number alone; what could be either is left out."""
    out = []
    for text in texts:
        lines = text.split("\n")
        titles = None
        for i, line in enumerate(lines):
            if not may_be_page(line):
                continue
            titles = titles if titles is not None else [editor.is_title(x) for x in lines]
            inside = 0 < i < len(lines) - 1
            goes_on = inside and lines[i - 1].strip() and lines[i + 1].strip() and lines[i - 1].rstrip()[-1] not in ".!?"
            if not is_page_number(line):
                out.append((line_features(lines, i, titles), "body", ["page", "body"]))
            elif goes_on or (inside and (titles[i - 1] or titles[i + 1])):
                out.append((line_features(lines, i, titles), "page", ["page", "body"]))
    return out


def _titles(texts: DataFrame) -> set[str]:
    """Keys of running titles: lines of the whole corpus that recur, and are often where the page number is."""
    split = texts.select(F.split("text", "\n").alias("l"))
    # a running title has capitals or no stop; a line that begins small is prose
    around = F.transform("l", lambda x, i: F.struct(x.alias("line"), F.get("l", i - 1).alias("before"), F.get("l", i + 1).alias("after")))
    lines = split.select(F.explode(F.filter(around, lambda x: (F.length(x["line"]) >= 6) & ~x["line"].rlike(r"^\s*\p{Ll}"))).alias("x")).select("x.*")
    total = split.agg(F.coalesce(F.sum(F.size("l")), F.lit(0)).alias("n")).first()["n"]
    page = r"(?i)^[\W_]*((str|s|p)\.?\s*)?\d{1,4}[\W_]*$"
    beside = F.coalesce(F.col("before").rlike(page), F.lit(False)) | F.coalesce(F.col("after").rlike(page), F.lit(False))
    numbered = F.col("line").rlike(r"^\s*\d{1,4}\s{2,}\S|\S\s{2,}\d{1,4}\s*$")
    s = F.regexp_replace(F.lower("line"), r"(?U)(?<!\w)[\d–—-]+(?!\w)", " ")
    key = F.regexp_replace(F.translate(s, "105$@§", "iossas"), r"[^\p{L}]", "")
    counted = lines.select(key.alias("key"), (beside | numbered).cast("int").alias("at_page")).where("length(key) >= 6").groupBy("key").agg(F.count("*").alias("n"), F.sum("at_page").alias("at_page"))
    return {r["key"] for r in counted.where((F.col("n") >= F.lit(max(LEAST_TITLES, TITLE_SHARE * total))) & (F.col("at_page") >= AT_PAGE * F.col("n"))).select("key").collect()}


def noise(letters: DataFrame, editor: Editor, id_col: str = "letter_id", text_col: str = "text", header_col: str = "raw_header") -> DataFrame:
    """(id, field, line_no BIGINT, kind): what scanning left in each line of the text and each part of the header.

    A header's parts are read as the first lines of the text where they are the same. A null
    or empty field has no rows. Repeated rows repeat.
    """
    shared = letters.sparkSession.sparkContext.broadcast(editor)
    kind_of = letters.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            ids, fields, numbers, kinds = [], [], [], []
            for i, text, header in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                lines = text.split("\n") if text else []
                found = {"text": own.read(lines)[0] if lines else []}
                parts = header.split(" | ") if header else []
                found["raw_header"] = found["text"][: len(parts)] if parts == lines[: len(parts)] else own.read(parts)[0]
                for name, rows in found.items():
                    for k, row in enumerate(rows, 1):
                        for kind in row:
                            ids.append(i)
                            fields.append(name)
                            numbers.append(k)
                            kinds.append(kind)
            yield pa.RecordBatch.from_arrays([pa.array([x.as_py() for x in ids], batch.schema.field(0).type), pa.array(fields, pa.string()), pa.array(numbers, pa.int64()), pa.array(kinds, pa.string())], ["id", "field", "line_no", "kind"])

    rows = letters.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("a"), F.col(header_col).cast("string").alias("b"))
    return rows.mapInArrow(run, f"id {kind_of}, field string, line_no bigint, kind string").withColumnRenamed("id", id_col)


def repaired(letters: DataFrame, editor: Editor, id_col: str = "letter_id", text_col: str = "text") -> DataFrame:
    """(id, text): every letter as continuous paragraphs; null stays null, empty stays empty."""
    shared = letters.sparkSession.sparkContext.broadcast(editor)
    kind_of = letters.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t and own.paragraphs(t) for t in batch.column(1).to_pylist()], pa.string())], ["id", "text"])

    rows = letters.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind_of}, text string").withColumnsRenamed({"id": id_col, "text": text_col})
