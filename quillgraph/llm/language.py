"""Languages of documents and of their passages, by compression.

For each language and script a raw-content dictionary for zstandard is made of texts
in it. A sentence is encoded with every dictionary of its script, and the fewer
bytes, the likelier the language. Sentences with a narrow margin are not decided alone:
the cheapest sequence of languages over the whole text, where every change costs SWITCH
bytes, assigns them, and a passage of fewer than PASSAGE sentences joins its neighbour.
A passage whose best language is less than REJECT bytes ahead of the next is rejected: it
keeps the likelier language, as every passage has one, but is marked as not told apart.

Dictionaries start from the seeds and from a bounded sample of labelled documents;
sentences whose language is not the one noted are then taken out and the dictionaries
are made again, so wrong labels and mixed documents do little harm.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import zip_longest

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Labelled documents sampled for each label, at most; bytes of a dictionary.
SAMPLE_DOCUMENTS, DICTIONARY_BYTES = 250, 100_000
LEVEL, SWITCH, OTHER_SCRIPT, PASSAGE = 3, 14, 20, 2
#: Bytes that a passage's language is ahead of the next, at least, or it is rejected; the confidence is then below 0.73.
REJECT = 6

# Common words and phrases of each language, for the first dictionaries.
SEEDS = {
    "sr": "i u je da se na za sa od do po iz što koji koja koje kao ali ili nije sam smo ste su bio bila bilo biti neka mi me vi vas vam ga ju ih njih kad kada gde kako samo još već vrlo posle pre zbog između pred iznad ovde tamo danas juče sutra uvek nikad. Draga gospođice, poštovani gospodine, primio sam Vaše pismo i odmah odgovaram. Molim Vas da mi pišete kako ste i šta radite. Srdačno Vas pozdravlja, Vaš odani. Hvala na lepim rečima.",
    "sr-cyrl": "и у је да се на за са од до по из што који која које као али или није сам смо сте су био била било бити нека ми ме ви вас вам га ју их њих кад када где како само још већ врло после пре због између пред изнад овде тамо данас јуче сутра увек никад. Драга госпођице, поштовани господине, примио сам Ваше писмо и одмах одговарам. Молим Вас да ми пишете како сте и шта радите. Срдачно Вас поздравља, Ваш одани. Хвала на лепим речима.",
    "de": "und der die das den dem des ein eine einen einem einer ist sind war waren wird werden hat haben hatte nicht mit von zu zum zur auf für aus bei nach über unter durch ich er sie es wir ihr Sie mich mir ihn ihm uns aber oder wenn weil dass wie was auch noch schon nur sehr hier dort heute gestern. Sehr geehrter Herr, liebes Fräulein, ich habe Ihren Brief erhalten und danke Ihnen herzlich. Bitte schreiben Sie mir bald. Mit herzlichen Grüßen, Ihr ergebener.",
    "fr": "et le la les un une des du de à au aux en dans par pour sur avec sans est sont était être avoir a ont ne pas plus que qui quoi dont où je tu il elle nous vous ils elles me te se lui leur mon ma mes votre vos notre mais ou si comme aussi encore déjà très ici là aujourd'hui hier. Cher monsieur, chère amie, j'ai bien reçu votre lettre et je vous en remercie. Écrivez-moi bientôt. Votre dévoué, avec mes meilleurs sentiments.",
    "en": "and the a an of to in on at by for with from is are was were be been have has had not no but or if that which who what when where how I you he she it we they me him her us them my your his our their this these those very also still already only here there today yesterday. My dear Miss, dear Sir, I have received your letter and thank you for it. Please write to me soon. With kind regards, yours ever.",
    "pl": "i w z na do od po za o u przez dla przed pod nad jest są był była było być nie tak ale lub albo że który która które jak co kto gdzie kiedy ja ty on ona my wy oni mnie mi go ją nas was im mój moja pan pani pana się już jeszcze tylko bardzo tu tam dziś wczoraj. Szanowny Panie, droga Pani, otrzymałem list i bardzo dziękuję. Proszę do mnie napisać. Z serdecznym pozdrowieniem, oddany.",
    "it": "e il lo la i gli le un uno una di a da in con su per tra fra del della dei delle al alla nel nella è sono era essere avere ha hanno non più che chi cui dove io tu lui lei noi voi loro mi ti si ci vi mio mia suo sua nostro ma o se come anche ancora già molto qui là oggi ieri. Egregio signore, cara amica, ho ricevuto la Sua lettera e La ringrazio. Mi scriva presto. Con i migliori saluti, Suo devoto.",
    "ru": "и в во не на что с со как а по к из у за от о об для до но или если чтобы который которая которые это этот эта эти был была было были быть есть нет я ты он она мы вы они меня мне его ей нас вам их мой моя ваш ваша уже ещё только очень здесь там сегодня вчера. Милостивый государь, дорогой друг, я получил Ваше письмо и благодарю Вас. Напишите мне скорее. Искренне Ваш, с уважением.",
}
CYRILLIC_CODES = ("sr-cyrl", "ru")
CODES = ("sr", "de", "fr", "en", "pl", "it", "ru")

# Abbreviations with a full stop that stand before a name.
SHORT = {"dr", "prof", "g", "gosp", "gđa", "br", "st", "sv", "str", "tel", "b", "čit", "čas", "zadr", "knjiž", "knj", "izd", "nar", "trg", "pev", "mes", "umet", "др", "проф", "г", "бр", "св", "стр", "чит", "час", "задр", "књиж"}
WORDS = 3
_STOP = re.compile(r"[.!?]+[)\]\"”»]*\s+")
_FIRST = re.compile(r"[.,!]\n")
_CUT = re.compile(r"(?<=[^\W\d_])[-‐‑¬\xad]\s*\n\s*(?=[^\W\d_])")


def plain(text: str) -> str:
    """A sentence as one line, words cut at a line's end put together."""
    return " ".join((_CUT.sub("", text) if "\n" in text else text).split())


def _begins(text: str, at: int) -> bool:
    """Whether a capital stands here, perhaps after an opening mark."""
    c = text[at : at + 1]
    return c.isupper() or (c in "\"„«»([" and text[at + 1 : at + 2].isupper())


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans of sentences; in the first lines a line that ends in a comma or stop is one, as in date and salutation."""
    cuts = {0, len(text)}
    for m in _STOP.finditer(text):
        before = text[m.start() - 1 : m.start()]
        if (before.islower() or before in ")]\"”»") and _begins(text, m.end()):
            word = text[max(0, m.start() - 7) : m.start()].split()
            if not word or word[-1].lower() not in SHORT:
                cuts.add(m.end())
    at = 0
    for _ in range(3):
        m = _FIRST.search(text, at, at + 90)
        if not m or not _begins(text, m.end()):
            break
        cuts.add(m.end())
        at = m.end()
    ordered = sorted(cuts)
    return [(a, b) for a, b in zip(ordered, ordered[1:]) if not text[a:b].isspace()]


def small_words(sentence: str) -> list[str]:
    """Words of a sentence proper: neither names nor letters set apart."""
    return [w for w in sentence.split() if w[0].islower() and w[1:2].isalpha()]


@dataclass(frozen=True)
class Dictionaries:
    content: dict[str, bytes]

    def compressors(self) -> dict[str, zstandard.ZstdCompressor]:
        out = {}
        for code, content in self.content.items():
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            out[code] = zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)
        return out


class Classifier:
    def __init__(self, dictionaries: Dictionaries):
        self.of = dictionaries.compressors()
        self.latin = [c for c in self.of if c not in CYRILLIC_CODES]
        self.cyrillic = [c for c in self.of if c in CYRILLIC_CODES]

    def sizes(self, sentence: str, small: list[str] | None = None) -> dict[str, int]:
        """Bytes of a sentence with each dictionary of its script; none for one without letters."""
        # names are often in the other alphabet, so words in small letters decide
        first = [w[0] for w in small or ()] or [c for c in sentence if c.isalpha()]
        if not first:
            return {}
        cyrillic = 2 * sum("Ѐ" <= c <= "ӿ" for c in first) > len(first)
        raw = sentence.encode("utf-8", "replace")
        return {c: len(self.of[c].compress(raw)) for c in (self.cyrillic if cyrillic else self.latin)}

    def passages(self, text: str) -> list[tuple[int, int, str, float, int, bool]]:
        """(start, end, language, confidence, sentences, rejected) of the passages of one text, in order."""
        spans = sentences(text)
        costs, proper = [], []
        for a, b in spans:
            one = plain(text[a:b])
            small = small_words(one)
            own = self.sizes(one, small)
            proper.append(len(small) >= WORDS)
            folded: dict[str, int] = {}
            for code, n in own.items():
                code = code[:2]
                folded[code] = min(n, folded.get(code, n))
            costs.append(folded)
        if not any(costs):
            return []
        if any(proper):
            costs = [x if p else {} for x, p in zip(costs, proper)]
        # a code of the other script costs as much as the dearest of this one, and more
        codes = sorted({c for x in costs for c in x})
        rows = [[x.get(c, max(x.values(), default=0) + (OTHER_SCRIPT if x else 0)) for c in codes] for x in costs]
        best, back = rows[0][:], []
        for row in rows[1:]:
            low = min(range(len(codes)), key=best.__getitem__)
            step = [i if best[i] <= best[low] + SWITCH else low for i in range(len(codes))]
            back.append(step)
            best = [row[i] + min(best[i], best[low] + SWITCH) for i in range(len(codes))]
        at = min(range(len(codes)), key=best.__getitem__)
        path = [at]
        for step in reversed(back):
            at = step[at]
            path.append(at)
        path.reverse()
        runs: list[list[int]] = []  # code, first, last sentence + 1
        for i, c in enumerate(path):
            if runs and runs[-1][0] == c:
                runs[-1][2] = i + 1
            else:
                runs.append([c, i, i + 1])
        long = lambda r: sum(proper[r[1] : r[2]]) >= PASSAGE
        if any(long(r) for r in runs):
            kept: list[list[int]] = []
            for r in runs:
                if long(r) and not (kept and kept[-1][0] == r[0]):
                    kept.append([r[0], kept[-1][2] if kept else 0, r[2]])
                elif kept:
                    kept[-1][2] = r[2]
            runs = kept
        else:
            total = [sum(row[i] for row in rows) for i in range(len(codes))]
            runs = [[min(range(len(codes)), key=total.__getitem__), 0, len(rows)]]
        out = []
        for c, a, b in runs:
            total = [sum(row[i] for row in rows[a:b]) for i in range(len(codes))]
            margin = min((x for i, x in enumerate(total) if i != c), default=total[c] + 40) - total[c]
            out.append((spans[a][0], spans[b - 1][1], codes[c], round(1 / (1 + math.exp(-margin / 6)), 6), b - a, margin < REJECT))
        return out


def fit(sample: list[tuple[str, str]], rounds: int = 2) -> Dictionaries:
    """Dictionaries from (label, text) pairs, some of them wrong, and the seeds.

    First a sentence counts for its label only if it has more of that language's seed
    words than of any other's; then the passages of each text, found with dictionaries of the other texts,
    say what language their sentences are in.
    """
    halves: list[dict[str, list[str]]] = [{c: [] for c in SEEDS} for _ in (0, 1)]
    common = {c: {w.strip(".,") for w in s.lower().split()} for c, s in SEEDS.items()}
    texts = list(dict.fromkeys(t for _, t in sample))
    label_of = {t: label for label, t in sample}
    for i, text in enumerate(texts):
        for a, b in sentences(text):
            s = plain(text[a:b])
            small = {w.strip(".,;:!?") for w in small_words(s)}
            if len(small) > WORDS:
                met = {c: len(small & own) for c, own in common.items()}
                code = max(met, key=met.__getitem__)
                if code[:2] == label_of[text] and met[code] > max(n for c, n in met.items() if c[:2] != code[:2]):
                    halves[i % 2][code].append(s)
    for _ in range(rounds):
        made = [Classifier(_dictionaries(by, DICTIONARY_BYTES // 2)) for by in halves]
        halves = [{c: [] for c in SEEDS} for _ in (0, 1)]
        for i, text in enumerate(texts):
            own = made[1 - i % 2]
            for start, end, lang, sure, _, _ in own.passages(text):
                for a, b in sentences(text[start:end]) if sure > 0.99 else ():
                    s = plain(text[start + a : start + b])
                    small = small_words(s)
                    sizes = own.sizes(s, small) if len(small) >= WORDS else {}
                    code = min(sizes, key=sizes.__getitem__, default=None)
                    if code and code[:2] == lang:
                        halves[i % 2][code].append(s)
    return _dictionaries({c: [s for pair in zip_longest(halves[0][c], halves[1][c]) for s in pair if s] for c in SEEDS}, DICTIONARY_BYTES)


def _dictionaries(by: dict[str, list[str]], most: int) -> Dictionaries:
    # the seeds come last, where zstandard reaches them cheaply
    return Dictionaries({c: ("\n".join(dict.fromkeys(own)).encode()[-most:] + b"\n" if own else b"") + SEEDS[c].encode() for c, own in by.items()})


def sampled(documents: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, bound: int = SAMPLE_DOCUMENTS) -> list[tuple[str, str]]:
    """At most ``bound`` labelled texts of each language, those with the least hash of the id; only for fitting."""
    noted = labels.where(F.col(label_col).isin(*CODES)).select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).dropna().distinct()
    # a bounded choice of ids first, in one pass, so that no other text is moved; the limit by rank is applied before the shuffle too
    first = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id")
    chosen = noted.withColumn("n", F.row_number().over(first)).where(F.col("n") <= bound).select("id", "label")
    ids = chosen.collect()
    listed = documents.sparkSession.createDataFrame(ids, "id string, label string") if ids else None
    if listed is None:
        return []
    texts = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(listed), "id").where("text is not null")
    return sorted((r["label"], r["text"]) for r in texts.select("id", "label", "text").dropDuplicates(["id"]).collect())


PASSAGES = "array<struct<start:int,end:int,lang:string,confidence:double,sentences:int,rejected:boolean>>"


def passages(documents: DataFrame, dictionaries: Dictionaries, id_col: str = "letter_id", text_col: str = "text") -> DataFrame:
    """(id, passages): the passages of every row in order, with offsets in code points, language and confidence.

    A null or empty text and one without letters have an empty list; a narrow margin is marked as rejected. A text has as many
    rows as it is repeated. One pass, no shuffle; whole texts.
    """
    shared = documents.sparkSession.sparkContext.broadcast(dictionaries)
    kind = documents.schema[id_col].dataType.simpleString()
    item = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64()), ("sentences", pa.int32()), ("rejected", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Classifier(shared.value)
        keys = ("start", "end", "lang", "confidence", "sentences", "rejected")
        for batch in batches:
            found = [[dict(zip(keys, p)) for p in own.passages(t.as_py() or "")] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, item)], ["id", "passages"])

    return documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, passages {PASSAGES}").withColumnRenamed("id", id_col)


def wrong_or_mixed(documents: DataFrame, labels: DataFrame, id_col: str = "letter_id", text_col: str = "text", label_col: str = "lang_label", bound: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """(id, lang): the languages of documents whose label is missing or wrong or whose text has several.

    A label that is none of CODES counts as missing; of two labels of one document
    the first in order of code counts. Rows with a null id or without letters have none.
    """
    dictionaries = fit(sampled(documents, labels, id_col, text_col, label_col, bound))
    found = passages(documents.where(F.col(id_col).isNotNull() & (F.length(text_col) > 0)), dictionaries, id_col, text_col)
    langs = found.select(F.col(id_col).alias("id"), F.array_sort(F.array_distinct(F.col("passages.lang"))).alias("langs")).where("size(langs) > 0").distinct()
    noted = labels.where(F.col(label_col).isin(*CODES)).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("label"))
    wrong = langs.join(noted, "id", "left").where("label is null or size(langs) > 1 or langs[0] <> label")
    return wrong.select(F.col("id").alias(id_col), F.explode("langs").alias("lang")).distinct()
