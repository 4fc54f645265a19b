"""Spellings of persons and organisations linked by merge-and-rematch resolution.

Every distinct name is read as a family name (of an organisation: its proper name) and
what stands beside it: given names in full, familiar forms, abbreviations, initials (of an
organisation: the words of its kind). What is a given name, a family name's ending, a
familiar form or a slip of a given name is told by the corpus' own counts; these tables
meet the words in joins. Names that read alike are one record. Records with
a full given name are profiles; a profile has the spellings and initials of all records
merged into it. In each round every other record, and every profile that may be a slip of
another, is matched to the profiles of its block: the same family name and initial, or
a family name with one letter left out. A record that fits exactly one profile is
merged into it. Where a family name has no profile, its abbreviated records are merged
into the one that says most if all of them may be it. The richer profiles enter the next
round, until a round merges nothing.

All steps are joins on block keys; no block is gathered in one task, and records are
distinct readings, so a name with any number of mentions is one row. The joins are hinted
to merge, as the tables between rounds grow with the data and their files are many times
smaller than their rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.llm.gazetteer import TITLES, frame_stem, known_forms, stem
from quillgraph.llm.nametext import latin, words, written
from quillgraph.session import checkpointed

#: A word beside family names is a given name if it stands beside this many different ones, and beside this share of them at least; bounds the list to 1 / share words.
GIVEN_PARTNERS, GIVEN_SHARE = 3, 2e-4
#: The last letters of a family name stand at the end of names this many times as often as at their beginning, and in this share of names at least; bounds the list to 1 / share endings.
TAIL_RATIO, TAIL_SHARE, TAIL = 2, 1e-3, 2
#: A word is a familiar form of a given name if beside this share of its family names that name stands too.
FAMILIAR_SHARE = 0.3
#: A word is of the kind of an organisation if it stands before as many different last words as this share of names, and three at least.
KIND_SHARE = 0.002
#: A profile that may be a slip of another has not more mentions, at most this part of its or FEW.
SLIP_PART, FEW = 0.6, 6
#: Letters from which a family name is matched with a slip without a full given name.
SHORT_FAMILY = 6


def is_short(word: str) -> bool:
    """Whether a word is an abbreviation; a full stop after a longer word ends the name."""
    return len(word) < 3 or (word.endswith(".") and len(word) < 7)


def _beginning(word: str, exact: str | None = None) -> list[str]:
    """What an abbreviation may stand for: words that begin so, or the word itself; an initial whose accent is known, that letter only."""
    s = word.rstrip(".")
    if len(s) == 1 and exact:
        return [f"{s}^{exact}"]
    return [s, stem(s) + "$"] if len(s) > 3 else [s]


def _addressed(name: str) -> list[str]:
    """Words of a name without titles; a capital G is an initial, a small one is not."""
    said = [w for w in words(name) if w not in ",("]
    capital = "G" in {w.strip(".,;:!?()[]»«„”'") for w in regex.split(r"[\s.]+", latin(name))}
    return [w for w in said if (w.rstrip(".") not in TITLES or (w.rstrip(".") == "g" and capital)) and not w[0].isdigit()]


_OWN = "array<struct<at:int,word:string,stem:string,frame:string,said:string,short:boolean>>"


def _words(names: DataFrame) -> DataFrame:
    """(kind, name, n, own): the words of each name in order, without titles (of an organisation, all words)."""
    item = pa.list_(pa.struct([("at", pa.int32()), ("word", pa.string()), ("stem", pa.string()), ("frame", pa.string()), ("said", pa.string()), ("short", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for kind, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                person = kind == "PER"
                own = _addressed(name) if person else [w for w in words(name) if w not in ",(" and not w[0].isdigit()]
                said = written(name) if person else {}
                out.append([{"at": k, "word": w, "stem": stem(w), "frame": frame_stem(w), "said": said.get(w.rstrip(".")), "short": is_short(w)} for k, w in enumerate(own)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(out, item)], ["kind", "name", "n", "own"])

    # a table of names is small for its work, so it is spread before Python
    spread = names.select("kind", "name", "n").repartition(2 * names.sparkSession.sparkContext.defaultParallelism)
    return spread.mapInArrow(run, f"kind string, name string, n bigint, own {_OWN}")


def read_person(plain: list[dict]) -> tuple[str | None, list[list[str]], str | None]:
    """(family name, alternatives of each word beside it, full given name); an exact word ends in $, an abbreviation doesn't."""
    if not plain:
        return None, [], None

    def family(i: int) -> float:
        w = plain[i]
        if w["short"] or len(w["stem"]) < 3:
            return -5
        score = 2.0 * w["tail"] + 0.1 * min(len(w["stem"]), 20) / 20 + 0.2 * (i == len(plain) - 1)
        return score - 3 if w["given"] or w["fulls"] else score

    at = max(range(len(plain)), key=family)
    if family(at) <= -2:
        return None, [], None
    beside: list[list[str]] = []
    full = None
    for i, x in enumerate(plain):
        if i == at:
            continue
        w, s, said = x["word"], x["stem"], x["said"]
        if x["short"]:
            beside.append(_beginning(w, said))
            continue
        own = s if x["given"] else x["slip"]
        if own:
            full = full or own
            beside.append([own + "$", f"{own[0]}^{said[0]}"] if said else [own + "$"])
        elif x["fulls"]:
            # Mica and Mića are forms of different names; without accents either
            meant = [f["full"] for f in x["fulls"] if not said or not f["said"] or stem(said) == stem(f["said"])] or [f["full"] for f in x["fulls"]]
            # a learnt form, or one without the listed form's ending, may as well be an abbreviation
            cut = len(w) < 6 and all(len(w) < len(short) for short in x["listed"])
            beside.append([s + "$", *(f + "$" for f in dict.fromkeys(sorted(meant))), *([w.rstrip(".")] if cut else [])])
        else:
            beside.append([s + "$", w.rstrip(".")] if len(w) < 6 else [s + "$"])
    return plain[at]["stem"], beside, full


def read_organisation(plain: list[dict]) -> tuple[str | None, list[list[str]], str | None]:
    """Like ``read_person``, of the proper name and the words of kind; all words of kind in full make it full."""
    proper = [w for w in plain if not w["short"] and len(w["word"]) > 3 and not w["kind"]]
    if not proper:
        return None, [], None
    own = max(proper, key=lambda w: len(w["word"]))
    beside, exact = [], []
    for w in plain:
        if w is own:
            continue
        if w["kind"]:
            beside.append([w["frame"] + "$"])
            exact.append(w["frame"])
        else:
            beside.append(_beginning(w["word"]))
    full = " ".join(sorted(set(exact))) if len(set(exact)) > 1 and len(exact) == len(beside) else None
    return own["stem"], beside, full


def _tails(said: DataFrame) -> list[str]:
    """Endings that family names have and given names have not: what stands at the end of names far more often than at their beginning."""
    full = said.where("kind = 'PER'").select(F.filter("own", lambda w: ~w["short"]).alias("own")).where("size(own) > 1")
    ends = full.select(F.explode(F.array(F.struct(F.get("own", F.lit(0))["stem"].alias("s"), F.lit(0).alias("last")), F.struct(F.get("own", F.size("own") - 1)["stem"].alias("s"), F.lit(1).alias("last")))).alias("e"))
    counted = ends.groupBy(F.expr(f"right(e.s, {TAIL})").alias("tail")).agg(F.sum("e.last").alias("last"), F.sum(1 - F.col("e.last")).alias("first"))
    total = full.count()
    return sorted(r["tail"] for r in counted.where((F.col("last") >= TAIL_RATIO * F.col("first")) & (F.col("last") >= max(2, TAIL_SHARE * total))).collect())


def _beside(said: DataFrame, tails: list[str]) -> DataFrame:
    """(kind, word, partner): words beside each other in distinct names: a person's words and the family name, an organisation's words and the last."""
    full = said.select("kind", F.filter("own", lambda w: ~w["short"]).alias("own"))
    families = F.filter("own", lambda w: F.substring(w["stem"], -TAIL, TAIL).isin(tails))
    persons = full.where("kind = 'PER'").withColumn("partner", F.get(families, F.size(families) - 1)["stem"]).where("partner is not null")
    persons = persons.select("kind", F.explode(F.transform("own", lambda w: w["stem"])).alias("word"), "partner").where("word <> partner")
    last = F.get("own", F.size("own") - 1)["word"]
    # a word of the kind stands before many proper names, a proper name before few words
    others = full.where("kind <> 'PER' and size(own) > 1").select("kind", F.explode(F.transform(F.slice("own", 1, F.size("own") - 1), lambda w: w["frame"])).alias("word"), last.alias("partner"))
    return persons.unionByName(others)


def _familiar(beside: DataFrame, given: DataFrame) -> DataFrame:
    """(short, full): familiar forms that the list of forms lacks: a word that stands beside family names beside which one other, more usual name stands too, three times as often as any third."""
    pairs = beside.where("kind = 'PER'").select("word", "partner").distinct()
    short = pairs.groupBy("word").agg(F.count("*").alias("k")).where(F.col("k") >= 2)
    both = pairs.join(short, "word").alias("a").join(pairs.join(given, "word").alias("b"), "partner").where((F.col("a.word") != F.col("b.word")) & (F.col("b.families") >= 2 * F.col("a.k")))
    shared = both.groupBy(F.col("a.word").alias("short"), F.col("b.word").alias("full"), F.col("a.k").alias("k")).agg(F.count("*").alias("c"))
    shared = shared.where((F.col("c") >= F.greatest(F.lit(2), F.lit(FAMILIAR_SHARE) * F.col("k"))) & ((F.col("c") > 2) | (F.substring("short", 1, 1) == F.substring("full", 1, 1))) & ~_slip(F.col("short"), F.col("full")))
    best = Window.partitionBy("short").orderBy(F.desc("c"), F.desc("full"))
    ranked = shared.withColumn("second", F.lead("c").over(best)).withColumn("at", F.row_number().over(best))
    return ranked.where((F.col("at") == 1) & (F.col("second").isNull() | (F.col("c") >= 3 * F.col("second")))).select("short", "full")


def _vocabulary(said: DataFrame, forms: DataFrame) -> tuple[list[str], list[str], DataFrame, DataFrame]:
    """(endings of family names, words of kind, given names (stem), familiar forms (stem, fulls, listed)) over the whole corpus; the lists are bounded by the shares above."""
    tails = _tails(said)
    beside = checkpointed(_beside(said, tails))
    totals = {r["kind"]: r["n"] for r in said.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    least = F.when(F.col("kind") == "PER", max(GIVEN_PARTNERS, GIVEN_SHARE * totals.get("PER", 0))).otherwise(max(3, KIND_SHARE * totals.get("ORG", 0)))
    usual = checkpointed(beside.groupBy("kind", "word").agg(F.count_distinct("partner").alias("families")).where(F.col("families") >= least))
    kinds = sorted(r["word"] for r in usual.where("kind = 'ORG'").select("word").collect())
    known = checkpointed(known_forms(forms))
    listed = known.select(F.col("short").alias("word")).distinct()
    given = usual.where("kind = 'PER' and length(word) > 2").join(listed, "word", "left_anti").select("word", "families")
    learnt = checkpointed(_familiar(beside, given))
    every = known.select("short", "said", F.col("full_name").alias("full"), F.lit(True).alias("listed")).unionByName(learnt.select("short", F.col("short").alias("said"), "full", F.lit(False).alias("listed")))
    familiar = every.groupBy(F.col("short").alias("stem")).agg(F.collect_set(F.struct("said", "full")).alias("fulls"), F.collect_set(F.when(F.col("listed"), F.col("said"))).alias("listed"))
    names = given.select(F.col("word").alias("stem")).join(learnt.select(F.col("short").alias("stem")), "stem", "left_anti").unionByName(known.select(F.col("full_name").alias("stem"))).distinct()
    return tails, kinds, checkpointed(names), checkpointed(familiar)


def _slips_of(stems: DataFrame, given: DataFrame) -> DataFrame:
    """(stem, slip): the given name that a stem is one slip from, if it is only one; they meet in blocks of a letter left out."""
    asked = stems.where(F.length("stem") >= 5).select("stem", F.explode(_shortened(F.col("stem"))).alias("block"))
    named = given.where(F.length("stem") > 3).select(F.col("stem").alias("slip"), F.explode(_shortened(F.col("stem"))).alias("block"))
    met = asked.join(named, "block").where(_slip(F.col("stem"), F.col("slip"))).select("stem", "slip").distinct()
    return met.groupBy("stem").agg(F.count("*").alias("k"), F.min("slip").alias("slip")).where("k = 1").select("stem", "slip")


def readings(said: DataFrame, forms: DataFrame) -> DataFrame:
    """(kind, name, n, family, beside, full, form) of each distinct name, from ``_words``; names with equal form read alike."""
    tails, kinds, given, familiar = _vocabulary(said, forms)
    each = said.select("kind", "name", "n", F.explode_outer("own").alias("w"))
    person = F.col("kind") == "PER"
    known = given.withColumn("given", F.lit(True)).join(familiar, "stem", "full")
    # what a stem is, once for each stem; a stem that is neither may be a slip
    stems = each.where(person).select(F.col("w.stem").alias("stem")).dropna().distinct()
    new = stems.join(known.select("stem"), "stem", "left_anti")
    known = checkpointed(known.unionByName(_slips_of(new, given), allowMissingColumns=True))
    each = each.join(known.withColumn("_kind", F.lit("PER")), (F.col("w.stem") == F.col("stem")) & (F.col("kind") == F.col("_kind")), "left")
    no = F.lit(False)
    word = F.struct("w.at", "w.word", "w.stem", "w.frame", "w.said", "w.short", F.coalesce("given", no).alias("given"), F.substring("w.stem", -TAIL, TAIL).isin(tails).alias("tail"), F.col("w.frame").isin(kinds).alias("kind"), "fulls", "listed", "slip")
    whole = each.groupBy("kind", "name", "n").agg(F.array_sort(F.collect_list(F.when(F.col("w").isNotNull(), word))).alias("own"))
    out = "kind string, name string, n bigint, family string, beside array<array<string>>, full string, form string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.string())), pa.string(), pa.string()]
        for batch in batches:
            rows = []
            for kind, name, n, own in zip(*(c.to_pylist() for c in batch.columns)):
                family, beside, full = (read_person if kind == "PER" else read_organisation)(own)
                if family is None:
                    form = f"{kind}|?|" + " ".join(w.rstrip(".") for w in words(name)) if words(name) else f"{kind}|?|{name}"
                else:
                    beside = sorted({tuple(b) for b in beside})
                    form = f"{kind}|{family}|" + " ".join("/".join(b) for b in beside)
                rows.append((kind, name, n, family, [list(b) for b in beside], full, form))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(fields)], ["kind", "name", "n", "family", "beside", "full", "form"])

    # given a number, as a table of names is small for its work
    return whole.repartition(2 * said.sparkSession.sparkContext.defaultParallelism).mapInArrow(run, out)


def _fits(beside: Column, givens: Column) -> Column:
    """Whether every word beside a record's family name may be one of a profile's: the same, or its beginning."""
    return F.forall(beside, lambda word: F.exists(word, lambda a: F.exists(givens, lambda g: g.startswith(a))))


def _slip(a: Column, b: Column) -> Column:
    """One letter too many, too few or wrong, or two neighbours that changed places."""
    swapped = (F.length(a) == F.length(b)) & (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, "")))
    d = F.levenshtein(a, b)
    return (d == 1) | ((d == 2) & swapped)


def _shortened(family: Column) -> Column:
    """A family name and the same with each letter left out in turn."""
    left_out = F.transform(F.sequence(F.lit(1), F.length(family)), lambda i: F.concat(F.substring(family, F.lit(1), i - 1), F.substring(family, i + 1, F.length(family))))
    return F.array_distinct(F.concat(F.array(family), left_out))


def resolve(read: DataFrame) -> DataFrame:
    """(form, entity): the entity of each form, from ``readings``.

    A round moves records to profiles, or to the richest record of their family, and
    profiles to profiles of more mentions, of equals to the first by name, so moves make no circle: the last of every chain
    has a target that stays. Each round therefore has fewer entities than the one before,
    and the rounds end.
    """
    forms = read.groupBy("form").agg(F.first("kind").alias("kind"), F.first("family").alias("family"), F.first("beside").alias("beside"), F.first("full").alias("full"), F.sum("n").alias("n"))
    # what reads as the same full name is one profile from the start, familiar forms beside it or not
    start = F.when(F.col("full").isNotNull(), F.concat_ws("|", "kind", "family", F.lit("="), "full")).otherwise(F.col("form"))
    state = checkpointed(forms.withColumn("entity", start))
    while True:
        known = _known(state)
        moves = checkpointed(_round(known))
        if moves.isEmpty():
            # what is without a profile still is looked at when no profile takes in anything more
            moves = checkpointed(_among_themselves(known))
            if moves.isEmpty():
                break
        # what would move to a profile that moves itself waits for the next round
        moves = moves.join(moves.select(F.col("entity").alias("to")).hint("merge"), "to", "left_anti")
        state = checkpointed(state.join(moves.hint("merge"), "entity", "left").withColumn("entity", F.coalesce("to", "entity")).drop("to"))
    return state.select("form", "entity")


def _known(state: DataFrame) -> DataFrame:
    """Entities by family name: what they are called, what a record asks for, and of how many profiles (k) the family name is, the least of them (only)."""
    exact = F.flatten(F.transform("beside", lambda w: F.filter(w, lambda a: a.endswith("$") | a.contains("^"))))
    # of a record without a full name only the form itself is a spelling, not all it may stand for
    spelled = F.when(F.col("full").isNull(), F.transform(F.filter("beside", lambda w: w[0].endswith("$")), lambda w: w[0])).otherwise(exact)
    fewest = F.max_by("beside", F.when(F.col("full").isNotNull(), -1).otherwise(F.size("beside")))
    named = state.where("family is not null").groupBy("entity").agg(F.first("kind").alias("kind"), F.collect_set("family").alias("families"), F.array_distinct(F.flatten(F.collect_list(spelled))).alias("givens"), F.max("full").alias("full"), F.sum("n").alias("n"), fewest.alias("beside"))
    # a profile is matched by its full name only, an organisation's by all words of its kind
    own = F.when(F.col("kind") == "ORG", F.transform(F.split("full", " "), lambda w: F.array(F.concat(w, F.lit("$"))))).otherwise(F.array(F.array(F.concat("full", F.lit("$")))))
    named = named.withColumn("beside", F.when(F.col("full").isNotNull(), own).otherwise(F.col("beside"))).withColumn("family", F.explode("families")).drop("families")
    alone = named.where("full is not null").groupBy("kind", "family").agg(F.count_distinct("entity").alias("k"), F.min("entity").alias("only"))
    return checkpointed(named.join(alone.hint("merge"), ["kind", "family"], "left"))


def _round(known: DataFrame) -> DataFrame:
    """(entity, to): what this round may merge into profiles."""
    initial = lambda words_: F.explode(F.array_distinct(F.transform(words_, lambda g: F.substring(g, 1, 1))))
    profiles = known.where("full is not null")
    # the family name alone, where only one profile has it; counted, not paired. A capital G may be a title at a sentence's start
    title = F.coalesce((F.size("beside") == 1) & F.try_element_at(F.try_element_at("beside", F.lit(1)), F.lit(1)).isin("g", "g^g"), F.lit(False))
    bare = known.where(F.col("full").isNull() & ((F.size("beside") == 0) | title) & (F.col("k") == 1)).select("entity", F.col("only").alias("to"), F.lit(True).alias("same"))
    # a block is an initial and a family name, or that with one letter left out: in it are the same names and those one slip apart
    target = profiles.select(F.col("entity").alias("to"), "kind", F.col("family").alias("to_family"), F.col("n").alias("m"), "givens", initial(F.col("givens")).alias("initial")).withColumn("block", F.explode(_shortened(F.col("to_family"))))
    asked = known.where("size(beside) > 0").select("entity", "kind", "family", "n", "full", "k", "beside", initial(F.col("beside")[0]).alias("initial")).withColumn("block", F.explode(_shortened(F.col("family"))))
    met = asked.join(target.hint("merge"), ["kind", "initial", "block"]).where((F.col("entity") != F.col("to")) & _fits(F.col("beside"), F.col("givens")))
    same = (F.col("family") == F.col("to_family")) & F.col("full").isNull()
    # a slip has fewer mentions than what it is a slip of, unless no profile has its family name; of two as rare either may be the slip
    fewer = (((F.col("n") < F.col("m")) | ((F.col("n") == F.col("m")) & F.col("full").isNotNull() & (F.col("entity") > F.col("to")))) & (F.col("n") <= F.greatest(F.lit(FEW), SLIP_PART * F.col("m")))) | (F.col("full").isNull() & F.col("k").isNull())
    # relatives may share a misspelled family name: a full name is judged by itself, and it fits what has the same given name. Two short names are often one slip apart, so they need it
    given = F.col("full").isNotNull()
    short = F.greatest(F.length("family"), F.length("to_family")) < SHORT_FAMILY
    slip = (F.col("family") != F.col("to_family")) & (given | ((F.coalesce("k", F.lit(0)) <= 1) & ~short)) & fewer & _slip(F.col("family"), F.col("to_family"))
    pairs = met.where(same | slip).select("entity", "to", same.alias("same")).unionByName(bare)
    chosen = pairs.groupBy("entity").agg(F.collect_set(F.when(F.col("same"), F.col("to"))).alias("equal"), F.collect_set(F.when(~F.col("same"), F.col("to"))).alias("slips"))
    chosen = chosen.withColumn("may", F.when(F.size("equal") > 0, F.col("equal")).otherwise(F.col("slips")))
    return chosen.where("size(may) = 1").select("entity", F.col("may")[0].alias("to"))


def _among_themselves(known: DataFrame) -> DataFrame:
    """(entity, to): records of a family name without a profile, and the one of them that says most, if all the others may be it."""
    open_ = known.where("full is null and k is null")
    says = F.aggregate("beside", F.lit(0), lambda n, w: n + F.length(w[0]))
    block = ["kind", "family"]
    richest = open_.groupBy(*block).agg(F.count("*").alias("_records"), F.max_by(F.struct(F.col("entity").alias("to"), F.transform("beside", lambda w: w[0]).alias("words")), F.struct(says, "n", "entity")).alias("_r")).where("_records > 1").select(*block, "_r.*")
    met = open_.join(richest.hint("merge"), block).withColumn("_fits", (F.col("entity") == F.col("to")) | _fits(F.col("beside"), F.col("words")))
    agreed = met.groupBy(*block).agg(F.min("_fits").alias("_all")).where("_all").select(*block)
    return met.join(agreed.hint("merge"), block, "left_semi").where("entity <> to").groupBy("entity").agg(F.min("to").alias("to"))


def distinct_names(mentions: DataFrame, recipients: DataFrame) -> DataFrame:
    """(kind, name, n): each distinct name once; one found as person and organisation is what it is more often."""
    found = mentions.where(F.col("label").isin("PER", "ORG") & F.col("text").isNotNull()).groupBy(F.col("label").alias("kind"), F.col("text").alias("name")).agg(F.count("*").alias("n"))
    typed = recipients.where(F.length("recipient") > 0).groupBy(F.col("recipient").alias("name")).agg(F.count("*").alias("n")).select(F.lit("PER").alias("kind"), "name", "n")
    every = found.unionByName(typed).groupBy("kind", "name").agg(F.sum("n").alias("n"))
    return every.groupBy("name").agg(F.max_by("kind", F.struct("n", "kind")).alias("kind"), F.sum("n").alias("n")).select("kind", "name", "n")


def entities(mentions: DataFrame, recipients: DataFrame, forms: DataFrame) -> DataFrame:
    """(name, entity): every distinct name of a person or organisation and the entity it stands for.

    Null and empty names are left out; a name without a letter is an entity of its own
    spelling; a name that fits several profiles stays by itself.
    """
    names = distinct_names(mentions, recipients)
    read = checkpointed(readings(checkpointed(_words(names)), forms))
    return read.select("name", "form").join(resolve(read).hint("merge"), "form").select("name", "entity")


def variant_pairs(named: DataFrame) -> DataFrame:
    """(name_a, name_b): all pairs of different names of one entity, name_a < name_b."""
    a, b = named.select("entity", F.col("name").alias("name_a")), named.select("entity", F.col("name").alias("name_b"))
    return a.join(b.hint("merge"), "entity").where("name_a < name_b").select("name_a", "name_b")
