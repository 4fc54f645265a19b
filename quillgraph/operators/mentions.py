"""Mentions: from taggers, merged, cleaned and deduplicated."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.dimensions import DROPPED_PARTS, DROPPED_SURFACES, FUSED_PAIRS, SPAN_LABELS, TAGGER_LABELS
from quillgraph.functions.dates import date_spans
from quillgraph.functions.spans import matches
from quillgraph.functions.text import aliased, canonical, canonical_composed, surface

DATE_MODEL = "rule-based-date-v1"
KEY = ["letter_id", "text", "label", "start", "end", "model"]


class Extractor(Protocol):
    """Anything that makes mentions (letter_id, text, label, start, end, score, model) of letters (letter_id, text)."""

    def __call__(self, letters: DataFrame) -> DataFrame: ...


def date_mentions(letters: DataFrame) -> DataFrame:
    """Mentions of dates by rule, score 1; the text is in label form, a date over a line end on one line."""
    found = letters.where("text is not null").select("letter_id", F.explode(date_spans("text")).alias("s"))
    return found.select("letter_id", canonical_composed("s.text").alias("text"), F.lit("DATE").alias("label"), "s.start", "s.end", F.lit(1.0).alias("score"), F.lit(DATE_MODEL).alias("model"))


def gazetteer_mentions(letters: DataFrame, dictionary: DataFrame, model: str = "gazetteer-v1") -> DataFrame:
    """Mentions of single words that a dictionary (label, type) lists, with their offsets; a model-free extractor.

    The words of the texts meet the dictionary in a join, so neither side is bounded.
    """
    words = letters.where("text is not null").select("letter_id", F.explode(matches("text", r"(?U)[\p{L}\p{M}]+")).alias("w")).select("letter_id", "w.*")
    listed = dictionary.select("label", "type").dropna().distinct()
    return words.join(listed, F.col("text") == F.col("label")).select("letter_id", "text", F.col("type").alias("label"), "start", "end", F.lit(1.0).alias("score"), F.lit(model).alias("model"))


def tagger_mentions(raw: DataFrame, letters: DataFrame, min_score: float, model: str, span_model: bool = False) -> DataFrame:
    """Mentions of raw tagger output (letter_id, ordinal, word, tag, start, end, score) over the letters' text.

    The tag is mapped, an unknown one passes; the text is the letter's between valid
    offsets, else the word without continuation marks; texts of less than two characters and,
    but for span models, scores below the least are left out.
    """
    labels = SPAN_LABELS if span_model else TAGGER_LABELS
    table = F.create_map(*[F.lit(x) for p in labels.items() for x in p])
    tag = F.coalesce(F.nullif(F.col("tag"), F.lit("")), F.lit("MISC"))
    tag = F.lower(tag) if span_model else F.upper(tag)
    joined = raw.join(letters.select("letter_id", F.col("text").alias("_text")), "letter_id", "left")
    valid = (F.col("start") >= 0) & (F.col("end") > F.col("start")) & (F.col("end") <= F.length("_text"))
    said = F.when(valid, F.substring(F.col("_text"), F.col("start") + 1, F.col("end") - F.col("start"))).otherwise(F.replace(F.col("word"), F.lit("##"), F.lit("")))
    out = joined.select("letter_id", "ordinal", canonical(said).alias("text"), F.coalesce(F.try_element_at(table, tag), F.upper(tag)).alias("label"), "start", "end", "score", F.lit(model).alias("model"))
    out = out.where("length(text) >= 2")
    return out if span_model else out.where(F.col("score") >= min_score)


def merged_in_model_order(pieces: DataFrame) -> DataFrame:
    """Continuation pieces put to what stands right before them in model order: same label, end and start the same.

    (letter_id, ordinal, word, tag, start, end, score); the end is the last piece's, the score the least.
    """
    w = Window.partitionBy("letter_id").orderBy("ordinal")
    joins = F.col("word").startswith("##") & (F.lag("tag").over(w) == F.col("tag")) & (F.lag("end").over(w) == F.col("start"))
    run = pieces.withColumn("_new", F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1)).withColumn("_run", F.sum("_new").over(w))
    parts = F.array_sort(F.collect_list(F.struct("ordinal", "word", "end")))
    return run.groupBy("letter_id", "_run").agg(F.min("ordinal").alias("ordinal"), F.array_join(F.transform(parts, lambda x, i: F.when(i == 0, x["word"]).otherwise(F.regexp_replace(x["word"], r"^##", ""))), "").alias("word"), F.min_by("tag", "ordinal").alias("tag"), F.min_by("start", "ordinal").alias("start"), F.max_by("end", "ordinal").alias("end"), F.min("score").alias("score")).drop("_run")


def merged_pieces(mentions: DataFrame, gap: int = 2) -> DataFrame:
    """Continuation pieces put to the run before them, in order of offsets.

    A piece beginning with ## joins if letter, label and model are the same and it starts at
    most ``gap`` after the run's end, which is the greatest end so far; a date breaks a run
    and stays. The score is the least. Ends are not before starts. Rows of a letter are in one
    order; only the pieces of one run are gathered.
    """
    rows = mentions.where("letter_id is not null")
    letter = Window.partitionBy("letter_id").orderBy("start", "end", "ordinal", "text", "label", "score", "model")
    no = F.lit(False)
    # what may join what is right before it; from the last row that may not, the greatest end is the run's, as a run that breaks by its gap ends before all that follows
    may = F.coalesce(F.col("text").startswith("##") & (F.col("label") != "DATE") & (F.lag("label").over(letter) == F.col("label")) & F.lag("model").over(letter).eqNullSafe(F.col("model")) & F.lag(F.lit(True)).over(letter), no)
    rows = rows.withColumn("_may", may).withColumn("_block", F.sum(F.when(F.col("_may"), 0).otherwise(1)).over(letter))
    before = Window.partitionBy("letter_id", "_block").orderBy("start", "end", "ordinal", "text", "label", "score", "model").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_joins", F.coalesce(F.col("_may") & (F.col("start") <= F.max("end").over(before) + gap), no))
    rows = rows.withColumn("_at", F.row_number().over(letter)).withColumn("_run", F.sum(F.when(F.col("_joins"), 0).otherwise(1)).over(letter))
    parts = F.array_sort(F.collect_list(F.struct("_at", "text")))
    text = F.array_join(F.transform(parts, lambda x, i: F.when(i == 0, x["text"]).otherwise(F.regexp_replace(x["text"], "^##", ""))), "")
    first = lambda c: F.min_by(c, "_at").alias(c)
    # a letter's rows are where the order put them
    return rows.groupBy("letter_id", "_run").agg(first("ordinal"), F.when(F.max(F.col("text").isNotNull()), text).alias("text"), first("label"), first("start"), F.max("end").alias("end"), F.min("score").alias("score"), first("model")).drop("_run")


def without_contained_dates(mentions: DataFrame) -> DataFrame:
    """Mentions without those dates that lie in a longer date of the same letter.

    The dates of a letter meet as one array, so a date is compared with those of its own
    letter only; all else passes by.
    """
    dates = mentions.where("label = 'DATE' and letter_id is not null and start is not null and end is not null")
    longer = dates.groupBy("letter_id").agg(F.collect_set(F.struct("start", "end", F.length("text").alias("size"))).alias("_dates"))
    inside = F.exists("_dates", lambda y: (y["start"] <= F.col("start")) & (y["end"] >= F.col("end")) & (y["size"] > F.length("text")))
    return mentions.join(longer, "letter_id", "left").where(~F.coalesce((F.col("label") == "DATE") & inside, F.lit(False))).drop("_dates")


def keeps(text: Column, label: Column, dropped: list[str] | None = None, parts: list[str] | None = None) -> Column:
    """Whether a cleaned surface stays: not listed, no listed part, longer than two if a name."""
    exact = text.isin(DROPPED_SURFACES if dropped is None else dropped)
    holds = F.lit(False)
    for p in DROPPED_PARTS if parts is None else parts:
        holds = holds | text.contains(p)
    return ~exact & ~holds & ~(label.isin("PER", "LOC", "ORG") & (F.length(text) <= 2)) & ~text.startswith("##")


def split_merged(mentions: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Places that were tagged as one, one row each: listed fused pairs, and names around a spaced dash, split at every dash."""
    place = F.col("label") == "LOC"
    fused = F.lit(None).cast("array<struct<text:string,start:int,end:int>>")
    for whole, (a, b) in FUSED_PAIRS.items():
        cut = F.col("start") + len(a)
        both = F.array(F.struct(F.lit(a).alias("text"), F.col("start").alias("start"), cut.alias("end")), F.struct(F.lit(b).alias("text"), cut.alias("start"), F.col("end").alias("end")))
        fused = F.when(place & (F.col("text") == whole), both).otherwise(fused)
    parts = F.transform(
        matches("text", "[^–—-]+"),
        lambda m: F.struct(surface(m["text"]).alias("clean"), (F.col("start") + m["start"] + F.length(m["text"]) - F.length(F.regexp_replace(m["text"], r"(?U)^\s+", ""))).alias("at")),
    )
    dashed = F.transform(F.filter(parts, lambda p: p["clean"] != ""), lambda p: F.struct(aliased(p["clean"], aliases or {}).alias("text"), p["at"].alias("start"), (p["at"] + F.length(p["clean"])).alias("end")))
    same = F.array(F.struct("text", "start", "end"))
    pieces = F.when(fused.isNotNull(), fused).when(place & F.col("text").rlike(r"(?U)\s+[–—-]\s+"), dashed).otherwise(same)
    rest = [c for c in mentions.columns if c not in ("text", "start", "end")]
    return mentions.withColumn("_p", F.explode(pieces)).select(*rest, "_p.text", "_p.start", "_p.end")


def first_of_each(rows: DataFrame, key: list[str], order: str = "ordinal") -> DataFrame:
    """The first row of each key, by an order that is kept."""
    w = Window.partitionBy(*key).orderBy(order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def cleaned(mentions: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Mentions as they go into the graph: merged, without contained dates, cleaned, dropped, aliased, split, each once.

    Mentions with a null letter or offset have no place in a letter: they are neither merged
    nor contained, and go through all else. Nulls are the same in what comes out once.
    """
    placed = F.col("letter_id").isNotNull() & F.col("start").isNotNull() & F.col("end").isNotNull()
    merged = without_contained_dates(merged_pieces(mentions.where(placed)))
    rows = merged.unionByName(mentions.where(~placed).select(*merged.columns)).withColumn("text", surface("text"))
    rows = rows.where(keeps(F.col("text"), F.col("label"))).withColumn("text", aliased("text", aliases or {}))
    return first_of_each(split_merged(rows, aliases), KEY)


def recognised(letters: DataFrame, extractors: list[Extractor]) -> DataFrame:
    """The mentions of all extractors, each once, in the order of extractors and offsets."""
    every = None
    for k, extract in enumerate(extractors):
        one = extract(letters).select("letter_id", "text", "label", "start", "end", "score", "model", F.lit(k).alias("_by"))
        every = one if every is None else every.unionByName(one)
    w = Window.partitionBy("letter_id", "text", "label", "start", "end").orderBy("_by", "model")
    return every.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_by")
