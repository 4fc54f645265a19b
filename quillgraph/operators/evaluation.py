"""Recognition and links scored against gold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NER_TYPES = ("PER", "LOC", "ORG", "MISC")
NEL_TYPES = ("PER", "LOC", "ORG")
MICRO = "micro avg."


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _scores(df: DataFrame) -> DataFrame:
    p, r = _ratio(F.col("correct"), F.col("predicted")), _ratio(F.col("correct"), F.col("gold"))
    df = df.withColumns({"precision": p, "recall": r})
    return df.withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def counter(rows: DataFrame, types: tuple[str, ...] = NER_TYPES) -> DataFrame:
    """(letter_id, text, label, n): mentions as a multiset, spans not regarded."""
    named = rows.select("letter_id", F.regexp_replace("text", r"(?U)^\s+|\s+$", "").alias("text"), F.upper(F.trim("label")).alias("label")).where(F.col("label").isin(*types) & (F.col("text") != ""))
    return named.groupBy("letter_id", "text", "label").agg(F.count("*").alias("n"))


def _both(gold: DataFrame, predicted: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """(letter_id, text, label, g, p): how often each is in either; both sides in one aggregate, without a join."""
    sides = counter(gold, types).withColumn("p", F.lit(0).cast("bigint")).withColumnRenamed("n", "g").unionByName(counter(predicted, types).withColumn("g", F.lit(0).cast("bigint")).withColumnRenamed("n", "p"))
    return sides.groupBy("letter_id", "text", "label").agg(F.sum("g").alias("g"), F.sum("p").alias("p"))


def ner_metrics(gold: DataFrame, predicted: DataFrame, types: tuple[str, ...] = NER_TYPES) -> DataFrame:
    """(type, gold, predicted, correct, precision, recall, f1): a row for each type, met or not, and the micro average."""
    found = _both(gold, predicted, types).groupBy("label").agg(F.sum("g").alias("gold"), F.sum("p").alias("predicted"), F.sum(F.least("g", "p")).alias("correct"))
    listed = gold.sparkSession.createDataFrame([(t,) for t in types], "label string")
    full = listed.join(found, "label", "left").na.fill(0)
    summed = full.groupingSets([["label"], []], "label").agg(*[F.sum(c).alias(c) for c in ("gold", "predicted", "correct")])
    return _scores(summed.select(F.coalesce("label", F.lit(MICRO)).alias("type"), "gold", "predicted", "correct"))


def ner_errors(gold: DataFrame, predicted: DataFrame, types: tuple[str, ...] = NER_TYPES) -> DataFrame:
    """(error_type, letter_id, text, label, n): what one side has more often than the other."""
    both = _both(gold, predicted, types)
    kinds = F.explode(F.array(F.struct(F.lit("FN").alias("error_type"), (F.col("g") - F.col("p")).alias("n")), F.struct(F.lit("FP").alias("error_type"), (F.col("p") - F.col("g")).alias("n"))))
    return both.select("letter_id", "text", "label", kinds.alias("e")).select("e.error_type", "letter_id", "text", "label", "e.n").where("n > 0")


def link_map(rows: DataFrame) -> DataFrame:
    """(key, type, uri): the link of each small-letter label and type, of several the last."""
    named = rows.where("wikidata_uri is not null and wikidata_uri <> ''").select(F.lower(F.trim("label")).alias("key"), F.upper(F.trim("type")).alias("type"), F.col("wikidata_uri").alias("uri"), "ordinal")
    return named.groupBy("key", "type").agg(F.max_by("uri", "ordinal").alias("uri"))


def _links(gold: DataFrame, system: DataFrame) -> DataFrame:
    """(key, type, g, s): the links of either side."""
    sides = link_map(gold).select("key", "type", F.col("uri").alias("g"), F.lit(None).cast("string").alias("s")).unionByName(link_map(system).select("key", "type", F.lit(None).cast("string").alias("g"), F.col("uri").alias("s")))
    return sides.groupBy("key", "type").agg(F.max("g").alias("g"), F.max("s").alias("s"))


def nel_metrics(gold: DataFrame, system: DataFrame) -> DataFrame:
    """(type, gold, predicted, correct, precision, recall, f1, accuracy): for three types, and over all; accuracy is correct over keys of either side."""
    per = _links(gold, system).groupBy("type").agg(F.count("g").alias("gold"), F.count("s").alias("predicted"), F.sum(F.coalesce((F.col("g") == F.col("s")).cast("bigint"), F.lit(0))).alias("correct"), F.count("*").alias("keys"))
    listed = gold.sparkSession.createDataFrame([(t,) for t in NEL_TYPES], "type string")
    micro = per.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("gold", "predicted", "correct", "keys")]).select(F.lit(MICRO).alias("type"), "*")
    rows = listed.join(per, "type", "left").na.fill(0).unionByName(micro)
    return _scores(rows).withColumn("accuracy", _ratio(F.col("correct"), F.col("keys"))).drop("keys")


def nel_errors(gold: DataFrame, system: DataFrame) -> DataFrame:
    """(error_type, label, type, wikidata_uri): links only gold has (FN) and only the system has (FP), by label, type and URI."""
    pairs = _links(gold, system).where("g is distinct from s")
    kinds = F.explode(F.array(F.struct(F.lit("FN").alias("error_type"), F.col("g").alias("wikidata_uri")), F.struct(F.lit("FP").alias("error_type"), F.col("s").alias("wikidata_uri"))))
    return pairs.select(F.col("key").alias("label"), "type", kinds.alias("e")).select("e.error_type", "label", "type", "e.wikidata_uri").where("wikidata_uri is not null")


def coverage(gold: DataFrame, system: DataFrame) -> DataFrame:
    """(coverage): rows of the system over rows of gold, linked or not."""
    return system.agg(F.count("*").alias("s")).crossJoin(gold.agg(F.count("*").alias("g"))).select(_ratio(F.col("s"), F.col("g")).alias("coverage"))


def formatted(metrics: DataFrame) -> DataFrame:
    """Metrics as they are written: ratios with three decimals."""
    return metrics.select(*[F.format_string("%.3f", c).alias(c) if t == "double" else F.col(c) for c, t in metrics.dtypes])


def label_histogram(mentions: DataFrame) -> DataFrame:
    """(label, n): labels by frequency."""
    return mentions.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label")
