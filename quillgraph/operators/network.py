"""The network of letters and entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.functions.text import safe


def edges(mentions: DataFrame, entities: DataFrame) -> DataFrame:
    """(source, target, source_type, target_type, weight): letters to what they mention, by number of mentions.

    The type is that of the entity table's last row with exactly this label, else the
    mention's own. Mentions are counted before the look-up, so a name met a billion times is
    looked up once a letter.
    """
    counted = mentions.select(safe("letter_id").alias("source"), safe("text").alias("target"), safe("label").alias("own")).where("source <> '' and target <> ''").groupBy("source", "target", "own").agg(F.count("*").alias("n"))
    types = entities.groupBy(safe("label").alias("target")).agg(F.max_by(safe("type"), "ordinal").alias("listed"))
    typed = counted.join(types, "target", "left").withColumn("target_type", F.coalesce(F.nullif("listed", F.lit("")), F.nullif("own", F.lit("")), F.lit("ENTITY")))
    return typed.groupBy("source", "target", F.lit("LETTER").alias("source_type"), "target_type").agg(F.sum("n").alias("weight"))


def sorted_edges(network: DataFrame) -> DataFrame:
    return network.orderBy("source", "target", "source_type", "target_type", "weight")


def nodes(network: DataFrame, base_size: int = 1100) -> DataFrame:
    """(node, node_type, degree, row_degree, size, html_size) of (ordinal, source, target, source_type, target_type, weight).

    degree counts distinct neighbours and goes with the type of a node's last row; row_degree
    counts rows and gives the size on the page.
    """
    kept = network.select("ordinal", safe("source").alias("source"), safe("target").alias("target"), F.coalesce(F.nullif(safe("source_type"), F.lit("")), F.lit("LETTER")).alias("source_type"), F.coalesce(F.nullif(safe("target_type"), F.lit("")), F.lit("ENTITY")).alias("target_type")).where("source <> '' and target <> ''")
    ends = F.array(F.struct(F.col("source").alias("node"), F.col("target").alias("other"), F.col("source_type").alias("node_type"), (F.col("ordinal") * 2).alias("at")), F.struct(F.col("target").alias("node"), F.col("source").alias("other"), F.col("target_type").alias("node_type"), (F.col("ordinal") * 2 + 1).alias("at")))
    half = kept.select(F.explode(ends).alias("e")).select("e.*")
    # pairs first: a hub's rows are counted in part before they meet
    pairs = half.groupBy("node", "other").agg(F.count("*").alias("n"), F.max(F.struct("at", "node_type")).alias("last"))
    own = pairs.groupBy("node").agg(F.count("*").alias("degree"), F.sum("n").alias("row_degree"), F.max("last").alias("last"))
    return own.select("node", F.col("last.node_type").alias("node_type"), "degree", "row_degree", (F.lit(base_size) + 120 * F.col("degree")).alias("size"), (18 + F.least(3 * F.col("row_degree"), F.lit(30))).alias("html_size"))


def drawn_edges(network: DataFrame) -> DataFrame:
    """(source, target, weight, width): an undirected edge each, its last row's weight, its width between 0.6 and 3."""
    pair = network.select("ordinal", F.least(safe("source"), safe("target")).alias("source"), F.greatest(safe("source"), safe("target")).alias("target"), F.coalesce(F.col("weight").try_cast("bigint"), F.lit(1)).alias("weight")).where("source <> '' and target <> ''")
    return pair.groupBy("source", "target").agg(F.max_by("weight", "ordinal").alias("weight")).withColumn("width", F.greatest(F.lit(0.6), F.least(F.lit(3.0), F.col("weight").cast("double"))))
