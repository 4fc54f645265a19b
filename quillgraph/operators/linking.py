"""The entity table and its links."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.functions.text import canonical_composed


class LinkProvider(Protocol):
    """Anything that gives (label, type, found_uri) for distinct (label, type) rows; at most one row each."""

    def __call__(self, labels: DataFrame) -> DataFrame: ...


class DictionaryProvider:
    """Links by exact label from a table (label, wikidata_uri), first in one language, then in another."""

    def __init__(self, primary: DataFrame, fallback: DataFrame | None = None):
        self.tables = [t for t in (primary, fallback) if t is not None]

    def __call__(self, labels: DataFrame) -> DataFrame:
        out = labels
        for k, table in enumerate(self.tables):
            own = table.groupBy(F.lower("label").alias("_l")).agg(F.min("wikidata_uri").alias(f"_u{k}"))
            out = out.join(own, F.lower("label") == F.col("_l"), "left").drop("_l")
        return out.select("label", "type", F.coalesce(*[F.col(f"_u{k}") for k in range(len(self.tables))]).alias("found_uri"))


def entity_table(mentions: DataFrame) -> DataFrame:
    """(label, type, mention_count): one row for each small-letter label and type, with the label seen first. Empty labels are left out."""
    named = mentions.select(canonical_composed("text").alias("label"), F.upper(F.coalesce("label", F.lit("MISC"))).alias("type"), "ordinal").where("label <> ''")
    return named.groupBy(F.lower("label").alias("_key"), "type").agg(F.min_by("label", "ordinal").alias("label"), F.count("*").alias("mention_count")).select("label", "type", "mention_count")


def linked(entities: DataFrame, manual: DataFrame, provider: LinkProvider | None = None, types: tuple[str, ...] = ("PER", "LOC", "ORG", "WORK", "PUBLICATION")) -> DataFrame:
    """Entities with ``wikidata_uri``: the manual link of the label and type, else the provider's for types it is asked for.

    The provider sees each label and type once, as entities are distinct already.
    """
    by_hand = manual.select(F.lower("label").alias("_l"), F.col("type").alias("_t"), F.col("wikidata_uri").alias("_manual"))
    out = entities.join(by_hand, (F.lower("label") == F.col("_l")) & (F.col("type") == F.col("_t")), "left").drop("_l", "_t")
    if provider is None:
        return out.withColumnRenamed("_manual", "wikidata_uri")
    asked = out.where(F.col("_manual").isNull() & F.col("type").isin(*types)).select("label", "type")
    found = provider(asked).select(F.col("label").alias("_l"), F.col("type").alias("_t"), "found_uri")
    out = out.join(found, (F.col("label") == F.col("_l")) & (F.col("type") == F.col("_t")), "left").drop("_l", "_t")
    return out.withColumn("wikidata_uri", F.coalesce("_manual", "found_uri")).drop("_manual", "found_uri")
