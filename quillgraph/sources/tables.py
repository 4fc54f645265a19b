"""CSV, text and dictionary sources with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: str, required: list[str] | None = None, order: str | None = None) -> DataFrame:
    """A CSV file with a header and texts of several lines; empty fields are null, a byte order mark is no part of a name.

    Columns are found by name, those the file lacks are null; a missing required column is an error. ``order`` names a
    column to add that sorts as the rows do, by file and place in it; a file of this kind is never split.
    """
    raw = spark.read.options(header="true", multiLine="true", escape='"', encoding="UTF-8", inferSchema="false").csv(path)
    raw = raw.toDF(*[c.replace("﻿", "").strip() for c in raw.columns])
    lacking = [c for c in required or [] if c not in raw.columns]
    if lacking:
        raise ValueError(f"{path} lacks the columns {', '.join(lacking)}")
    fields = T._parse_datatype_string(schema).fields
    return raw.select(*[(F.nullif(F.col(f"`{f.name}`"), F.lit("")) if f.name in raw.columns else F.lit(None)).try_cast(f.dataType).alias(f.name) for f in fields], *([F.struct(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("row")).alias(order)] if order else []))


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): whole files."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def link_dictionary(rows: DataFrame, order: Column | None = None) -> DataFrame:
    """(label, type, wikidata_uri): one row for each canonical label and type, the last complete one.

    ``order`` says which is last; without it, of rows that differ only in their link the greatest.
    """
    from quillgraph.functions.text import canonical

    named = rows.withColumn("_at", order if order is not None else F.col("wikidata_uri"))
    named = named.select(canonical("label").alias("label"), F.upper(F.trim("type")).alias("type"), F.trim("wikidata_uri").alias("wikidata_uri"), "_at").where("label <> '' and type <> '' and wikidata_uri <> ''")
    last = Window.partitionBy(F.lower("label"), "type").orderBy(F.desc("_at"))
    return named.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n", "_at")


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """A link dictionary from CSV; a missing file is an empty dictionary."""
    from pyspark.errors import AnalysisException

    schema = "label string, type string, wikidata_uri string"
    try:
        return link_dictionary(read_csv(spark, path, schema, order="_order"), F.col("_order"))
    except AnalysisException:
        return spark.createDataFrame([], schema)
