"""Date mentions of page files as they arrive; an extension of the batch operators, stateless."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillgraph.operators.mentions import date_mentions
from quillgraph.sources.pagexml import parse_pages


def page_stream(spark: SparkSession, folder: str, files_each: int = 1000) -> DataFrame:
    """Lines of ``*.xml`` files as they arrive in a folder."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.xml").option("maxFilesPerTrigger", files_each).load(folder)
    return parse_pages(files.select("path", "content"))


def date_stream(lines: DataFrame) -> DataFrame:
    """Date mentions of each line, with the line's place instead of a letter's."""
    keyed = lines.where("error is null").select(F.concat_ws("#", "path", F.col("seq").cast("string")).alias("letter_id"), "text")
    return date_mentions(keyed)


def counted_by_window(mentions: DataFrame, time: str, every: str = "1 day", late: str = "7 days") -> DataFrame:
    """(window, label, n): mentions by tumbling window of a time column, rows later than ``late`` left to the watermark."""
    return mentions.withWatermark(time, late).groupBy(F.window(time, every), "label").agg(F.count("*").alias("n"))


def write_dates(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Append the dates of all files that are in a folder and stop."""
    return date_stream(page_stream(spark, folder)).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
