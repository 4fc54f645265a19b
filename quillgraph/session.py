"""Session helpers shared by every operator."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_own: dict[str, str] = {}
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, so that they need no copy of their own."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    # the driver's own copy, from which Spark sends it; it goes when the driver ends
    folder = tempfile.mkdtemp(prefix="quillgraph-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / "quillgraph.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def shared_folder(spark: SparkSession) -> str:
    """Where tables between steps are written: the folder the cluster names in spark.checkpoint.dir; without it one of this machine's, only where all runs on this machine, as in tests."""
    app = spark.sparkContext.applicationId
    if app not in _own:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines of the cluster share")
        base = base or tempfile.mkdtemp(prefix="quillgraph-")
        _own[app] = f"{base.rstrip('/')}/quillgraph-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(_drop, spark, _own[app])
    return _own[app]


def _drop(spark: SparkSession, folder: str) -> None:
    try:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session has ended; the cluster clears its folder
        pass


def checkpointed(df: DataFrame, by: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read again: the lineage is cut, lost executors lose nothing, and nothing is computed twice.

    ``by`` names a column of few values to partition by, so that later filters on it read only their part.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running(df: DataFrame, order: list[str], value: Column, into: str) -> DataFrame:
    """``df`` with the sum of ``value`` over all rows up to each, in an order, by ranges side by side; only one number for each range is summed in one place."""
    placed = checkpointed(df.withColumn("_value", value).repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = placed.groupBy("_range").agg(F.sum("_value").alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.sum("_value").over(Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    # one row for each range, and as many ranges as there are partitions
    out = placed.withColumn("_inside", inside).join(F.broadcast(sizes.select("_range", before.alias("_before"))), "_range")
    return out.withColumn(into, (F.col("_before") + F.col("_inside")).cast("bigint")).drop("_range", "_inside", "_before", "_value")


def numbered(df: DataFrame, order: list[str], into: str) -> DataFrame:
    """``df`` with rows counted from 0 in an order, by ranges side by side."""
    # the old values of the column may be part of the order, so the new ones come last
    return running(df, order, F.lit(1), "_number").withColumn(into, F.col("_number") - 1).drop("_number")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a dataset folder; its Parquet files carry the schema."""
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))
