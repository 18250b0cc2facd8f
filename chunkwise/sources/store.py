"""O3: scan a written store, optionally scoped to keys with a prefix.

A store laid out by key (``write_keyed_store``) is range-partitioned and sorted, one row
group a file, with a table of every file's least and greatest key beside it. A scan by
prefix reads that table and opens only the files whose range meets the prefix; neither
the other files nor their footers are touched.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_store(spark: SparkSession | None, source: str | DataFrame,
               prefix: str | None = None, key: str = "id") -> DataFrame:
    """All records of a store; with ``prefix`` only keys starting with it.

    ``startswith`` on a parquet scan is pushed down as ``StringStartsWith``.
    """
    df = spark.read.parquet(source) if isinstance(source, str) else source
    if prefix is not None:
        df = df.where(F.col(key).startswith(prefix))
    return df


ROWS_PER_FILE = 500_000


def write_keyed_store(df: DataFrame, path: str, key: str = "id", rows_per_file: int = ROWS_PER_FILE) -> str:
    """Write ``df`` laid out by ``key`` (text): ``rows`` sorted in files of at most
    ``rows_per_file`` rows, ``layout`` with the range of keys of each file."""
    spark = df.sparkSession
    parts = max(1, math.ceil(df.select(key).count() / rows_per_file))
    (df.repartitionByRange(parts, key).sortWithinPartitions(key)
     .write.option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/rows"))
    (spark.read.schema(df.schema).parquet(f"{path}/rows")
     .groupBy(F.col("_metadata.file_path").alias("file"))
     .agg(F.min(key).alias("least"), F.max(key).alias("greatest"), F.count(F.lit(1)).alias("rows"))
     .withColumn("key", F.lit(key)).write.parquet(f"{path}/layout"))
    return path


def files_with_prefix(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """The files of a keyed store whose range of keys meets ``prefix``."""
    layout = spark.read.parquet(f"{path}/layout")
    start = lambda c: F.substring(c, 1, len(prefix))  # noqa: E731  cutting keeps the order of keys
    hit = (start("least") <= F.lit(prefix)) & (start("greatest") >= F.lit(prefix))
    return sorted(r["file"] for r in layout.where(hit).select("file").collect())


def scan_keyed_store(spark: SparkSession, path: str, prefix: str | None = None, key: str = "id") -> DataFrame:
    """All records of a keyed store; with ``prefix`` those of keys starting with it, from
    the files that can hold them. Null keys have no prefix."""
    rows = spark.read.parquet(f"{path}/rows")
    if prefix is None:
        return rows
    files = files_with_prefix(spark, path, prefix)
    if not files:
        return rows.limit(0)
    return spark.read.schema(rows.schema).parquet(*files).where(F.col(key).startswith(prefix))
