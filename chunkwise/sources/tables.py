"""The driver's parquet tables and the page view derived from ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwise.operators.numbering import row_number_within
from chunkwise.session import spread

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pages_view(spark: SparkSession, sf_dir: str, keep_doc_id: bool = False) -> DataFrame:
    """``documents`` as pages of files: ``file = source``, ``page`` 0-based by doc_id.

    Page numbering is skew-safe (a source may hold a large share of documents).
    """
    docs = spread(read_table(spark, sf_dir, "documents").select(
        F.col("source").alias("file"), "doc_id", "text"), "doc_id")
    cols = ["doc_id", "file", "page", "text"] if keep_doc_id else ["file", "page", "text"]
    return row_number_within(docs, ["file"], "doc_id", out="page", base=0).select(*cols)
