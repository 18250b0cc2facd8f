"""Continuous ingest: new files in a folder -> pages -> chunks -> vectors -> store.

The store is log-structured: every micro-batch is written to its own partition
``seq=<number>/stream=<source>`` with overwrite, so a replayed batch replaces itself
instead of duplicating rows (exactly-once with the stream checkpoint), and streams
from several folders never overwrite each other. A stream's numbers follow those
that the store held when the stream first began. Reading resolves the
write semantics by aggregation: upsert = latest (seq, chunk_index) per key,
insert-if-absent = earliest, append = every row. Deletes are rows of a log too: a mark
names a value and, for each stream, the last number that the store held then; it takes
away what was there, not what comes later. No file is ever rewritten. A compacted store
notes in ``_folded`` up to which number each key stands once: while nothing was written
after it, reading has nothing to resolve.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chunkwise.functions.text import chunk_key
from chunkwise.operators import sinks
from chunkwise.operators.chunking import chunk
from chunkwise.operators.encode import DEFAULT_HASH_DIM, embed, hash_vectors
from chunkwise.sources.files import extract_pages, file_name, text_pages

MODES = ("upsert", "insert_if_absent", "append")
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def ingest_stream(spark: SparkSession, directory: str, store_path: str, *, suffix: str = ".pdf",
                  extractor: Callable[[bytes], list[str]] | None = None,
                  encoder: Callable | None = None,
                  dim: int = DEFAULT_HASH_DIM, checkpoint: str | None = None,
                  available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start a stream that ingests files appearing in ``directory``.

    ``encoder`` turns a list of texts into a (n, ``dim``) matrix, as for ``embed``; by
    default chunks get hashed vectors. Without ``checkpoint`` the progress of each
    folder is kept in ``_checkpoint`` below the store, so that a stream started again
    goes on where it was.
    """
    source = hashlib.sha256(f"{directory}\0{suffix}".encode()).hexdigest()[:16]
    base = _first_seq(spark, store_path, source)
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", f"*{suffix}")
              .option("recursiveFileLookup", "false"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.load(directory)
    files = raw.withColumn("file", file_name(raw))
    pages = extract_pages(files, extractor) if extractor else text_pages(files)
    chunks = chunk(pages, "text", keep=["file", "page"])
    rows = embed(chunks, "chunk", encoder, dim) if encoder else hash_vectors(chunks, "chunk", dim)
    rows = rows.withColumn("key", chunk_key())

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{store_path}/seq={base + batch_id}/stream={source}")

    writer = (rows.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint or f"{store_path}/_checkpoint/{source}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def _read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _first_seq(spark: SparkSession, store_path: str, source: str) -> int:
    """Number of a source's first batch; chosen once and kept beside the store."""
    path = f"{store_path}/_first/{source}"
    kept = _read_if_there(spark, path)
    if kept is None:
        log = _read_if_there(spark, store_path)
        last = log.agg(F.max("seq")).first()[0] if log is not None else None
        spark.range(0 if last is None else last + 1, (0 if last is None else last + 1) + 1).write.parquet(path)
        kept = spark.read.parquet(path)
    return int(kept.first()[0])


def run_to_end(query: StreamingQuery, timeout_s: float = 3600.0) -> StreamingQuery:
    """Wait for an available-now stream to finish; stop it and fail past the timeout.

    A failed stream raises its StreamingQueryException from ``awaitTermination``.
    """
    if not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} did not finish in {timeout_s} s")
    return query


MARKS = "column string, value string, stream string, upto long"


def delete_from_store(spark: SparkSession, store_path: str, column: str, value) -> None:
    """O9 while streams go on: take away the rows whose ``column`` equals ``value`` (null
    equals null) and which the store holds now. Rows written later stay, also with the
    same value, key and stream."""
    log = _read_if_there(spark, store_path)
    if log is None:
        return
    if column not in log.columns:
        raise ValueError(f"the store has no column {column!r}")
    if "stream" not in log.columns:
        log = log.withColumn("stream", F.lit(""))
    (log.groupBy(F.col("stream").cast("string").alias("stream")).agg(F.max("seq").cast("long").alias("upto"))
     .select(F.lit(column).alias("column"), F.lit(value).cast("string").alias("value"), "stream", "upto")
     .write.mode("append").parquet(f"{store_path}/_marks"))


def _without_marked(log: DataFrame, store_path: str) -> DataFrame:
    marks = _read_if_there(log.sparkSession, f"{store_path}/_marks")
    if marks is None:
        return log
    marks = marks.groupBy("column", "value", "stream").agg(F.max("upto").alias("_upto"))
    for column in sorted(r["column"] for r in marks.select("column").distinct().collect()):  # columns of the store
        own = marks.where(F.col("column") == column).select(F.col("value").alias("_value"), F.col("stream").alias("_stream"), "_upto")
        stream = F.col("stream").cast("string") if "stream" in log.columns else F.lit("")
        log = log.join(own, F.col(column).cast("string").eqNullSafe(F.col("_value"))
                       & (stream == F.col("_stream")) & (F.col("seq") <= F.col("_upto")), "left_anti")
    return log


def read_store(spark: SparkSession, store_path: str, mode: str = "upsert") -> DataFrame:
    """The store as of now under the given write semantics."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    log = spark.read.parquet(store_path)
    folded = mode == "append" or _is_folded(log, store_path)
    log = _without_marked(log, store_path)
    return log if folded else _resolved(log, mode)


def _resolved(log: DataFrame, mode: str) -> DataFrame:
    pick = sinks.merge_latest if mode == "upsert" else sinks.merge_first
    return pick(None, log, ["key"], ["seq", "chunk_index"])


def _is_folded(log: DataFrame, store_path: str) -> bool:
    """Whether every row of the store is one that a compaction left, each key once."""
    noted = _read_if_there(log.sparkSession, f"{store_path}/_folded")
    upto = noted.agg(F.max("upto")).first()[0] if noted is not None else None
    return upto is not None and log.where(F.col("seq") > upto).isEmpty()


def compact_store(spark: SparkSession, store_path: str, out_path: str,
                  mode: str = "upsert") -> str:
    """Fold every batch and every delete of a log-structured store into one version at ``out_path``.

    The result keeps the ``seq`` column, so a compacted store can itself be
    read (or compacted again) with the same semantics; the source log is left
    untouched until the caller switches to the new path.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    # dealt out by key before they are resolved: that layout serves the aggregate and the files
    rows = _without_marked(spark.read.parquet(store_path), store_path).repartitionByRange("key")
    if mode != "append":
        rows = _resolved(rows, mode)
    rows.write.mode("errorifexists").partitionBy("seq").parquet(out_path)
    if mode != "append":
        (spark.read.schema(rows.schema).parquet(out_path).agg(F.max("seq").cast("long").alias("upto"))
         .coalesce(1).write.parquet(f"{out_path}/_folded"))
    return out_path
