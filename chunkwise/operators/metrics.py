"""A3, A4, M1-M4: store statistics, ingest summaries and run timings.

Sizes are measured with ``DataFrame.observe`` on the write itself (no second
pass). Timings are wall-clock seconds around an action, recorded as one
``run_log`` row per run; comparing runs is an ordinary aggregate.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

FLOAT_BYTES = 4

RUN_LOG_SCHEMA = ("run_id string, store string, encoder string, llm string, phase string, "
                  "rows long, bytes long, seconds double")


def store_stats(df: DataFrame, vec: str = "embedding", text: str = "chunk") -> DataFrame:
    """A3: one row describing a store."""
    return df.agg(
        F.count(F.lit(1)).alias("n_records"),
        F.min(F.size(vec)).alias("min_dim"),
        F.max(F.size(vec)).alias("max_dim"),
        F.count_distinct("file").alias("n_files"),
        F.sum(F.size(vec) * FLOAT_BYTES).cast("long").alias("vector_bytes"),
        F.sum(F.octet_length(text)).cast("long").alias("text_bytes"),
    )


SKETCH_BITS = 14  # of the distinct count of files: a standard error of 0.8 %
BATCH_STATS = ("n_records long, min_dim int, max_dim int, vector_bytes long, text_bytes long, files binary")


def write_with_stats(df: DataFrame, path: str, name: str, vec: str = "embedding", text: str = "chunk") -> None:
    """Write a batch to ``path/name`` and its statistics beside it, in one pass over the rows.

    The statistics of a batch are one row that merges with others: counts, sizes, and a
    sketch of the files' names.
    """
    seen = Observation(f"stats-{uuid.uuid4().hex}")
    (df.observe(seen, F.count(F.lit(1)).alias("n_records"), F.min(F.size(vec)).alias("min_dim"),
                F.max(F.size(vec)).alias("max_dim"),
                F.coalesce(F.sum(F.size(vec) * FLOAT_BYTES), F.lit(0)).cast("long").alias("vector_bytes"),
                F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).cast("long").alias("text_bytes"),
                F.hll_sketch_agg("file", F.lit(SKETCH_BITS)).alias("files"))
     .write.mode("overwrite").parquet(f"{path}/{name}"))
    row = seen.get
    names = [c.split()[0] for c in BATCH_STATS.split(", ")]
    values = tuple(bytes(row[c]) if c == "files" and row[c] is not None else row[c] for c in names)
    df.sparkSession.createDataFrame([values], BATCH_STATS).coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/_stats/{name}")


def merged_stats(spark: SparkSession, path: str) -> DataFrame:
    """A3 of a store of batches, from their statistics alone: no row of the store is read.

    ``n_files`` is an estimate (see ``SKETCH_BITS``), exact for few files.
    """
    rows = spark.read.schema(BATCH_STATS).option("recursiveFileLookup", "true").parquet(f"{path}/_stats")
    return rows.agg(F.sum("n_records").alias("n_records"), F.min("min_dim").alias("min_dim"),
                    F.max("max_dim").alias("max_dim"),
                    F.hll_sketch_estimate(F.hll_union_agg("files")).alias("n_files"),
                    F.sum("vector_bytes").alias("vector_bytes"), F.sum("text_bytes").alias("text_bytes"))


def ingest_summary(chunks: DataFrame, text: str = "chunk") -> DataFrame:
    """A4: per file, pages and chunks written and chunk bytes."""
    return chunks.groupBy("file").agg(
        F.count_distinct("page").alias("n_pages"),
        F.count(F.lit(1)).alias("n_chunks"),
        F.sum(F.octet_length(text)).cast("long").alias("text_bytes"),
    )


def size_observation(name: str = "ingest", vec: str = "embedding", text: str = "chunk"):
    """M2: metrics gathered while the write runs."""
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows"),
             F.coalesce(F.sum(F.size(vec) * FLOAT_BYTES), F.lit(0)).cast("long").alias("vector_bytes"),
             F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).cast("long").alias("text_bytes")]
    return obs, exprs


@dataclass
class RunRecord:
    run_id: str
    store: str
    encoder: str
    llm: str
    phase: str
    rows: int
    bytes: int
    seconds: float


def timed_write(df: DataFrame, path: str, run_id: str, store: str, encoder: str, llm: str,
                vec: str = "embedding", text: str = "chunk") -> RunRecord:
    """M1 + M2: write ``df`` and record rows, bytes and wall seconds."""
    obs, exprs = size_observation(f"ingest-{run_id}", vec, text)
    started = time.perf_counter()
    df.observe(obs, *exprs).write.mode("errorifexists").parquet(path)
    seconds = time.perf_counter() - started
    m = obs.get
    return RunRecord(run_id, store, encoder, llm, "ingest", int(m["rows"]),
                     int(m["vector_bytes"]) + int(m["text_bytes"]), seconds)


def timed_answers(build: Callable[[], DataFrame], path: str, run_id: str, store: str, encoder: str, llm: str,
                  text: str = "answer", phase: str = "query") -> RunRecord:
    """M3: wall seconds of a query batch from its building to its written answers.

    ``build`` makes the answers' DataFrame; the clock starts before it is called, so
    retrieval that runs while the plan is built counts too, and the answers are
    written, so no column of them is pruned away.
    """
    started = time.perf_counter()
    obs = Observation(f"answers-{run_id}")
    (build().observe(obs, F.count(F.lit(1)).alias("rows"),
                     F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).cast("long").alias("bytes"))
     .write.mode("errorifexists").parquet(path))
    seconds = time.perf_counter() - started
    m = obs.get
    return RunRecord(run_id, store, encoder, llm, phase, int(m["rows"]), int(m["bytes"]), seconds)


def run_log(spark: SparkSession, records: list[RunRecord]) -> DataFrame:
    """One row per run (a handful of driver-side timings, not data)."""
    return spark.createDataFrame([tuple(r.__dict__.values()) for r in records], RUN_LOG_SCHEMA)


def append_runs(spark: SparkSession, records: list[RunRecord], path: str) -> None:
    """M1: append run records to the log at ``path``."""
    run_log(spark, records).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Every run logged at ``path``, by any session."""
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(path)


def compare(log: DataFrame) -> DataFrame:
    """M4: runs compared by store, encoder and language model."""
    return log.groupBy("store", "encoder", "llm", "phase").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("rows").alias("rows"),
        F.sum("bytes").alias("bytes"),
        F.avg("seconds").alias("avg_seconds"),
        F.max("seconds").alias("max_seconds"),
    )
