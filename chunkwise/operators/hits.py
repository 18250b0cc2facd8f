"""Shaping search hits.

Ranking runs on ids and vectors only; payload columns (file, page, chunk text)
are joined to the k kept hits afterwards, so chunk text never enters the
distance stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwise.session import scratch_dir

# --- fixed values: defaults for missing hit fields -----------------------------
UNKNOWN_FILE = "Unknown file"
UNKNOWN_PAGE = "Unknown page"
UNKNOWN_CHUNK = "Unknown chunk"
MISSING_DISTANCE = 0.0
# ------------------------------------------------------------------------------


def with_payload(hits: DataFrame, payload: DataFrame, on: list[str], how: str = "left",
                 hits_bounded: bool = False) -> DataFrame:
    """Bring payload columns back to hits by id (``how`` = left or inner).

    ``hits_bounded`` says the hit table has a proven size bound (queries that
    passed the broadcast probe, times k). Then the payload table is scanned once
    through a broadcast semi-join on the hit ids and only matching payload rows
    meet the hits; the payload side is never shuffled. Otherwise the join is a
    plain shuffle join left to AQE.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    if hits_bounded:
        # the hits feed two joins; checkpoint the (small) table so the search
        # that produced it runs once, and its result survives executor loss
        scratch_dir(hits.sparkSession)
        hits = hits.checkpoint(eager=True)
        wanted = F.broadcast(hits.select(*on).distinct())
        payload = payload.join(wanted, on=on, how="left_semi")
    return hits.join(payload, on=on, how=how)


def select_hits(df: DataFrame, query_id: str = "query_id") -> DataFrame:
    """The hit fields, ``distance`` being what the stores call similarity."""
    return df.select(query_id, "rank", "file", "page", "chunk", "distance")


def with_defaults(hits: DataFrame) -> DataFrame:
    """Missing file/page/chunk become fixed labels, missing distance 0."""
    return hits.select(
        *[c for c in hits.columns if c not in ("file", "page", "chunk", "distance")],
        F.coalesce(F.col("file"), F.lit(UNKNOWN_FILE)).alias("file"),
        F.coalesce(F.col("page").cast("string"), F.lit(UNKNOWN_PAGE)).alias("page"),
        F.coalesce(F.col("chunk"), F.lit(UNKNOWN_CHUNK)).alias("chunk"),
        F.coalesce(F.col("distance").cast("double"), F.lit(MISSING_DISTANCE)).alias("distance"),
    )


def keep_queries(queries: DataFrame, per_query: DataFrame, query_id: str = "query_id") -> DataFrame:
    """Every query survives, with null per-query fields if it had no hit."""
    return queries.join(per_query, on=query_id, how="left")


def _ordered(values: Column, rank: str = "rank") -> Column:
    """Values of a group in rank order (group size is bounded by k)."""
    rank = F.col(rank)
    pairs = F.array_sort(F.collect_list(F.struct(rank.alias("r"), values.alias("v"))))
    return F.transform(pairs, lambda x: x["v"])


def merge_hits(hits: DataFrame, query_id: str = "query_id") -> DataFrame:
    """A1: one record per query: all chunk texts in rank order, file/page of the
    best hit, and its distance."""
    return hits.groupBy(query_id).agg(
        _ordered(F.col("chunk")).alias("chunks"),
        F.min_by("file", "rank").alias("file"),
        F.min_by("page", "rank").alias("page"),
        F.min("distance").alias("distance"),
        F.count(F.lit(1)).cast("int").alias("n_hits"),
    )
