"""Consume an ordered stream of entries until a sentinel.

For each session, keep the entries strictly before the first one whose value
equals the sentinel ignoring case (no trimming: " exit" is not the sentinel).

The first sentinel per session is found with an aggregate (``min`` of the order
struct, combined map-side), then joined back with a salted join: a session with
more than ``target_rows`` entries is spread over several tasks. No window puts a
whole session into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwise.operators.skew import TARGET_ROWS, salted_lookup_join


def take_until(df: DataFrame, session: list[str], order: list[str], column: str,
               sentinel: str = "exit", target_rows: int = TARGET_ROWS) -> DataFrame:
    hit = F.lower(F.col(column)) == F.lit(sentinel.lower())
    key = F.struct(*[F.col(c) for c in order])
    first_stop = (df.where(hit).groupBy(*session)
                  .agg(F.min(key).alias("_stop")))
    joined = salted_lookup_join(df, first_stop, session, "left", target_rows)
    return joined.where(F.col("_stop").isNull() | (key < F.col("_stop"))).drop("_stop")
