"""Joins that stay balanced when one key holds a large share of a table.

``salted_lookup_join`` joins a large table with a lookup table that has at most
one row per key (null is a key like any other). Keys of the large table with more than ``target_rows`` rows are
found by an aggregate; there can be at most rows / target_rows of them, so that
small table is broadcast (a proven bound). Each hot key's rows are spread over
ceil(count / target_rows) salts by a hash of the row, and its lookup row is
replicated once per salt, so no task receives more than about ``target_rows``
rows of one key. Cold keys get a single salt and join as usual.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TARGET_ROWS = 1_000_000


def hot_keys(big: DataFrame, keys: list[str], target_rows: int = TARGET_ROWS) -> DataFrame:
    """``*keys, _ns``: keys with more than ``target_rows`` rows and their salt count."""
    return (big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > target_rows)
            .select(*keys, F.ceil(F.col("_n") / target_rows).cast("int").alias("_ns")))


def _join_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on ``keys`` where a null key matches a null key; the left keys are kept."""
    renamed = right.select(*[F.col(c).alias(f"_right_{c}") if c in keys else F.col(c) for c in right.columns])
    match = [left[c].eqNullSafe(renamed[f"_right_{c}"]) for c in keys]
    return left.join(renamed, match, how).drop(*[f"_right_{c}" for c in keys])


def salted_lookup_join(big: DataFrame, lookup: DataFrame, keys: list[str], how: str = "left",
                       target_rows: int = TARGET_ROWS) -> DataFrame:
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    hot = F.broadcast(hot_keys(big, keys, target_rows))
    salted_big = (_join_safe(big, hot, keys, "left")
                  .withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]),
                                              F.coalesce(F.col("_ns"), F.lit(1)).cast("long")))
                  .drop("_ns"))
    salted_lookup = (_join_safe(lookup, hot, keys, "left")
                     .withColumn("_salt", F.explode(F.sequence(
                         F.lit(0).cast("long"), (F.coalesce(F.col("_ns"), F.lit(1)) - 1).cast("long"))))
                     .drop("_ns"))
    return _join_safe(salted_big, salted_lookup, keys + ["_salt"], how).drop("_salt")
