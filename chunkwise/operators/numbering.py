"""Row numbers inside groups without putting a whole group into one task.

``row_number().over(partitionBy(g).orderBy(o))`` sends every row of a group to a
single task; if one group holds a third of the table, that task holds a third of
the table. Here the order column is cut into ranges by global quantiles, rows are
numbered inside each (group, range) cell, and per-cell counts are turned into
offsets by a window over the small count table. Cells are bounded by
rows / ranges whatever the group sizes are; the final join is on the same keys as
the numbering window, so it reuses that shuffle.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


ROWS_PER_RANGE = 1_000_000


def _range_cuts(df: DataFrame, order_col: str, ranges: int | None, rel_error: float,
                rows_per_range: int) -> list[float]:
    """Inner cut points of the order column: quantiles, as many as the row count asks for."""
    if ranges is None:
        ranges = max(16, -(-df.count() // rows_per_range))
    probs = [i / ranges for i in range(1, ranges)]
    picked = df.approxQuantile(order_col, probs, min(rel_error, 0.25 / ranges)) if probs else []
    return sorted({float(c) for c in picked if c is not None})


def row_number_within(df: DataFrame, group_cols: list[str], order_col: str,
                      out: str = "rn", base: int = 1, ranges: int | None = None,
                      rel_error: float = 0.001,
                      rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``out`` = position of the row in its group by ``order_col`` (+ ``base``).

    ``order_col`` must be numeric and (near) unique inside a group; ties are
    broken arbitrarily, as ``row_number`` does. Rows with a null group form a group of
    their own, rows with a null order value come first in theirs. By default the number of ranges
    follows the row count, so no (group, range) cell exceeds about
    ``rows_per_range`` rows, whatever share of the table one group holds.
    """
    cuts = _range_cuts(df, order_col, ranges, rel_error, rows_per_range)
    splits = [float("-inf")] + cuts + [float("inf")]

    ordered = df.withColumn("_ord_d", F.col(order_col).cast("double"))
    bucketed = Bucketizer(splits=splits, inputCol="_ord_d", outputCol="_rng",
                          handleInvalid="keep").transform(ordered).drop("_ord_d")
    bucketed = bucketed.withColumn("_rng", F.when(F.col(order_col).isNull(), -1.0).otherwise(F.col("_rng")))

    # keys without nulls: one set of columns that the window, the counts and the join share, so
    # that the rows are shuffled once
    cell = []
    for i, c in enumerate(group_cols):
        bucketed = bucketed.withColumn(f"_g{i}", F.coalesce(F.col(c).cast("string"), F.lit(""))) \
                           .withColumn(f"_z{i}", F.col(c).isNull())
        cell += [f"_g{i}", f"_z{i}"]
    groups, cell = cell, [*cell, "_rng"]
    counts = bucketed.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_rng").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")

    local = bucketed.withColumn(
        "_loc", F.row_number().over(Window.partitionBy(*cell).orderBy(order_col)))
    return (local.join(offsets, cell, "inner").drop(*cell)
            .withColumn(out, (F.col("_off") + F.col("_loc") - 1 + base).cast("int"))
            .drop("_loc", "_off"))
