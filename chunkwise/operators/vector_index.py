"""J3 with O4/O6/O9: an approximate index that is kept up to date by writes.

Cells. A quantiser has two levels: about sqrt(cells) coarse centroids, and below each its
fine centroids, the cells; their number grows with the square root of the rows
(``cells_per_root``). The index has ``tables`` quantisers, trained from different starts,
and files every vector once under each: cells of different tables overlap in different
directions, so a neighbour just across a border of one lies inside a cell of another.
Quantisers are fitted on a documented sample (``train_per_cell`` distinct vectors a cell);
every vector is filed.

Log. Nothing is rewritten. Below ``path``:

* ``spec``: metric, names, sizes.
* ``cells/version=v``: table, cell, coarse group, centroid, whether it is in use.
* ``rows/seq=s/tbl=t/coarse=c``: filed vectors, sorted by cell; ``born`` is the number of the
  write they belong to.
* ``marks/seq=s``: ids that a delete or upsert took away from earlier writes.
* ``counts/seq=s``: rows per cell; ``commits/seq=s``: written last, names the version of the
  cells. Readers see committed numbers only, so a write that died leaves nothing visible
  and is written again under the same number.

A row counts if no later mark names its ids and its cell is in use. After a write, cells
that outgrew ``cell_bound`` are split: their rows are filed again under new cells and the
old ones go out of use.

Search. A query ranks the cells of its ``breadth`` nearest coarse groups and is compared
with the vectors of the ``nprobe`` nearest of them. Cells are packed into blocks of about
``block_rows`` rows (larger cells are cut by a hash of the ids), and each (block, part of
its queries) is one bounded cogroup. Only the coarse groups that some query probes are read.
A search of all cells ranks none: every query meets every block of one table.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunkwise.operators.knn import (BLOCK_ROWS, BROADCAST_MAX_BYTES, DECIMALS, SPARE, _best,
                                     _candidate_schema, _check_metric, _distances, _empty,
                                     _final_topk, _matrix, _pair_distances, topk_block, valid_vectors)
from chunkwise.session import scratch_path

TILE = 1024                # queries that meet the cells of a block together, at most
NEAR_VALUES = 1 << 21      # cells ranked, and cell numbers returned, at a time
FIT_ROUNDS = 8             # Lloyd iterations of a quantiser
CELLS = "tbl int, coarse int, cell int, used boolean, whole boolean, centroid array<double>"


@dataclass(frozen=True)
class VectorIndex:
    """An index on disk. ``cell_bound`` is the number of rows beyond which a cell is split."""
    path: str
    metric: str
    ids: tuple[str, ...]
    vec: str
    dim: int
    tables: int
    cell_bound: int
    seed: int
    columns: str  # DDL of ids and vector

    @property
    def id_list(self) -> list[str]:
        return list(self.ids)


# ----------------------------------------------------------------------------
# quantisers
# ----------------------------------------------------------------------------

def _unit(X: np.ndarray, metric: str) -> np.ndarray:
    """Vectors as they are clustered: of length one for cosine, as they are for l2sq."""
    if metric != "cosine":
        return X
    norms = np.linalg.norm(X, axis=1, keepdims=True)
    return X / np.where(norms > 0, norms, 1.0)


def _far(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    """Order-preserving distances of rows of X to centroids (squared, less |x|^2)."""
    return np.einsum("ij,ij->i", C, C) - 2.0 * X @ C.T


def fit_centroids(X: np.ndarray, k: int, metric: str, seed: int) -> np.ndarray:
    """At most ``k`` centroids of the rows of ``X`` by Lloyd's iterations from random rows."""
    X = _unit(X, metric)
    start = np.unique(X, axis=0)
    C = start[np.random.default_rng(seed).permutation(len(start))[:k]].copy()
    for _ in range(FIT_ROUNDS):
        near = np.concatenate([np.argmin(_far(X[s:s + 4096], C), axis=1) for s in range(0, len(X), 4096)])
        sums = np.zeros_like(C)
        np.add.at(sums, near, X)
        n = np.bincount(near, minlength=len(C))[:, None]
        C = np.where(n > 0, _unit(sums / np.maximum(n, 1), metric), C)
    return C


def _hash_order(ids: list[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in ids])


def _write_cells(index: VectorIndex, cells: DataFrame, version: int) -> None:
    cells.select("tbl", "coarse", "cell", "used", "whole", "centroid") \
        .write.mode("overwrite").parquet(f"{index.path}/cells/version={version}")


def create_index(sample: DataFrame, path: str, rows: int, metric: str = "cosine", *,
                 ids: tuple[str, ...] | list[str] = ("id",), vec: str = "embedding", dim: int,
                 tables: int = 2, cells_per_root: float = 9.0, train_per_cell: int = 32,
                 cell_bound: int = BLOCK_ROWS, seed: int = 11) -> VectorIndex:
    """Declare an empty index for about ``rows`` vectors, its quantisers fitted on ``sample``.

    Of ``sample`` at most ``train_per_cell`` distinct vectors a cell are used, in order of
    a hash of the ids, and as many a coarse centroid reach the driver. Without any valid
    vector there is one cell a table, which splits as it fills.
    """
    _check_metric(metric)
    ids = list(ids)
    spark = sample.sparkSession
    columns = ", ".join(f"`{c}` {sample.schema[c].dataType.simpleString()}" for c in [*ids, vec])
    index = VectorIndex(path, metric, tuple(ids), vec, dim, tables, cell_bound, seed, columns)
    cells = max(1, round(cells_per_root * math.sqrt(max(rows, 1))))
    groups = max(1, math.ceil(math.sqrt(cells)))
    valid = valid_vectors(sample.select(*ids, vec), vec, dim)
    if metric == "cosine":
        valid = valid.where(F.exists(vec, lambda x: x != 0))
    picked = (valid.withColumn("_h", _hash_order(ids)).groupBy(vec).agg(F.min("_h").alias("_h"))
              .orderBy("_h").limit(train_per_cell * cells).select("_h", F.col(vec).alias("v")))
    train = scratch_path(spark, "index-sample")
    picked.write.parquet(train)
    picked = spark.read.schema(picked.schema).parquet(train)
    first = _matrix([r["v"] for r in picked.orderBy("_h").limit(train_per_cell * groups).select("v").collect()], dim)
    if len(first) == 0:
        empty = spark.createDataFrame([(t, 0, 0, True, False, [0.0] * dim) for t in range(tables)], CELLS)
        _write_cells(index, empty, 0)
    else:
        coarse = [fit_centroids(first, groups, metric, seed + t) for t in range(tables)]
        share = cells / max(picked.count(), 1)

        def near_group(batches):
            for pdf in batches:
                X = _unit(_matrix(pdf["v"], dim), metric)
                for t, C in enumerate(coarse):
                    yield pd.DataFrame({"tbl": t, "coarse": np.argmin(_far(X, C), axis=1) if len(X) else [],
                                        "_h": pdf["_h"], "v": pdf["v"]})

        def fit_group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            X = _matrix(pdf.sort_values("_h")["v"], dim)
            C = fit_centroids(X, max(1, round(share * len(X))), metric, seed + 31 * int(key[1]))
            return pd.DataFrame({"tbl": key[0], "coarse": key[1], "centroid": list(C)})

        # a group that holds far more of the sample than its share is fitted on its first rows
        cap = Window.partitionBy("tbl", "coarse").orderBy("_h")
        fitted = (picked.mapInPandas(near_group, "tbl int, coarse int, _h long, v array<double>")
                  .withColumn("_n", F.row_number().over(cap)).where(F.col("_n") <= 4 * train_per_cell * groups).drop("_n")
                  .groupBy("tbl", "coarse").applyInPandas(fit_group, "tbl int, coarse int, centroid array<double>"))
        number = Window.partitionBy("tbl").orderBy("coarse", "centroid")
        _write_cells(index, fitted.withColumn("cell", F.row_number().over(number) - 1)
                     .withColumn("used", F.lit(True)).withColumn("whole", F.lit(False)), 0)
    spark.createDataFrame([(json.dumps(asdict(index) | {"path": ""}),)], "spec string") \
        .write.mode("errorifexists").parquet(f"{path}/spec")
    return index


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    spec = json.loads(spark.read.parquet(f"{path}/spec").first()["spec"])
    return VectorIndex(**(spec | {"path": path, "ids": tuple(spec["ids"])}))


@dataclass(frozen=True)
class Commit:
    """A committed write: its number, the version of the cells after it, and whether it
    filed rows and took ids away."""
    seq: int
    version: int
    filed: bool
    marked: bool


def _commits(spark: SparkSession, index: VectorIndex) -> list[Commit]:
    """The committed writes in order (a row a write)."""
    try:
        found = spark.read.schema("version int, filed boolean, marked boolean, seq int") \
            .parquet(f"{index.path}/commits").collect()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return sorted((Commit(r["seq"], r["version"], r["filed"], r["marked"]) for r in found), key=lambda c: c.seq)


def _version(commits: list[Commit]) -> int:
    return commits[-1].version if commits else 0


def live_cells(spark: SparkSession, index: VectorIndex, version: int | None = None) -> DataFrame:
    """The cells in use: ``tbl, coarse, cell, whole, centroid``."""
    version = _version(_commits(spark, index)) if version is None else version
    return spark.read.schema(CELLS).parquet(f"{index.path}/cells/version={version}").where("used").drop("used")


# ----------------------------------------------------------------------------
# nearest cells of a vector
# ----------------------------------------------------------------------------

class _Quantisers:
    """All cells in use as arrays, to rank them for a batch of vectors."""

    def __init__(self, cells: pd.DataFrame, metric: str):
        self.metric, self.tables = metric, {}
        for t, own in cells.groupby("tbl"):
            own = own.sort_values(["coarse", "cell"])
            C = _matrix(own["centroid"])
            groups, start = np.unique(own["coarse"].to_numpy(), return_index=True)
            means = np.add.reduceat(C, start) / np.diff(np.append(start, len(C)))[:, None]
            self.tables[int(t)] = (C, own["cell"].to_numpy(np.int64), groups,
                                   np.repeat(np.arange(len(groups)), np.diff(np.append(start, len(C)))), means)

    def nearest(self, X: np.ndarray, n: int | None, breadth: int | None) -> dict[int, list[np.ndarray]]:
        """Per table, for each row of X its ``n`` nearest cells (None: all), those of its
        ``breadth`` nearest groups."""
        X = _unit(X, self.metric)
        out = {}
        for t, (C, cell, groups, group_of, means) in self.tables.items():
            picked, tile = [], max(16, min(1024, NEAR_VALUES // len(C)))
            for s in range(0, len(X), tile):
                far = _far(X[s:s + tile], C)
                if breadth is not None and breadth < len(groups):
                    seen = np.zeros((len(far), len(groups)), bool)
                    np.put_along_axis(seen, _best(_far(X[s:s + tile], means), breadth), True, axis=1)
                    far[~seen[:, group_of]] = np.inf
                at = _best(far, len(cell) if n is None else min(n, len(cell)))
                picked += [cell[a[np.isfinite(f[a])]] for a, f in zip(at, far)]
            out[t] = picked
        return out


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of an Arrow list column without nulls, all of length ``dim``."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _ranked_parts(ranked: _Quantisers, batch: pa.RecordBatch, vec: str, dim: int, n: int | None, breadth: int | None):
    """Runs of rows of a batch, each as ``(rows, table, nearest cells of each)``: a run has
    so few rows that about ``NEAR_VALUES`` cell numbers are held at a time."""
    widest = max((len(t[1]) for t in ranked.tables.values()), default=1)
    step = max(1, NEAR_VALUES // (widest if n is None else min(n, widest)))
    for s in range(0, batch.num_rows, step):
        part = batch.slice(s, step)
        for t, picked in ranked.nearest(_vectors(part.column(vec), dim), n, breadth).items():
            yield part, t, picked


def _with_lists(rows: pa.RecordBatch, plain: dict[str, pa.Array], lists: dict[str, list[np.ndarray]]) -> pa.RecordBatch:
    """``rows`` with further columns; those of ``lists`` hold an array of ints a row."""
    arrays = list(plain.values())
    for parts in lists.values():
        ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
        values = np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)
        arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values)))
    return pa.RecordBatch.from_arrays([*rows.columns, *arrays], [*rows.schema.names, *plain, *lists])


def _probed_blocks(q: DataFrame, index: VectorIndex, cells: DataFrame, plan: DataFrame, n: int, breadth: int | None,
                   max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``q`` with ``tbl, block, cells, groups, cuts``: a row for each block that holds some of
    the ``n`` nearest cells, with those cells, their coarse groups, and the most cuts of one.

    Centroids that go to every task take the plan with them, so the cells are dealt to
    blocks where they are ranked; beyond ``max_bytes`` the ranked cells meet the plan in a join.
    """
    if plan.count() * index.dim * 8 > max_bytes:
        near = _near_cells(q, index, cells, "_v", n, breadth, max_bytes)
        return (near.join(plan, ["tbl", "coarse", "cell"]).groupBy("tbl", "block", "_qid")
                .agg(F.first("_v").alias("_v"), F.collect_list("cell").alias("cells"),
                     F.collect_set("coarse").alias("groups"), F.max("_cuts").alias("cuts")))
    where = {int(t): own.set_index("cell")[["block", "coarse", "_cuts"]]
             for t, own in plan.select("tbl", "cell", "block", "coarse", "_cuts").toPandas().groupby("tbl")}
    bc = q.sparkSession.sparkContext.broadcast((_Quantisers(cells.toPandas(), index.metric), where))

    def probe(batches):
        ranked, at = bc.value
        for batch in batches:
            for part, t, picked in _ranked_parts(ranked, batch, "_v", index.dim, n, breadth):
                if t not in at or not part.num_rows:
                    continue
                found = at[t].reindex(np.concatenate(picked))  # a cell without rows is in no block
                row = np.repeat(np.arange(len(picked)), [len(p) for p in picked])
                held = found["block"].notna().to_numpy()
                row, found = row[held], found[held]
                block, cuts = found["block"].to_numpy(np.int64), found["_cuts"].to_numpy(np.int32)
                order = np.lexsort((block, row))
                fresh = np.flatnonzero(np.diff(row[order], prepend=-1) | np.diff(block[order], prepend=-1))
                if len(fresh):
                    first = order[fresh]
                    split = lambda x: np.split(x[order], fresh[1:])
                    yield _with_lists(
                        part.take(pa.array(row[first])),
                        {"tbl": pa.array(np.full(len(first), t, np.int32)), "block": pa.array(block[first]),
                         "cuts": pa.array(np.maximum.reduceat(cuts[order], fresh))},
                        {"cells": split(found.index.to_numpy()),
                         "groups": [np.unique(g) for g in split(found["coarse"].to_numpy(np.int64))]})

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in q.schema.fields)
    return q.mapInArrow(probe, f"{kept}, tbl int, block long, cuts int, cells array<int>, groups array<int>")


def _near_cells(rows: DataFrame, index: VectorIndex, cells: DataFrame, vec: str, n: int | None,
                breadth: int | None, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``rows`` with ``tbl, coarse, cell``: one row for each of the ``n`` nearest cells a table.

    Centroids go to every task while they are at most ``max_bytes``; beyond that, groups
    are ranked by their means and each (vector, group) meets the group's centroids in a
    join. Both rank by the same distances.
    """
    spark = rows.sparkSession
    if cells.count() * index.dim * 8 <= max_bytes:
        bc = spark.sparkContext.broadcast(_Quantisers(cells.toPandas(), index.metric))

        def near(batches):
            for batch in batches:
                for part, t, picked in _ranked_parts(bc.value, batch, vec, index.dim, n, breadth):
                    yield _with_lists(part, {"tbl": pa.array(np.full(part.num_rows, t, np.int32))}, {"_near": picked})

        kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        out = (rows.mapInArrow(near, f"{kept}, tbl int, _near array<int>")
               .select(*rows.columns, "tbl", F.explode("_near").alias("cell")))
        return out.join(F.broadcast(cells.select("tbl", "cell", "coarse")), ["tbl", "cell"]) \
            .select(*rows.columns, "tbl", "coarse", "cell")
    return _near_cells_joined(rows, index, cells, vec, n, breadth)


def _near_cells_joined(rows: DataFrame, index: VectorIndex, cells: DataFrame, vec: str, n: int | None,
                       breadth: int | None) -> DataFrame:
    spark, metric = rows.sparkSession, index.metric
    means = (cells.select("tbl", "coarse", F.posexplode("centroid").alias("i", "x"))
             .groupBy("tbl", "coarse", "i").agg(F.avg("x").alias("x")).groupBy("tbl", "coarse")
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("centroid"))
             .withColumn("cell", F.col("coarse")).withColumn("coarse", F.lit(0)).toPandas())
    bc = spark.sparkContext.broadcast(_Quantisers(means, metric))

    @F.pandas_udf("array<struct<tbl:int,coarse:int>>")
    def groups(vectors: pd.Series) -> pd.Series:
        by_table = bc.value.nearest(_matrix(vectors), breadth, None) if len(vectors) else {}
        return pd.Series([[{"tbl": t, "coarse": int(c)} for t, picked in by_table.items() for c in picked[i]]
                          for i in range(len(vectors))], dtype=object)

    path, wide_path = scratch_path(spark, "index-vectors"), scratch_path(spark, "index-groups")
    rows.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    keyed = spark.read.parquet(path)
    (keyed.withColumn("_near", F.explode(groups(F.col(vec)))).select("_row", F.col(vec).alias("_v"), "_near.*")
     .write.parquet(wide_path))
    wide = spark.read.parquet(wide_path)
    parts = (wide.groupBy("tbl", "coarse").count().agg(F.max("count")).first()[0] or 0) // BLOCK_ROWS + 1
    left = wide.withColumn("_part", F.pmod(F.xxhash64("_row"), F.lit(parts)))
    right = cells.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))

    def ranked(lpdf: pd.DataFrame, cpdf: pd.DataFrame) -> pd.DataFrame:
        if len(lpdf) == 0 or len(cpdf) == 0:
            return pd.DataFrame({"_row": [], "tbl": [], "coarse": [], "cell": [], "far": []})
        cpdf = cpdf.sort_values("cell")
        C, cell = _matrix(cpdf["centroid"]), cpdf["cell"].to_numpy()
        far = _far(_unit(_matrix(lpdf["_v"]), metric), C)
        at = _best(far, len(cell) if n is None else min(n, len(cell)))
        return pd.DataFrame({"_row": np.repeat(lpdf["_row"].to_numpy(), at.shape[1]), "tbl": lpdf["tbl"].iloc[0],
                             "coarse": lpdf["coarse"].iloc[0], "cell": cell[at].ravel(),
                             "far": np.take_along_axis(far, at, axis=1).ravel()})

    keys = ["tbl", "coarse", "_part"]
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        ranked, "_row long, tbl int, coarse int, cell int, far double")
    if n is not None:
        best = Window.partitionBy("_row", "tbl").orderBy("far", "coarse", "cell")
        near = near.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= n)
    return keyed.join(near, "_row").select(*rows.columns, "tbl", "coarse", "cell")


# ----------------------------------------------------------------------------
# writes
# ----------------------------------------------------------------------------

def _commit(index: VectorIndex, spark: SparkSession, made: Commit) -> None:
    spark.createDataFrame([(made.version, made.filed, made.marked)], "version int, filed boolean, marked boolean") \
        .coalesce(1).write.mode("overwrite").parquet(f"{index.path}/commits/seq={made.seq}")


def _file_rows(index: VectorIndex, filed: DataFrame, seq: int) -> None:
    """Write filed rows (``tbl, coarse, cell, born``, ids, vector) and their counts."""
    spark, path = filed.sparkSession, f"{index.path}/rows/seq={seq}"
    (filed.select("tbl", "coarse", "cell", "born", *index.ids, index.vec)
     .repartitionByRange("tbl", "coarse", "cell", *index.ids).sortWithinPartitions("tbl", "coarse", "cell", *index.ids)
     .write.mode("overwrite").partitionBy("tbl", "coarse").parquet(path))
    (_read_rows(spark, index, [seq]).groupBy("tbl", "cell").agg(F.count(F.lit(1)).alias("n"))
     .write.mode("overwrite").parquet(f"{index.path}/counts/seq={seq}"))


def write_batch(index: VectorIndex, batch: DataFrame | None, *, delete: DataFrame | None = None,
                upsert: bool = True, breadth: int | None = 16) -> int:
    """File a batch (O4 with ``upsert``, O6 without) and take away the ids of ``delete``.

    Vectors that are null, of another length, or zero under cosine are not filed (an
    upsert still takes the old ones away). Of rows with equal ids in one upsert batch
    the one of greatest vector stays. Returns the number of the write; cells beyond the
    bound are split at once.
    """
    frames = [x for x in (batch, delete) if x is not None]
    if not frames:
        raise ValueError("nothing to write: give a batch, ids to delete, or both")
    spark, ids = frames[0].sparkSession, index.id_list
    commits = _commits(spark, index)
    seq, version = (commits[-1].seq + 1 if commits else 0), _version(commits)
    gone = [delete.select(*ids)] if delete is not None else []
    if batch is not None:
        rows = batch.select(*ids, index.vec)
        if upsert:
            rows = rows.groupBy(*ids).agg(F.max(index.vec).alias(index.vec))
            gone.append(batch.select(*ids))
        rows = valid_vectors(rows, index.vec, index.dim)
        if index.metric == "cosine":
            rows = rows.where(F.exists(index.vec, lambda x: x != 0))
        filed = _near_cells(rows, index, live_cells(spark, index, version), index.vec, 1, breadth)
        _file_rows(index, filed.withColumn("born", F.lit(seq)), seq)
    marked = bool(gone and commits)  # nothing was written before the first number
    if marked:
        marks = gone[0] if len(gone) == 1 else gone[0].unionByName(gone[1])
        marks.distinct().write.mode("overwrite").parquet(f"{index.path}/marks/seq={seq}")
    _commit(index, spark, Commit(seq, version, batch is not None, marked))
    if batch is not None:
        split_cells(spark, index)
    return seq


def _read(spark: SparkSession, index: VectorIndex, kind: str, columns: str, seqs: list[int]) -> DataFrame:
    """The folders ``kind/seq=s``; the schema is given, as a write may be empty."""
    paths = [f"{index.path}/{kind}/seq={s}" for s in seqs]
    if not paths:
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).option("basePath", f"{index.path}/{kind}").parquet(*paths)


def _read_rows(spark: SparkSession, index: VectorIndex, seqs: list[int]) -> DataFrame:
    return _read(spark, index, "rows", f"cell int, born int, {index.columns}, seq int, tbl int, coarse int", seqs)


def _counts(spark: SparkSession, index: VectorIndex, seqs: list[int]) -> DataFrame:
    return _read(spark, index, "counts", "tbl int, cell int, n long, seq int", seqs) \
        .groupBy("tbl", "cell").agg(F.sum("n").alias("n"))


def split_cells(spark: SparkSession, index: VectorIndex, train_rows: int = 8192) -> int:
    """Split the cells in use that hold more than ``cell_bound`` rows; returns how many did.

    A cell's children are fitted on at most ``train_rows`` of its distinct vectors, in
    order of a hash of the ids. A cell of one distinct vector stays whole: search cuts it.
    """
    commits = _commits(spark, index)
    seqs, version = [c.seq for c in commits if c.filed], _version(commits)
    cells = live_cells(spark, index, version)
    full = (cells.where("not whole").join(_counts(spark, index, seqs), ["tbl", "cell"])
            .where(F.col("n") > index.cell_bound).select("tbl", "coarse", "cell", "n"))
    full_path = scratch_path(spark, "full-cells")
    full.write.parquet(full_path)
    full = spark.read.parquet(full_path)
    n_full = full.count()
    if n_full == 0:
        return 0
    bound, metric, dim, seed = index.cell_bound, index.metric, index.dim, index.seed
    rows = _read_rows(spark, index, seqs).join(full, ["tbl", "coarse", "cell"])
    order = Window.partitionBy("tbl", "coarse", "cell").orderBy("_h")
    picked = (rows.groupBy("tbl", "coarse", "cell", "n", index.vec).agg(F.min(_hash_order(index.id_list)).alias("_h"))
              .withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= train_rows)
              .select("tbl", "coarse", "cell", "n", "_h", F.col(index.vec).alias("v")))

    def children(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        X = _matrix(pdf.sort_values("_h")["v"], dim)
        C = fit_centroids(X, max(2, math.ceil(2 * int(pdf["n"].iloc[0]) / bound)), metric, seed + int(key[2]))
        return pd.DataFrame({"tbl": key[0], "coarse": key[1], "parent": key[2], "whole": len(C) < 2, "centroid": list(C)})

    everything = spark.read.schema(CELLS).parquet(f"{index.path}/cells/version={version}")
    last = everything.groupBy("tbl").agg(F.max("cell").alias("_last"))
    number = Window.partitionBy("tbl").orderBy("parent", "centroid")
    new_path = scratch_path(spark, "new-cells")
    (picked.groupBy("tbl", "coarse", "cell")
     .applyInPandas(children, "tbl int, coarse int, parent int, whole boolean, centroid array<double>")
     .join(last, "tbl").withColumn("cell", F.col("_last") + F.row_number().over(number)).drop("_last")
     .write.parquet(new_path))
    new = spark.read.parquet(new_path)
    old = full.select("tbl", "cell", F.lit(True).alias("_full"))
    kept = everything.join(old, ["tbl", "cell"], "left").withColumn("used", F.col("used") & F.col("_full").isNull())
    _write_cells(index, kept.select("tbl", "coarse", "cell", "used", "whole", "centroid").unionByName(
        new.select("tbl", "coarse", "cell", F.lit(True).alias("used"), "whole", "centroid")), version + 1)

    # a full cell's rows, in parts of about the bound, meet the cell's children
    parts = F.ceil(F.col("n") / bound).cast("long")
    names = ["tbl", "coarse", "cell", "born", *index.ids, index.vec]
    left = rows.withColumn("_part", F.pmod(F.monotonically_increasing_id(), parts)).select(*names, "_part")
    right = (new.select("tbl", F.col("parent").alias("cell"), F.col("cell").alias("child"), "centroid")
             .join(full.select("tbl", "cell", "n"), ["tbl", "cell"])
             .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))))

    def refile(lpdf: pd.DataFrame, rpdf: pd.DataFrame) -> pd.DataFrame:
        if len(lpdf):
            rpdf = rpdf.sort_values("child")
            far = _far(_unit(_matrix(lpdf[index.vec]), metric), _matrix(rpdf["centroid"]))
            lpdf = lpdf.assign(cell=rpdf["child"].to_numpy()[np.argmin(far, axis=1)])
        return lpdf[names]

    moved = left.groupBy("tbl", "cell", "_part").cogroup(right.groupBy("tbl", "cell", "_part")) \
        .applyInPandas(refile, f"tbl int, coarse int, cell int, born int, {index.columns}")
    seq = commits[-1].seq + 1
    _file_rows(index, moved, seq)
    _commit(index, spark, Commit(seq, version + 1, True, False))
    return n_full


def live_rows(spark: SparkSession, index: VectorIndex, groups: list[tuple[int, int]] | None = None) -> DataFrame:
    """``tbl, coarse, cell``, ids and vector of the rows that count; ``groups``: only those
    (table, coarse group) folders are read."""
    commits = _commits(spark, index)
    rows = _read_rows(spark, index, [c.seq for c in commits if c.filed])
    if groups is not None:
        wanted = {}
        for t, c in groups:
            wanted.setdefault(t, []).append(c)
        keep = F.lit(False)
        for t, cs in sorted(wanted.items()):
            keep = keep | ((F.col("tbl") == t) & F.col("coarse").isin(sorted(cs)))
        rows = rows.where(keep)
    used = live_cells(spark, index, _version(commits)).select("tbl", "coarse", "cell")
    rows = rows.join(used, ["tbl", "coarse", "cell"], "left_semi")
    marked = [c.seq for c in commits if c.marked]
    if marked:
        marks = (_read(spark, index, "marks", f"{index.columns}, seq int", marked).groupBy(*index.ids)
                 .agg(F.max("seq").alias("_gone")))
        marks = marks.select("_gone", *[F.col(c).alias(f"_m_{c}") for c in index.ids])
        same = [rows[c].eqNullSafe(marks[f"_m_{c}"]) for c in index.ids]
        rows = rows.join(marks, same + [F.col("_gone") > F.col("born")], "left_anti")
    return rows.select("tbl", "coarse", "cell", "born", *index.ids, index.vec)


def compact_index(spark: SparkSession, index: VectorIndex, path: str) -> VectorIndex:
    """The rows that count and the cells in use as a fresh index of one write at ``path``."""
    out = VectorIndex(**(asdict(index) | {"path": path}))
    _write_cells(out, live_cells(spark, index).withColumn("used", F.lit(True)), 0)
    spark.createDataFrame([(json.dumps(asdict(out) | {"path": ""}),)], "spec string").write.parquet(f"{path}/spec")
    _file_rows(out, live_rows(spark, index).withColumn("born", F.lit(0)), 0)
    _commit(out, spark, Commit(0, 0, True, False))
    return out


# ----------------------------------------------------------------------------
# search
# ----------------------------------------------------------------------------

def _least(far: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k least of each row of ``far``, equal ones by ``row`` (as many numbers)."""
    if far.shape[1] <= k:
        return np.broadcast_to(np.arange(far.shape[1]), far.shape)
    pick = np.argpartition(far, k - 1, axis=1)[:, :k]
    found = np.take_along_axis(far, pick, axis=1)
    kth = found.max(axis=1, keepdims=True)
    more = (far == kth).sum(1) > (found == kth).sum(1)
    for i in np.flatnonzero(more & np.isfinite(kth[:, 0])):
        tied = np.flatnonzero(far[i] == kth[i])
        less = np.flatnonzero(far[i] < kth[i])
        pick[i] = np.append(less, tied[np.argsort(row[i, tied], kind="stable")[:k - len(less)]])
    return pick


def _block_hits(qpdf: pd.DataFrame, cpdf: pd.DataFrame, ids: list[str], metric: str, k: int) -> pd.DataFrame | None:
    """The k best rows of each query among the cells it probes, by (rounded distance, ids).

    A tile of queries meets the cells one by one; each query keeps the distances to the
    rows of its own cells side by side, and nothing of the others.
    """
    cpdf = cpdf.sort_values(ids, kind="mergesort").reset_index(drop=True)  # position is the tie-break
    C, cell = _matrix(cpdf["_v"]), cpdf["cell"].to_numpy()
    order = np.argsort(cell, kind="stable")
    C, cell, place_of = C[order], cell[order], np.argsort(order)  # the rows of a cell follow each other
    cn = np.einsum("ij,ij->i", C, C)
    start = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    names, size = cell[start], np.diff(np.append(start, len(cell)))
    query = np.repeat(np.arange(len(qpdf)), [len(x) for x in qpdf["cells"]])
    wanted = np.concatenate([np.asarray(x, np.int64) for x in qpdf["cells"]])
    at = np.searchsorted(names, wanted)
    held = at < len(names)
    held[held] = names[at[held]] == wanted[held]
    query, at = query[held], at[held]
    widths = np.bincount(query, size[at], len(qpdf)).astype(np.int64)
    tile = max(16, min(TILE, 2 * NEAR_VALUES // max(1, int(widths.max(initial=0)))))
    out = []
    for s in range(0, len(qpdf), tile):
        part, width = qpdf.iloc[s:s + tile], widths[s:s + tile]
        if not width.any():
            continue
        Q = _matrix(part["_v"])
        qn = np.einsum("ij,ij->i", Q, Q)
        own = slice(*np.searchsorted(query, [s, s + tile]))
        probes = np.unique(np.stack([at[own], query[own] - s]), axis=1)  # by cell
        far, row = np.full((len(part), int(width.max())), np.inf), np.zeros((len(part), int(width.max())), np.int32)
        filled = np.zeros(len(part), np.int64)
        for own in np.split(probes, np.flatnonzero(np.diff(probes[0])) + 1, axis=1):
            c, met = own[0, 0], own[1]
            rows = np.arange(start[c], start[c] + size[c])
            place = (met[:, None], filled[met][:, None] + np.arange(size[c]))
            far[place] = _distances(Q[met], qn[met], C[rows[0]:rows[-1] + 1], cn[rows[0]:rows[-1] + 1], metric)
            row[place] = order[rows]
            filled[met] += size[c]
        np.round(far, DECIMALS, out=far)
        best = _least(far, row, k + SPARE)
        reached = np.isfinite(np.take_along_axis(far, best, axis=1))
        best = np.take_along_axis(row, best, axis=1).astype(np.int64)
        exact = np.full(best.shape, np.inf)
        for r in range(0, len(Q), 64):
            exact[r:r + 64] = _pair_distances(Q[r:r + 64], C[place_of[best[r:r + 64]]], metric)
        exact[~reached] = np.inf
        rank = np.lexsort((best, np.round(exact, DECIMALS)), axis=1)[:, :k]
        exact, best = np.take_along_axis(exact, rank, axis=1), np.take_along_axis(best, rank, axis=1)
        good = np.isfinite(exact)
        hits = cpdf[ids].iloc[best[good]].reset_index(drop=True)
        hits.insert(0, "_qid", part["_qid"].to_numpy(dtype=object)[np.nonzero(good)[0]])
        hits["distance"] = exact[good]
        out.append(hits)
    return pd.concat(out, ignore_index=True) if out else None


def search_index(queries: DataFrame, index: VectorIndex, k: int, nprobe: int | None, *, breadth: int | None = 16,
                 query_id: str = "query_id", query_vec: str = "embedding", block_rows: int = BLOCK_ROWS,
                 compared: list | None = None) -> DataFrame:
    """``query_id, rank, *ids, distance``: the k nearest rows in each query's ``nprobe``
    nearest cells of every table (None: all cells, which is the exact answer).

    ``compared``, a list, gets the number of (query, row) pairs whose distance the search
    works out, counted from the cells' sizes (rows taken away included).
    """
    spark, ids = queries.sparkSession, index.id_list
    if query_id in ids:
        raise ValueError("query id column must not share a name with an id column of the index")
    commits = _commits(spark, index)
    cells = live_cells(spark, index, _version(commits))
    plan_path = scratch_path(spark, "index-plan")
    before = Window.partitionBy("tbl").orderBy("coarse", "cell").rowsBetween(Window.unboundedPreceding, -1)
    (cells.join(_counts(spark, index, [c.seq for c in commits if c.filed]), ["tbl", "cell"])
     .withColumn("block", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / block_rows))
     .select("tbl", "coarse", "cell", "block", "n", F.ceil(F.col("n") / block_rows).cast("int").alias("_cuts"))
     .write.parquet(plan_path))
    plan = spark.read.parquet(plan_path)

    q = valid_vectors(queries.select(F.col(query_id).alias("_qid"), F.col(query_vec).alias("_v")), "_v", index.dim)
    keys = ["tbl", "block", "_cut", "_turn"]
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    turn = lambda turns: F.pmod(F.xxhash64("_qid"), turns.cast("long")).cast("int")
    if nprobe is None:  # one table holds every row
        one = int(cells.agg(F.min("tbl")).first()[0])
        plan = plan.where(F.col("tbl") == one)
        n_queries = q.count()
        if compared is not None:
            compared.append(n_queries * int(plan.agg(F.sum("n")).first()[0] or 0))
        blocks = plan.select("block", every(F.col("_cuts")).alias("_cut")).distinct()
        every_block = F.from_json(F.lit(json.dumps([r.asDict() for r in blocks.collect()])), "array<struct<block:long,_cut:int>>")
        turns = F.lit(max(1, math.ceil(n_queries / block_rows)))
        qx = (q.select(F.lit(one).alias("tbl"), F.explode(every_block).alias("_b"), turn(turns).alias("_turn"), "_qid", "_v")
              .select("tbl", "_b.block", "_b._cut", "_turn", "_qid", "_v"))
        rows = live_rows(spark, index).where(F.col("tbl") == one)
        spread = None
    else:
        probes_path = scratch_path(spark, "index-probes")
        _probed_blocks(q, index, cells, plan, nprobe, breadth).withColumn("_cut", every(F.col("cuts"))).write.parquet(probes_path)
        probes = spark.read.parquet(probes_path)
        if compared is not None:
            met = probes.where("_cut = 0").select("tbl", F.explode("cells").alias("cell"))
            compared.append(int(met.join(plan, ["tbl", "cell"]).agg(F.sum("n")).first()[0] or 0))
        groups = [(r["tbl"], r["g"]) for r in probes.select("tbl", F.explode("groups").alias("g")).distinct().collect()]
        rows = live_rows(spark, index, groups)
        spread = (probes.groupBy("tbl", "block", "_cut").agg(F.count(F.lit(1)).alias("_nq"))
                  .withColumn("_turns", F.ceil(F.col("_nq") / block_rows).cast("int")).drop("_nq"))
        qx = (probes.join(spread, ["tbl", "block", "_cut"]).withColumn("_turn", turn(F.col("_turns")))
              .select(*keys, "_qid", "_v", "cells"))
    cx = (rows.join(plan.select("tbl", "cell", "block", "_cuts"), ["tbl", "cell"])
          .withColumn("_cut", F.pmod(F.xxhash64(*ids), F.col("_cuts").cast("long")).cast("int")))
    cx = cx.withColumn("_turns", turns) if spread is None else cx.join(spread, ["tbl", "block", "_cut"])
    cx = cx.withColumn("_turn", every(F.col("_turns"))).select(*keys, "cell", *ids, F.col(index.vec).alias("_v"))
    schema = _candidate_schema(queries.schema[query_id].dataType, rows, ids)
    metric = index.metric

    def hits(qpdf: pd.DataFrame, cpdf: pd.DataFrame) -> pd.DataFrame:
        if not len(qpdf) or not len(cpdf):
            return _empty(schema)
        if "cells" in qpdf:
            found = _block_hits(qpdf, cpdf, ids, metric, k)
        else:
            found = topk_block(qpdf["_qid"].to_numpy(dtype=object), _matrix(qpdf["_v"]), cpdf[ids], _matrix(cpdf["_v"]), metric, k)
        return found if found is not None else _empty(schema)

    cand = qx.groupBy(*keys).cogroup(cx.groupBy(*keys)).applyInPandas(hits, schema)
    # a row found in cells of several tables has one distance; dealt by query, it is merged and ranked in place
    once = cand.repartition("_qid").groupBy("_qid", *ids).agg(F.min("distance").alias("distance"))
    return _final_topk(once, query_id, ids, k)
