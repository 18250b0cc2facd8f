"""J2, exact: k nearest rows by pivots and triangle inequalities.

Both sides are filed under their nearest pivot (pivots: centroids of a bounded sample;
they decide the cost, never the result). For each pivot a table of a few numbers is kept:
how many corpus rows lie there, their least and greatest distance to the pivot, and the
k least distances. From these alone, for a query q at distance d(q, p) of pivot p:

* no neighbour is farther than the k-th least of d(q, p) + r over all pivots p and kept
  distances r (so many rows lie at least that near);
* a row of p is no nearer than d(q, p) - greatest(p), least(p) - d(q, p), and, q's own
  pivot being o, (d(q, p)^2 - d(q, o)^2) / (2 d(o, p)).

A query goes only to pivots whose lower bound does not exceed its upper bound, so blocks
that cannot hold a neighbour are never shuffled to each other. Cosine search runs on unit
vectors, where the order of cosine and Euclidean distances is the same. The rows are
those of ``knn_join``; vectors without any structure prune nothing and cost what it costs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chunkwise.operators.knn import (BLOCK_ROWS, BROADCAST_MAX_BYTES, DECIMALS, _candidate_schema, _check_metric,
                                     _empty, _final_topk, _matrix, valid_vectors)
from chunkwise.operators.vector_index import _block_hits, _hash_order, _unit, fit_centroids
from chunkwise.session import scratch_path

SLACK = 1e-6  # slack of the bounds, relative to the vectors' length: rounding must not prune
TIE = 4 * 10.0 ** -DECIMALS  # squared distances this near may rank as equal, then by id
TRAIN_PER_PIVOT = 32


def _gaps(X: np.ndarray, P: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows of X to pivots."""
    d = np.einsum("ij,ij->i", X, X)[:, None] + np.einsum("ij,ij->i", P, P) - 2.0 * X @ P.T
    return np.sqrt(np.maximum(d, 0.0))


class _Bounds:
    """Pivots and what is known of the corpus rows filed under each."""

    def __init__(self, pivots: np.ndarray, near: pd.DataFrame, k: int, metric: str):
        self.P, self.metric, self.k = pivots, metric, k
        m = len(pivots)
        self.low, self.high = np.full(m, np.inf), np.full(m, -np.inf)
        self.kept = np.full((m, k), np.inf)
        for r in near.itertuples():
            self.low[r.pivot], self.high[r.pivot] = r.least, r.greatest
            self.kept[r.pivot, :len(r.kept)] = sorted(r.kept)
        self.between = _gaps(pivots, pivots)

    def visits(self, V: np.ndarray) -> list[np.ndarray]:
        """For each query the pivots that can hold one of its k nearest rows."""
        out = []
        for s in range(0, len(V), 512):
            X = _unit(V[s:s + 512], self.metric)
            d = _gaps(X, self.P)
            own = np.argmin(d, axis=1)
            # column by column: the i-th nearest row of every pivot; k of all of them bound the k-th neighbour
            reach = np.concatenate([d + self.kept[:, i] for i in range(self.k)], axis=1)
            upper = np.partition(reach, self.k - 1, axis=1)[:, self.k - 1:self.k]
            between = self.between[own]
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = np.where(between > 0, (d * d - d[np.arange(len(d)), own][:, None] ** 2) / (2.0 * between), 0.0)
            lower = np.maximum(np.maximum(d - self.high, self.low - d), plane)
            slack = SLACK * (1.0 + np.linalg.norm(X, axis=1, keepdims=True) + d)
            reached = np.maximum(lower, 0.0) ** 2 <= (upper + slack) ** 2 + TIE
            out += [np.flatnonzero(x) for x in reached & np.isfinite(self.low)]
        return out


def _pivots(c: DataFrame, ids: list[str], n: int, metric: str, dim: int, k: int, seed: int) -> np.ndarray:
    """About sqrt(n) centroids, as many as their table of bounds may be broadcast."""
    per = 8 * (dim + k + 2)
    m = max(1, min(math.ceil(math.sqrt(n)), BROADCAST_MAX_BYTES // per, math.isqrt(BROADCAST_MAX_BYTES // 8)))
    sample = (c.withColumn("_h", _hash_order(ids)).groupBy("_v").agg(F.min("_h").alias("_h"))
              .orderBy("_h").limit(min(TRAIN_PER_PIVOT * m, max(m, BROADCAST_MAX_BYTES // (8 * dim)))))
    X = _matrix([r["_v"] for r in sample.collect()], dim)
    return fit_centroids(X, m, metric, seed) if len(X) else np.zeros((1, dim))


def knn_join_pruned(queries: DataFrame, corpus: DataFrame, k: int, metric: str = "l2sq", *,
                    query_id: str = "query_id", query_vec: str = "embedding",
                    corpus_ids: tuple[str, ...] | list[str] = ("id",), corpus_vec: str = "embedding",
                    dim: int, block_rows: int = BLOCK_ROWS, seed: int = 5, stats: dict | None = None) -> DataFrame:
    """Exact k nearest corpus rows for every query: ``query_id, rank, *ids, distance``.

    ``stats`` gets ``pairs`` and ``compared`` (query-row pairs in all, and worked out),
    ``block_pairs`` and ``visited`` (the same for queries' pivots and corpus pivots).
    """
    _check_metric(metric)
    ids = list(corpus_ids)
    if query_id in ids:
        raise ValueError("query id column must not share a name with a corpus id column")
    spark = queries.sparkSession
    q = valid_vectors(queries.select(F.col(query_id).alias("_qid"), F.col(query_vec).alias("_v")), "_v", dim)
    c = valid_vectors(corpus.select(*ids, F.col(corpus_vec).alias("_v")), "_v", dim)
    if metric == "cosine":  # a zero vector has no cosine distance
        q, c = (x.where(F.exists("_v", lambda y: y != 0)) for x in (q, c))
    P = _pivots(c, ids, corpus.select(*ids).count(), metric, dim, k, seed)
    bc = spark.sparkContext.broadcast(P)

    @F.pandas_udf("struct<cell:int,r:double>")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        d = _gaps(_unit(_matrix(vectors, dim), metric), bc.value)
        at = np.argmin(d, axis=1) if len(d) else np.zeros(0, np.int64)
        return pd.DataFrame({"cell": at.astype(np.int32), "r": d[np.arange(len(d)), at]})

    path = scratch_path(spark, "pivot-rows")
    c.withColumn("_p", nearest("_v")).select(*ids, "_v", "_p.cell", "_p.r").write.parquet(path)
    rows = spark.read.parquet(path)
    first = Window.partitionBy("cell").orderBy("r")
    kept = (rows.select("cell", "r").withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k)
            .groupBy("cell").agg(F.collect_list("r").alias("kept")))
    near = (rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("r").alias("least"), F.max("r").alias("greatest"))
            .join(kept, "cell").withColumnRenamed("cell", "pivot").toPandas())  # a row a pivot
    bounds = spark.sparkContext.broadcast(_Bounds(P, near, k, metric))

    near = near.sort_values("pivot")
    ahead = near["n"].cumsum() - near["n"]
    plan = spark.createDataFrame(
        [(int(p), int(a // block_rows), int(n), -(-int(n) // block_rows)) for p, a, n in zip(near["pivot"], ahead, near["n"])],
        "cell int, block long, n long, _cuts int")

    @F.pandas_udf("array<int>")
    def visits(vectors: pd.Series) -> pd.Series:
        found = bounds.value.visits(_matrix(vectors, dim)) if len(vectors) else []
        return pd.Series([x.astype(np.int32) for x in found], dtype=object)

    probes_path = scratch_path(spark, "pivot-probes")
    (q.withColumn("cell", F.explode(visits("_v"))).join(F.broadcast(plan), "cell")
     .withColumn("_cut", F.explode(F.sequence(F.lit(0), F.col("_cuts") - 1)))
     .groupBy("block", "_cut", "_qid").agg(F.first("_v").alias("_v"), F.collect_list("cell").alias("cells"),
                                           F.sum(F.when(F.col("_cut") == 0, F.col("n")).otherwise(0)).alias("n"))
     .write.parquet(probes_path))
    probes = spark.read.parquet(probes_path)
    if stats is not None:
        n_queries = q.count()
        own = q.select(F.col("_qid"), nearest("_v")["cell"].alias("own"))
        seen = probes.where("_cut = 0").select("_qid", F.explode("cells").alias("cell")).join(own, "_qid")
        stats |= {"pairs": n_queries * int(near["n"].sum()), "compared": int(probes.agg(F.sum("n")).first()[0] or 0),
                  "block_pairs": own.select("own").distinct().count() * len(near),
                  "visited": seen.select("own", "cell").distinct().count()}

    spread = (probes.groupBy("block", "_cut").agg(F.count(F.lit(1)).alias("_nq"))
              .withColumn("_turns", F.ceil(F.col("_nq") / block_rows).cast("int")).drop("_nq"))
    keys = ["block", "_cut", "_turn"]
    qx = (probes.join(spread, ["block", "_cut"])
          .withColumn("_turn", F.pmod(F.xxhash64("_qid"), F.col("_turns").cast("long")).cast("int"))
          .select(*keys, "_qid", "_v", "cells"))
    cx = (rows.join(F.broadcast(plan.drop("n")), "cell")
          .withColumn("_cut", F.pmod(F.xxhash64(*ids), F.col("_cuts").cast("long")).cast("int"))
          .join(spread, ["block", "_cut"])
          .withColumn("_turn", F.explode(F.sequence(F.lit(0), F.col("_turns") - 1)))
          .select(*keys, "cell", *ids, "_v"))
    schema = _candidate_schema(queries.schema[query_id].dataType, corpus, ids)

    def hits(qpdf: pd.DataFrame, cpdf: pd.DataFrame) -> pd.DataFrame:
        found = _block_hits(qpdf, cpdf, ids, metric, k) if len(qpdf) and len(cpdf) else None
        return found if found is not None else _empty(schema)

    return _final_topk(qx.groupBy(*keys).cogroup(cx.groupBy(*keys)).applyInPandas(hits, schema), query_id, ids, k)
