"""S3 with a coded first stage: fetch by product codes, keep by exact distance.

A vector is cut into ``groups`` runs of dimensions; each run is coded by the nearest of at
most 256 centroids of its own codebook, one byte a run. The first stage reads ids and
codes only: for a query, a table of squared distances to the 256 centroids of each run
turns a code into a distance by one look-up a run. Which rows can be among the nearest is
found by one matrix product a tile, in single precision and with a margin for its error;
only those are looked up. The ``fetch`` nearest by code meet their vectors in a join by
id, and the ``keep`` nearest by exact distance stay.

Codebooks are fitted on a bounded sample (``train_rows`` distinct vectors, in order of a
hash of the ids); every vector is coded. Cosine search codes unit vectors. Null, empty,
wrongly sized and (under cosine) zero vectors have no code and give no hit.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chunkwise.operators.knn import (BLOCK_ROWS, DECIMALS, _candidate_schema, _check_metric, _empty, _matrix,
                                     distance_column, valid_vectors)
from chunkwise.operators.vector_index import _far, _hash_order, _unit, fit_centroids
from chunkwise.session import scratch_path

CODES = 256
TILE_QUERIES, TILE_CODES = 256, 4096


@dataclass(frozen=True)
class CodedStore:
    """Codes on disk (``*ids, code``) and the codebooks they refer to."""
    path: str
    books: tuple[np.ndarray, ...]
    metric: str
    ids: tuple[str, ...]
    vec: str
    dim: int
    rows: int

    @property
    def starts(self) -> list[int]:
        return [0, *np.cumsum([b.shape[1] for b in self.books]).tolist()]


def _runs(dim: int, groups: int) -> list[int]:
    """Bounds of ``groups`` runs of dimensions, as even as can be."""
    return [dim * g // groups for g in range(groups + 1)]


def _indexable(df: DataFrame, vec: str, dim: int, metric: str) -> DataFrame:
    df = valid_vectors(df, vec, dim)
    return df.where(F.exists(vec, lambda x: x != 0)) if metric == "cosine" else df


def build_codes(corpus: DataFrame, metric: str = "cosine", *, ids: tuple[str, ...] | list[str] = ("id",),
                vec: str = "embedding", dim: int, groups: int = 16, train_rows: int = 16_384, seed: int = 3,
                path: str | None = None) -> CodedStore:
    """Fit the codebooks and write one code per indexable vector."""
    _check_metric(metric)
    if not 1 <= groups <= dim:
        raise ValueError("groups must be between 1 and dim")
    ids, spark = list(ids), corpus.sparkSession
    rows = _indexable(corpus.select(*ids, vec), vec, dim, metric)
    sample = (rows.withColumn("_h", _hash_order(ids)).groupBy(vec).agg(F.min("_h").alias("_h"))
              .orderBy("_h").limit(train_rows).select(vec).collect())
    X = _unit(_matrix([r[0] for r in sample], dim), metric) if sample else np.zeros((1, dim))
    cut = _runs(dim, groups)
    books = tuple(fit_centroids(X[:, a:b], CODES, "l2sq", seed + a) for a, b in zip(cut, cut[1:]))
    bc = spark.sparkContext.broadcast(books)

    @F.pandas_udf("binary")
    def code(vectors: pd.Series) -> pd.Series:
        if len(vectors) == 0:
            return pd.Series([], dtype=object)
        V = _unit(_matrix(vectors, dim), metric)
        codes = np.stack([np.argmin(_far(V[:, a:b], book), axis=1) for a, b, book in zip(cut, cut[1:], bc.value)], axis=1)
        return pd.Series([bytes(c) for c in codes.astype(np.uint8)])

    path = path or scratch_path(spark, "codes")
    rows.select(*ids, code(vec).alias("code")).write.mode("errorifexists").parquet(path)
    return CodedStore(path, books, metric, tuple(ids), vec, dim, spark.read.parquet(path).count())


def code_distances(Q: np.ndarray, codes: np.ndarray, books: tuple[np.ndarray, ...]) -> np.ndarray:
    """Squared distances of queries to coded rows, from one table of distances a run."""
    out, at = np.zeros((len(Q), len(codes))), 0
    for g, book in enumerate(books):
        part = Q[:, at:at + book.shape[1]]
        table = np.maximum(np.einsum("ij,ij->i", part, part)[:, None] + _far(part, book), 0.0)
        out += table[:, codes[:, g]]
        at += book.shape[1]
    return out


def _first_of_equal(rows: pd.DataFrame, codes: np.ndarray, n: int) -> tuple[pd.DataFrame, np.ndarray]:
    """The first ``n`` rows of each code: position breaks ties, so no later one is fetched."""
    own = np.unique(np.ascontiguousarray(codes).view(f"V{codes.shape[1]}").ravel(), return_inverse=True)[1]
    order = np.argsort(own, kind="stable")
    size = np.bincount(own)
    place = np.empty(len(own), np.int64)
    place[order] = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)
    kept = np.flatnonzero(place < n)
    return rows.iloc[kept].reset_index(drop=True), codes[kept]


def _near_codes(Q: np.ndarray, codes: np.ndarray, books: tuple[np.ndarray, ...], fetch: int) -> tuple[np.ndarray, np.ndarray]:
    """``(rows of Q, rows of codes)`` that hold for each query its ``fetch`` nearest codes, equal
    ones at the border included: those within the error of a product in single precision."""
    size = np.einsum("ij,ij->i", Q, Q) + sum(np.einsum("ij,ij->i", book, book).max() for book in books)
    kind = np.float32 if size.max(initial=0) < 1e36 else np.float64  # no overflow
    left = np.concatenate([-2.0 * Q, np.ones((len(Q), 1))], axis=1).astype(kind)
    # |q|^2 + |c|^2 bounds every term: rounding of the factors and of the sum, on both sides
    margin = 2 * (np.finfo(kind).eps * (Q.shape[1] + 2) * size + 10.0 ** -DECIMALS)
    best, limit, found = np.empty((len(Q), 0), kind), np.full(len(Q), np.inf), []
    for t in range(0, len(codes), TILE_CODES):
        part = np.concatenate([book[codes[t:t + TILE_CODES, g]] for g, book in enumerate(books)], axis=1)
        own = np.einsum("ij,ij->i", part, part)
        d = left @ np.concatenate([part, own[:, None]], axis=1).astype(kind).T
        if t == 0:
            best = np.partition(d, min(fetch, d.shape[1]) - 1, axis=1)[:, :fetch]
        else:
            row, at = np.nonzero(d <= limit[:, None])
            if len(row):
                n = np.bincount(row, minlength=len(Q))
                more = np.full((len(Q), n.max()), np.inf, kind)
                more[row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)] = d[row, at]
                best = np.concatenate([best, more], axis=1)
                best = np.partition(best, min(fetch, best.shape[1]) - 1, axis=1)[:, :fetch]
        if best.shape[1] == fetch:
            limit = np.maximum.reduce(best, axis=1).astype(np.float64) + margin
        if t == 0:
            row, at = np.nonzero(d <= limit[:, None])
        found.append((row, at + t, d[row, at]))
    row, at, d = (np.concatenate([f[i] for f in found]) for i in range(3))
    kept = d <= limit[row]
    return row[kept], at[kept]


def _looked_up(Q: np.ndarray, codes: np.ndarray, books: tuple[np.ndarray, ...], row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``code_distances`` of single pairs: the same look-ups, added in the same order."""
    out, start = np.zeros(len(row)), 0
    for g, book in enumerate(books):
        part = Q[:, start:start + book.shape[1]]
        table = np.maximum(np.einsum("ij,ij->i", part, part)[:, None] + _far(part, book), 0.0)
        out += table[row, codes[at, g]]
        start += book.shape[1]
    return out


def fetch_by_code(queries: DataFrame, store: CodedStore, fetch: int, *, query_id: str = "query_id",
                  query_vec: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """First stage: ``_qid, *ids, distance`` of the ``fetch`` rows nearest by code. Each
    (block of queries, block of codes) is one bounded cogroup."""
    spark, ids = queries.sparkSession, list(store.ids)
    if query_id in ids:
        raise ValueError("query id column must not share a name with a corpus id column")
    q = _indexable(queries.select(F.col(query_id).alias("_qid"), F.col(query_vec).alias("_v")), "_v", store.dim, store.metric)
    # codes are small: long blocks of them with short ones of queries, so that few candidates are made
    turns = max(1, math.ceil(4 * queries.select(query_id).count() / block_rows))
    cuts = max(1, math.ceil(store.rows / (4 * block_rows)))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    qx = q.withColumn("_qb", F.pmod(F.xxhash64("_qid"), F.lit(turns))).withColumn("_cb", every(cuts))
    codes = spark.read.parquet(store.path)
    cx = codes.withColumn("_cb", F.pmod(F.xxhash64(*ids), F.lit(cuts))).withColumn("_qb", every(turns))
    bc, metric = spark.sparkContext.broadcast(store.books), store.metric
    schema = _candidate_schema(queries.schema[query_id].dataType, codes, ids)

    def near(qpdf: pd.DataFrame, cpdf: pd.DataFrame) -> pd.DataFrame:
        if len(qpdf) == 0 or len(cpdf) == 0:
            return _empty(schema)
        cpdf = cpdf.sort_values(ids, kind="mergesort").reset_index(drop=True)  # position is the tie-break
        coded = np.frombuffer(b"".join(cpdf["code"]), np.uint8).reshape(len(cpdf), -1)
        cpdf, coded = _first_of_equal(cpdf, coded, fetch)
        Q, out = _unit(_matrix(qpdf["_v"]), metric), []
        for s in range(0, len(Q), TILE_QUERIES):
            part = Q[s:s + TILE_QUERIES]
            row, at = _near_codes(part, coded, bc.value, fetch)
            far = np.round(_looked_up(part, coded, bc.value, row, at), DECIMALS)
            order = np.lexsort((at, far, row))
            row, at, far = row[order], at[order], far[order]
            n = np.bincount(row, minlength=len(part))
            kept = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) < fetch
            hits = cpdf[ids].iloc[at[kept]].reset_index(drop=True)
            hits.insert(0, "_qid", qpdf["_qid"].to_numpy(dtype=object)[s + row[kept]])
            hits["distance"] = far[kept]
            out.append(hits)
        return pd.concat(out, ignore_index=True)

    cand = qx.groupBy("_qb", "_cb").cogroup(cx.groupBy("_qb", "_cb")).applyInPandas(near, schema)
    best = Window.partitionBy("_qid").orderBy("distance", *ids)
    return cand.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= fetch).drop("_n")


def coded_search(queries: DataFrame, store: CodedStore, vectors: DataFrame, fetch: int, keep: int, *,
                 query_id: str = "query_id", query_vec: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, *ids, distance``: of the ``fetch`` rows nearest by code the ``keep``
    nearest by exact distance. ``vectors`` holds ``*ids`` (unique) and the vectors; only
    fetched ids meet it."""
    ids, spark = list(store.ids), queries.sparkSession
    path = scratch_path(spark, "fetched")
    fetch_by_code(queries, store, fetch, query_id=query_id, query_vec=query_vec, block_rows=block_rows) \
        .select("_qid", *ids).write.parquet(path)
    fetched = spark.read.parquet(path)
    q = queries.select(F.col(query_id).alias("_qid"), F.col(query_vec).alias("_qv"))
    pairs = fetched.join(vectors.select(*ids, F.col(store.vec).alias("_cv")), ids).join(q, "_qid")
    scored = pairs.select("_qid", *ids, distance_column("_cv", F.col("_qv"), store.metric).alias("distance"))
    best = Window.partitionBy("_qid").orderBy(F.round("distance", DECIMALS), *ids)
    return (scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)
            .select(F.col("_qid").alias(query_id), "rank", *ids, "distance"))
