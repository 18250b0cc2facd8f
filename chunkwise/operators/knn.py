"""K-nearest-neighbour search as Spark jobs.

Exact batch search (``knn_join``) has two physical forms, chosen by the caller or by size:

* **blocked** (default): both sides are hashed into blocks of ``BLOCK_ROWS`` rows;
  each (query block, corpus block) pair is one cogroup, so no task ever holds more
  than a block of either side, and all pairs are never materialised.
* **broadcast**: for query sets known to be small. They are broadcast and every
  corpus task keeps its k best per query while it reads; a set above
  ``BROADCAST_MAX_BYTES`` is refused.

Both forms share one kernel: tiles of fixed shape, a running best-k per query, kept
candidates scored again one pair at a time. A pair's distance therefore does not
depend on how rows were dealt out, and ranks go by the distance rounded to nine
decimals, then by ids.

``ann_join`` is the approximate search that the stores' HNSW indexes stand for,
re-expressed as an inverted-file index: k-means cells, a written corpus tagged by
cell, and an equi-join of queries (exploded over their ``nprobe`` nearest cells)
with the corpus on cell. Cells larger than ``block_rows`` are split into sub-blocks
on both sides, so a hot cell becomes many bounded tasks.

Ties on distance are broken by the corpus id columns ascending. Zero vectors have
no cosine distance and produce no hit; invalid vectors are filtered by
``valid_vectors`` (P12).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwise.functions.vectors import cosine_distance, l2sq_distance
from chunkwise.session import scratch_path

METRICS = ("cosine", "l2sq")
BROADCAST_MAX_BYTES = 64 * 1024 * 1024   # query matrix shipped to every executor
BLOCK_ROWS = 16_384                       # rows of one side in one cogroup task
TILE_QUERIES, TILE_ROWS = 512, 2048       # shape of one distance matrix
SPARE = 16                                # candidates kept beyond k until pairs are scored again
DECIMALS = 9                              # distances are ranked as rounded to so many
REDUCE_EVERY = 8                          # batches between in-task top-k merges
BOUNDED_HITS = 1_000_000                  # hits that count as proven small


def _check_metric(metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, got {metric!r}")


def valid_vectors(df: DataFrame, vec: str = "embedding", dim: int | None = None,
                  observation=None) -> DataFrame:
    """Drop rows whose vector is null, empty, or not ``dim`` long.

    With a ``pyspark.sql.Observation``, the number of rows seen and rejected is
    recorded while the query runs (no extra pass).
    """
    cond = F.col(vec).isNotNull() & (F.size(vec) > 0)
    if dim is not None:
        cond = cond & (F.size(vec) == dim)
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"),
                        F.sum(F.when(cond, 0).otherwise(1)).alias("rejected"))
    return df.where(cond)


def distance_column(vec: str | Column, target: Column, metric: str) -> Column:
    _check_metric(metric)
    return cosine_distance(vec, target) if metric == "cosine" else l2sq_distance(vec, target)


# ----------------------------------------------------------------------------
# numpy kernel shared by every physical form
# ----------------------------------------------------------------------------

def _matrix(values, dim: int | None = None) -> np.ndarray:
    if len(values) == 0:
        return np.empty((0, dim or 0), dtype=np.float64)
    return np.stack([np.asarray(v, dtype=np.float64) for v in values])


def _distances(Q: np.ndarray, qn: np.ndarray, C: np.ndarray, cn: np.ndarray, metric: str) -> np.ndarray:
    dot = Q @ C.T
    if metric == "cosine":
        with np.errstate(divide="ignore", invalid="ignore"):
            d = 1.0 - dot / np.sqrt(np.multiply.outer(qn, cn))
        d[~np.isfinite(d)] = np.inf
    else:
        d = np.maximum(qn[:, None] + cn[None, :] - 2.0 * dot, 0.0)
    return d


def _pair_distances(Q: np.ndarray, C: np.ndarray, metric: str) -> np.ndarray:
    """Distances of rows (query, candidate, dim): each pair by itself, in one order
    of summation, so tiles and blocks cannot change the last bits."""
    if metric == "cosine":
        dot = np.einsum("qd,qcd->qc", Q, C)
        norms = np.sqrt(np.einsum("qd,qd->q", Q, Q)[:, None] * np.einsum("qcd,qcd->qc", C, C))
        with np.errstate(divide="ignore", invalid="ignore"):
            d = 1.0 - dot / norms
        d[~np.isfinite(d)] = np.inf
        return d
    gap = Q[:, None, :] - C
    return np.einsum("qcd,qcd->qc", gap, gap)


def _best(d: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k least of each row, equal ones by column, as (rows, k)."""
    if d.shape[1] <= k:
        return np.broadcast_to(np.arange(d.shape[1]), d.shape)
    kth = np.partition(d, k - 1, axis=1)[:, k - 1:k]
    less, tied = d < kth, d == kth
    pick = less | (tied & (np.cumsum(tied, axis=1) <= k - less.sum(1, keepdims=True)))
    return np.nonzero(pick)[1].reshape(len(d), k)


def topk_block(qids: np.ndarray, Q: np.ndarray, ids: pd.DataFrame, C: np.ndarray,
               metric: str, k: int) -> pd.DataFrame | None:
    """For each query row of ``Q``, its k best rows of ``C`` by (rounded distance, ids).

    Works through tiles of fixed shape with a running best-k per query, so memory is
    that of the inputs, one tile and queries x (k + SPARE). Returns
    ``_qid, *ids, distance`` or None when nothing qualifies.
    """
    if len(ids) == 0 or len(qids) == 0:
        return None
    if Q.shape[1] != C.shape[1]:
        raise ValueError(f"query dimension {Q.shape[1]} != corpus dimension {C.shape[1]}")
    ids = ids.reset_index(drop=True)
    order = ids.sort_values(list(ids.columns), kind="mergesort").index.to_numpy()
    ids, C = ids.iloc[order].reset_index(drop=True), C[order]  # from here position is the tie-break
    qn, cn = np.einsum("ij,ij->i", Q, Q), np.einsum("ij,ij->i", C, C)
    keep = k + SPARE
    rows, at, far = [], [], []
    for s in range(0, len(qids), TILE_QUERIES):
        q, own = Q[s:s + TILE_QUERIES], qn[s:s + TILE_QUERIES]
        best_d = np.empty((len(q), 0))
        best_i = np.empty((len(q), 0), dtype=np.int64)
        for t in range(0, len(C), TILE_ROWS):
            d = np.round(_distances(q, own, C[t:t + TILE_ROWS], cn[t:t + TILE_ROWS], metric), DECIMALS)
            pick = _best(d, keep)
            d = np.concatenate([best_d, np.take_along_axis(d, pick, axis=1)], axis=1)
            i = np.concatenate([best_i, pick + t], axis=1)  # earlier tiles hold smaller positions
            pick = _best(d, keep)
            best_d, best_i = np.take_along_axis(d, pick, axis=1), np.take_along_axis(i, pick, axis=1)
        exact = np.empty_like(best_d)
        for r in range(0, len(q), 64):  # bounds the gathered rows
            exact[r:r + 64] = _pair_distances(q[r:r + 64], C[best_i[r:r + 64]], metric)
        rank = np.lexsort((best_i, np.round(exact, DECIMALS)), axis=1)[:, :k]
        exact, best_i = np.take_along_axis(exact, rank, axis=1), np.take_along_axis(best_i, rank, axis=1)
        good = np.isfinite(exact)
        rows.append(np.nonzero(good)[0] + s)
        at.append(best_i[good])
        far.append(exact[good])
    rows, at, far = np.concatenate(rows), np.concatenate(at), np.concatenate(far)
    if len(rows) == 0:
        return None
    out = ids.iloc[at].reset_index(drop=True)
    out.insert(0, "_qid", qids[rows])
    out["distance"] = far
    return out


def _reduce(frames: list[pd.DataFrame], id_cols: list[str], k: int) -> pd.DataFrame | None:
    frames = [f for f in frames if f is not None and len(f)]
    if not frames:
        return None
    allc = pd.concat(frames, ignore_index=True)
    if len(frames) == 1:
        return allc
    allc["_round"] = allc["distance"].round(DECIMALS)
    allc = allc.sort_values(["_qid", "_round", *id_cols], kind="mergesort").drop(columns="_round")
    return allc.groupby("_qid", sort=False).head(k)


def _empty(schema: T.StructType) -> pd.DataFrame:
    return pd.DataFrame({f.name: pd.Series([], dtype=object) for f in schema.fields})


def _candidate_schema(qtype: T.DataType, corpus: DataFrame, id_cols: list[str]) -> T.StructType:
    fields = [T.StructField("_qid", qtype)]
    fields += [T.StructField(c, corpus.schema[c].dataType) for c in id_cols]
    fields.append(T.StructField("distance", T.DoubleType()))
    return T.StructType(fields)


def _final_topk(cand: DataFrame, query_id: str, id_cols: list[str], k: int) -> DataFrame:
    w = Window.partitionBy("_qid").orderBy(F.round("distance", DECIMALS), *id_cols)
    return (cand.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k)
            .select(F.col("_qid").alias(query_id), "rank", *id_cols, "distance"))


# ----------------------------------------------------------------------------
# One query vector
# ----------------------------------------------------------------------------

def knn(corpus: DataFrame, vector, k: int, metric: str = "cosine",
        ids: tuple[str, ...] | list[str] = ("id",), vec: str = "embedding",
        payload: bool = True) -> DataFrame:
    """k nearest rows to one literal vector: ``*ids, distance, rank`` (+ the other
    corpus columns when ``payload``).

    Ranking carries only ids and distance (planned as ``TakeOrderedAndProject``:
    per-partition top-k, k rows per partition merged); the payload of the k
    winners is joined afterwards, so no text funnels into the merging task.
    """
    from chunkwise.operators.hits import with_payload

    ids = list(ids)
    target = F.array(*[F.lit(float(x)) for x in vector]).cast("array<double>")
    dist = distance_column(vec, target, metric)
    top = (corpus.select(*ids, dist.alias("distance")).where(F.col("distance").isNotNull())
           .orderBy("distance", *ids).limit(k))
    top = top.withColumn("rank", F.row_number().over(Window.orderBy("distance", *ids)))
    if not payload:
        return top
    rest = corpus.select(*ids, *[c for c in corpus.columns if c not in ids and c != "distance"])
    return with_payload(top, rest, ids, how="inner", hits_bounded=True)


# ----------------------------------------------------------------------------
# Exact batch search
# ----------------------------------------------------------------------------

@dataclass
class KnnResult:
    """Hits plus whether their row count is proven small (broadcast queries x k is at
    most ``BOUNDED_HITS``)."""
    hits: DataFrame
    bounded: bool


def knn_join(queries: DataFrame, corpus: DataFrame, k: int, metric: str = "cosine", **kw) -> DataFrame:
    """Exact k nearest corpus rows for every query: ``query_id, rank, *ids, distance``.

    Keyword arguments as for ``knn_search``.
    """
    return knn_search(queries, corpus, k, metric, **kw).hits


def knn_search(queries: DataFrame, corpus: DataFrame, k: int, metric: str = "cosine", *,
               query_id: str = "query_id", query_vec: str = "embedding",
               corpus_ids: tuple[str, ...] | list[str] = ("id",), corpus_vec: str = "embedding",
               dim: int | None = None, strategy: str = "blocked",
               broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
               block_rows: int = BLOCK_ROWS) -> KnnResult:
    """Exact k nearest corpus rows for every query, with the bound flag.

    ``strategy``: ``blocked``; ``broadcast`` for a query set known to be small (one whose
    vectors exceed ``broadcast_max_bytes`` raises); or ``auto``, which measures the query
    vectors and broadcasts those within the limit. The rows are the same.
    """
    _check_metric(metric)
    ids = list(corpus_ids)
    if query_id in ids:
        raise ValueError("query id column must not share a name with a corpus id column")
    q = valid_vectors(queries.select(query_id, query_vec), query_vec, dim)
    c = valid_vectors(corpus.select(*ids, corpus_vec), corpus_vec, dim)
    qtype = queries.schema[query_id].dataType
    schema = _candidate_schema(qtype, corpus, ids)
    if strategy == "auto":
        strategy = "broadcast" if _vector_bytes(q, query_vec)[1] <= broadcast_max_bytes else "blocked"
    if strategy == "broadcast":
        cand, rows = _broadcast_candidates(q, c, query_id, query_vec, ids, corpus_vec, metric, k,
                                           schema, broadcast_max_bytes)
        return KnnResult(_final_topk(cand, query_id, ids, k), bounded=rows * k <= BOUNDED_HITS)
    if strategy != "blocked":
        raise ValueError(f"unknown strategy {strategy!r}")
    cand = _blocked_candidates(q, c, query_id, query_vec, ids, corpus_vec, metric, k, schema, block_rows,
                               queries.select(query_id).count(), corpus.select(*ids).count())
    return KnnResult(_final_topk(cand, query_id, ids, k), bounded=False)


def _vector_bytes(q: DataFrame, vec: str) -> tuple[int, int]:
    """Rows of a query set and the bytes of its vectors as the kernel holds them."""
    size = q.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size(vec)).alias("values")).first()
    return int(size["n"]), 8 * int(size["values"] or 0)


def _broadcast_candidates(q: DataFrame, c: DataFrame, query_id: str, query_vec: str, ids: list[str],
                          corpus_vec: str, metric: str, k: int, schema: T.StructType,
                          max_bytes: int) -> tuple[DataFrame, int]:
    """Every corpus task scores its rows against the broadcast queries and emits its k
    best per query; inside a task the running top-k is merged every few batches.
    Returns the candidates and the number of queries."""
    n, size = _vector_bytes(q, query_vec)
    if size > max_bytes:
        raise ValueError(f"{n} query vectors exceed {max_bytes} bytes: too large to broadcast")
    probe = q.toPandas()
    qids = probe[query_id].to_numpy(dtype=object)
    bc = c.sparkSession.sparkContext.broadcast((qids, _matrix(probe[query_vec])))

    def run(batches):
        qids_b, Q_b = bc.value
        frames = []
        for pdf in batches:
            if len(pdf) == 0:
                continue
            frames.append(topk_block(qids_b, Q_b, pdf[ids], _matrix(pdf[corpus_vec]), metric, k))
            if len(frames) >= REDUCE_EVERY:
                frames = [_reduce(frames, ids, k)]
        res = _reduce(frames, ids, k)
        if res is not None:
            yield res

    return c.mapInPandas(run, schema), len(qids)


def _cogroup_topk(qx: DataFrame, cx: DataFrame, keys: list[str], ids: list[str], metric: str,
                  k: int, schema: T.StructType) -> DataFrame:
    """Cogroup queries (``_qid, _v``) and corpus (``*ids, _v``) on ``keys``; k best per query."""
    def run(qpdf: pd.DataFrame, cpdf: pd.DataFrame) -> pd.DataFrame:
        if len(qpdf) == 0 or len(cpdf) == 0:
            return _empty(schema)
        res = topk_block(qpdf["_qid"].to_numpy(dtype=object), _matrix(qpdf["_v"]),
                         cpdf[ids], _matrix(cpdf["_v"]), metric, k)
        return res if res is not None else _empty(schema)

    return qx.groupBy(*keys).cogroup(cx.groupBy(*keys)).applyInPandas(run, schema)


def _blocked_candidates(q: DataFrame, c: DataFrame, query_id: str, query_vec: str,
                        ids: list[str], corpus_vec: str, metric: str, k: int,
                        schema: T.StructType, block_rows: int, n_queries: int,
                        n_corpus: int) -> DataFrame:
    """Blocks sized from row counts; upper bounds are enough (invalid vectors
    are filtered later), so the counts need not read the vector column."""
    nq_blocks = max(1, math.ceil(n_queries / block_rows))
    nc_blocks = max(1, math.ceil(n_corpus / block_rows))
    qx = (q.select(F.col(query_id).alias("_qid"), F.col(query_vec).alias("_v"))
          .withColumn("_qb", F.pmod(F.xxhash64("_qid"), F.lit(nq_blocks)))
          .withColumn("_cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nc_blocks - 1).cast("long")))))
    cx = (c.select(*ids, F.col(corpus_vec).alias("_v"))
          .withColumn("_cb", F.pmod(F.xxhash64(*ids), F.lit(nc_blocks)))
          .withColumn("_qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nq_blocks - 1).cast("long")))))
    return _cogroup_topk(qx, cx, ["_qb", "_cb"], ids, metric, k, schema)


# ----------------------------------------------------------------------------
# Approximate search over an inverted-file index
# ----------------------------------------------------------------------------

@dataclass
class IvfIndex:
    path: str
    centroids: np.ndarray
    metric: str
    ids: list[str]
    vec: str
    cell_rows: dict[int, int] = field(default_factory=dict)

    @property
    def cells(self) -> int:
        return len(self.centroids)


def _space(vec: str, metric: str) -> Column:
    """Vectors as clustered: unit length for cosine (spherical k-means), raw for l2sq."""
    v = F.col(vec).cast("array<double>")
    if metric == "cosine":
        norm = F.sqrt(F.aggregate(v, F.lit(0.0).cast("double"), lambda a, x: a + x * x))
        return F.transform(v, lambda x: x / norm)
    return v


def build_ivf_index(corpus: DataFrame, cells: int, metric: str = "cosine", *,
                    ids: tuple[str, ...] | list[str] = ("id",), vec: str = "embedding",
                    dim: int | None = None, seed: int = 11,
                    max_iter: int = 10, path: str | None = None) -> IvfIndex:
    """Cluster the corpus into ``cells`` k-means cells and write it partitioned by cell.

    The quantiser is trained on all valid rows for a few iterations (distributed
    k-means); every corpus row is assigned. The written table cuts the lineage, so searching never
    recomputes the corpus or its embeddings.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    _check_metric(metric)
    ids = list(ids)
    spark = corpus.sparkSession
    c = valid_vectors(corpus.select(*ids, vec), vec, dim)
    if metric == "cosine":
        # zero vectors have no cosine neighbours; keep them out of the index
        c = c.where(F.exists(vec, lambda x: x != 0))
    feats = c.withColumn("_f", array_to_vector(_space(vec, metric)))
    train = feats.select("_f").persist()
    try:
        model = KMeans(k=cells, seed=seed, maxIter=max_iter, featuresCol="_f",
                       predictionCol="cell").fit(train)
    finally:
        train.unpersist()
    centroids = np.array([np.asarray(x, dtype=np.float64) for x in model.clusterCenters()])
    path = path or scratch_path(spark, "ivf-index")
    (model.transform(feats).select(*ids, vec, F.col("cell").cast("int").alias("cell"))
     # range on (cell, id): a hot cell spans many tasks, a task holds few cells
     .repartitionByRange("cell", *ids)
     .write.mode("errorifexists").partitionBy("cell").parquet(path))
    stored = spark.read.parquet(path)
    counts = {int(r["cell"]): int(r["n"]) for r in
              stored.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    return IvfIndex(path=path, centroids=centroids, metric=metric, ids=ids, vec=vec,
                    cell_rows=counts)


def _probe_udf(bc, nprobe: int, metric: str):
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def probe(vectors: pd.Series) -> pd.Series:
        cents = bc.value
        if len(vectors) == 0:
            return pd.Series([], dtype=object)
        V = _matrix(vectors)
        if metric == "cosine":
            norms = np.linalg.norm(V, axis=1, keepdims=True)
            with np.errstate(divide="ignore", invalid="ignore"):
                V = np.where(norms > 0, V / norms, 0.0)
        p = min(nprobe, len(cents))
        cn = np.einsum("ij,ij->i", cents, cents)
        out = []
        for s in range(0, len(V), TILE_QUERIES):
            near = np.empty((len(V[s:s + TILE_QUERIES]), 0))
            cells = np.empty(near.shape, dtype=np.int64)
            for t in range(0, len(cents), TILE_ROWS):
                d = cn[t:t + TILE_ROWS] - 2.0 * V[s:s + TILE_QUERIES] @ cents[t:t + TILE_ROWS].T
                d = np.concatenate([near, d], axis=1)
                i = np.concatenate([cells, np.broadcast_to(np.arange(t, t + d.shape[1] - near.shape[1]),
                                                           (len(d), d.shape[1] - near.shape[1]))], axis=1)
                pick = _best(d, p)
                near, cells = np.take_along_axis(d, pick, axis=1), np.take_along_axis(i, pick, axis=1)
            out += list(cells.astype(np.int32))
        return pd.Series(out)
    return probe


def ann_join(queries: DataFrame, index: IvfIndex, k: int, nprobe: int = 1, *,
             query_id: str = "query_id", query_vec: str = "embedding",
             block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Approximate k nearest: search only each query's ``nprobe`` nearest cells.

    Only the cells some query probes are read (partition pruning on the cell
    folders). With ``nprobe >= index.cells`` the result equals ``knn_join``.
    """
    spark = queries.sparkSession
    ids, metric = index.ids, index.metric
    if query_id in ids:
        raise ValueError("query id column must not share a name with a corpus id column")
    q = valid_vectors(queries.select(query_id, query_vec), query_vec, None)
    bc = spark.sparkContext.broadcast(index.centroids)
    probed = q.select(F.col(query_id).alias("_qid"), F.col(query_vec).alias("_v"),
                      F.explode(_probe_udf(bc, nprobe, metric)(F.col(query_vec))).alias("cell"))

    # split hot cells: sub-blocks on the corpus side by cell size, on the query
    # side by how many queries probe the cell; both tables have <= cells rows
    q_counts = {int(r["cell"]): int(r["n"]) for r in
                probed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan_rows = [(cell, max(1, math.ceil(index.cell_rows.get(cell, 0) / block_rows)),
                  max(1, math.ceil(q_counts.get(cell, 0) / block_rows)))
                 for cell in range(index.cells)]
    plan = spark.createDataFrame(plan_rows, "cell int, _ncs int, _nqs int")

    qx = (probed.join(F.broadcast(plan), "cell")
          .withColumn("_qs", F.pmod(F.xxhash64("_qid"), F.col("_nqs").cast("long")))
          .withColumn("_cs", F.explode(F.sequence(F.lit(0), F.col("_ncs") - 1)))
          .select("cell", "_cs", F.col("_qs").cast("int").alias("_qs"), "_qid", "_v"))
    # read only the probed cells: the index is partitioned by cell on disk
    probed_cells = sorted(q_counts)
    corpus = spark.read.parquet(index.path).where(F.col("cell").isin(probed_cells))
    cx = (corpus.join(F.broadcast(plan), "cell")
          .withColumn("_cs", F.pmod(F.xxhash64(*ids), F.col("_ncs").cast("long")).cast("int"))
          .withColumn("_qs", F.explode(F.sequence(F.lit(0), F.col("_nqs") - 1)))
          .select("cell", "_cs", "_qs", *ids, F.col(index.vec).alias("_v")))
    qtype = queries.schema[query_id].dataType
    schema = _candidate_schema(qtype, corpus, ids)
    cand = _cogroup_topk(qx, cx, ["cell", "_cs", "_qs"], ids, metric, k, schema)
    return _final_topk(cand, query_id, ids, k)
