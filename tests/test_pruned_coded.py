"""J2 with pruning: the same rows, fewer pairs. S3 with codes: recall and bytes."""

import os

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from chunkwise.operators.coded import build_codes, code_distances, coded_search
from chunkwise.operators.knn import knn_join
from chunkwise.operators.pruned_knn import knn_join_pruned
from chunkwise.plans import queries
from chunkwise.session import scratch_path


def frame(spark, V, name="id", first=0):
    return spark.createDataFrame([(int(first + i), v.tolist()) for i, v in enumerate(V)], f"{name} long, embedding array<float>")


def hits(df):
    return sorted((r["query_id"], r["rank"], r["id"], round(r["distance"], 6)) for r in df.collect())


def clustered(rng, n, dim=8, parts=12, wide=0.2):
    return (rng.normal(size=(parts, dim))[rng.integers(0, parts, n)] * 5 + rng.normal(size=(n, dim)) * wide).astype(np.float32)


@pytest.mark.parametrize("metric", ["l2sq", "cosine"])
@pytest.mark.parametrize("kind", ["clustered", "uniform", "copies"])
def test_pruned_join_equals_the_exact_join(spark, metric, kind):
    rng = np.random.default_rng(7)
    V = {"clustered": clustered(rng, 900), "uniform": rng.normal(size=(300, 8)).astype(np.float32),
         "copies": np.concatenate([np.tile(clustered(rng, 5), (60, 1)),
                                   np.tile(clustered(rng, 5), (2, 1)) + np.float32(1e-6)])}[kind]
    V[3] = 0.0
    c, q = frame(spark, V), frame(spark, np.concatenate([V[:80], clustered(rng, 40)]), "query_id", 5000)
    stats = {}
    got = knn_join_pruned(q, c, 4, metric, dim=8, block_rows=64, stats=stats)
    assert hits(got) == hits(knn_join(q, c, 4, metric, dim=8))
    assert stats["compared"] <= stats["pairs"] and stats["visited"] <= stats["block_pairs"]
    if kind == "clustered":
        assert stats["compared"] < 0.25 * stats["pairs"] and stats["visited"] < 0.4 * stats["block_pairs"]


def test_pruned_join_takes_awkward_rows(spark):
    schema = "id long, embedding array<float>"
    c = spark.createDataFrame([(1, None), (2, []), (3, [1.0]), (None, [1.0, 0.0]), (4, [0.0, 0.0]), (5, [0.0, 2.0])], schema)
    q = spark.createDataFrame([(1, [1.0, 1.0]), (2, None), (None, [0.0, 1.0])], "query_id long, embedding array<float>")
    for metric in ("cosine", "l2sq"):
        key = lambda df: sorted(map(str, df.select("query_id", "rank", "id").collect()))
        assert key(knn_join_pruned(q, c, 3, metric, dim=2)) == key(knn_join(q, c, 3, metric, dim=2))
    empty = spark.createDataFrame([], schema)
    assert knn_join_pruned(q, empty, 3, dim=2).count() == 0
    assert knn_join_pruned(spark.createDataFrame([], q.schema), c, 3, dim=2).count() == 0


def test_code_distances_are_those_of_the_decoded_vectors():
    rng = np.random.default_rng(1)
    books = tuple(rng.normal(size=(7, w)) for w in (3, 2, 4))
    codes = rng.integers(0, 7, (20, 3)).astype(np.uint8)
    Q = rng.normal(size=(5, 9))
    rows = np.concatenate([b[codes[:, g]] for g, b in enumerate(books)], axis=1)
    assert np.allclose(code_distances(Q, codes, books), ((Q[:, None] - rows[None]) ** 2).sum(-1))


def test_registered_coded_search_recall_and_bytes(spark):
    """Fetch 20, keep 5 over vectors without structure; codes and ids are a tenth of the vectors."""
    sf = "/root/testdata/sf0.1"
    pairs = lambda df: {(r["query_id"], r["id"]) for r in df.select("query_id", "id").collect()}
    want, got = pairs(queries.knn_join_cosine(spark, sf)), pairs(queries.knn_coded(spark, sf))
    assert len(got & want) >= 0.9 * len(want) > 0
    e = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    store = build_codes(e, ids=["vec_id"], dim=64, groups=queries.CODE_GROUPS, path=scratch_path(spark, "codes"))
    size = lambda d: sum(c.total_compressed_size for f in os.listdir(d) if f.endswith(".parquet")
                         for m in [pq.ParquetFile(f"{d}/{f}").metadata] for g in range(m.num_row_groups)
                         for c in [m.row_group(g).column(i) for i in range(m.num_columns)] if c.num_values)
    plain = scratch_path(spark, "plain")
    e.select("embedding").write.parquet(plain)
    assert store.rows == e.count() and size(store.path) <= 0.12 * size(plain)


def test_coded_search_with_everything_fetched_is_exact(spark):
    rng = np.random.default_rng(2)
    V = clustered(rng, 120)
    V[4], V[9] = 0.0, V[8]
    c, q = frame(spark, V), frame(spark, V[:30], "query_id")
    for metric in ("cosine", "l2sq"):
        store = build_codes(c, metric, dim=8, groups=3)
        got = coded_search(q, store, c, 120, 4, block_rows=50)
        assert [h[:3] for h in hits(got)] == [h[:3] for h in hits(knn_join(q, c, 4, metric, dim=8))
                                             if metric == "l2sq" or h[0] != 4]
    empty = build_codes(spark.createDataFrame([], c.schema), dim=8, groups=3)
    assert coded_search(q, empty, c, 5, 2).count() == 0


def test_only_codes_that_may_be_nearest_are_looked_up():
    from chunkwise.operators.coded import _looked_up, _near_codes

    rng = np.random.default_rng(11)
    for scale, move in ((1.0, 0.0), (1e-3, 0.0), (1e20, 0.0), (1.0, 50.0)):
        books = tuple((rng.normal(size=(64, 4)) + move) * scale for _ in range(4))
        codes = rng.integers(0, 64, (9000, 4)).astype(np.uint8)
        codes[5000:5030] = codes[17]                                # ties
        Q = (rng.normal(size=(40, 16)) + move) * scale
        Q[3] = np.concatenate([b[c] for b, c in zip(books, codes[17])])
        want = np.round(code_distances(Q, codes, books), 9)
        row, at = _near_codes(Q, codes, books, 20)
        assert np.array_equal(np.round(_looked_up(Q, codes, books, row, at), 9), want[row, at])
        kth = np.sort(want, axis=1)[:, 19:20]
        assert set(zip(*np.nonzero(want <= kth))) <= set(zip(row, at))
        if not move:
            assert len(row) < 0.02 * want.size


def test_a_common_code_is_fetched_in_order_of_id(spark):
    V = np.concatenate([np.tile([[1.0, 2.0, 3.0, 4.0]], (300, 1)), np.random.default_rng(12).normal(size=(50, 4))]).astype(np.float32)
    c, q = frame(spark, V), frame(spark, V[:3], "query_id")
    got = coded_search(q, build_codes(c, "l2sq", dim=4, groups=2), c, 6, 4, block_rows=30)
    assert [h[:3] for h in hits(got)] == [(i, r, r - 1) for i in range(3) for r in range(1, 5)]
