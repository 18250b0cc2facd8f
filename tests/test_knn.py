"""Exact search in both physical forms, approximate search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkwise.operators.knn import ann_join, build_ivf_index, knn, knn_search, topk_block


def brute(Q, qids, C, cids, k, metric):
    out = {}
    for qi, q in zip(qids, Q):
        if metric == "cosine":
            with np.errstate(divide="ignore", invalid="ignore"):
                d = 1 - (C @ q) / np.sqrt((C * C).sum(1) * (q @ q))
        else:
            d = ((C - q) ** 2).sum(1)
        order = sorted((x, c) for x, c in zip(d, cids) if np.isfinite(x))
        out[qi] = [c for _, c in order[:k]]
    return out


def frames(spark, n_c=300, n_q=40, dim=8, seed=5, dup=True):
    rng = np.random.default_rng(seed)
    C = rng.normal(size=(n_c, dim)).astype(np.float32)
    if dup:
        C[10] = C[11] = C[12]          # exact ties, broken by id
    Q = rng.normal(size=(n_q, dim)).astype(np.float32)
    Q[0] = C[12]
    Q[1] = 0.0                          # zero query: no cosine hits
    cdf = spark.createDataFrame([(int(i), C[i].tolist()) for i in range(n_c)], "id long, embedding array<float>")
    qdf = spark.createDataFrame([(int(1000 + i), Q[i].tolist()) for i in range(n_q)],
                                "query_id long, embedding array<float>")
    return C.astype(np.float64), Q.astype(np.float64), cdf, qdf


def as_lists(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["id"])
    return got


@pytest.mark.parametrize("metric", ["cosine", "l2sq"])
@pytest.mark.parametrize("strategy,block", [("broadcast", 20000), ("blocked", 50), ("blocked", 20000)])
def test_knn_join_matches_brute_force(spark, metric, strategy, block):
    C, Q, cdf, qdf = frames(spark)
    res = knn_search(qdf, cdf, 5, metric, dim=8, strategy=strategy, block_rows=block)
    assert res.bounded == (strategy == "broadcast")
    got = as_lists(res.hits)
    want = brute(Q, range(1000, 1040), C, range(len(C)), 5, metric)
    want = {q: v for q, v in want.items() if v}
    assert got == want
    if metric == "cosine":
        assert 1001 not in got           # zero vector
        assert got[1000][:3] == [10, 11, 12]


def test_broadcast_refuses_a_large_query_set(spark):
    _, _, cdf, qdf = frames(spark)
    with pytest.raises(ValueError, match="too large"):
        knn_search(qdf, cdf, 3, "cosine", dim=8, strategy="broadcast", broadcast_max_bytes=8 * 8 * 10)


def test_hits_do_not_depend_on_how_rows_are_dealt_out(spark):
    rng = np.random.default_rng(9)
    V = rng.normal(size=(40, 384)).astype(np.float32)
    V = np.concatenate([V] * 6)                              # six exact copies of each row
    rows = [(int(i), V[i].tolist()) for i in rng.permutation(len(V))]
    df = spark.createDataFrame(rows, "id long, embedding array<float>")
    q = df.select(F.col("id").alias("query_id"), "embedding")
    want = [[i % 40 + 40 * j for j in range(4)] for i in range(len(V))]
    for metric in ("cosine", "l2sq"):
        for parts, block in ((1, 7), (5, 64), (3, 1000)):
            got = as_lists(knn_search(q, df.repartition(parts), 4, metric, dim=384, block_rows=block).hits)
            assert [got[i] for i in range(len(V))] == want


def test_kernel_memory_is_bounded():
    import tracemalloc

    import pandas as pd
    rng = np.random.default_rng(0)
    V = rng.normal(size=(12_000, 16))
    tracemalloc.start()
    out = topk_block(np.arange(len(V)), V, pd.DataFrame({"id": np.arange(len(V))}), V, "cosine", 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(out) == 5 * len(V) and (out.groupby("_qid")["id"].first() == np.arange(len(V))).all()
    assert peak < 250e6                                      # all pairs would take 1.15 GB


def test_near_copies_far_from_the_origin_keep_their_distances():
    import pandas as pd
    base = np.full((1, 4), 4000.0)
    C = base + np.array([[2e-4, 0, 0, 0], [1e-4, 0, 0, 0], [1.0, 0, 0, 0]])
    out = topk_block(np.array([0], dtype=object), base, pd.DataFrame({"id": [0, 1, 2]}), C, "l2sq", 3)
    assert out["id"].tolist() == [1, 0, 2] and np.allclose(out["distance"], [1e-8, 4e-8, 1.0], rtol=1e-3)


def test_knn_single(spark):
    C, Q, cdf, _ = frames(spark)
    top = knn(cdf, Q[5].tolist(), 4, "cosine", ids=["id"]).orderBy("rank").collect()
    want = brute(Q[5:6], [0], C, range(len(C)), 4, "cosine")[0]
    assert [r["id"] for r in top] == want
    assert [r["rank"] for r in top] == [1, 2, 3, 4]


def test_topk_block_ties_and_k_larger_than_block():
    import pandas as pd
    C = np.array([[1.0, 0.0]] * 4)
    Q = np.array([[1.0, 0.0]])
    ids = pd.DataFrame({"id": [7, 3, 9, 1]})
    out = topk_block(np.array([5], dtype=object), Q, ids, C, "cosine", 10)
    assert out["id"].tolist() == [1, 3, 7, 9]


def test_ann_full_probe_equals_exact_and_recall_grows(spark):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    q = e.select(F.col("vec_id").alias("query_id"), "embedding")
    c = e.select("vec_id", "embedding")
    exact = knn_search(q, c, 5, "cosine", corpus_ids=["vec_id"], dim=64).hits
    want = {}
    for r in exact.collect():
        want.setdefault(r["query_id"], set()).add(r["vec_id"])
    index = build_ivf_index(c, 8, "cosine", ids=["vec_id"], dim=64, seed=3)
    assert index.cells == 8 and sum(index.cell_rows.values()) == 500
    recalls = []
    for nprobe in (1, 2, 4, 8):
        got = {}
        # tiny block size: every cell is split into sub-blocks on both sides
        for r in ann_join(q, index, 5, nprobe, block_rows=16).collect():
            got.setdefault(r["query_id"], set()).add(r["vec_id"])
        recalls.append(sum(len(got.get(k, set()) & v) for k, v in want.items()) / (5 * len(want)))
        if nprobe == 8:
            assert got == want
    assert recalls == sorted(recalls)
    assert recalls[-1] == 1.0


def test_ann_hot_cell_is_split(spark):
    rng = np.random.default_rng(1)
    hot = rng.normal(loc=5.0, scale=0.01, size=(400, 4))
    rest = rng.normal(size=(40, 4))
    C = np.vstack([hot, rest])
    cdf = spark.createDataFrame([(int(i), C[i].tolist()) for i in range(len(C))], "id long, embedding array<double>")
    qdf = spark.createDataFrame([(int(i), C[i].tolist()) for i in range(0, len(C), 7)],
                                "query_id long, embedding array<double>")
    index = build_ivf_index(cdf, 4, "l2sq", dim=4, seed=2)
    assert max(index.cell_rows.values()) >= 300
    got = as_lists(ann_join(qdf, index, 3, 4, block_rows=32).withColumnRenamed("id", "id"))
    want = brute(C[::7], list(range(0, len(C), 7)), C, range(len(C)), 3, "l2sq")
    assert got == want


def test_many_exact_copies_keep_candidates_bounded():
    import pandas as pd
    n = 5000
    C = np.tile(np.array([[1.0, 2.0, 3.0]]), (n, 1))
    C[7] = [3.0, 2.0, 1.0]
    ids = pd.DataFrame({"id": np.arange(n)[::-1]})          # ids descending by position
    Q = np.array([[1.0, 2.0, 3.0], [3.0, 2.0, 1.0]])
    out = topk_block(np.array([1, 2], dtype=object), Q, ids, C, "cosine", 3)
    got = {q: g["id"].tolist() for q, g in out.groupby("_qid")}
    assert got[1] == [0, 1, 2]                               # smallest ids among the copies
    assert got[2][0] == n - 1 - 7 and len(got[2]) == 3
