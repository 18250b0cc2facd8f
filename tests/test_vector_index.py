"""J3 with O4/O6/O9: the index kept by writes, against brute force and against exact search."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chunkwise.operators import vector_index as VI
from chunkwise.operators.knn import knn_join
from chunkwise.plans import queries
from chunkwise.session import scratch_path

DIM = 6


def frame(spark, ids, V, name="id"):
    return spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, V)], f"{name} long, embedding array<float>")


def lists(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["id"])
    return got


def clusters(rng, n):
    return (rng.normal(size=(9, DIM))[rng.integers(0, 9, n)] * 4 + rng.normal(size=(n, DIM))).astype(np.float32)


def test_three_batches_and_a_delete_equal_a_fresh_search(spark):
    metric = "cosine"
    rng = np.random.default_rng(3)
    V = clusters(rng, 400)
    V[5], V[6] = V[7], V[7]                                   # exact ties
    first = frame(spark, range(200), V[:200])
    index = VI.create_index(first, scratch_path(spark, "vi"), 400, metric, dim=DIM, cells_per_root=0.5, cell_bound=40)
    VI.write_batch(index, first)
    VI.write_batch(index, frame(spark, range(150, 300), V[250:400]))          # replaces 150..199
    VI.write_batch(index, frame(spark, range(300, 320), V[:20]), delete=spark.createDataFrame([(7,), (160,), (999,)], "id long"))
    VI.write_batch(index, None, delete=spark.createDataFrame([(301,)], "id long"))
    VI.write_batch(index, frame(spark, [7, 301], V[[7, 1]]))                   # written again after its delete
    state = {i: V[i] for i in range(150)} | {150 + i: V[250 + i] for i in range(150)} | {300 + i: V[i] for i in range(20)}
    del state[160]
    state[7], state[301] = V[7], V[1]
    now = frame(spark, state, np.stack(list(state.values())))
    q = frame(spark, range(50), V[100:150], "query_id")
    want = lists(knn_join(q, now, 4, metric, dim=DIM))
    again = VI.open_index(spark, index.path)
    assert again == index and lists(VI.search_index(q, again, 4, None, block_rows=17)) == want
    small = VI.compact_index(spark, index, scratch_path(spark, "vi"))
    assert lists(VI.search_index(q, small, 4, None)) == want
    assert len(VI._commits(spark, small)) == 1
    rows = VI.live_rows(spark, index)
    assert rows.count() == 2 * len(state) == rows.select("tbl", "id").distinct().count()   # once a table
    biggest = rows.groupBy("tbl", "cell").count().agg(F.max("count")).first()[0]
    assert biggest <= 40                                       # cells that outgrew the bound were split
    assert max(c.version for c in VI._commits(spark, index)) > 0


def test_probing_more_cells_finds_more_and_each_row_once(spark):
    rng = np.random.default_rng(4)
    V = rng.normal(size=(500, DIM)).astype(np.float32)
    c, q = frame(spark, range(500), V), frame(spark, range(500), V, "query_id")
    index = VI.create_index(c, scratch_path(spark, "vi"), 500, dim=DIM, cells_per_root=2.0)
    VI.write_batch(index, c)
    want = {(i, j) for i, js in lists(knn_join(q, c, 5, dim=DIM)).items() for j in js}
    recalls, pairs = [], []
    for nprobe in (1, 4, 12, None):
        hits = VI.search_index(q, index, 5, nprobe, breadth=None, compared=pairs)
        got = [(i, j) for i, js in lists(hits).items() for j in js]
        assert len(got) == len(set(got))
        recalls.append(len(want & set(got)) / len(want))
    assert recalls == sorted(recalls) and recalls[-1] == 1.0 and recalls[1] > 0.8
    assert pairs == sorted(pairs) and pairs[-1] == 500 * 500 and pairs[1] < 0.4 * 500 * 500


def test_both_ways_to_rank_cells_agree(spark):
    rng = np.random.default_rng(5)
    V = clusters(rng, 300)
    c = frame(spark, range(300), V)
    index = VI.create_index(c, scratch_path(spark, "vi"), 300, "l2sq", dim=DIM, cells_per_root=3.0)
    cells = VI.live_cells(spark, index)
    for n, breadth in ((1, 2), (5, 3), (None, None)):
        small = VI._near_cells(c, index, cells, "embedding", n, breadth)
        large = VI._near_cells(c, index, cells, "embedding", n, breadth, max_bytes=0)
        key = lambda df: sorted(map(tuple, df.select("id", "tbl", "coarse", "cell").collect()))
        assert key(small) == key(large)


def test_a_write_that_died_is_invisible_and_is_written_again(spark, monkeypatch):
    rng = np.random.default_rng(6)
    V = clusters(rng, 60)
    c = frame(spark, range(40), V[:40])
    index = VI.create_index(c, scratch_path(spark, "vi"), 60, dim=DIM)
    VI.write_batch(index, c)
    q = frame(spark, range(10), V[40:50], "query_id")
    before = lists(VI.search_index(q, index, 3, None))
    with monkeypatch.context() as m:
        m.setattr(VI, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            VI.write_batch(index, frame(spark, range(40, 60), V[40:]), delete=c.select("id"))
    assert lists(VI.search_index(q, index, 3, None)) == before
    VI.write_batch(index, frame(spark, range(40, 60), V[40:]))
    got = lists(VI.search_index(q, index, 3, None))
    assert all(got[i][0] == 40 + i for i in range(10))


def test_awkward_vectors_and_empty_tables(spark):
    schema = "id long, embedding array<float>"
    rows = spark.createDataFrame([(1, None), (2, []), (3, [1.0] * (DIM - 1)), (4, [0.0] * DIM), (None, [1.0] * DIM),
                                  (5, [1.0] * DIM), (5, [1.0] * DIM)], schema)
    q = spark.createDataFrame([(1, [1.0] * DIM), (2, None), (3, [0.0] * DIM)], "query_id long, embedding array<float>")
    for sample in (rows, spark.createDataFrame([], schema)):
        index = VI.create_index(sample, scratch_path(spark, "vi"), 0, dim=DIM)
        VI.write_batch(index, spark.createDataFrame([], schema))
        assert VI.search_index(q, index, 3, None).count() == 0
        VI.write_batch(index, rows, upsert=False)
        assert [r["id"] for r in VI.search_index(q, index, 3, None).orderBy("rank").collect()] == [None, 5]
        VI.write_batch(index, rows.where("id = 5"))             # an upsert leaves one of the two
        assert VI.live_rows(spark, index).where("id = 5 and tbl = 0").count() == 1
        VI.write_batch(index, None, delete=spark.createDataFrame([(None,)], "id long"))
        assert [r["id"] for r in VI.search_index(q, index, 3, None).collect()] == [5]


def test_copies_of_one_vector_stay_one_whole_cell(spark):
    V = np.tile(np.arange(1, DIM + 1, dtype=np.float32), (300, 1))
    c = frame(spark, range(300), V)
    index = VI.create_index(c, scratch_path(spark, "vi"), 300, dim=DIM, cell_bound=50)
    VI.write_batch(index, c)
    assert VI.split_cells(spark, index) == 0                    # not tried again and again
    q = frame(spark, range(120), V[:120], "query_id")
    got = lists(VI.search_index(q, index, 3, 1, block_rows=40))
    assert got == {i: [0, 1, 2] for i in range(120)}


@pytest.mark.parametrize("sf,share", [("sf0.001", 0.5), ("sf0.01", 0.25), ("sf0.1", 0.2)])
def test_registered_ann_join_compares_a_fifth_of_the_pairs(spark, sf, share):
    """Vectors without any structure, so the least favourable case for cells."""
    pairs = lambda df: {(r["query_id"], r["id"]) for r in df.select("query_id", "id").collect()}
    compared = []
    want = pairs(queries.knn_join_cosine(spark, f"/root/testdata/{sf}"))
    got = pairs(queries.ann_join(spark, f"/root/testdata/{sf}", compared))
    n = len({q for q, _ in want})
    assert len(got & want) >= 0.9 * len(want) > 0
    assert compared[0] <= share * n * n


def test_a_search_of_all_cells_ranks_none(spark, monkeypatch):
    rng = np.random.default_rng(8)
    V = clusters(rng, 300)
    c, q = frame(spark, range(300), V), frame(spark, range(40), V[:40], "query_id")
    index = VI.create_index(c, scratch_path(spark, "vi"), 300, dim=DIM)
    VI.write_batch(index, c)

    def refuse(*a, **kw):
        raise AssertionError("cells were ranked")

    monkeypatch.setattr(VI, "_near_cells", refuse)
    monkeypatch.setattr(VI._Quantisers, "nearest", refuse)
    assert lists(VI.search_index(q, index, 4, None, block_rows=70)) == lists(knn_join(q, c, 4, dim=DIM))


def test_ranked_cells_are_held_in_small_runs(spark):
    import pyarrow as pa

    rng = np.random.default_rng(9)
    V = clusters(rng, 400)
    index = VI.create_index(frame(spark, range(400), V), scratch_path(spark, "vi"), 400, dim=DIM, cells_per_root=5.0)
    cells = VI.live_cells(spark, index).toPandas()
    ranked = VI._Quantisers(cells, "cosine")
    batch = pa.RecordBatch.from_arrays([pa.array(V.tolist() * 200, pa.list_(pa.float32()))], ["v"])
    runs = [(part.num_rows, t, sum(map(len, picked))) for part, t, picked in VI._ranked_parts(ranked, batch, "v", DIM, None, None)]
    assert max(n for _, _, n in runs) <= VI.NEAR_VALUES and len(runs) > 2
    assert sum(n for n, t, _ in runs if t == 0) == batch.num_rows


def test_blocks_dealt_by_plan_or_by_join_hold_the_same_cells(spark):
    rng = np.random.default_rng(10)
    V = clusters(rng, 500)
    c, q = frame(spark, range(500), V), frame(spark, range(60), V[:60], "query_id")
    index = VI.create_index(c, scratch_path(spark, "vi"), 500, dim=DIM, cells_per_root=3.0)
    VI.write_batch(index, c)
    want = lists(VI.search_index(q, index, 4, 5, breadth=None))
    assert want == lists(VI.search_index(q, index, 4, 5, breadth=None, block_rows=30))
    cells = VI.live_cells(spark, index)
    counts = cells.join(VI._counts(spark, index, [0]), ["tbl", "cell"])
    plan = counts.select("tbl", "coarse", "cell", (F.col("cell") % 7).cast("long").alias("block"), "n", (F.col("cell") % 3 + 1).alias("_cuts"))
    q = q.select(F.col("query_id").alias("_qid"), F.col("embedding").alias("_v"))
    key = lambda df: sorted((r["tbl"], r["block"], r["_qid"], r["cuts"], sorted(r["cells"]), sorted(r["groups"])) for r in df.collect())
    assert key(VI._probed_blocks(q, index, cells, plan, 5, 3)) == key(VI._probed_blocks(q, index, cells, plan, 5, 3, max_bytes=0))


def test_a_block_is_met_cell_by_cell_with_ties_by_id(monkeypatch):
    rng = np.random.default_rng(5)
    C = rng.integers(-1, 2, (400, 3)).astype(float)  # few distinct vectors: many ties
    cells = rng.integers(0, 12, len(C))
    corpus = pd.DataFrame({"cell": cells, "id": rng.permutation(len(C)), "_v": list(C)})
    Q = rng.integers(-1, 2, (50, 3)).astype(float)
    probed = [sorted(rng.choice(15, rng.integers(0, 6), replace=False).tolist()) for _ in Q]
    queries = pd.DataFrame({"_qid": range(50), "_v": list(Q), "cells": probed})
    wide, plain = [], np.full
    monkeypatch.setattr(VI.np, "full", lambda shape, *a, **k: wide.append(np.shape(np.empty(shape))) or plain(shape, *a, **k))
    got = VI._block_hits(queries, corpus, ["id"], "l2sq", 4)
    assert {i: list(g) for i, g in got.groupby("_qid")["id"]} == {
        i: w for i, (q, own) in enumerate(zip(Q, probed))
        if (w := [x for _, x in sorted((round(float(((q - C[r]) ** 2).sum()), 9), corpus["id"][r])
                                       for r in range(len(C)) if cells[r] in own)[:4]])}
    assert max(shape[1] for shape in wide if len(shape) == 2) < len(C)  # no column for rows of cells that no query probes
