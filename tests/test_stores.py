"""Deletes in the streaming log, stores laid out by key, statistics that merge, ended sessions."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from chunkwise.operators import metrics as M
from chunkwise.session import scratch_path
from chunkwise.sources.store import files_with_prefix, scan_keyed_store, write_keyed_store
from chunkwise.streaming import answer_stream, compact_store, delete_from_store, ingest_stream, read_store, run_to_end


def put(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


@pytest.mark.parametrize("mode", ["upsert", "insert_if_absent", "append"])
def test_delete_then_insert_again(spark, tmpdir_fresh, mode):
    src, other, store = f"{tmpdir_fresh}/in", f"{tmpdir_fresh}/other", scratch_path(spark, "log")
    run = lambda d: run_to_end(ingest_stream(spark, d, store), 60)
    files = lambda: sorted(r["file"] for r in read_store(spark, store, mode).select("file").collect())
    put(f"{other}/z.pdf", b"zeta")
    run(other)
    put(f"{src}/a.pdf", b"alpha beta")
    put(f"{src}/b.pdf", b"gamma delta")
    run(src)
    delete_from_store(spark, store, "file", "a.pdf")
    delete_from_store(spark, store, "file", None)
    delete_from_store(spark, store, "file", "*")              # no wildcard
    assert files() == ["b.pdf", "z.pdf"]
    # the other stream's next batch has a lower number than the delete saw: it stays all the same
    put(f"{other}/a.pdf", b"alpha beta")
    run(other)
    assert files() == ["a.pdf", "b.pdf", "z.pdf"]
    put(f"{src}/sub.pdf", b"epsilon")
    run(src)
    folded = compact_store(spark, store, scratch_path(spark, "folded"), mode)
    cols = ["key", "file", "seq", "chunk"]
    rows = lambda path: sorted(map(tuple, read_store(spark, path, mode).select(*cols).collect()))
    assert rows(folded) == rows(store) and not os.path.exists(f"{folded}/_marks")
    delete_from_store(spark, store, "file", "a.pdf")
    assert files() == ["b.pdf", "sub.pdf", "z.pdf"]
    with pytest.raises(ValueError):
        delete_from_store(spark, store, "no_such", 1)


def test_keyed_store_opens_only_the_files_of_a_prefix(spark):
    n = 20_000
    df = spark.range(n).select(F.format_string("k%03d:%06d", F.col("id") % 100, F.col("id")).alias("id"),
                               F.repeat(F.col("id").cast("string"), 20).alias("body"))
    path = write_keyed_store(df, scratch_path(spark, "keyed"), rows_per_file=200)
    total = spark.read.parquet(f"{path}/layout").count()
    opened = files_with_prefix(spark, path, "k042")
    got = scan_keyed_store(spark, path, "k042")
    assert total >= 100 and len(opened) <= 0.05 * total        # 1 % of the keys, at most 5 % of the row groups
    assert got.inputFiles() and len(got.inputFiles()) == len(opened)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.where("id like 'k042%'").collect()))
    assert scan_keyed_store(spark, path).count() == n and scan_keyed_store(spark, path, "").count() == n
    assert scan_keyed_store(spark, path, "q").count() == 0


def test_keyed_store_takes_hot_null_and_wide_keys(spark):
    rows = [("same", i) for i in range(50)] + [(None, 1), ("", 2), ("é", 3), ("€uro", 4), ("😀x", 5), ("z", 6)]
    df = spark.createDataFrame(rows, "id string, v int")
    path = write_keyed_store(df, scratch_path(spark, "keyed"), rows_per_file=10)
    for prefix in ("same", "s", "é", "€", "😀", "z", ""):
        want = sorted(v for k, v in rows if k is not None and k.startswith(prefix))
        assert sorted(r["v"] for r in scan_keyed_store(spark, path, prefix).collect()) == want
    assert scan_keyed_store(spark, path).count() == len(rows)
    empty = write_keyed_store(spark.createDataFrame([], df.schema), scratch_path(spark, "keyed"))
    assert scan_keyed_store(spark, empty, "a").count() == 0


def test_statistics_of_ten_batches_merge_without_reading_vectors(spark):
    path = scratch_path(spark, "batches")
    rows = spark.range(30_000).select(F.concat(F.lit("f"), F.col("id") % 9000).alias("file"),
                                      F.concat(F.lit("é"), F.col("id")).alias("chunk"),
                                      F.array_repeat(F.lit(1.0).cast("float"), 4).alias("embedding"), (F.col("id") % 10).alias("b"))
    for i in range(10):
        M.write_with_stats(rows.where(F.col("b") == i).drop("b"), path, f"seq={i}")
    want = M.store_stats(rows).first().asDict()
    merged = M.merged_stats(spark, path)
    assert all("_stats" in f for f in merged.inputFiles())
    got = merged.first().asDict()
    assert abs(got.pop("n_files") - 9000) <= 0.02 * 9000 and want.pop("n_files") == 9000
    assert got == want
    M.write_with_stats(rows.where("b = 99").drop("b"), path, "seq=10")      # an empty batch changes nothing
    again = M.merged_stats(spark, path).first().asDict()
    assert {k: v for k, v in again.items() if k != "n_files"} == want


def test_run_log_is_appended_and_read_back(spark):
    path = scratch_path(spark, "runs")
    for i in range(2):
        M.append_runs(spark, [M.RunRecord(f"r{i}", "upsert", "hash", "stub", "ingest", 5, 100, 1.0 + i)], path)
    row = M.compare(M.read_runs(spark, path)).first()
    assert (row["runs"], row["rows"], row["avg_seconds"], row["max_seconds"]) == (2, 10, 1.5, 2.0)


def ask(path, name, rows):
    put(f"{path}/{name}.json", "\n".join(json.dumps(dict(zip(("session", "seq", "query"), r))) for r in rows).encode())


def test_ended_sessions_hold_over_batches_and_restarts_and_expire(spark, tmpdir_fresh):
    store = spark.createDataFrame([("f.pdf", 0, 0, "alpha beta", [1.0] * 64)],
                                  "file string, page int, chunk_index int, chunk string, embedding array<float>")
    qdir, answers = f"{tmpdir_fresh}/q", scratch_path(spark, "answers")
    run = lambda **kw: run_to_end(answer_stream(spark, qdir, store, answers, lambda ps: ["ok"] * len(ps), **kw), 60)
    seen = lambda: sorted((r["session"], r["seq"]) for r in spark.read.parquet(answers).collect())
    ask(qdir, "1", [("s", 1, "alpha"), ("s", 3, "Exit"), ("s", 4, "late"), ("t", 1, "beta"), (None, 1, "alone")])
    run(ended_ttl=3600)
    assert seen() == [("", 1), ("s", 1), ("t", 1)]
    ask(qdir, "2", [("s", 2, "earlier number, later batch"), ("t", 2, "again"), ("s", 9, "gone")])
    run(ended_ttl=3600)                                        # a new query from the checkpoint
    assert seen() == [("", 1), ("s", 1), ("t", 1), ("t", 2)]
    assert not os.path.exists(f"{answers}/_ended")             # no table that gains a file each batch

    qdir, answers = f"{tmpdir_fresh}/q2", scratch_path(spark, "answers")
    ask(qdir, "1", [("s", 1, "exit"), ("t", 1, "beta")])
    run(ended_ttl=1)
    time.sleep(1.5)
    ask(qdir, "2", [("s", 2, "a new session of that name")])
    run(ended_ttl=1)
    assert seen() == [("s", 2), ("t", 1)]


def test_a_compacted_store_moves_its_rows_once(spark, tmpdir_fresh):
    src, store = f"{tmpdir_fresh}/in", scratch_path(spark, "log")
    for name in "ab":
        put(f"{src}/{name}.pdf", f"words of {name}".encode())
    run_to_end(ingest_stream(spark, src, store), 60)
    plain = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    folded = compact_store(spark, store, scratch_path(spark, "folded"))
    assert "Aggregate" not in plain(read_store(spark, folded)) and "Aggregate" in plain(read_store(spark, store))
    key = lambda df: sorted(map(tuple, df.select("key", "file", "chunk").collect()))
    want = key(read_store(spark, store))
    assert key(read_store(spark, folded)) == want and len(want) == 2
    # what is written after it is resolved again: a second row of a key replaces the first
    spark.read.parquet(folded).where("file = 'a.pdf'").drop("seq").write.parquet(f"{folded}/seq=7")
    assert "Aggregate" in plain(read_store(spark, folded))
    assert key(read_store(spark, folded)) == want
    assert {r["file"]: r["seq"] > 0 for r in read_store(spark, folded).collect()} == {"a.pdf": True, "b.pdf": False}
    delete_from_store(spark, folded, "file", "b.pdf")
    assert [r["file"] for r in read_store(spark, folded).collect()] == ["a.pdf"]
    twice = compact_store(spark, folded, scratch_path(spark, "folded"))
    assert [r["file"] for r in read_store(spark, twice).collect()] == ["a.pdf"]
    # a layout by key serves the aggregate: no second exchange
    rows = spark.read.parquet(store).repartitionByRange("key")
    from chunkwise.operators import sinks
    p = sinks.merge_latest(None, rows, ["key"], ["seq", "chunk_index"])._jdf.queryExecution().executedPlan().toString()
    assert p.count("Exchange") == 1
