"""Streaming ingest and the streamed question loop."""

import json
import os

from pyspark.sql import functions as F

from chunkwise.session import scratch_path
from chunkwise.streaming import answer_stream, compact_store, ingest_stream, read_store


def _write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_stream_ingest_then_answer(spark, tmpdir_fresh):
    src = f"{tmpdir_fresh}/in"
    _write(f"{src}/a.pdf", ("alpha beta gamma " * 200 + "\f" + "delta epsilon " * 10).encode())
    _write(f"{src}/skip.txt", b"not ingested")
    store_path = scratch_path(spark, "stream-store")
    ckpt = scratch_path(spark, "ingest-ckpt")
    q = ingest_stream(spark, src, store_path, checkpoint=ckpt)
    q.awaitTermination(120)
    _write(f"{src}/b.pdf", ("alpha beta gamma " * 200 + "\f" + "zeta eta").encode())
    q = ingest_stream(spark, src, store_path, checkpoint=ckpt)
    q.awaitTermination(120)
    log = spark.read.parquet(store_path)
    assert {r["file"] for r in log.select("file").distinct().collect()} == {"a.pdf", "b.pdf"}
    up = read_store(spark, store_path, "upsert")
    assert up.count() == up.select("key").distinct().count()
    assert read_store(spark, store_path, "append").count() >= up.count()
    compacted = compact_store(spark, store_path, scratch_path(spark, "compacted"))
    cols = ["key", "seq", "chunk_index"]
    assert sorted(map(tuple, read_store(spark, compacted, "upsert").select(*cols).collect())) == \
        sorted(map(tuple, up.select(*cols).collect()))

    qdir = f"{tmpdir_fresh}/questions"
    lines = [{"session": "s1", "seq": 0, "query": "alpha beta"},
             {"session": "s1", "seq": 1, "query": "EXIT"},
             {"session": "s1", "seq": 2, "query": "never answered"},
             {"session": "s2", "seq": 0, "query": " exit"},
             {"session": "s2", "seq": 1, "query": "zeta"}]
    _write(f"{qdir}/q1.json", "\n".join(json.dumps(x) for x in lines).encode())
    answers = scratch_path(spark, "answers")
    s = answer_stream(spark, qdir, up, answers, lambda ps: [f"len={len(p)}" for p in ps])
    s.awaitTermination(180)
    got = spark.read.parquet(answers).where(F.col("batch").isNotNull())
    rows = sorted((r["session"], r["query"]) for r in got.collect())
    assert rows == [("s1", "alpha beta"), ("s2", " exit"), ("s2", "zeta")]
    assert all(r["answer"].startswith("len=") for r in got.collect())
    assert "From a.pdf" in got.where("query = 'alpha beta'").first()["prompt"] or \
        "From b.pdf" in got.where("query = 'alpha beta'").first()["prompt"]


def test_sentinel_holds_across_micro_batches(spark, tmpdir_fresh):
    store = spark.createDataFrame(
        [("f.pdf", 0, 0, "alpha beta gamma", [1.0] * 64)],
        "file string, page int, chunk_index int, chunk string, embedding array<float>")
    qdir = f"{tmpdir_fresh}/q"
    batches = [[{"session": "s1", "seq": 0, "query": "alpha"}, {"session": "s1", "seq": 1, "query": "Exit"},
                {"session": "s2", "seq": 0, "query": "beta"}],
               [{"session": "s1", "seq": 2, "query": "after exit"}, {"session": "s2", "seq": 1, "query": "gamma"}]]
    for i, lines in enumerate(batches):
        _write(f"{qdir}/q{i}.json", "\n".join(json.dumps(x) for x in lines).encode())
    answers = scratch_path(spark, "answers2")
    s = answer_stream(spark, qdir, store, answers, lambda ps: ["ok"] * len(ps), max_files_per_trigger=1)
    s.awaitTermination(180)
    got = spark.read.parquet(answers).where(F.col("batch").isNotNull())
    rows = sorted((r["batch"], r["session"], r["query"]) for r in got.collect())
    assert rows == [(0, "s1", "alpha"), (0, "s2", "beta"), (1, "s2", "gamma")]
