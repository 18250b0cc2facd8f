"""O1/O2 file scans, P11 sentinel, G1-G4 prompts, numbering."""

import os

import numpy as np

from pyspark.sql import Window
from pyspark.sql import functions as F

from chunkwise.operators.hits import merge_hits
from chunkwise.operators.numbering import row_number_within
from chunkwise.operators.rag import context, generate, prompt
from chunkwise.operators.sessions import take_until
from chunkwise.sources.files import extract_pages, scan_files, text_pages


def _write(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_scan_files_only_top_level_pdf(spark, tmpdir_fresh):
    d = tmpdir_fresh
    _write(f"{d}/a.pdf", "page one\fpage two\f\fpage four".encode())
    _write(f"{d}/b.PDF", b"x")
    _write(f"{d}/c.txt", b"y")
    _write(f"{d}/sub/e.pdf", b"z")
    files = scan_files(spark, d)
    assert [r["file"] for r in files.collect()] == ["a.pdf"]
    pages = text_pages(files).orderBy("page").collect()
    assert [(r["page"], r["text"]) for r in pages] == [(0, "page one"), (1, "page two"), (2, ""), (3, "page four")]
    _write(f"{d}/more/x.pdf", "p0\fp1\n\f".encode())
    tail = text_pages(scan_files(spark, f"{d}/more")).orderBy("page").collect()
    assert [r["text"] for r in tail] == ["p0", "p1\n"]
    _write(f"{d}/more2/y.pdf", "p0\f\n".encode())
    tail = text_pages(scan_files(spark, f"{d}/more2")).orderBy("page").collect()
    assert [r["text"] for r in tail] == ["p0", "\n"]
    custom = extract_pages(files, lambda b: b.decode().upper().split("\f")).orderBy("page").collect()
    assert [r["text"] for r in custom] == ["PAGE ONE", "PAGE TWO", "", "PAGE FOUR"]


def test_take_until_sentinel(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, "EXIT"), (1, 2, "b"), (2, 0, " exit"), (2, 1, "c"),
                                (3, 0, "exit")], "s int, seq int, q string")
    got = sorted((r["s"], r["q"]) for r in take_until(df, ["s"], ["seq"], "q", "exit").collect())
    assert got == [(1, "a"), (2, " exit"), (2, "c")]


def test_prompt_keeps_slot_text_literal_and_every_query(spark):
    qs = spark.createDataFrame([(1, "what?"), (2, "none")], "query_id long, query string")
    hits = spark.createDataFrame([(1, 1, "f.pdf", 0, "uses {query} and\nnewline", 0.125),
                                  (1, 2, None, None, None, None)],
                                 "query_id long, rank int, file string, page int, chunk string, distance double")
    ctx = context(hits, "scored")
    out = prompt(qs.join(ctx, "query_id", "left"), "C:{context}|Q:{query}").orderBy("query_id").collect()
    assert out[0]["prompt"] == ("C:From f.pdf (page 0, chunk uses {query} and\nnewline) with similarity 0.12\n"
                                "From Unknown file (page Unknown page, chunk Unknown chunk) with similarity 0.00"
                                "|Q:what?")
    assert out[1]["prompt"] == "C:|Q:none"
    plain = context(hits.where("rank = 1"), "plain").first()["context"]
    assert plain == "From f.pdf (page 0): uses {query} and\nnewline"
    answers = generate(prompt(qs, "{query}"), lambda ps: [p[::-1] for p in ps]).orderBy("query_id").collect()
    assert [a["answer"] for a in answers] == ["?tahw", "enon"]


def test_merge_hits(spark):
    hits = spark.createDataFrame([(1, 2, "g", 5, "second", 0.5), (1, 1, "f", 4, "first", 0.25)],
                                 "query_id long, rank int, file string, page int, chunk string, distance double")
    r = merge_hits(hits).first()
    assert (r["chunks"], r["file"], r["page"], r["distance"], r["n_hits"]) == (["first", "second"], "f", 4, 0.25, 2)


def test_row_number_within_matches_window_on_skewed_groups(spark):
    # one group holds most rows; ids are sparse and unordered
    rows = [("hot", i * 7 + 3) for i in range(3000)] + [(f"g{i % 5}", 100000 + i * 13) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, o long").repartition(7)
    got = row_number_within(df, ["g"], "o", out="rn", base=0, ranges=16)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1)
    assert sorted(map(tuple, got.select("g", "o", "rn").collect())) == \
        sorted(map(tuple, want.select("g", "o", "rn").collect()))


def test_row_number_within_sizes_ranges_from_the_row_count(spark):
    rows = [("hot", i) for i in range(5000)] + [("cold", 10_000 + i) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, o long").repartition(5)
    got = row_number_within(df, ["g"], "o", out="rn", rows_per_range=100)   # ~50 ranges
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    assert sorted(map(tuple, got.select("g", "o", "rn").collect())) == \
        sorted(map(tuple, want.select("g", "o", "rn").collect()))


def test_flow_with_a_caller_encoder(spark):
    from chunkwise.plans.flows import ingest, retrieve

    class ProjectionEncoder:
        """A model-like stand-in: hashed counts projected to 24 unit-length dims
        (defined here so workers receive it by value)."""

        def __init__(self):
            from chunkwise.operators.encode import HashEncoder
            self.hashed = HashEncoder(64)
            self.proj = np.random.default_rng(0).normal(size=(64, 24))

        def __call__(self, texts):
            v = self.hashed(texts) @ self.proj
            n = np.linalg.norm(v, axis=1, keepdims=True)
            return np.where(n > 0, v / np.where(n > 0, n, 1), 0.0)

    pages = spark.createDataFrame([("a.pdf", 0, "alpha beta gamma delta"), ("a.pdf", 1, "zeta eta theta"),
                                   ("b.pdf", 0, "kappa lambda mu nu xi")], "file string, page int, text string")
    from chunkwise.operators.chunking import chunk
    enc = ProjectionEncoder()
    store = ingest(chunk(pages, keep=["file", "page"]), dim=24, encoder=enc)
    assert store.first()["embedding"] is not None and len(store.first()["embedding"]) == 24
    qs = spark.createDataFrame([(1, "zeta eta theta"), (2, "kappa lambda mu nu xi")], "query_id long, query string")
    hits = retrieve(qs, store, k_fetch=2, encoder=enc, dim=24).where("rank = 1").orderBy("query_id").collect()
    assert [(h["file"], h["page"]) for h in hits] == [("a.pdf", 1), ("b.pdf", 0)]
    assert all(abs(h["distance"]) < 1e-6 for h in hits)
