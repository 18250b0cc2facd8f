"""Failures kept apart, models built once a worker, answers kept by prompt."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkwise.operators.encode import HashEncoder, embed
from chunkwise.operators.outside import Once, apart
from chunkwise.operators.rag import answer_once, generate, kept_answers
from chunkwise.plans import flows
from chunkwise.session import scratch_path
from chunkwise.sources.files import extract_pages


def test_apart_isolates_the_items_that_raise():
    calls = []

    def call(items):
        calls.append(len(items))
        if any(i % 7 == 3 for i in items):
            raise KeyError("seven")
        return [2 * i for i in items]

    out, errors = apart(call, list(range(20)))
    assert [e is not None for e in errors] == [i % 7 == 3 for i in range(20)]
    assert out == [None if i % 7 == 3 else 2 * i for i in range(20)] and errors[3] == "KeyError: 'seven'"
    assert len(calls) < 2 * 20
    assert apart(lambda items: [1], [1, 2]) == ([1, 1], [None, None])    # one result each, when asked one by one
    assert apart(lambda items: [], [5]) == ([None], ["ValueError: 0 results for 1 items"]) and apart(call, []) == ([], [])


def test_once_builds_a_model_once_per_worker(spark):
    marks = tempfile.mkdtemp(prefix="chunkwise-once-")

    def factory():
        fd, _ = tempfile.mkstemp(prefix=f"{os.getpid()}-", dir=marks)
        os.close(fd)
        return HashEncoder(8)

    model = Once(factory, f"test-{marks}")
    df = spark.range(400).select(F.concat(F.lit("word "), F.col("id")).alias("t")).repartition(40)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        for _ in range(2):                                  # two jobs, 40 tasks each, several batches a task
            out = embed(df, "t", model, 8).agg(F.count("embedding"), F.sum(F.size("embedding"))).first()
            assert tuple(out) == (400, 3200)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    built = [name.split("-")[0] for name in os.listdir(marks)]
    assert 1 <= len(built) == len(set(built)) <= 16


class Picky(HashEncoder):
    def __call__(self, texts):
        if any("bad" in t for t in texts):
            raise ValueError("bad text")
        return super().__call__(texts)


def page_reader(content):
    return content.decode("utf-8").split("\f")


def test_a_corrupt_file_and_a_raising_encoder_leave_all_other_rows(spark):
    files = spark.createDataFrame([("a", b"one two\fthree bad"), ("b", b"\xff\xfe"), ("c", b""), ("d", None), ("e", b"four")],
                                  "file string, content binary")
    store, rejects = flows.ingest_apart(files, page_reader, Picky(8), 8)
    assert sorted((r.file, r.page, r.chunk_index, r.chunk, len(r.embedding)) for r in store.collect()) == \
        [("a", 0, 0, "one two", 8), ("e", 0, 0, "four", 8)]
    got = {(r.file, r.page, r.chunk): r.error for r in rejects.collect()}
    assert set(got) == {("a", 1, "three bad"), ("b", None, None)}
    assert got["a", 1, "three bad"] == "ValueError: bad text" and got["b", None, None].startswith("UnicodeDecodeError")
    assert "error" not in store.columns
    with pytest.raises(Exception, match="UnicodeDecodeError"):
        extract_pages(files, page_reader).count()
    empty, none = flows.ingest_apart(spark.createDataFrame([], files.schema), page_reader, Picky(8), 8)
    assert empty.count() == 0 and none.count() == 0


def test_an_encoder_of_the_wrong_shape_is_an_error_of_its_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, t string")
    out = embed(df, "t", lambda ts: np.zeros((len(ts), 3)), 4, errors="why").collect()
    assert all(r.embedding is None and "expected (1, 4)" in r.why for r in out)


def test_a_raising_client_leaves_all_other_answers(spark):
    def client(prompts):
        if any("bad" in p for p in prompts):
            raise TimeoutError("no answer")
        return [p.upper() for p in prompts]

    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a", "bad", None, "c", "a"])], "id long, prompt string").coalesce(1)
    out = {r.id: (r.answer, r.error) for r in generate(df, client, errors="error").collect()}
    assert out == {0: ("A", None), 1: (None, "TimeoutError: no answer"), 2: ("", None), 3: ("C", None), 4: ("A", None)}


class Counted:
    """A client that logs every call, and raises for a prompt's first ``fails`` calls."""

    def __init__(self, fails=0, always=()):
        self.log, self.fails, self.always = tempfile.mkdtemp(prefix="chunkwise-calls-"), fails, always

    def __call__(self, prompts):
        before = len(os.listdir(self.log))
        fd, path = tempfile.mkstemp(dir=self.log)
        with os.fdopen(fd, "w") as f:
            f.write("\n".join(prompts))
        if before < self.fails or set(prompts) & set(self.always):
            raise ConnectionError("busy")
        return [f"<{p}>" for p in prompts]

    def sent(self):
        return [p for name in os.listdir(self.log) for p in open(f"{self.log}/{name}").read().split("\n")]


def test_answers_are_kept_by_prompt(spark):
    path = scratch_path(spark, "answers")
    df = spark.createDataFrame([(i, f"p{i % 4}") for i in range(40)] + [(40, None)], "id long, prompt string")
    first = Counted()
    out = answer_once(df, first, path, model="m", max_parallel=2).collect()
    assert len(out) == 41 and {(r.prompt, r.answer) for r in out} == {(f"p{i}", f"<p{i}>") for i in range(4)} | {(None, "<>")}
    assert all(r.seconds >= 0 and r.tries == 1 and r.error is None for r in out)
    assert sorted(first.sent()) == ["", "p0", "p1", "p2", "p3"]                # equal prompts were sent once
    second = Counted()
    more = df.unionByName(spark.createDataFrame([(50, "new")], df.schema))
    assert answer_once(more, second, path, model="m").where("answer is null").count() == 0
    assert second.sent() == ["new"]                                           # a second run calls for new prompts only
    other = Counted()
    answer_once(df, other, path, model="another")
    assert len(other.sent()) == 5                                             # another model has answers of its own
    assert kept_answers(spark, path).count() == 11


def test_failing_calls_are_retried_and_failures_tried_again_later(spark):
    path = scratch_path(spark, "answers")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "worse")], "id long, prompt string").coalesce(1)
    flaky = Counted(fails=1, always=("worse",))
    out = {r.prompt: r for r in answer_once(df, flaky, path, model="m", tries=2, max_parallel=1).collect()}
    assert out["a"].answer == "<a>" and out["b"].answer == "<b>" and out["a"].error is None
    assert out["worse"].answer is None and out["worse"].error == "ConnectionError: busy" and out["worse"].tries == 4
    assert flaky.sent().count("worse") == 4                                   # two calls together, two alone: bounded
    healed = Counted()
    out = answer_once(df, healed, path, model="m").collect()
    assert healed.sent() == ["worse"] and {r.answer for r in out} == {"<a>", "<b>", "<worse>"}
    assert all(r.error is None for r in out)
    with pytest.raises(ValueError):
        answer_once(df, healed, path, model="m", tries=0)


def test_an_encoder_gets_few_texts_at_a_time(spark):
    from chunkwise.operators.encode import ENCODE_ROWS

    def encoder(texts):
        if len(texts) > ENCODE_ROWS:
            raise ValueError(f"{len(texts)} texts at once")
        return np.array([[len(t), 1] for t in texts], np.float32)

    df = spark.range(2000).select("id", F.when(F.col("id") % 7 > 0, F.repeat(F.lit("x"), F.col("id").cast("int"))).alias("t")).coalesce(1)
    want = {(i, float(i if i % 7 else 0)) for i in range(2000)}
    assert {(r.id, r.embedding[0]) for r in embed(df, "t", encoder, 2).collect()} == want
    assert {(r.id, r.embedding[0]) for r in embed(df, "t", encoder, 2, errors="why").where("why is null").collect()} == want
    # what calls apart gives for the texts that fail alone
    short = lambda texts: encoder(texts) if max(map(len, texts)) < 1990 else 1 / 0
    assert {r.id for r in embed(df, "t", short, 2, errors="why").where("why is not null").collect()} == \
        {i for i in range(1990, 2000) if i % 7}


def test_pages_leave_a_worker_in_small_batches():
    import pyarrow as pa
    from chunkwise.sources.files import PAGE_BYTES

    class Files:  # takes the function that would go to the workers
        def select(self, *names):
            return self

        def mapInArrow(self, run, schema):
            return run

    content = [b"\f".join([b"y" * 1000] * 3000), None, b"\xff", b"a\f\fb"]
    batch = pa.RecordBatch.from_arrays([pa.array(["f", "g", "h", "i"]), pa.array(content, pa.binary())], ["file", "content"])
    out = list(extract_pages(Files(), page_reader, errors="error")(iter([batch])))
    assert max(b.nbytes for b in out) < 1.2 * PAGE_BYTES and len(out) > 2
    rows = [tuple(r.values()) for b in out for r in b.to_pylist()]
    assert [r[:2] for r in rows] == [("f", i) for i in range(3000)] + [("h", None)] + [("i", i) for i in range(3)]
    assert [r[2] for r in rows[-3:]] == ["a", "", "b"] and rows[3000][3].startswith("UnicodeDecodeError")
