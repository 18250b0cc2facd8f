"""Rows with null groups, keys and sessions are neither lost nor merged; UDFs run once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkwise.functions.text import chunk_key
from chunkwise.operators.encode import embed
from chunkwise.operators.metrics import timed_answers
from chunkwise.operators.numbering import row_number_within
from chunkwise.operators.rag import generate
from chunkwise.operators.sessions import take_until
from chunkwise.session import scratch_path
from chunkwise.streaming import ingest_stream, read_store


def test_numbering_keeps_null_groups_and_null_order_values(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4), ("a", None)], "g string, o long")
    got = {(r.g, r.o): r.rn for r in row_number_within(df, ["g"], "o").collect()}
    assert got == {("a", None): 1, ("a", 1): 2, ("a", 2): 3, (None, 3): 1, (None, 4): 2}


def test_a_key_with_null_parts_is_a_key(spark):
    df = spark.createDataFrame([(None, 0, "1"), (None, 0, "2")], "file string, page int, chunk string")
    assert [r[0] for r in df.select(chunk_key()).collect()] == ["doc::null_page_0_chunk_1", "doc::null_page_0_chunk_2"]


@pytest.mark.parametrize("target", [1, 1000])
def test_a_null_session_stops_too(spark, target):
    rows = [(None, 1, "a"), (None, 2, "EXIT"), (None, 3, "b"), ("s", 1, "c")]
    df = spark.createDataFrame(rows, "session string, seq int, query string")
    got = take_until(df, ["session"], ["seq"], "query", target_rows=target)
    assert sorted(r.query for r in got.collect()) == ["a", "c"]


def test_filters_on_results_run_the_udf_once(spark):
    df = spark.createDataFrame([("p",)], "prompt string")
    plans = [generate(df, lambda p: p).where("answer <> 'x'"),
             embed(df, "prompt", lambda t: np.ones((len(t), 2)), 2).where("embedding[0] > 0")]
    for out in plans:
        assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_timed_answers_run_the_client(spark):
    def broken(prompts):
        raise RuntimeError("no model here")

    df = spark.createDataFrame([("p",)], "prompt string")
    with pytest.raises(Exception, match="no model here"):
        timed_answers(lambda: generate(df, broken), scratch_path(spark, "t"), "r", "s", "e", "l")
    record = timed_answers(lambda: generate(df, lambda p: ["four"] * len(p)), scratch_path(spark, "t"), "r2", "s", "e", "l")
    assert (record.rows, record.bytes) == (1, 4) and record.seconds > 0


def test_a_second_stream_into_a_store_adds_to_it(spark, tmp_path):
    store = f"{tmp_path}/store"
    for name in ("a", "c"):
        folder = tmp_path / name
        folder.mkdir()
        (folder / f"{name}.txt").write_text(f"text of {name}")
        q = ingest_stream(spark, str(folder), store, suffix=".txt", dim=2,
                          encoder=lambda texts: np.full((len(texts), 2), 3.0))
        assert q.awaitTermination(120)
    rows = read_store(spark, store).select("file", F.col("embedding")[0].alias("x")).collect()
    assert sorted((r.file, r.x) for r in rows) == [("a.txt", 3.0), ("c.txt", 3.0)]
