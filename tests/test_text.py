"""Tokenising, chunking, keys, previews, number format."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chunkwise.functions.text import chunk_key, fmt2, preview, words
from chunkwise.operators.chunking import check_params, chunk, chunk_count

PY_WHITESPACE = [chr(c) for c in range(0x110000) if chr(c).isspace()]


def py_chunks(text, size=300, overlap=50):
    ws = (text or "").split()
    return [" ".join(ws[i:i + size]) for i in range(0, len(ws), size - overlap)]


def test_whitespace_class_is_pythons():
    assert len(PY_WHITESPACE) == 29


def test_words_match_str_split(spark):
    texts = [f"a{c}b{c}{c}c" for c in PY_WHITESPACE]
    texts += ["  lead and trail \t\n", " 　   ", "", "one", None, "x y\u0085z"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    got = {r["id"]: r["w"] for r in df.select("id", words("text").alias("w")).collect()}
    for i, t in enumerate(texts):
        if t is None:
            assert got[i] is None
        else:
            assert got[i] == t.split(), repr(t)


@pytest.mark.parametrize("n,expected", [(0, 0), (1, 1), (250, 1), (251, 2), (300, 2), (301, 2),
                                        (500, 2), (501, 3), (1000, 4)])
def test_chunk_counts(spark, n, expected):
    text = " ".join(f"w{i}" for i in range(n))
    df = spark.createDataFrame([(1, text)], "id int, text string")
    rows = chunk(df).orderBy("chunk_index").collect()
    assert len(rows) == expected
    assert [r["chunk"] for r in rows] == py_chunks(text)
    assert [r["chunk_index"] for r in rows] == list(range(expected))
    cnt = df.select(chunk_count(F.size(words("text"))).alias("c")).first()["c"]
    assert cnt == expected


def test_chunk_null_and_blank_pages_give_no_chunks(spark):
    df = spark.createDataFrame([(1, None), (2, "   \n\t "), (3, "")], "id int, text string")
    assert chunk(df).count() == 0


def test_chunk_params():
    assert check_params(300, 50) == 250
    with pytest.raises(ValueError):
        check_params(300, 300)
    with pytest.raises(ValueError):
        check_params(300, 301)
    with pytest.raises(ValueError):
        check_params(0, 0)


@settings(max_examples=25, deadline=None)
@given(n=st.integers(min_value=0, max_value=1200), size=st.integers(2, 40), overlap=st.integers(0, 39))
def test_chunks_restore_words(spark, n, size, overlap):
    if overlap >= size:
        return
    text = " ".join(f"t{i}" for i in range(n))
    rows = chunk(spark.createDataFrame([(text,)], "text string"), size=size, overlap=overlap) \
        .orderBy("chunk_index").collect()
    assert [r["chunk"] for r in rows] == py_chunks(text, size, overlap)
    step = size - overlap
    assert len(rows) == (math.ceil(n / step) if n else 0)
    restored = []
    for r in rows:
        restored.extend(r["chunk"].split()[: step])
    assert restored == text.split()


def test_fmt2_matches_python_rounding(spark):
    values = [0.125, 1.005, 1.015, 0.375, -0.001, 1234.5, 2.675, 0.295, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "d double")
    got = [r["s"] for r in df.select(fmt2("d").alias("s")).collect()]
    assert got == ["%.2f" % v for v in values]
    assert got[:8] == ["0.12", "1.00", "1.01", "0.38", "-0.00", "1234.50", "2.67", "0.29"]


def test_preview_and_key(spark):
    df = spark.createDataFrame([("f.pdf", 3, "é" * 60 + "{query}\nx")], "file string, page int, chunk string")
    r = df.select(preview("chunk", 50).alias("p"), chunk_key().alias("k")).first()
    assert r["p"] == "é" * 50 + "..."
    assert r["k"] == "doc::f.pdf_page_3_chunk_" + "é" * 60 + "{query}\nx"
