"""V5 / V5h: text -> fixed-length vectors.

``embed`` runs any batch encoder ``list[str] -> ndarray[n, dim]`` inside Python
workers through an Arrow-batched iterator UDF: only the text column crosses to
Python. An encoder that loads weights is given as ``Once(factory, key)`` and loads them
once per worker process.

``hash_vectors`` is the built-in stand-in encoder (hashed bag of words,
Weinberger et al. 2009), computed entirely in the JVM: bucket = md5 of the
lower-cased word, counts per bucket from native array scans.
``hash_vectors_arrow`` counts in Python (one ``bincount`` per Arrow batch) and
``hash_counts`` is the sparse, pure-SQL form; all three agree exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwise.functions.text import words
from chunkwise.operators.outside import apart

VECTOR_TYPE = T.ArrayType(T.FloatType())
DEFAULT_HASH_DIM = 64
ENCODE_ROWS = 512  # texts that an encoder gets at a time


def word_buckets(text: str | Column, dim: int = DEFAULT_HASH_DIM) -> Column:
    """Bucket of every word: the first 8 hex digits of md5(lower(word)) as an
    integer, modulo ``dim``. The text is lower-cased once, before splitting:
    lower-casing never creates or removes whitespace, so the words are the same."""
    text = F.col(text) if isinstance(text, str) else text
    return F.transform(words(F.lower(text)), lambda w: _bucket_of_lower(w, dim))


def _bucket_of_lower(word: Column, dim: int) -> Column:
    return F.pmod(F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint"),
                  F.lit(dim)).cast("int")


def hash_counts(df: DataFrame, text: str, keep: list[str], dim: int = DEFAULT_HASH_DIM) -> DataFrame:
    """Sparse form: one row per (keep..., bucket) with the word count.

    The count is a map-side-combined aggregate; at most ``dim`` rows per input
    row are shuffled.
    """
    exploded = df.select(*keep, F.explode(word_buckets(text, dim)).alias("bucket"))
    return exploded.groupBy(*keep, "bucket").agg(F.count(F.lit(1)).alias("cnt"))


def _bincount_udf(dim: int):
    @F.pandas_udf(VECTOR_TYPE)
    def bincount(buckets: pd.Series) -> pd.Series:
        n = len(buckets)
        arrays = [a if a is not None else np.empty(0, dtype=np.int64) for a in buckets]
        lens = np.fromiter((len(a) for a in arrays), dtype=np.int64, count=n)
        if n == 0:
            return pd.Series([], dtype=object)
        flat = np.concatenate(arrays).astype(np.int64) if lens.sum() else np.empty(0, dtype=np.int64)
        rows = np.repeat(np.arange(n, dtype=np.int64), lens)
        dense = np.bincount(rows * dim + flat, minlength=n * dim).reshape(n, dim)
        return pd.Series(list(dense.astype(np.float32)))
    return bincount


def hash_vectors(df: DataFrame, text: str, dim: int = DEFAULT_HASH_DIM,
                 out: str = "embedding") -> DataFrame:
    """Dense hashed bag-of-words vector (``array<float>``) for ``text``, JVM only.

    The bucket array is computed once per row; the count of bucket j is
    ``size(b) - size(array_remove(b, j))`` (native array scans, no per-word
    lambda). Empty or null text gives the zero vector.
    """
    tmp = f"_{out}_buckets"
    with_b = df.withColumn(tmp, F.coalesce(word_buckets(text, dim), F.array().cast("array<int>")))
    counts = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)),
                         lambda j: (F.size(tmp) - F.size(F.array_remove(tmp, j))).cast("float"))
    return with_b.withColumn(out, counts).drop(tmp)


def hash_vectors_arrow(df: DataFrame, text: str, dim: int = DEFAULT_HASH_DIM,
                       out: str = "embedding") -> DataFrame:
    """Same vectors, counted by one ``bincount`` per Arrow batch in Python."""
    return df.withColumn(out, _bincount_udf(dim)(word_buckets(text, dim)))


class HashEncoder:
    """The hashed encoder as a plain batch callable (same buckets as the JVM form).

    Useful wherever a Python encoder is expected, e.g. ``embed``. Buckets of
    recent words are memoised per worker (word frequencies are heavily skewed).
    """

    MEMO_LIMIT = 100_000

    def __init__(self, dim: int = DEFAULT_HASH_DIM):
        self.dim = dim
        self._memo: dict[str, int] = {}

    def __getstate__(self):
        return {"dim": self.dim}

    def __setstate__(self, state):
        self.dim = state["dim"]
        self._memo = {}

    def bucket(self, word: str) -> int:
        b = self._memo.get(word)
        if b is None:
            if len(self._memo) >= self.MEMO_LIMIT:
                self._memo.clear()
            b = int(hashlib.md5(word.lower().encode("utf-8")).hexdigest()[:8], 16) % self.dim
            self._memo[word] = b
        return b

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), dtype=np.float32)
        for i, text in enumerate(texts):
            for word in (text or "").split():
                out[i, self.bucket(word)] += 1.0
        return out


def embed(df: DataFrame, text: str, encoder: Callable[[list[str]], np.ndarray], dim: int,
          out: str = "embedding", errors: str | None = None) -> DataFrame:
    """Add ``out`` = encoder(text) as ``array<float>`` of length ``dim``.

    The encoder is called for runs of up to ``ENCODE_ROWS`` texts of an Arrow batch; its result
    must have shape ``(len(run), dim)``. One that loads weights is best given as
    ``Once(factory, key)``, which builds it once per worker process. Encoders that are not
    deterministic across task retries should have their output written before it is joined on.

    With ``errors``, the column of that name tells why a row has no vector: what the
    encoder raised for this text alone, or what an earlier step already wrote there (such
    rows are not encoded). Without it an error ends the job.
    """
    def matrix_of(texts: list) -> np.ndarray:
        matrix = np.asarray(encoder([t if t is not None else "" for t in texts]), dtype=np.float32)
        if matrix.shape != (len(texts), dim):
            raise ValueError(f"encoder returned shape {matrix.shape}, expected ({len(texts)}, {dim})")
        return matrix

    if errors is None:
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                vectors = np.empty((len(texts), dim), np.float32)
                for s in range(0, len(texts), ENCODE_ROWS):
                    vectors[s:s + ENCODE_ROWS] = matrix_of(texts.slice(s, ENCODE_ROWS).to_pylist())
                ends = np.arange(0, vectors.size + 1, dim, dtype=np.int32)
                yield pa.ListArray.from_arrays(pa.array(ends), pa.array(vectors.ravel()))

        # marked as not deterministic: a filter on the vectors must not encode twice
        udf = F.arrow_udf(encode, VECTOR_TYPE).asNondeterministic()
        return df.withColumn(out, udf(F.col(text)))

    def encode_apart(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, before in batches:
            vectors, found = [], []
            for s in range(0, len(texts), ENCODE_ROWS):
                own, why = texts.slice(s, ENCODE_ROWS).to_pylist(), before.slice(s, ENCODE_ROWS).to_pylist()
                open_rows = [i for i, e in enumerate(why) if e is None]
                got, failed = apart(matrix_of, [own[i] for i in open_rows])
                coded = [None] * len(own)
                for i, v, e in zip(open_rows, got, failed):
                    coded[i], why[i] = v, e
                vectors.append(pa.array(coded, pa.list_(pa.float32())))
                found.append(pa.array(why, pa.string()))
            yield pa.StructArray.from_arrays([pa.concat_arrays(vectors), pa.concat_arrays(found)], ["v", "e"])

    udf = F.arrow_udf(encode_apart, T.StructType([T.StructField("v", VECTOR_TYPE), T.StructField("e", T.StringType())]))
    before = F.col(errors) if errors in df.columns else F.lit(None).cast("string")
    return (df.withColumn("_coded", udf.asNondeterministic()(F.col(text), before))
            .withColumn(out, F.col("_coded.v")).withColumn(errors, F.col("_coded.e")).drop("_coded"))
