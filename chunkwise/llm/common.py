"""Shared pieces of the operators: stored intermediates, hold-out folds, word memo.

``stored`` writes a DataFrame as Parquet below the session's shared scratch folder
and reads it back. That cuts the lineage (a lost executor costs a re-read, not a
re-run) and pins generated row ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwise.session import scratch_path

WORD_CLASS = r"[^\x20\x09-\x0D]+"


#: Rows of whole texts that go to Python at once where ``arrow_rows`` says so.
TEXT_ROWS = 1_000


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Jobs run inside have ``key`` set to ``value``."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int = TEXT_ROWS) -> Iterator[None]:
    """Jobs run inside send at most ``rows`` rows to Python at once.

    Batches of 10,000 whole texts, Spark's default, are held by executor and worker, once
    in Arrow buffers and once as rows, which is what such tasks need most memory for.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = int(spark.conf.get(key))
    with setting(spark, key, str(min(rows, before) if before > 0 else rows)):
        yield


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as written and read again; its shuffle files go as soon as it is written."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    with setting(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def row_key(doc_id: Column, text: Column) -> Column:
    """A text key of a row that sorts by id: equal for rows of equal id and text only."""
    return F.concat_ws(":", F.lpad(F.coalesce(doc_id.cast("string"), F.lit("~")), 20, "0"),
                       F.sha2(F.coalesce(text, F.lit("")), 256), text.isNull().cast("string"))


def utf8(text) -> bytes:
    """UTF-8 bytes of a text; null (None or NaN) counts as empty."""
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def slices(frames: Iterator[pd.DataFrame], max_bytes: int = 1 << 20,
           column: str = "text") -> Iterator[tuple[pd.DataFrame, list[bytes]]]:
    """Cut Arrow batches into runs of rows of about ``max_bytes`` of text.

    A run holds at least one row, so memory is bounded by ``max_bytes`` plus the
    longest single text.
    """
    for frame in frames:
        start, size, texts = 0, 0, []
        for i, text in enumerate(frame[column]):
            raw = utf8(text)
            if size and size + len(raw) > max_bytes:
                yield frame.iloc[start:i], texts
                start, size, texts = i, 0, []
            texts.append(raw)
            size += len(raw) + 64
        if texts:
            yield frame.iloc[start:], texts


class Interner(dict):
    """Numbers distinct byte words in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


class WordMemo:
    """Per-task memo of a vector per distinct word.

    ``compute(words) -> array (n, width)`` is called once for each word not yet
    known. Above ``limit`` words the memo starts afresh, which bounds its memory
    and never changes a value.
    """

    def __init__(self, compute, width: int, limit: int = 100_000):
        self.compute, self.width, self.limit = compute, width, limit
        self._clear()

    def _clear(self) -> None:
        self.names, self.values = Interner(), np.zeros((0, self.width), np.float32)

    def rows(self, docs: list[list[bytes]]) -> list[np.ndarray]:
        """Word numbers per document; ``values`` then has a row for every number."""
        if len(self.names) > self.limit:
            self._clear()
        ids = [self.names.ids(words) for words in docs]
        known = len(self.values)
        if len(self.names) > known:
            fresh = list(self.names)[known:]
            self.values = np.concatenate([self.values, self.compute(fresh).astype(np.float32)])
        return ids
