"""Sliding word windows over page text, entirely in the JVM.

Windows of ``size`` words start every ``size - overlap`` words; a page with n
words gives ceil(n / step) chunks (none for n = 0), and the last chunk may lie
inside the one before it, exactly as slicing a word list in steps does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwise.functions.text import words

DEFAULT_SIZE = 300
DEFAULT_OVERLAP = 50


def check_params(size: int, overlap: int) -> int:
    """Return the step; overlap >= size is rejected (zero or negative step)."""
    if size <= 0:
        raise ValueError("chunk size must be positive")
    if overlap < 0:
        raise ValueError("overlap must not be negative")
    if overlap >= size:
        raise ValueError(f"overlap ({overlap}) must be smaller than size ({size})")
    return size - overlap


def chunk_count(n_words: Column, size: int = DEFAULT_SIZE, overlap: int = DEFAULT_OVERLAP) -> Column:
    step = check_params(size, overlap)
    return F.when(n_words > 0, F.floor((n_words - 1) / step) + 1).otherwise(0).cast("int")


def chunk(df: DataFrame, text: str = "text", size: int = DEFAULT_SIZE,
          overlap: int = DEFAULT_OVERLAP, keep: list[str] | None = None,
          pass_on: str | None = None) -> DataFrame:
    """One row per chunk: ``*keep, chunk_index int, chunk string``.

    ``keep`` defaults to every column except ``text``. A row whose column ``pass_on`` (one
    of ``keep``, such as an error) is not null gives one row with a null chunk.
    """
    step = check_params(size, overlap)
    keep = keep if keep is not None else [c for c in df.columns if c != text]
    ws = df.select(*keep, words(text).alias("_ws"))
    starts = F.when(F.size("_ws") > 0, F.sequence(F.lit(0), F.floor((F.size("_ws") - 1) / step).cast("int")))
    if pass_on:
        starts = F.when(F.col(pass_on).isNotNull(), F.array(F.lit(None).cast("int"))).otherwise(starts)
    exploded = ws.select(*keep, "_ws", F.explode(starts).alias("chunk_index"))
    return exploded.select(
        *keep, "chunk_index",
        F.array_join(F.slice("_ws", F.col("chunk_index") * step + 1, F.lit(size)), " ").alias("chunk"))
