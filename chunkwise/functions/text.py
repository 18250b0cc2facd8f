"""Text functions: tokenising, chunk keys, previews, number formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------
# Python's str.split() whitespace, as one regex character class (the 29 code
# points for which str.isspace() is true): U+0009-U+000D, U+001C-U+0020, U+0085,
# U+00A0, U+1680, U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
# Java and RE2 (DuckDB) both read the \x{..} escapes; plain \s is ASCII only.
WHITESPACE = (r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
              r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+")
# Store key layout: prefix, then "{file}_page_{page}_chunk_{chunk}".
KEY_PREFIX = "doc::"
PREVIEW_SUFFIX = "..."
# ------------------------------------------------------------------------------


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(text: str | Column) -> Column:
    """Python ``str.split()``: runs of Unicode whitespace, no empty tokens.

    Null text gives null (treated as zero words downstream).
    """
    return F.filter(F.split(_c(text), WHITESPACE), lambda w: w != F.lit(""))


def chunk_key(file: str | Column = "file", page: str | Column = "page",
              chunk: str | Column = "chunk", prefix: str = KEY_PREFIX) -> Column:
    """``{prefix}{file}_page_{page}_chunk_{chunk}``; the page is cast to string.

    A null part reads ``null``, so rows that lack a part still have a key.
    """
    part = lambda c: F.coalesce(_c(c).cast("string"), F.lit("null"))
    return F.concat(F.lit(prefix), part(file), F.lit("_page_"), part(page), F.lit("_chunk_"), part(chunk))


def preview(text: str | Column, n: int) -> Column:
    """First ``n`` characters (code points) followed by ``...``, always."""
    return F.concat(F.substring(_c(text), 1, n), F.lit(PREVIEW_SUFFIX))


def fmt2(value: str | Column) -> Column:
    """Two decimals with Python ``%.2f`` rounding of the exact binary value.

    ``format_number`` rounds half-even on the exact double, as ``%.2f`` does;
    ``format_string('%.2f')`` (Java) does not. Thousands separators are not
    wanted, so the pattern has none.
    """
    return F.call_function("format_number", _c(value).cast("double"), F.lit("0.00"))
