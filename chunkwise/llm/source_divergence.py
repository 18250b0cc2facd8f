"""Source divergence audit: how far each source's words lie from its language's.

Terms are counted by length-bucketed packing. Inside a task, Arrow's text buffer is
cut into terms as byte positions; terms of up to 8 bytes become one big-endian
uint64, those of up to 16 bytes two, and are sorted by an LSD radix sort over 16-bit
digits; longer terms go to buckets of equal padded width and are sorted as bytes.
Equal neighbours are run-counted. No term holds a zero byte, so zero padding cannot
make two terms equal. A task keeps its runs in arrays of bounded length and merges
or emits them, so Spark shuffles counts, never words.

A language keeps the terms found in at least ``min_docs`` of its documents. With n
occurrences in a group (a language's source, or the whole language), N the sum of n
over the V kept terms, a term's share is p = 1 + floor(10^9 (n + 5) / (N + 5 V)).

* ``pair`` rows: for each source every other source of its language, with the sum of
  |p - q| over all kept terms.
* ``term`` rows: for each source its ``top`` kept terms by p - q (q: the language's
  share), of those that occur there and have p > q.

Pair sums are worked out on blocks: ``TERM_BLOCK`` terms by two runs of
``SOURCE_BLOCK`` sources make one cogroup, so no task holds a whole vocabulary or all
sources, and terms that no source of a block uses cost nothing.

Defined cases: null text, language and source count as ''; a text without letters
has no terms, its group still occurs; repeated rows count each; a language without
kept terms gives pair rows of value 0 and no term rows; ties are ordered by the
item's UTF-8 bytes; an empty table gives no rows; columns other than the named ones
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkwise.llm.common import Interner, stored

SLICE_BYTES = 2 << 20        # text worked on at once (one text at least)
MERGE_ROWS = 1 << 20         # runs gathered before equal ones are merged
KEEP_ROWS = 1 << 19          # merged runs a task holds on to; beyond that it emits them
TERM_BLOCK, SOURCE_BLOCK = 4096, 256
SCALE = 1_000_000_000
COUNTS = "lang string, source string, term string, n long, docs long"

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# ----------------------------------------------------------------------------
# packing, sorting and counting inside a task
# ----------------------------------------------------------------------------

def find_terms(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and document of every term; document i is bytes bounds[i]:bounds[i + 1]."""
    inside = _LETTER[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins, ends = bounds[:-1][bounds[:-1] < len(data)], bounds[1:][bounds[1:] > 0] - 1
    first[begins], last[ends] = inside[begins], inside[ends]  # no term crosses a document's edge
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1 - starts, np.searchsorted(bounds, starts, "right") - 1


def pack(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, words: int) -> list[np.ndarray]:
    """The terms' bytes as ``words`` big-endian uint64 columns, zero-padded on the right."""
    padded = np.concatenate([data, np.zeros(8 * words, np.uint8)])
    at_byte = np.ndarray((len(data) + 8 * (words - 1) + 1,), ">u8", padded, strides=(1,))
    columns = []
    for w in range(words):
        spare = (8 * (8 - np.clip(lengths - 8 * w, 0, 8))).astype(np.uint64)
        half = spare >> np.uint64(1)  # two shifts, as one by 64 is not defined
        word = at_byte[starts + 8 * w].astype(np.uint64)
        columns.append(word >> half >> (spare - half) << half << (spare - half))
    return columns


def padded_bytes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """Terms of at most ``width`` bytes as fixed-width byte strings."""
    cell = np.arange(width)
    raw = data.take(starts[:, None] + cell, mode="clip")
    raw[cell >= lengths[:, None]] = 0
    return np.ascontiguousarray(raw).view(f"S{width}").ravel()


def sorted_order(columns: list[np.ndarray]) -> np.ndarray:
    """Stable order by ``columns``, the first counting most: unsigned integers by LSD radix
    passes over 16-bit digits (digits equal in all rows are skipped), byte strings as bytes."""
    order = np.arange(len(columns[0]))
    for column in reversed(columns):
        if column.dtype.kind == "S":
            order = order[np.argsort(column[order], kind="stable")]
            continue
        for shift in range(0, 8 * column.itemsize, 16):
            digit = (column >> column.dtype.type(shift)).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                order = order[np.argsort(digit[order], kind="stable")]  # radix sort for 16 bits
    return order


def _run_starts(columns: list[np.ndarray]) -> np.ndarray:
    new = np.ones(len(columns[0]), bool)
    if len(new) > 1:
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(new)


def count_runs(columns: list[np.ndarray], docs: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct rows of ``columns`` with their occurrences and documents; ``docs`` ascend."""
    order = sorted_order(columns)
    columns, docs = [c[order] for c in columns], docs[order]
    runs = _run_starts(columns)
    fresh = np.zeros(len(order), np.int64)
    fresh[_run_starts([*columns, docs])] = 1
    return ([c[runs] for c in columns], np.diff(np.append(runs, len(order))),
            np.add.reduceat(fresh, runs))


def merge_runs(columns: list[np.ndarray], n: np.ndarray, docs: np.ndarray):
    """Sums of ``n`` and ``docs`` over equal rows of ``columns``."""
    order = sorted_order(columns)
    columns = [c[order] for c in columns]
    runs = _run_starts(columns)
    return [c[runs] for c in columns], np.add.reduceat(n[order], runs), np.add.reduceat(docs[order], runs)


class TermRuns:
    """Runs of one task by bucket: 1 or 2 packed words, or a padded width in bytes."""

    def __init__(self):
        self.buckets: dict[int, list] = {}
        self.pending = 0

    def add(self, data: np.ndarray, bounds: np.ndarray, groups: np.ndarray) -> None:
        data = _LOWER[data]
        starts, lengths, docs = find_terms(data, bounds)
        bucket = np.where(lengths <= 8, 1, 2)
        long = lengths > 16
        bucket[long] = 1 << np.ceil(np.log2(lengths[long])).astype(np.int64)
        for b in np.unique(bucket):
            here = bucket == b
            s, l, d = starts[here], lengths[here], docs[here]
            words = pack(data, s, l, int(b)) if b <= 2 else [padded_bytes(data, s, l, int(b))]
            runs = count_runs([*words, groups[d]], d)
            self.buckets.setdefault(int(b), []).append(runs)
            self.pending += len(runs[1])

    def merge(self) -> int:
        """Merge equal runs; the number of runs left."""
        for b, parts in self.buckets.items():
            if len(parts) > 1:
                columns = [np.concatenate(c) for c in zip(*[p[0] for p in parts])]
                self.buckets[b] = [merge_runs(columns, np.concatenate([p[1] for p in parts]),
                                              np.concatenate([p[2] for p in parts]))]
        self.pending = sum(len(p[1]) for parts in self.buckets.values() for p in parts)
        return self.pending

    def emit(self, names: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
        """All runs as Arrow batches of lang, source, term, n, docs; then none are held."""
        self.merge()
        langs, sources = pa.array([x[0] for x in names], pa.string()), pa.array([x[1] for x in names], pa.string())
        for b, parts in sorted(self.buckets.items()):
            (*words, group), n, docs = parts[0]
            raw = np.stack(words, axis=1).astype(">u8").view(np.uint8) if b <= 2 else \
                words[0].view(np.uint8).reshape(len(n), b)
            ends = np.cumsum(np.append(0, np.count_nonzero(raw, axis=1))).astype(np.int32)
            terms = pa.StringArray.from_buffers(len(n), pa.py_buffer(ends), pa.py_buffer(raw[raw != 0].tobytes()))
            code = pa.array(group.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [langs.take(code), sources.take(code), terms, pa.array(n.astype(np.int64)),
                 pa.array(docs.astype(np.int64))], names=["lang", "source", "term", "n", "docs"])
        self.buckets, self.pending = {}, 0


def _text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row bounds of a string column without nulls."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), bounds


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs, codes, names = TermRuns(), Interner(), []
    for batch in batches:
        lang, source = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        groups = codes.ids(list(zip(lang, source))).astype(np.uint32)
        names = list(codes)
        data, bounds = _text_buffer(batch.column(2))
        row = 0
        while row < len(groups):
            to = max(row + 1, int(np.searchsorted(bounds, bounds[row] + SLICE_BYTES, "right")) - 1)
            if bounds[to] > bounds[row]:
                runs.add(data[bounds[row]:bounds[to]], bounds[row:to + 1] - bounds[row], groups[row:to])
            if runs.pending > MERGE_ROWS and runs.merge() > KEEP_ROWS:
                yield from runs.emit(names)
            row = to
    yield from runs.emit(names)


# ----------------------------------------------------------------------------
# the audit
# ----------------------------------------------------------------------------

def _named(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(out)
                         for c, out in ((lang, "lang"), (source, "source"), (text, "text"))])


def kept_terms(docs: DataFrame, min_docs: int = 30, text: str = "text", lang: str = "lang",
               source: str = "source") -> DataFrame:
    """``lang, source, term, n, n_lang, lead`` for kept terms that occur in the source.

    ``n_lang`` counts the term in the whole language; ``lead`` is true in one row of
    each (lang, term). One shuffle, of counts, by (lang, term).
    """
    counted = (_named(docs, text, lang, source).mapInArrow(_count_batches, COUNTS)
               .repartition("lang", "term")
               .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    whole = Window.partitionBy("lang", "term")
    return (counted.withColumn("docs_lang", F.sum("docs").over(whole))
            .withColumn("n_lang", F.sum("n").over(whole))
            .withColumn("lead", F.row_number().over(whole.orderBy("source")) == 1)
            .where(F.col("docs_lang") >= min_docs).select("lang", "source", "term", "n", "n_lang", "lead"))


def _share(n: Column | str, total: str) -> Column:
    """1 + floor(10^9 (n + 5) / (N + 5 V)) in decimals, 0 without kept terms."""
    wide = lambda c: (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")
    top = F.lit(SCALE).cast("decimal(10,0)") * (wide(n) + F.lit(5).cast("decimal(2,0)"))
    least = wide(total) + F.lit(5).cast("decimal(2,0)") * wide("v")
    return F.when(F.col("v") == 0, F.lit(0).cast("long")).otherwise(
        1 + F.call_function("div", top.cast("decimal(38,0)"), least.cast("decimal(38,0)")))


def _groups(docs: DataFrame, kept: DataFrame, lang: str, source: str) -> DataFrame:
    """One row per occurring group: N of the group and its language, V, the share of a term
    that does not occur, and the place of the source among its language's."""
    langs = kept.groupBy("lang").agg(F.sum(F.col("lead").cast("long")).alias("v"), F.sum("n").alias("lang_total"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    every = _named(docs, source, lang, source).select("lang", "source").distinct()
    out = every.join(own, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    place = Window.partitionBy("lang").orderBy("source")
    return (out.withColumn("p0", _share(F.lit(0), "total")).withColumn("at", F.row_number().over(place) - 1)
            .withColumn("n_sources", F.count(F.lit(1)).over(Window.partitionBy("lang"))))


def _pair_sums(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` both ways, from blocks of terms and sources."""
    blocks = F.ceil(F.col("n_sources") / SOURCE_BLOCK).cast("int")
    cells = F.greatest(F.lit(1), F.ceil(F.col("v") / TERM_BLOCK).cast("int"))
    own = F.floor(F.col("at") / SOURCE_BLOCK).cast("int")

    def dealt(df: DataFrame) -> DataFrame:
        """Each row once for every block of sources that its own block meets."""
        df = df.withColumn("_o", own).withColumn("_x", F.explode(F.sequence(F.lit(0), blocks - 1)))
        return df.withColumn("low", F.least("_o", "_x")).withColumn("high", F.greatest("_o", "_x"))

    keys = ["lang", "cell", "low", "high"]
    left = dealt(shares.withColumn("cell", F.pmod(F.xxhash64("term"), cells.cast("long")).cast("int"))) \
        .select(*keys, "term", "at", "p")
    right = dealt(groups.withColumn("cell", F.explode(F.sequence(F.lit(0), cells - 1)))) \
        .select(*keys, "source", "at", "p0", "v")
    right = right.toDF(*right.columns)  # both sides come from ``groups``
    schema = "lang string, a string, b string, extra long, base long"

    def sums(key: tuple, terms: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        members = members.sort_values("at").reset_index(drop=True)
        place = pd.Series(members.index, index=members["at"])
        codes, names = pd.factorize(terms["term"])
        none = members["p0"].to_numpy(np.int64)
        p = np.repeat(none[:, None], len(names), axis=1)
        if len(codes):
            p[place[terms["at"]].to_numpy(), codes] = terms["p"].to_numpy(np.int64)
        block = members["at"].to_numpy() // SOURCE_BLOCK
        rows, low, high = [], np.flatnonzero(block == key[2]), np.flatnonzero(block == key[3])
        v, name = int(members["v"].iloc[0]), members["source"].to_numpy(object)
        for i in low:
            to = high[high > i] if key[2] == key[3] else high
            apart = np.abs(none[to] - none[i])
            rows.append(pd.DataFrame({"lang": key[0], "a": name[i], "b": name[to],
                                      "extra": np.abs(p[to] - p[i]).sum(1) - len(names) * apart,
                                      "base": v * apart}))
        return pd.concat(rows) if rows else pd.DataFrame(columns=["lang", "a", "b", "extra", "base"])

    both = (left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(sums, schema)
            .groupBy("lang", "a", "b").agg((F.sum("extra") + F.max("base")).alias("value")))
    turned = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                               F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return both.select("lang", turned.alias("x"), "value").select("lang", "x.source", "x.item", "value")


def audit(docs: DataFrame, min_docs: int = 30, top: int = 50, text: str = "text", lang: str = "lang",
          source: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank``: all pairs of sources, ``top`` terms a source."""
    kept = stored(kept_terms(docs, min_docs, text, lang, source), "kept-terms")
    groups = stored(_groups(docs, kept, lang, source), "groups")
    shares = kept.join(groups, ["lang", "source"]).withColumn("p", _share("n", "total")) \
        .withColumn("q", _share("n_lang", "lang_total"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                          (F.col("p") - F.col("q")).alias("value"))
             .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top))
    pairs = (_pair_sums(shares, groups).withColumn("part", F.lit("pair"))
             .withColumn("rank", F.row_number().over(ranked)))
    return pairs.select(*terms.columns).unionByName(terms)
