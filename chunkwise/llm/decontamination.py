"""Benchmark decontamination: pigeonhole pieces and bit-parallel edit distance.

A document leaks an item if some substring of it is within k = floor(rate * length)
edits of the item, both lower-cased with runs of white space as one blank. An item
is split in half with budgets e1 + e2 + 1 = k, again and again, down to k + 1 pieces
of budget 0: if the whole is within k edits, one half is within its budget, and so
on to a piece that occurs exactly. All pieces are looked up in one pass over each
whole text (Aho-Corasick); from an exact hit the halves above are verified one
after the other, each with Myers' bit-parallel distance, so chance hits end early
and a match at the top is exact.

The test items are the stated query set. They are broadcast in blocks of about
``block_chars`` characters (their number follows from the items' total size), each
block against all documents.

Defined cases: null, empty and blank documents leak nothing, and so do null or
blank items; items with k = 0 are sought exactly; repeated documents and items are
each reported; empty tables give no rows; other columns are passed by. Rows with a
null id are reported under it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwise.llm.common import row_key, stored

_WORD = re.compile(r"\S+")


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if isinstance(text, str) else ""


def myers(pattern: str, text: str, k: int, anchored: bool = False,
          masks: dict[str, int] | None = None) -> tuple[int, int]:
    """Least distance (at most ``k``) of ``pattern`` to a substring of ``text`` and the
    first end where it is reached; (k + 1, -1) if there is none. ``anchored``
    substrings start at 0."""
    m = len(pattern)
    masks = masks if masks is not None else bit_masks(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, k + 1, -1
    for j, ch in enumerate(text):
        eq = masks.get(ch, 0)
        across = eq | down
        diagonal = (((eq & up) + up) ^ up) | eq
        plus = down | (full & ~(diagonal | up))
        minus = up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = (plus << 1) | anchored
        minus <<= 1
        up = (minus | ~(across | plus)) & full
        down = plus & across & full
        if score < best:
            best, end = score, j + 1
    return best, end


def bit_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, ch in enumerate(pattern):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    return masks


@dataclass
class Part:
    """A stretch of an item with its error budget; leaves have budget 0."""

    item: int
    start: int
    end: int
    budget: int
    text: str
    above: Part | None = None
    masks: dict = field(default_factory=dict)


def leaves(item: int, text: str, k: int) -> list[Part]:
    """The k + 1 pieces of an item, linked to the halves they come from."""
    stack, out = [Part(item, 0, len(text), k, text)], []
    while stack:
        part = stack.pop()
        if part.budget == 0:
            out.append(part)
            continue
        left = (part.budget - 1) // 2
        right = part.budget - 1 - left
        # lengths in proportion to the pieces on each side
        cut = part.start + (part.end - part.start) * (left + 1) // (part.budget + 1)
        for a, b, budget in ((part.start, cut, left), (cut, part.end, right)):
            stack.append(Part(item, a, b, budget, text[a:b], part))
    return out


class Finder:
    """All pieces of a block of items in one automaton."""

    def __init__(self, items: list[str], rate: float):
        self.items = items
        self.automaton = ahocorasick.Automaton()
        pieces: dict[str, list[Part]] = {}
        for i, text in enumerate(items):
            if text:
                for leaf in leaves(i, text, math.floor(rate * len(text) + 1e-9)):
                    if leaf.text:
                        pieces.setdefault(leaf.text, []).append(leaf)
        for piece, parts in pieces.items():
            self.automaton.add_word(piece, (len(piece), parts))
        if pieces:
            self.automaton.make_automaton()
        self.empty = not pieces

    def search(self, text: str) -> dict[int, tuple[int, int, int]]:
        """Best (distance, start, end) of each item found in a normalised text."""
        best: dict[int, tuple[int, int, int]] = {}
        tried: set[tuple[int, int]] = set()  # windows verified: part and place
        if self.empty or not text:
            return best
        for last, (size, parts) in self.automaton.iter(text):
            at = last - size + 1
            for leaf in parts:
                self._climb(leaf, at, text, best, tried)
        return best

    def _climb(self, leaf: Part, at: int, text: str, best: dict, tried: set) -> None:
        part, found = leaf, (0, at, at + leaf.end - leaf.start)
        while part.above is not None:
            part = part.above
            reach = part.budget
            first = at - (leaf.start - part.start) - reach  # may lie before the text: still its own window
            low = max(0, first)
            high = min(len(text), at + (part.end - leaf.start) + reach)
            key = (id(part), first)
            if key in tried:
                return  # the same window has been verified from another piece
            tried.add(key)
            if not part.masks:
                part.masks.update(bit_masks(part.text))
            distance, end = myers(part.text, text[low:high], reach, masks=part.masks)
            if distance > reach:
                return
            found = (distance, low, low + end)
        distance, low, end = found
        if part is not leaf:
            length = myers(part.text[::-1], text[low:end][::-1], distance, anchored=True)[1]
            found = (distance, end - max(0, length), end)
        if part.item not in best or found < best[part.item]:
            best[part.item] = found


def original_span(text: str, start: int, end: int) -> tuple[int, int]:
    """Code-point span in ``text`` of a span of its normal form."""
    at, first, last = 0, 0, 0
    for word in _WORD.finditer(text):
        size = len(word.group().lower())
        if at <= start <= at + size:
            first = word.start() + min(start - at, len(word.group()))
        if at < end:
            last = word.start() + min(end - at, len(word.group()))
        at += size + 1
    return first, last


def item_blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple]]:
    """Items in blocks of about ``block_chars`` characters, one at a time."""
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_chars))
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for b in range(blocks):
        yield [(r.item_id, r.text) for r in items.where(place == b).collect()]


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text", rate: float = 0.1,
               block_chars: int = 4_000_000) -> DataFrame:
    """``doc_id, item_id, distance, start, end``: the best match of each leaked item.

    ``start`` and ``end`` (exclusive) are code points of the document's own text.
    Among matches of an item in a text the least distance wins, then the first.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    tests = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").alias("text"))
    tests = tests.where(F.col("text").isNotNull())
    schema = (f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, "
              f"item_id {tests.schema['item_id'].dataType.simpleString()}, distance int, start int, end int")
    spark = docs.sparkSession

    def search(block: list[tuple]) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)  # at most about block_chars characters

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids = [i for i, _ in shared.value]
            finder = Finder([normal(t) for _, t in shared.value], rate)
            for frame in frames:
                out = []
                for doc, body in zip(frame["doc_id"], frame["text"]):
                    for item, (distance, start, end) in finder.search(normal(body)).items():
                        out.append((doc, ids[item], distance, *original_span(body, start, end)))
                yield pd.DataFrame(out, columns=["doc_id", "item_id", "distance", "start", "end"], dtype=object)

        return rows.mapInPandas(run, schema)

    return reduce(DataFrame.unionByName, map(search, item_blocks(tests, block_chars)))


def drop_leaking(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 **options) -> DataFrame:
    """``docs`` without the rows that leak an item (rows of equal id and text go together)."""
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"),
                        row_key(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("_key"))
    leaks = find_leaks(keyed, items, "_key", "_text", **options).select(F.col("doc_id").alias("_key")).distinct()
    kept = keyed.join(stored(leaks, "leaks"), "_key", "left_anti")
    return kept.select("_row.*")  # the struct keeps columns of clashing names apart
