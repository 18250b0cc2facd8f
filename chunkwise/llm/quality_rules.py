"""Quality rules as a short-circuit cascade.

Every rule is a test of a document's measures. On a bounded sample each rule's
cost (seconds per document) and selectivity (share rejected) are estimated, and
rules run in descending order of rejection per cost; a document stops at its first
failed rule. The order changes the work, never the verdict: a document is kept
exactly if no rule rejects it.

Measures are worked out lazily and once per document, so a rule that needs no
window counts does not pay for them; the base counts of the contract are asked
for by the query and come from the same measures.

Defined cases: null and empty texts have no words and fail ``too_few_words``;
repeated rows each get their own verdict; an empty table (or sample) runs the
rules in their stated order; other columns are passed by.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwise.llm.common import slices, utf8

SYMBOLS = b"#*$%&|<>"
_LETTER_WORD = re.compile(rb"[A-Za-z\x80-\xff]")


class Measures:
    """Lazy measures of one text, given as UTF-8 bytes."""

    def __init__(self, raw: bytes):
        self.raw = raw

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()  # bytes split at exactly [\x20\x09-\x0D]

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_bytes(self) -> bytes:
        return b"".join(self.words)

    @cached_property
    def word_chars(self) -> int:
        codes = np.frombuffer(self.word_bytes, np.uint8)
        return int(np.count_nonzero((codes & 0xC0) != 0x80))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.raw.count, [bytes([c]) for c in SYMBOLS]))

    @cached_property
    def n_dup_lines(self) -> int:
        lines = [line for line in self.raw.split(b"\n") if line.strip(b" \t\n\r\x0b\x0c")]
        return len(lines) - len(set(lines))

    @cached_property
    def n_lines(self) -> int:
        return sum(1 for line in self.raw.split(b"\n") if line.strip(b" \t\n\r\x0b\x0c"))

    @cached_property
    def n_repeat_words(self) -> int:
        w = self.words
        windows = list(zip(w, w[1:], w[2:]))
        seen = Counter(windows)
        if len(seen) == len(windows):
            return 0
        again = np.fromiter((seen[x] > 1 for x in windows), bool, len(windows))
        covered = np.zeros(len(w), bool)
        for shift in range(3):
            covered[shift:shift + len(again)] |= again
        return int(covered.sum())

    @cached_property
    def top_word(self) -> int:
        return max(Counter(self.words).values(), default=0)

    @cached_property
    def letter_words(self) -> int:
        return sum(1 for w in self.words if _LETTER_WORD.search(w))

    @cached_property
    def ascii_letters(self) -> int:
        codes = np.frombuffer(self.word_bytes, np.uint8) | 0x20
        return int(np.count_nonzero((codes >= 0x61) & (codes <= 0x7A)))

    @cached_property
    def upper_letters(self) -> int:
        codes = np.frombuffer(self.word_bytes, np.uint8)
        return int(np.count_nonzero((codes >= 0x41) & (codes <= 0x5A)))


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Callable[[Measures], bool]


#: In stated order. All comparisons are between integers, so no rounding decides.
RULES = (
    Rule("too_few_words", lambda m: m.n_words < 50),
    Rule("mean_word_length", lambda m: m.word_chars < 2 * m.n_words or m.word_chars > 15 * m.n_words),
    Rule("symbols", lambda m: 5 * m.n_symbols > m.n_words),
    Rule("upper_case", lambda m: 2 * m.upper_letters > m.ascii_letters > 0),
    Rule("words_without_letters", lambda m: 10 * m.letter_words < 6 * m.n_words),
    Rule("top_word", lambda m: 4 * m.top_word > m.n_words),
    Rule("repeated_lines", lambda m: 2 * m.n_dup_lines > m.n_lines),
    Rule("repeated_words", lambda m: 100 * m.n_repeat_words > 50 * m.n_words),
)


def rank_rules(texts: list, rules: tuple[Rule, ...] = RULES) -> list[dict]:
    """Cost, selectivity and rank of each rule on a sample, best first.

    Each rule is timed on fresh measures (it pays for what it needs itself) and
    its rejections are counted over the whole sample. Rejection per cost decides,
    stated order breaks ties; with no sample the stated order stays.
    """
    found = []
    for at, rule in enumerate(rules):
        docs = [Measures(utf8(t)) for t in texts]
        began = time.perf_counter()
        rejected = sum(map(bool, map(rule.fails, docs)))
        cost = (time.perf_counter() - began) / max(1, len(docs)) + 1e-9
        share = rejected / max(1, len(docs))
        found.append({"name": rule.name, "cost": cost, "selectivity": share,
                      "score": share / cost, "at": at})
    return sorted(found, key=lambda x: (-x["score"], x["at"]))


def sample_texts(docs: DataFrame, text: str = "text", rows: int = 512) -> list:
    """A bounded sample for the estimate: at most ``rows`` texts of small hash.

    The share that passes map-side follows from the number of rows, so what reaches
    the driver does not grow with the table.
    """
    body = F.col(f"`{text}`")
    share = min(1.0, rows / max(1, docs.count()))
    place = F.pmod(F.xxhash64("t"), F.lit(1 << 30))
    picked = docs.select(body.alias("t")).where(place <= int(share * (1 << 30))).limit(rows)
    return [r.t for r in picked.collect()]


def cascade(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
            rules: tuple[Rule, ...] = RULES, order: list[str] | None = None,
            sample_rows: int = 512, counts: bool = True) -> DataFrame:
    """One row per input row: ``doc_id``, ``kept``, and the base counts if ``counts``.

    ``order`` (rule names) overrides the sampled order. The sample serves the
    order only; every rule's verdict covers every whole text.
    """
    by_name = {r.name: r for r in rules}
    ranked = order or [r["name"] for r in rank_rules(sample_texts(docs, text, sample_rows), rules)]
    if set(ranked) != set(by_name):
        raise ValueError(f"order must name each rule once: {sorted(by_name)}")
    fails = [by_name[n].fails for n in ranked]
    fields = {"n_words": "n_words", "word_chars": "word_chars", "n_symbols": "n_symbols",
              "n_dup_lines": "n_dup_lines", "n_repeat_words": "n_repeat_words"} if counts else {}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, texts in slices(frames):
            out = {"doc_id": rows["doc_id"].to_numpy(), "kept": []} | {f: [] for f in fields}
            for raw in texts:
                m = Measures(raw)
                out["kept"].append(not any(f(m) for f in fails))  # stops at the first failure
                for f in fields:
                    out[f].append(getattr(m, f))
            yield pd.DataFrame(out)

    picked = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, kept boolean" + "".join(f", {f} bigint" for f in fields)
    return picked.mapInPandas(run, schema)


def digest(verdicts: DataFrame) -> DataFrame:
    """The contract's columns from ``cascade``."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return verdicts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                           "n_repeat_words", failed.alias("base_failed"),
                           (~failed & F.col("kept")).alias("kept"))
