"""Quality classifier: weak labels by expectation-maximisation, a hashed linear scorer.

Overlapping heuristic labellers vote good (1), bad (0) or abstain (2) on each text.
Votes of all documents are summed by vote pattern (at most 3 ** labellers patterns,
whatever the corpus size), and expectation-maximisation over the pattern counts
estimates each labeller's vote probabilities under either class and the share of
good documents. The posterior of a document's pattern is its weak label.

A linear scorer is then trained in numpy on the weak labels of a bounded sample
(``train_rows`` distinct non-blank texts of small hash): hashed words and word shapes,
averaged over the text, and a few named measures. It scores every whole text.

Defined cases: null, empty and blank texts have no words, all labellers abstain and
the score comes from the named measures alone; repeated rows each get their score;
an empty table gives no rows; other columns are passed by.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwise.llm.common import WORD_CLASS, WordMemo, slices, utf8
from chunkwise.llm.quality_rules import Measures

GOOD, BAD, ABSTAIN = 1, 0, 2


def _vote(bad: bool, good: bool) -> int:
    return BAD if bad else GOOD if good else ABSTAIN


_PLAIN = re.compile(rb"[A-Za-z0-9\x80-\xff'-]+[.,;:!?]?")
_RUN = re.compile(rb"([!-/:-@\[-`{-~])\1")


class WordMeasures(Measures):
    """Further lazy measures, over the words of a text."""

    @cached_property
    def n_plain(self) -> int:
        return sum(map(bool, map(_PLAIN.fullmatch, self.words)))

    @cached_property
    def n_runs(self) -> int:
        return sum(map(bool, map(_RUN.search, self.words)))

    @cached_property
    def n_stops(self) -> int:
        return sum(w.endswith((b".", b"!", b"?")) and not w.endswith((b"!!", b"??", b"...")) for w in self.words)

    @cached_property
    def n_distinct(self) -> int:
        return len(set(self.words))


#: Labellers in order of their place in a vote pattern.
LABELLERS = (
    ("symbols", lambda m: _vote(5 * m.n_symbols > m.n_words, m.n_words > 0 and m.n_symbols == 0)),
    ("capitals", lambda m: _vote(2 * m.upper_letters > m.ascii_letters > 3, 5 * m.upper_letters < m.ascii_letters)),
    ("repeated_words", lambda m: _vote(100 * m.n_repeat_words > 30 * m.n_words, m.n_words >= 20 and 100 * m.n_repeat_words < 10 * m.n_words)),
    ("top_word", lambda m: _vote(m.n_words >= 20 and 4 * m.top_word > m.n_words, m.n_words >= 20 and 6 * m.top_word < m.n_words)),
    ("letters", lambda m: _vote(10 * m.letter_words < 7 * m.n_words, 20 * m.letter_words > 19 * m.n_words)),
    ("repeated_lines", lambda m: _vote(2 * m.n_dup_lines > m.n_lines, m.n_lines > 2 and m.n_dup_lines == 0)),
    ("sentences", lambda m: _vote(m.n_words >= 50 and m.n_stops == 0, m.n_words > 0 and m.n_stops > 0)),
    ("plain_words", lambda m: _vote(2 * m.n_plain < m.n_words, m.n_words > 0 and 10 * m.n_plain > 9 * m.n_words)),
    ("doubled_marks", lambda m: _vote(10 * m.n_runs > m.n_words, m.n_words > 0 and 50 * m.n_runs < m.n_words)),
    ("variety", lambda m: _vote(m.n_words >= 50 and 5 * m.n_distinct < m.n_words, 5 * m.n_distinct > 2 * m.n_words)),
)


def votes(m: WordMeasures) -> int:
    """Vote pattern of a text as a number in base 3."""
    pattern = 0
    for _, labeller in LABELLERS:
        pattern = 3 * pattern + labeller(m)
    return pattern


def unpacked(patterns: np.ndarray) -> np.ndarray:
    places = 3 ** np.arange(len(LABELLERS) - 1, -1, -1)
    return (np.asarray(patterns, np.int64)[:, None] // places) % 3


@dataclass
class LabelModel:
    """P(vote | class, no abstention) per labeller, and the share of good documents."""

    table: np.ndarray  # labeller x class x vote; abstentions weigh nothing
    good: float

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability that documents with these vote patterns are good."""
        v = unpacked(patterns)
        logs = np.log([1 - self.good, self.good])[None] + sum(
            np.log(self.table[k][:, v[:, k]]).T for k in range(v.shape[1]))
        logs -= logs.max(1, keepdims=True)
        p = np.exp(logs)
        return p[:, 1] / p.sum(1)


def fit_labels(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """Expectation-maximisation over pattern counts.

    It begins with a bad vote trusted more than a good one (labellers look for
    faults; a text without one fault may have another).
    """
    v, n = unpacked(patterns), np.asarray(counts, float)
    for_, against = (v == GOOD).sum(1), (v == BAD).sum(1)
    p = 1 / (1 + np.exp(1.5 * against - 0.5 * for_ - 1.0))
    model = LabelModel(np.ones((len(LABELLERS), 2, 3)), 0.5)
    for _ in range(rounds):
        weight = np.stack([(1 - p) * n, p * n])
        table = np.stack([np.stack([[weight[c][v[:, k] == x].sum() for x in (BAD, GOOD)] for c in range(2)])
                          for k in range(len(LABELLERS))]) + 1.0
        table /= table.sum(2, keepdims=True)
        share = float((weight[1].sum() + 1) / (n.sum() + 2))
        model = LabelModel(np.concatenate([table, np.ones((len(LABELLERS), 2, 1))], axis=2), share)
        fresh = model.posterior(patterns) if len(n) else p
        if len(n) == 0 or np.abs(fresh - p).max() < 1e-9:
            break
        p = fresh
    return model


_KIND = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c for c in range(256))
_LETTERS = re.compile(rb"([Aa0])\1+")
_MARKS = re.compile(rb"(.)\1+", re.S)
#: Distinct words that a task remembers.
WORDS = 400_000


def shape(word: bytes) -> bytes:
    """Kinds of characters in a word, runs of a kind once: ``Aa``, ``A!``, ``a*``, ``0``."""
    return _MARKS.sub(rb"\1\1", _LETTERS.sub(rb"\1", word.translate(_KIND)))


def slot(kind: bytes, name: bytes, slots: int) -> int:
    return xxhash.xxh3_64_intdigest(kind + name) % slots


#: Named measures of a text, each between 0 and about 1.
MEASURES = (b"repeat", b"lines", b"symbols", b"top", b"runs", b"one")


def named(m: WordMeasures) -> list[float]:
    n = max(1, m.n_words)
    return [m.n_repeat_words / n, m.n_dup_lines / max(1, m.n_lines), min(1.0, m.n_symbols / n),
            m.top_word / n if m.n_words >= 20 else 0.0, m.n_runs / n, 1.0]


def word_slots(words: list[bytes], slots: int) -> np.ndarray:
    """Slots of each word itself and of its shape; few kinds of words have many words."""
    kinds = [w.translate(_KIND) for w in words]
    of = {kind: slot(b"s", shape(kind), slots) for kind in set(kinds)}
    own = [slot(b"w", w.lower(), slots) for w in words]
    return np.array([own, [of[kind] for kind in kinds]], np.int64).T.reshape(-1, 2)


def train(texts: list, target: np.ndarray, slots: int = 1 << 16, epochs: int = 8, rate: float = 0.3,
          seed: int = 11) -> np.ndarray:
    """Weights of the slots and, behind them, of the named measures (AdaGrad, soft labels)."""
    weights = np.zeros(slots + len(MEASURES))
    weights[-1] = 2.0  # without other evidence a text passes
    seen = np.full(len(weights), 1e-6)
    memo: dict[bytes, tuple[int, int]] = {}
    bags = []
    for text in texts:
        m = WordMeasures(utf8(text))
        for w in m.words:
            if w not in memo:
                memo[w] = slot(b"w", w.lower(), slots), slot(b"s", shape(w), slots)
        at, n = np.unique(np.array([s for w in m.words for s in memo[w]], np.int64), return_counts=True)
        bags.append((np.concatenate([at, slots + np.arange(len(MEASURES))]),
                     np.concatenate([n / max(1, m.n_words), named(m)])))
    rng = np.random.default_rng(seed)
    for epoch in range(epochs):
        for i in rng.permutation(len(bags)):
            at, x = bags[i]
            p = 1 / (1 + math.exp(-min(30.0, max(-30.0, float(weights[at] @ x)))))
            g = (p - target[i]) * x
            seen[at] += g * g
            weights[at] -= rate * (1 - epoch / epochs) * g / np.sqrt(seen[at])
    return weights


def label_model(rows: DataFrame) -> LabelModel:
    """The label model from the votes on all documents."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, texts in slices(frames):
            yield pd.DataFrame({"pattern": [votes(WordMeasures(t)) for t in texts]})

    found = (rows.select("text").mapInPandas(run, "pattern long").groupBy("pattern")
             .agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect())
    return fit_labels(np.array([r.pattern for r in found], np.int64), np.array([r.n for r in found]))


def sample(rows: DataFrame, train_rows: int) -> list:
    """Distinct texts of small hash with a word in them, about and at most ``train_rows``
    of them, in order of hash; neither blank texts nor copies can fill the sample."""
    texts = rows.where(F.col("text").rlike(WORD_CLASS)).select("text", F.xxhash64("text").alias("key"))
    n = texts.agg(F.approx_count_distinct("key", 0.02)).first()[0]
    share = min(1.0, 1.1 * train_rows / max(1, n))  # the count is a few per cent off at most
    place = F.pmod("key", F.lit(1 << 30))
    picked = texts.select("text", place.alias("h")).where(F.col("h") <= int(share * (1 << 30))).distinct()
    return [r.text for r in picked.orderBy("h", "text").limit(train_rows).collect()]


def classify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.4,
             train_rows: int = 3000, slots: int = 1 << 16) -> DataFrame:
    """``doc_id, weak_label, score, kept`` of every row: the posterior of its votes, the
    scorer's probability that it is good, and whether that reaches ``threshold``."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    model = label_model(rows)
    texts = sample(rows, train_rows)
    patterns = np.array([votes(WordMeasures(utf8(t))) for t in texts], np.int64)
    weights = train(texts, model.posterior(patterns) if texts else np.zeros(0), slots)
    shared = docs.sparkSession.sparkContext.broadcast((model, weights))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labels, w = shared.value
        memo = WordMemo(lambda words: w[word_slots(words, slots)].sum(1, keepdims=True), 1, WORDS)
        for own, raws in slices(frames):
            measures = [WordMeasures(t) for t in raws]
            ids = memo.rows([m.words for m in measures])
            odds = [float(memo.values[x, 0].sum(dtype=np.float64)) / max(1, len(x)) + float(w[slots:] @ named(m))
                    for x, m in zip(ids, measures)]
            yield pd.DataFrame({
                "doc_id": own["doc_id"].to_numpy(),
                "weak_label": labels.posterior(np.array([votes(m) for m in measures], np.int64)),
                "score": 1 / (1 + np.exp(-np.clip(odds, -30, 30)))})

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInPandas(run, f"doc_id {kind}, weak_label double, score double")
    return scored.withColumn("kept", F.col("score") >= threshold)
