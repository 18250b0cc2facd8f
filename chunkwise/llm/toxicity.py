"""Toxicity: averaged subword embeddings under a linear softmax, trained jointly.

A word is the bag of its hashed byte n-grams (with word marks) and itself. A text is
the average of the embeddings of all n-grams of all its words, with ``PAD`` zero
vectors added so that a handful of words proves little, and a linear softmax over
that average gives the class. Embeddings and softmax are trained together in
numpy by AdaGrad on a bounded sample of labelled rows (``toxic_rows`` and
``clean_rows``, the rows of smallest id hash). Misspellings never seen in training
share n-gram vectors with the words that were.

Because the average is linear, a text's log odds are the sum over its words of a
per-word number, over the number of n-grams. Tasks work that number out once per
distinct word and read every whole text.

Defined cases: null and empty texts have an empty bag and get the class prior alone;
labels that are null or of null ids are not learned from; with no labelled rows of
one class every score is 0.5; repeated rows each get their score; an empty table
gives no rows; other columns are passed by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwise.llm.common import WordMemo, fold, slices

#: Zero vectors in every average.
PAD = 40
#: N-grams in fewer sampled texts than this are not learned.
LEAST_TEXTS = 4
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BREAKS = bytes.maketrans(bytes(range(48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 128)),
                          b" " * (48 + 7 + 6 + 5))


def words_of(raw: bytes) -> list[bytes]:
    """Lower-cased runs of letters and digits (any byte above ASCII counts as a letter)."""
    return raw.decode("utf-8", "replace").lower().encode("utf-8", "replace").translate(_BREAKS).split()


def subwords(words: list[bytes], buckets: int, low: int = 3, high: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Bucket ids of all words' n-grams, flat, and the number of each word."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    marked = b"".join(b"<" + w + b">" for w in words)
    codes = np.frombuffer(marked, np.uint8).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))  # bytes up to the word's end
    ids, owners = [], []
    rolling = np.zeros(len(codes), np.uint64)
    for n in range(1, high + 1):
        at = np.flatnonzero(left >= n)
        rolling[at] = rolling[at] * np.uint64(1_000_003) + codes[at + n - 1] + np.uint64(1)
        if n >= low:
            ids.append(rolling[at])
            owners.append(owner[at])
    whole = np.fromiter((hash_bytes(w) for w in words), np.uint64, len(words))
    ids.append(whole)
    owners.append(np.arange(len(words)))
    flat, owners = np.concatenate(ids), np.concatenate(owners)
    slots = ((flat * _MIX) >> np.uint64(40)) % np.uint64(buckets)
    order = np.argsort(owners, kind="stable")
    return slots[order].astype(np.int64), np.bincount(owners, minlength=len(words))


def hash_bytes(word: bytes) -> int:
    """A 64-bit hash of a whole word."""
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


@dataclass
class Model:
    embeddings: np.ndarray  # buckets x width
    weights: np.ndarray  # width x 2
    bias: np.ndarray  # 2

    def odds(self) -> tuple[np.ndarray, float]:
        """Log odds of class 1 that each bucket adds, and those of an empty text."""
        w = self.weights[:, 1] - self.weights[:, 0]
        return (self.embeddings @ w).astype(np.float32), float(self.bias[1] - self.bias[0])


def train(texts: list[bytes], labels: list[int], buckets: int = 1 << 18, width: int = 8,
          epochs: int = 8, rate: float = 0.1, seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    docs = [words_of(t) for t in texts]
    bags, texts_with = [], np.zeros(buckets, np.int32)
    for words in docs:
        slots, counts = np.unique(subwords(words, buckets)[0], return_counts=True)
        texts_with[slots] += 1
        bags.append((slots.astype(np.int32), (counts / (counts.sum() + PAD)).astype(np.float32)))
    for i, (slots, part) in enumerate(bags):
        common = texts_with[slots] >= LEAST_TEXTS
        bags[i] = slots[common], part[common]
    y = np.asarray(labels, np.int64)
    share = np.maximum(1, np.bincount(y, minlength=2)) / max(1, len(y))
    cost = 0.5 / share  # both classes weigh the same
    table = rng.normal(0, 0.1, (buckets, width)).astype(np.float32)
    table[texts_with < LEAST_TEXTS] = 0
    weights, bias = np.zeros((width, 2), np.float32), np.zeros(2, np.float32)
    weights[:, 0], weights[:, 1] = -0.5, 0.5
    g_table = np.full(buckets, 1e-8, np.float32)
    g_weights, g_bias = np.full((width, 2), 1e-8, np.float32), np.full(2, 1e-8, np.float32)
    if len(np.unique(y)) < 2:
        return Model(np.zeros_like(table), weights, bias)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(len(y)):
            slots, part = bags[i]
            hidden = part @ table[slots]
            logits = hidden @ weights + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= cost[y[i]]
            back = weights @ p
            grad = np.outer(hidden, p)
            g_weights += grad * grad
            g_bias += p * p
            weights -= step * grad / np.sqrt(g_weights)
            bias -= step * 0.1 * p / np.sqrt(g_bias)
            if len(slots):
                g_table[slots] += part * part * float(back @ back) / width
                table[slots] -= (step * part / np.sqrt(g_table[slots]))[:, None] * back
    return Model(table, weights, bias)


def sample(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id",
           text: str = "text", use: Column | None = None, toxic_rows: int = 1500,
           clean_rows: int = 5000) -> tuple[list[bytes], list[int]]:
    """A bounded labelled sample: per class the rows of smallest id hash."""
    known = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("y"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1))
    if use is not None:
        known = known.where(use)
    mark = F.xxhash64(F.col("doc_id").cast("string"))
    picked = [known.where(F.col("y") == y).orderBy(mark, "doc_id").limit(rows)
              for y, rows in ((1, toxic_rows), (0, clean_rows))]
    few = F.broadcast(picked[0].union(picked[1]))  # at most toxic_rows + clean_rows rows
    rows = (docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
            .join(few, "doc_id").orderBy(mark, "doc_id", "text").collect())
    return [(r.text or "").encode("utf-8", "replace") for r in rows], [r.y for r in rows]


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score``: the model's probability of class 1 for every whole text."""
    values, prior = model.odds()
    shared = docs.sparkSession.sparkContext.broadcast(values)  # one float per bucket

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = shared.value

        def per_word(words: list[bytes]) -> np.ndarray:
            slots, counts = subwords(words, len(table))
            ends = np.cumsum(counts)
            total = np.concatenate([[0.0], np.cumsum(table[slots], dtype=np.float64)])
            return np.stack([total[ends] - total[ends - counts], counts], axis=1)

        memo = WordMemo(per_word, 2)
        for rows, texts in slices(frames):
            ids = memo.rows([words_of(t) for t in texts])
            sums = np.array([memo.values[x].sum(0, dtype=np.float64) for x in ids]).reshape(-1, 2)
            odds = sums[:, 0] / (sums[:, 1] + PAD) + prior
            yield pd.DataFrame({"doc_id": rows["doc_id"].to_numpy(), "score": 1 / (1 + np.exp(-odds))})

    picked = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return picked.mapInPandas(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1,
             threshold: float = 0.7) -> DataFrame:
    """Train on labels outside the held-out fold, score every document."""
    in_fold = fold(F.col("doc_id"), folds) == held
    model = train(*sample(docs, labels, use=~in_fold))
    return score(docs, model).select(
        "doc_id", F.coalesce(in_fold, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
