"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a span (a word of the text, longer words in
pieces of at most ``SPAN`` bytes). Two gated recurrent layers run over it, one in
each direction; a softmax over both states labels every byte position. A
document's probabilities are the softmax of its positions' pooled log
probabilities: their sum over all positions of the whole text, divided by the
square root of their number, so long texts are not absurdly certain.

Training is in numpy by backpropagation through time (Adam), on a bounded sample:
``per_lang`` documents of each language, the ones of smallest text hash, from which
``spans`` spans are drawn per language. The network reads one span at a time, so
equal spans have equal labels and each task runs the network once per distinct
span.

Defined cases: a text that is null or has no letter gets ``und`` and score 0, as do
all texts if nothing was learned; rows with a null language are not learned from;
repeated rows each get their result; an empty table gives no rows; other columns
are passed by.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkwise.llm.common import WordMemo, fold, slices

SPAN = 32
UNKNOWN = "und"
_LATIN = re.compile(rb"[A-Za-z]")
#: ASCII bytes other than letters part words; bytes above ASCII are kept.
_BREAKS = bytes.maketrans(bytes(range(65)) + bytes(range(91, 97)) + bytes(range(123, 128)),
                          b" " * (65 + 6 + 5))


def spans_of(raw: bytes) -> list[bytes]:
    """Words of a text in pieces of at most ``SPAN`` bytes."""
    words = raw.translate(_BREAKS).split()
    if max(map(len, words), default=0) <= SPAN:
        return words
    return [w[i:i + SPAN] for w in words for i in range(0, len(w), SPAN)]


def has_letter(raw: bytes) -> bool:
    return bool(_LATIN.search(raw)) or any(map(str.isalpha, raw.decode("utf-8", "replace")))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def pack(spans: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes as a (longest, n) array and the lengths."""
    sizes = np.fromiter(map(len, spans), np.int64, len(spans))
    codes = np.zeros((len(spans), max(1, int(sizes.max(initial=0)))), np.uint8)
    codes[np.arange(codes.shape[1]) < sizes[:, None]] = np.frombuffer(b"".join(spans), np.uint8)
    return codes.T, sizes


class Layer:
    """One direction: z and r gates and a candidate state; arrays are (width, n).

    The padding of shorter spans is at the end of the run: the forward direction
    meets it last, and the backward one is given each span reversed.
    """

    NAMES = ("E", "U", "V")

    def __init__(self, width: int, rng: np.random.Generator):
        self.width = width
        self.E = rng.normal(0, 0.3, (256, 3 * width)).astype(np.float32)  # input to z, r, candidate
        self.U = rng.normal(0, 0.3, (2 * width, width)).astype(np.float32)
        self.V = rng.normal(0, 0.3, (width, width)).astype(np.float32)

    def forward(self, codes: np.ndarray, trace: list | None = None) -> np.ndarray:
        h = np.zeros((self.width, codes.shape[1]), np.float32)
        out = np.empty((len(codes), *h.shape), np.float32)
        for t, row in enumerate(codes):
            x = self.E[row].T
            gates = _sigmoid(x[:2 * self.width] + self.U @ h)
            z, r = gates[:self.width], gates[self.width:]
            c = np.tanh(x[2 * self.width:] + self.V @ (r * h))
            new = z * h + (1 - z) * c
            if trace is not None:
                trace.append((row, h, z, r, c))
            h = out[t] = new
        return out

    def backward(self, trace: list, d_out: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients by backpropagation through time."""
        g = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        d_next = np.zeros_like(d_out[0])
        for t in range(len(trace) - 1, -1, -1):
            row, h, z, r, c = trace[t]
            d = d_out[t] + d_next
            d_c = d * (1 - z) * (1 - c * c)
            d_rh = self.V.T @ d_c
            d_z = d * (h - c) * z * (1 - z)
            d_r = d_rh * h * r * (1 - r)
            d_gates = np.concatenate([d_z, d_r])
            d_next = d * z + d_rh * r + self.U.T @ d_gates
            g["U"] += d_gates @ h.T
            g["V"] += d_c @ (r * h).T
            np.add.at(g["E"], row, np.concatenate([d_gates, d_c]).T)
        return g


@dataclass
class Model:
    langs: list[str]
    ahead: Layer
    back: Layer
    out: np.ndarray  # langs x (2 * width)
    bias: np.ndarray

    def positions(self, codes: np.ndarray, sizes: np.ndarray, trace: tuple | None = None):
        """Log probabilities (position, lang, span), the joined states and the reversal."""
        order = np.arange(len(codes))[:, None]
        mirror = np.where(order < sizes, sizes - 1 - order, order)  # reverses each span in place
        columns = np.arange(codes.shape[1])
        fwd = self.ahead.forward(codes, trace and trace[0])
        bwd = self.back.forward(codes[mirror, columns], trace and trace[1])
        states = np.concatenate([fwd, bwd.transpose(0, 2, 1)[mirror, columns].transpose(0, 2, 1)], axis=1)
        logits = np.matmul(self.out, states) + self.bias[:, None]
        logits -= logits.max(1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(1, keepdims=True)), states, mirror

    def pooled(self, spans: list[bytes], block: int = 4096) -> np.ndarray:
        """Per span: summed log probabilities of its positions, one column a language."""
        result = np.zeros((len(spans), len(self.langs)), np.float32)
        by_size = np.argsort([len(s) for s in spans], kind="stable")
        for at in range(0, len(spans), block):
            chosen = by_size[at:at + block]
            codes, sizes = pack([spans[i] for i in chosen])
            logp = self.positions(codes, sizes)[0]
            inside = np.arange(len(codes))[:, None] < sizes
            result[chosen] = np.einsum("tln,tn->nl", logp, inside.astype(np.float32))
        return result


def train(spans: list[bytes], langs: list[str], width: int = 12, epochs: int = 6, block: int = 256,
          rate: float = 0.02, seed: int = 5) -> Model | None:
    """Fit on spans with their languages; None without any span."""
    if not spans:
        return None
    rng = np.random.default_rng(seed)
    names = sorted(set(langs))
    y = np.array([names.index(x) for x in langs])
    model = Model(names, Layer(width, rng), Layer(width, rng),
                  rng.normal(0, 0.3, (len(names), 2 * width)).astype(np.float32),
                  np.zeros(len(names), np.float32))
    params = [(model.ahead, n) for n in Layer.NAMES] + [(model.back, n) for n in Layer.NAMES]
    params += [(model, "out"), (model, "bias")]
    first = [np.zeros_like(getattr(o, n)) for o, n in params]
    second = [np.zeros_like(getattr(o, n)) for o, n in params]
    step, steps = 0, epochs * -(-len(spans) // block)
    for _ in range(epochs):
        order = rng.permutation(len(spans))
        for at in range(0, len(order), block):
            chosen = order[at:at + block]
            codes, sizes = pack([spans[i] for i in chosen])
            trace: tuple[list, list] = ([], [])
            logp, states, mirror = model.positions(codes, sizes, trace)
            inside = (np.arange(len(codes))[:, None] < sizes).astype(np.float32)
            d = np.exp(logp)
            d[:, y[chosen], np.arange(len(chosen))] -= 1
            d *= inside[:, None, :] / inside.sum()
            d_states = np.matmul(model.out.T, d)
            columns = np.arange(codes.shape[1])
            d_back = d_states[:, width:].transpose(0, 2, 1)[mirror, columns].transpose(0, 2, 1)
            grads = [model.ahead.backward(trace[0], d_states[:, :width]),
                     model.back.backward(trace[1], d_back)]
            flat = [g[n] for g in grads for n in Layer.NAMES]
            flat += [np.einsum("tln,tsn->ls", d, states), d.sum((0, 2))]
            step += 1
            pace = rate * (1 - 0.9 * step / steps)
            for k, ((owner, name), g) in enumerate(zip(params, flat)):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                move = first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
                setattr(owner, name, (getattr(owner, name) - pace * move).astype(np.float32))
    return model


def sample(docs: DataFrame, lang: str = "lang", text: str = "text", use: Column | None = None,
           per_lang: int = 500, max_langs: int = 1000, spans: int = 12_000,
           seed: int = 3) -> tuple[list[bytes], list[str]]:
    """Training spans and their languages, from ``per_lang`` distinct texts a language.

    Learned are the ``max_langs`` languages of most distinct texts. The texts of a language
    are those of smallest text hash among all rows that may be learned from: a share
    of its distinct texts is passed map-side, copies are dropped, and the exact bound is
    cut per language, so neither copies nor another language can crowd one out.
    """
    rows = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"),
                       (use if use is not None else F.lit(True)).alias("use"))
    rows = rows.where(F.col("use") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select("lang", "text", F.xxhash64("text").alias("h"))
    found = rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs)
    shares = docs.sparkSession.createDataFrame(  # at most max_langs rows
        [(r.lang, 1.3 * per_lang / max(1, r.n)) for r in found.collect()], "lang string, share double")
    place = F.pmod("h", F.lit(1 << 30)) / float(1 << 30)
    passed = (rows.join(F.broadcast(shares), "lang").where(place < F.col("share"))
              .groupBy("lang", "h").agg(F.min("text").alias("text")))
    rank = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 30)), "h")
    picked = passed.withColumn("_n", F.row_number().over(rank)).where(F.col("_n") <= per_lang)
    texts: dict[str, list[str]] = {}
    for r in picked.orderBy("lang", "h").toLocalIterator():
        texts.setdefault(r.lang, []).append(r.text)
    rng = np.random.default_rng(seed)
    out: list[bytes] = []
    langs: list[str] = []
    for name in sorted(texts):
        words = [w for t in texts[name] for w in spans_of(t.encode("utf-8", "replace"))]
        if words:
            out += [words[i] for i in rng.integers(0, len(words), spans)]
            langs += [name] * spans
    return out, langs


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; only the text column goes to Python."""
    names = model.langs if model else []
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand floats

    def label(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        net = shared.value
        memo = WordMemo(net.pooled, len(names)) if net else None
        for column in columns:
            preds, scores = [], []
            for _, texts in slices(iter([column.to_frame("text")])):
                ids = memo.rows([spans_of(t) for t in texts]) if memo else [()] * len(texts)
                sizes = np.fromiter(map(len, memo.names), np.int64, len(memo.names)) if memo else None
                for raw, own in zip(texts, ids):
                    if len(own) == 0 or not has_letter(raw):
                        preds.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    total = memo.values[own].sum(0, dtype=np.float64) / np.sqrt(sizes[own].sum())
                    p = np.exp(total - total.max())
                    preds.append(names[int(p.argmax())])
                    scores.append(float(p.max() / p.sum()))
            yield pd.DataFrame({"lang_pred": preds, "score": scores})

    # marked as not deterministic, so that a filter on the result does not run it twice
    labels = F.pandas_udf(label, "lang_pred string, score double").asNondeterministic()
    columns = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    labelled = docs.select(*columns, labels(F.col(f"`{text}`")).alias("_label"))
    return labelled.select(*columns, "_label.lang_pred", "_label.score")


def classify(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """Learn from rows outside the held-out fold, label every document."""
    in_fold = F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False))
    model = train(*sample(docs, use=~in_fold))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", in_fold.alias("held_out"), "lang_pred", "score")
