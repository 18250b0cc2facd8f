"""Language-model scoring by context-tree weighting over bytes.

Each byte of a text (its UTF-8 bytes with A-Z lower-cased, then an end mark) is coded
as eight binary decisions, each in its own context tree over the ``DEPTH`` bytes
before it. Every node of a tree keeps a Krichevsky-Trofimov estimate from the counts
of zeros and ones seen there; the weighted probability of a node is half its own
estimate plus half the product of its children's, down to the full depth. After
learning, the predictive probability of a decision is the mixture along the context
path with the weights that the corpus gives, and a text's score is the sum of the
log probabilities of all its decisions.

Counting is distributed: tasks count the (DEPTH + 1)-byte windows of every text, Spark
sums them, and shorter contexts are their marginals. Every context that occurs in a
training text is a node of its own, however rare. The nodes are a Spark table of one row
a context and decision (``predicted``): weights go up the tree by one ``groupBy`` a depth,
mixtures come down it by one join a depth, and what comes out is the log probability of
each window that stands in some text. A context that no training text has stops there
with probability one half, as an empty estimate says. All windows go to the tasks that
score while there are at most 2 ** ``WINDOW_BITS`` of them; beyond that only those that
make up more than one in 2 ** WINDOW_BITS positions do, and the others are joined.

The base score needs the corpus count of each word. Words that make up more than one
in 2 ** ``FREQUENT_BITS`` training tokens are broadcast (at most 2 ** FREQUENT_BITS of
them); all other words of the scored texts go through a join with the count table.

Defined cases: null and empty texts have no words and one end token; a null id
belongs to no held-out fold and is learned from; with no training text every
decision has probability one half; repeated rows each get their score; an empty
table gives no rows; other columns are passed by.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwise.llm.common import fold, slices, stored

DEPTH = 3
FREQUENT_BITS = 18
WINDOW_BITS = 20
#: Never a byte of UTF-8: it ends a text and fills the contexts before its start.
END = 0xFF
#: The word count table's key of the end token; no word contains white space.
END_TOKEN = b" "


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The (DEPTH + 1)-byte window at each position, as uint32, and text lengths.

    The lowest byte is the one coded, the next ones are its context, nearest first.
    """
    pad = bytes([END]) * DEPTH
    joined = np.frombuffer(b"".join(pad + t + bytes([END]) for t in texts), np.uint8).astype(np.uint32)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    key = joined.copy()
    for back in range(1, DEPTH + 1):
        key[back:] |= joined[:-back] << np.uint32(8 * back)
    starts = np.repeat(np.cumsum(sizes + DEPTH) - sizes, sizes)
    offsets = np.arange(len(starts)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return key[starts + offsets], sizes


def count_corpus(docs: DataFrame, training: Column | None = None) -> DataFrame:
    """``kind, key, n``: words (kind 0, the end token included) and windows (kind 1) of the
    rows with ``training`` true (None: all), windows of the others (kind 2)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter = Counter()
        held = {kind: (np.zeros(0, np.uint32), np.zeros(0, np.int64)) for kind in (1, 2)}

        def tell_words() -> pd.DataFrame:
            out = pd.DataFrame({"kind": 0, "key": list(words), "n": list(words.values())})
            words.clear()
            return out

        def tell_windows(kind: int) -> pd.DataFrame:
            keys, counts = held[kind]
            held[kind] = np.zeros(0, np.uint32), np.zeros(0, np.int64)
            return pd.DataFrame({"kind": kind, "key": [int(k).to_bytes(4, "big") for k in keys], "n": counts})

        for own, texts in slices(frames):
            parts: dict[int, list[bytes]] = {1: [], 2: []}
            for t, learned in zip(texts, own["learned"]):
                parts[1 if learned else 2].append(t.lower())  # bytes: A-Z only
            for t in parts[1]:
                words.update(t.split())
            if parts[1]:
                words[END_TOKEN] += len(parts[1])
            for kind, some in parts.items():
                if some:
                    fresh, n = np.unique(windows(some)[0], return_counts=True)
                    keys, at = np.unique(np.concatenate([held[kind][0], fresh]), return_inverse=True)
                    counts = np.bincount(at, np.concatenate([held[kind][1], n]), minlength=len(keys)).astype(np.int64)
                    held[kind] = keys, counts
                    if len(keys) > 500_000:
                        yield tell_windows(kind)
            if len(words) > 200_000:
                yield tell_words()
        if words:
            yield tell_words()
        for kind in held:
            if len(held[kind][0]):
                yield tell_windows(kind)

    learned = F.lit(True) if training is None else F.coalesce(training, F.lit(False))
    counted = docs.select("text", learned.alias("learned")).mapInPandas(run, "kind int, key binary, n long")
    return stored(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x > 0 by Stirling's series, shifted up by eight."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) - shift


def kt_log(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov block probability."""
    return (_log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0)
            - 2 * _log_gamma(np.array([0.5]))[0])


def decisions(byte_counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones of the 255 decisions (heap order from 1) from counts of 256 bytes."""
    zeros = np.zeros((len(byte_counts), 256))
    ones = np.zeros((len(byte_counts), 256))
    for bit in range(8):
        halves = byte_counts.reshape(len(byte_counts), 1 << bit, 2, -1).sum(3)
        zeros[:, 1 << bit:2 << bit], ones[:, 1 << bit:2 << bit] = halves[:, :, 0], halves[:, :, 1]
    return zeros, ones


def byte_logs(p_one: np.ndarray) -> np.ndarray:
    """log10 probabilities of the 256 bytes from those of ones at each decision."""
    p = np.clip(p_one, 1e-12, 1 - 1e-12)
    out = np.zeros((len(p), 1))
    for bit in range(8):
        part = p[:, 1 << bit:2 << bit]
        out = (out[:, :, None] + np.log10(np.stack([1 - part, part], axis=2))).reshape(len(p), -1)
    return out


@dataclass
class Tree:
    """Final nodes' byte tables, and the node of each full context."""

    symbols: np.ndarray  # class of each byte: 0, or one of its own if some node's context has it
    index: np.ndarray  # node number by the classes of the DEPTH bytes before, the farthest first
    tables: np.ndarray  # node x 256, log10


class _Depth:
    """Nodes of one depth: sorted context keys, counts, and the parent of each."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts


def build(levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Tree:
    """Weight the tree. ``levels[d]``: context, byte and count of the nodes at depth d.

    Contexts hold the nearest byte lowest; a context's parent drops its highest
    (farthest) byte. Level 0 is the root, whose context is 0.
    """
    nodes = []
    for d, (context, byte, n) in enumerate(levels):
        keys = np.unique(context) if d else np.zeros(1, np.int64)
        table = np.zeros((len(keys), 256), np.float32 if d == DEPTH else np.float64)
        np.add.at(table, (np.searchsorted(keys, context), byte), n)
        nodes.append(_Depth(keys, table))
    for d in range(1, len(nodes)):  # a node stands only below a node
        above = nodes[d - 1].keys
        nodes[d].parent = np.searchsorted(above, nodes[d].keys & ((1 << (8 * (d - 1))) - 1))
    weighted = None  # log of the weighted probability of each node of the depth below
    for d in range(len(nodes) - 1, -1, -1):
        node = nodes[d]
        own = _by_rows(node.counts, lambda c: kt_log(*decisions(c)))
        if d + 1 < len(nodes) and len(nodes[d + 1].keys):
            below = nodes[d + 1]
            rest = node.counts.astype(np.float64)
            np.subtract.at(rest, below.parent, below.counts)
            node.rest = rest
            product = _by_rows(rest, lambda c: kt_log(*decisions(c))).astype(np.float64)
            np.add.at(product, below.parent, weighted)
            inner = np.zeros(len(node.keys), bool)
            inner[below.parent] = True
            both = np.logaddexp(own, product) - np.log(2.0)
            node.stop = np.where(inner[:, None], np.exp(own - np.log(2.0) - both), 1.0).astype(np.float32)
            node.inner = inner
            weighted = np.where(inner[:, None], both, own).astype(np.float32)
        else:
            node.stop = np.ones((len(node.keys), 256), np.float32)
            node.inner = np.zeros(len(node.keys), bool)
            weighted = own
    estimate = lambda c: (lambda z, o: (o + 0.5) / (z + o + 1.0))(*decisions(c))
    met = {int(k >> (8 * i)) & 255 for d, node in enumerate(nodes) for k in node.keys for i in range(d)}
    symbols = np.zeros(256, np.int32)
    symbols[sorted(met)] = np.arange(1, len(met) + 1)
    index = np.zeros((len(met) + 1,) * DEPTH, np.int32)
    tables, total = [], 0
    passed = np.ones((1, 256), np.float32)  # mass that reaches a node, per decision
    mixed = np.zeros((1, 256), np.float32)  # mixture gathered above it
    for d, node in enumerate(nodes):
        if d:
            passed, mixed = passed[node.parent], mixed[node.parent]
        mixed = mixed + passed * node.stop * _by_rows(node.counts, estimate)
        passed = passed * (1 - node.stop)
        # what ends here: all of a leaf, or the remainder below an inner node
        final = mixed.copy()
        if node.inner.any():
            final[node.inner] += passed[node.inner] * _by_rows(node.rest[node.inner], estimate)
        tables.append(_by_rows(final, byte_logs))
        numbers = total + np.arange(len(node.keys))
        at = [symbols[(node.keys >> (8 * i)) & 255] for i in range(d - 1, -1, -1)]
        if d:  # contexts that no deeper node claims keep this one
            np.moveaxis(index, range(DEPTH - d), range(d, DEPTH))[tuple(at)] = numbers.reshape(-1, *[1] * (DEPTH - d))
        total += len(node.keys)
    return Tree(symbols, index, np.concatenate(tables))


def _by_rows(rows: np.ndarray, f, block: int = 1024) -> np.ndarray:
    """``f`` over blocks of rows, so that its temporaries stay small; float32."""
    out = np.empty((len(rows), 256), np.float32)
    for at in range(0, len(rows), block):
        out[at:at + block] = f(rows[at:at + block].astype(np.float64))
    return out


def learn(counts: DataFrame, rare_bits: int | None = None) -> Tree:
    """The weighted tree from ``count_corpus`` in one process's memory, a row of 256 a context.

    For small corpora; ``predicted`` gives the same probabilities for any. With
    ``rare_bits``, contexts of less than one in 2 ** rare_bits positions share a
    remainder node under their parent.
    """
    key = F.conv(F.hex("key"), 16, 10).cast("long")
    seen = counts.where("kind = 1").select(key.alias("k"), "n")
    total = seen.agg(F.sum("n")).first()[0] or 0
    least = 1 if rare_bits is None else max(1, total / (1 << rare_bits))
    levels = []
    for d in range(DEPTH + 1):
        context = F.shiftright("k", 8).bitwiseAND((1 << (8 * d)) - 1) if d else F.lit(0).cast("long")
        pairs = (seen.select(context.alias("context"), F.col("k").bitwiseAND(255).alias("byte"), "n")
                 .groupBy("context", "byte").agg(F.sum("n").alias("n")))
        kept = pairs.groupBy("context").agg(F.sum("n").alias("all")).where(F.col("all") >= least)
        rows = pairs.join(kept.select("context"), "context", "left_semi").toPandas()
        levels.append(tuple(rows[c].to_numpy(np.int64) for c in ("context", "byte", "n")))
    return build(levels)


def _log_gamma_column(x: Column) -> Column:
    """``_log_gamma`` of a column."""
    y, product = x + 8, x
    for k in range(1, 8):
        product = product * (x + k)
    return ((y - 0.5) * F.log(y) - y + 0.5 * float(np.log(2 * np.pi)) + 1 / (12 * y) - 1 / (360 * y * y * y)
            - F.log(product))


def _kt_column() -> Column:
    """``kt_log`` of the columns ``zeros`` and ``ones``."""
    zeros, ones = F.col("zeros").cast("double"), F.col("ones").cast("double")
    return (_log_gamma_column(zeros + 0.5) + _log_gamma_column(ones + 0.5) - _log_gamma_column(zeros + ones + 1.0)
            - 2 * float(_log_gamma(np.array([0.5]))[0]))


def predicted(counts: DataFrame) -> DataFrame:
    """``key, n, log``: each window of ``count_corpus``, how often it stands in any text, and
    the log10 probability of its byte after its context, learned from those of kind 1.

    A node's ``cell`` is its context, nearest byte lowest, then eight bits for the
    decision (heap order from 1); its parent's cell drops the farthest byte.
    """
    seen = (counts.where("kind > 0").groupBy("key")
            .agg(F.sum("n").alias("n"), F.sum(F.expr("if(kind = 1, n, 0)")).alias("learned"))
            .withColumn("k", F.conv(F.hex("key"), 16, 10).cast("long")))
    asked = seen.select("key", "n", "learned", "k", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("i")).select(
        "key", "n", "learned", F.expr("(k >> (7 - i)) & 1").alias("bit"),
        F.expr("((k >> 8) << 8) + (1L << i) + ((k & 255) >> (8 - i))").alias("cell"))
    log2, estimate = float(np.log(2.0)), (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1.0)
    leaf = asked.groupBy("cell").agg(F.sum(F.expr("if(bit = 0, learned, 0)")).alias("zeros"),
                                     F.sum(F.expr("if(bit = 1, learned, 0)")).alias("ones"))
    levels = [stored(leaf.withColumn("weight", _kt_column()), "nodes")]
    for d in range(DEPTH - 1, -1, -1):
        node = (levels[0].groupBy(F.col("cell").bitwiseAND((1 << 8 * (d + 1)) - 1).alias("cell"))
                .agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weight").alias("below"))
                .withColumn("own", _kt_column()))
        both = F.greatest("own", "below") + F.log1p(F.exp(-F.abs(F.col("own") - F.col("below")))) - log2
        node = node.withColumn("weight", both).withColumn("stop", F.exp(F.col("own") - log2 - F.col("weight")))
        levels.insert(0, stored(node.select("cell", "zeros", "ones", "weight", "stop"), "nodes"))
    # mass that reaches below a node, and the mixture gathered down to it
    above = levels[0].select(F.col("cell").alias("parent"), (F.col("stop") * estimate).alias("mixed"),
                             (1 - F.col("stop")).alias("passed"))
    for d in range(1, DEPTH + 1):
        stop = F.col("stop") if d < DEPTH else F.lit(1.0)
        node = levels[d].withColumn("parent", F.col("cell").bitwiseAND((1 << 8 * d) - 1)).join(above, "parent")
        above = node.select(F.col("cell").alias("parent"),
                            (F.col("mixed") + F.col("passed") * stop * estimate).alias("mixed"),
                            (F.col("passed") * (1 - stop)).alias("passed"))
    p = F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-12), F.col("mixed")))
    logs = (asked.join(above.select(F.col("parent").alias("cell"), p.alias("p")), "cell").groupBy("key")
            .agg(F.first("n").alias("n"), F.sum(F.log10(F.expr("if(bit = 1, p, 1 - p)"))).alias("log")))
    return stored(logs, "windows")


def code_lengths(tree: Tree, texts: list[bytes]) -> np.ndarray:
    """log10 probability of each text (lower-cased bytes), end mark included."""
    pad = bytes([END]) * DEPTH
    joined = np.frombuffer(b"".join(pad + t + bytes([END]) for t in texts), np.uint8)
    sizes = np.fromiter((len(t) + DEPTH + 1 for t in texts), np.int64, len(texts))
    starts = np.cumsum(sizes) - sizes
    classes = tree.symbols[joined]
    place = np.zeros(len(joined) - DEPTH, np.int32)
    for back in range(DEPTH, 0, -1):
        place = place * len(tree.index) + classes[DEPTH - back:len(classes) - back]
    logs = np.zeros(len(joined), np.float32)
    logs[DEPTH:] = tree.tables[tree.index.ravel()[place], joined[DEPTH:]]
    for i in range(DEPTH):  # the fill in front of a text is not coded
        logs[starts + i] = 0
    return np.add.reduceat(logs, starts, dtype=np.float64)


def score_texts(docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Model and base scores of every text; rows with ``training`` true are learned from."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    counts = count_corpus(rows, training)
    logs = predicted(counts)
    words = counts.where("kind = 0").select(F.col("key").alias("word"), F.col("n").alias("c"))
    size = words.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = int(size.n or 0), int(size.v)
    common = words.where(F.col("c") > total / (1 << FREQUENT_BITS)).toPandas()
    places = logs.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    seldom = F.lit(False) if places.v <= 1 << WINDOW_BITS else F.col("n") <= places.n / (1 << WINDOW_BITS)
    usual = logs.where(~seldom).select("key", "log").toPandas()
    keys = np.frombuffer(b"".join(usual["key"].map(bytes)), ">u4").astype(np.uint32)
    order = np.argsort(keys)
    shared = docs.sparkSession.sparkContext.broadcast(
        (keys[order], usual["log"].to_numpy(np.float64)[order], dict(zip(common["word"].map(bytes), common["c"].astype(int)))))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, logs, known = shared.value
        value = {w: float(np.log10(c + 0.5)) for w, c in known.items()}
        end = known.get(END_TOKEN, 0)
        for own, texts in slices(frames):
            texts = [t.lower() for t in texts]
            out = {"doc_id": own["doc_id"].to_numpy(), "n_tokens": [], "n_common": [], "part": [], "rare": []}
            for t in texts:
                tokens = t.split()
                sums = list(map(value.get, tokens))
                rare = Counter(w for w, x in zip(tokens, sums) if x is None)
                part = sum(x for x in sums if x is not None)
                out["n_tokens"].append(len(tokens) + 1)
                out["n_common"].append(len(tokens) - sum(rare.values()) + (end > 0))
                out["part"].append(part + np.log10(end + 0.5))
                out["rare"].append([{"kind": 0, "word": w, "m": m} for w, m in rare.items()])
            met, sizes = windows(texts)
            at = np.searchsorted(keys, met)
            there = at < len(keys)
            there[there] = keys[at[there]] == met[there]
            coded = np.zeros(len(met))
            coded[there] = logs[at[there]]
            out["score"] = np.add.reduceat(coded, np.cumsum(sizes) - sizes)
            if not there.all():
                of = np.repeat(np.arange(len(texts)), sizes)[~there].astype(np.uint64)
                pairs, times = np.unique(of << np.uint64(32) | met[~there], return_counts=True)
                for x, m in zip(pairs.tolist(), times.tolist()):
                    out["rare"][x >> 32].append({"kind": 1, "word": (x & 0xFFFFFFFF).to_bytes(4, "big"), "m": m})
            yield pd.DataFrame(out)

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInPandas(run, f"doc_id {kind}, n_tokens long, n_common long, part double, "
                                   "rare array<struct<kind:int,word:binary,m:long>>, score double")
    scored = stored(scored.select("*", F.monotonically_increasing_id().alias("rid")), "scored")
    rare = scored.select("rid", F.explode("rare").alias("x")).select("rid", "x.kind", "x.word", "x.m")
    values = words.where(F.col("c") <= total / (1 << FREQUENT_BITS)).select(
        F.lit(0).alias("kind"), "word", F.log10(F.col("c") + 0.5).alias("value"))
    values = values.unionByName(logs.where(seldom).select(
        F.lit(1).alias("kind"), F.col("key").alias("word"), F.col("log").alias("value")))
    looked = (rare.join(values, ["kind", "word"], "left").groupBy("rid")
              .agg(F.sum(F.when(F.col("kind") == 0, F.col("m") * F.coalesce("value", F.log10(F.lit(0.5))))).alias("rest"),
                   F.sum(F.when((F.col("kind") == 0) & F.col("value").isNotNull(), F.col("m"))).alias("n_rare"),
                   F.sum(F.when(F.col("kind") == 1, F.col("m") * F.col("value"))).alias("coded")))
    none = np.log10(total + 0.5 * (distinct + 1))
    out = scored.drop("rare").join(looked, "rid", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return out.select(
        "doc_id", "n_tokens", (F.col("n_common") + zero("n_rare")).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("part") + zero("rest") - F.col("n_tokens") * float(none)).alias("base_score"),
        (F.col("score") + zero("coded")).alias("score"))


def classify(docs: DataFrame, folds: int = 5, held: int = 1) -> DataFrame:
    """Learn from documents outside the held-out fold, score every document."""
    in_fold = F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False))
    scored = score_texts(docs, ~in_fold)
    return scored.select("doc_id", in_fold.alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")
