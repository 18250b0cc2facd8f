"""N-gram Jaccard join: grouped prefix join over word shingles.

A document's set is its distinct ``width``-word shingles (64-bit hashes). Two
documents link when 100 * intersection >= ``percent`` * union. The steps:

1. Frequent shingles. Each task counts shingles over runs of documents and passes
   on those that a noticeable share of the run has; sums of these counts over the
   whole corpus order the shingles, rare ones first. At most 2 * (mean set size) *
   ``FREQUENT`` shingles reach the threshold whatever the corpus size, so the table
   is broadcast. The order only steers the work: any total order gives the same
   links.
2. Prefixes. In that order, linked sets share a shingle among their first
   n - ceil(percent * n / 100) + 1. Documents with equal sets fall into one class;
   classes with identical prefixes and size are collapsed into one group.
3. Group pairs. Groups that share a prefix shingle meet in that shingle's bucket
   and are filtered by size, by the positions of the shingle and by the Hamming
   distance of parity sketches, which never exceeds the symmetric difference (a
   group's radius covers its other members): 512 bits for all, and for sets of more
   than 1,024 shingles, where these tell little, as many bits as the set has shingles or
   more. Shingles whose groups are in one component by then are left out of later
   turns; long sketches travel from the second turn on. Buckets with many groups
   are cut into blocks, and pairs of blocks go to separate places, so no task holds
   more than two blocks of a bucket. For ``ROUNDS`` turns every group gives its closest
   candidate of another component in each bucket alone; all remaining candidates of
   different components follow, so a group of near copies does not give all its pairs.
4. Group pairs are expanded to pairs of classes, filtered by their own sketches, and
   verified on the whole sets; pairs that other links have joined already are not.
5. Components come from star rounds over the verified links.

Defined cases: null, empty and blank texts have an empty set, link with nothing and
are their own component; texts of fewer than ``width`` words have one shingle, the
whole sequence; rows are the nodes, so repeated ids do not merge different texts;
a null id takes part like any other and is never a component's name unless nothing
else is; an empty table gives no rows; other columns are passed by.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwise.llm.common import arrow_rows, row_key, slices, stored
from chunkwise.llm.components import components
from chunkwise.llm.words import hashed_words, mix

#: A shingle in more than one of so many documents counts as frequent.
FREQUENT = 8000
#: Groups of a bucket that one block holds.
BLOCK = 20_000
#: Turns that take each group's closest candidate only.
ROUNDS = 2
SKETCH = 512
#: Bits of the map that marks rows to verify.
SLOTS = 1 << 23
_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)


def _rolled(h: np.ndarray, size: int) -> np.ndarray:
    out = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        out = (out + h[k:len(h) - size + k + 1]) * _A
        out ^= out >> np.uint64(29)
    return mix(out)


def shingle_sets(raws: list[bytes], width: int = 4) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text (ASCII letters lower-cased)."""
    h, counts = hashed_words(raws)
    ends = np.cumsum(counts)
    whole = np.ones(max(0, len(h) - width + 1), bool)  # windows inside one text
    for k in range(1, width):
        cut = ends[counts >= k] - k
        whole[cut[cut < len(whole)]] = False
    made = _rolled(h, width)[whole] if len(whole) else np.zeros(0, np.uint64)
    edges = np.append(0, np.cumsum(np.maximum(counts - width + 1, 0)))
    for a, b in zip(edges, edges[1:]):
        made[a:b].sort()
    fresh = np.ones(len(made), bool)
    fresh[1:] = made[1:] != made[:-1]
    fresh[edges[:-1][edges[:-1] < len(made)]] = True
    edges, made = np.append(0, np.cumsum(fresh))[edges], made[fresh]
    out = [made[a:b] for a, b in zip(edges, edges[1:])]
    for i in np.flatnonzero((counts > 0) & (counts < width)):  # the whole sequence as one
        out[i] = _rolled(h[ends[i] - counts[i]:ends[i]], int(counts[i]))
    return out


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    """SKETCH bits as int64 words: each shingle flips one bit."""
    odd = np.bincount((mix(shingles ^ _A) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide_sketch(shingles: np.ndarray) -> bytes | None:
    """Parity sketch of a power of two of bits, at least one a shingle; none for short sets."""
    if len(shingles) <= 2 * SKETCH:
        return None
    width = 1 << (len(shingles) - 1).bit_length()
    odd = np.bincount((mix(shingles ^ _B) % np.uint64(width)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def wide_distance(a: bytes | None, b: bytes | None) -> int:
    """A lower bound of the symmetric difference from two wide sketches (0 without them).

    The wider sketch is folded to the other's width: a bit's place is a hash modulo it.
    """
    if a is None or b is None:
        return 0
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) != len(y):
        if len(x) < len(y):
            x, y = y, x
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


@F.pandas_udf(T.LongType())
def _wide_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([wide_distance(x, y) for x, y in zip(a, b)], dtype="int64")


def frequent_shingles(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles above the threshold with their counts, sorted by shingle (step 1)."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def tell(run: list[np.ndarray]) -> pd.DataFrame:
            found, n = np.unique(np.concatenate(run), return_counts=True)
            often = n >= max(2, -(-len(run) // (2 * FREQUENT)))
            return pd.DataFrame({"token": found[often].view(np.int64), "n": n[often]})

        run: list[np.ndarray] = []
        size = 0
        for _, texts in slices(frames):
            for own in shingle_sets(texts, width):
                run.append(own)
                size += len(own)
                if size > 1_500_000:
                    yield tell(run)
                    run, size = [], 0
        if run:
            yield tell(run)

    counts = docs.select("text").mapInPandas(count, "token long, n long")
    least = max(2, docs.count() / (2 * FREQUENT))
    with arrow_rows(docs.sparkSession):
        hot = counts.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= least).toPandas()
    order = np.argsort(hot["token"].to_numpy().view(np.uint64))
    return hot["token"].to_numpy().view(np.uint64)[order], hot["n"].to_numpy()[order]


def _row_hash():
    return F.xxhash64("doc_id", "text").alias("h")


def profiles(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], width: int, percent: int) -> DataFrame:
    """Per row: id, set size, fingerprints of set and prefix, prefix, sketch (step 2)."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, counts = shared.value
        for rows, texts in slices(frames):
            out = []
            for own in shingle_sets(texts, width):
                if not len(own):
                    out.append((0, 0, 0, 0, 0, [], [], None))
                    continue
                rank = np.zeros(len(own), np.int64)
                if len(tokens):
                    at = np.minimum(np.searchsorted(tokens, own), len(tokens) - 1)
                    rank = np.where(tokens[at] == own, counts[at], 0)
                prefix = own[np.argsort(rank, kind="stable")[:prefix_length(len(own), percent)]]
                marks = [xxhash.xxh3_64_intdigest(x.tobytes(), seed=s) for x in (own, prefix) for s in (1, 2)]
                out.append((len(own), *np.array(marks, np.uint64).view(np.int64).tolist(),
                            prefix.view(np.int64), parity_sketch(own), wide_sketch(own)))
            made = pd.DataFrame(out, columns=["n", "f1", "f2", "p1", "p2", "prefix", "sketch", "wide"])
            made.insert(0, "doc_id", rows["doc_id"].to_numpy())
            made.insert(1, "h", rows["h"].to_numpy())
            yield made

    made = docs.select("doc_id", "text", _row_hash()).mapInPandas(
        run, f"doc_id {kind}, h long, n long, f1 long, f2 long, p1 long, p2 long, prefix array<long>, "
             "sketch array<long>, wide binary")
    with arrow_rows(docs.sparkSession):
        return stored(made.select("*", F.monotonically_increasing_id().alias("rid")), "profiles")


def _distance(a: str, b: str):
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _bucket_pairs(percent: int, nearest: bool):
    """Candidate pairs within sorted buckets (step 3): with ``nearest`` each row's closest
    candidate, otherwise all candidates of different labels."""

    def pairs(rows: pd.DataFrame) -> pd.DataFrame:
        bucket = np.unique(rows[["token", "low", "high"]].to_numpy(), axis=0, return_inverse=True)[1].ravel()
        order = np.lexsort((rows["n"].to_numpy(), bucket))
        rows, bucket = rows.iloc[order], bucket[order]
        n, pos, rad, gid, label = (rows[c].to_numpy() for c in ("n", "pos", "rad", "gid", "label"))
        block, one = rows["block"].to_numpy(), (rows["low"] == rows["high"]).to_numpy()
        sketch = np.stack(rows["sketch"].to_numpy()).astype(np.int64).view(np.uint64)
        wide, wide_rad = rows["wide"].to_numpy(object), rows["wide_rad"].to_numpy()
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        least, partner = np.full(len(rows), np.iinfo(np.int64).max), np.full(len(rows), -1)
        at, gap = np.arange(len(rows)), 0
        while len(at):
            gap += 1
            at = at[at + gap < len(rows)]
            to = at + gap
            # sizes rise within a bucket: once a partner is too large, later ones are too
            near = (bucket[at] == bucket[to]) & (100 * n[at] >= percent * n[to])
            at, to = at[near], to[near]
            need = -(-percent * (n[at] + n[to]) // (100 + percent))
            ok = (label[at] != label[to]) & (one[at] | (block[at] != block[to]))
            ok &= np.minimum(n[at] - pos[at], n[to] - pos[to]) >= need
            i, j, need = at[ok], to[ok], need[ok]
            far = np.bitwise_count(sketch[i] ^ sketch[j]).sum(1, dtype=np.int64) - rad[i] - rad[j]
            most = n[i] + n[j] - 2 * need
            for x in np.flatnonzero((far <= most) & (n[i] > 2 * SKETCH)):
                apart = wide_distance(wide[i[x]], wide[j[x]]) - wide_rad[i[x]] - wide_rad[j[x]]
                far[x] = max(far[x], apart)
            ok = far <= most
            i, j, far = i[ok], j[ok], far[ok]
            if nearest:
                for x, y in ((i, j), (j, i)):  # each place occurs once on either side
                    less = far < least[x]
                    least[x[less]], partner[x[less]] = far[less], y[less]
            else:
                left.append(i)
                right.append(j)
        i = np.flatnonzero(partner >= 0) if nearest else np.concatenate(left)
        j = partner[i] if nearest else np.concatenate(right)
        return pd.DataFrame({"g1": np.minimum(gid[i], gid[j]), "g2": np.maximum(gid[i], gid[j])}).drop_duplicates()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            if not len(frame):
                continue
            rows = frame if rest is None else pd.concat([rest, frame])
            last = rows.iloc[-1]
            open_ = ((rows["token"] == last["token"]) & (rows["low"] == last["low"])
                     & (rows["high"] == last["high"])).to_numpy()
            rest = rows[open_]
            if not open_.all():
                yield pairs(rows[~open_])
        if rest is not None:
            yield pairs(rest)

    return run


def _shared_only(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of a sorted partition whose token the row before or behind has too."""
    rest = None
    for frame in frames:
        if not len(frame):
            continue
        rows = frame if rest is None else pd.concat([rest, frame])
        token = rows["token"].to_numpy()
        same = token[1:] == token[:-1]
        keep = np.append(same, False) | np.append(False, same)
        if rest is not None:
            keep[0] |= rest_shared
        # the last row waits for the next batch; that it is shared already is remembered
        rest, rest_shared = rows.iloc[-1:], bool(keep[-1])
        yield rows[:-1][keep[:-1]]
    if rest is not None and rest_shared:
        yield rest


def shared_prefixes(groups: DataFrame) -> DataFrame:
    """``token, gid, n, pos``: prefix shingles that two groups or more have.

    Most prefix shingles occur in one group only and go in this one sorted pass,
    before sketches are attached.
    """
    packed = F.posexplode(F.col("prefix")).alias("pos", "token")
    tokens = groups.select("gid", "n", packed).select(
        "token", "gid", F.shiftleft(F.col("n"), 32).bitwiseOR(F.col("pos").cast("long")).alias("np"))
    shared = (tokens.repartition("token").sortWithinPartitions("token")
              .mapInPandas(_shared_only, "token long, gid long, np long"))
    return stored(shared.select("token", "gid", F.shiftright("np", 32).alias("n"),
                                F.col("np").bitwiseAND((1 << 32) - 1).cast("int").alias("pos")), "shared")


def open_shingles(shared: DataFrame, labels: DataFrame, block: int = BLOCK) -> DataFrame:
    """``token, gid, n, pos, label, blocks``: rows of shingles whose groups have two labels or
    more. Labels only merge, so the other shingles are done with for good."""
    rows = shared.select("token", "gid", "n", "pos").join(labels.select("gid", "label"), "gid")
    mixed = (rows.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"),
                                       F.min("label").alias("a"), F.max("label").alias("b"))
             .where("a <> b").select("token", "blocks"))
    return stored(rows.join(mixed, "token"), "open")


def candidate_groups(rows: DataFrame, groups: DataFrame, percent: int, nearest: bool, wide: bool) -> DataFrame:
    """Distinct pairs ``g1 < g2`` of groups of different ``label`` that may hold linked
    members (step 3); with ``nearest`` only the closest one of each group and shingle.
    ``wide`` attaches the long sketches too."""
    long = (F.col("wide"), F.col("wide_rad")) if wide else \
        (F.lit(None).cast("binary").alias("wide"), F.lit(0).cast("long").alias("wide_rad"))
    rows = rows.join(groups.select("gid", "rad", "sketch", *long), "gid")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("gid"), F.col("blocks").cast("long")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    placed = (rows.select("token", "low", "high", "block", "gid", "n", "pos", "rad", "label", "sketch", "wide", "wide_rad")
              .repartition("token", "low", "high").sortWithinPartitions("token", "low", "high"))
    return placed.mapInPandas(_bucket_pairs(percent, nearest), "g1 long, g2 long").distinct()


def verified(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs ``u, v`` whose whole sets link; ``hu`` and ``hv`` are hashes of their rows.

    The sets of the rows that the pairs name are worked out again from the texts. A
    bitmap of ``SLOTS`` bits (a fixed size) tells tasks which rows to pass on.
    """
    ends = pairs.select(F.col("hu").alias("h")).union(pairs.select(F.col("hv").alias("h")))
    found = ends.select(F.pmod("h", F.lit(SLOTS)).alias("slot")).distinct().toPandas()["slot"].to_numpy(np.int64)
    if not len(found):
        return pairs.select("u", "v")
    wanted = np.zeros(SLOTS, bool)
    wanted[found] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(wanted))

    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marked = np.unpackbits(shared.value).view(bool)
        for frame in frames:
            picked = frame[marked[frame["h"].to_numpy() % SLOTS]]
            for rows, raws in slices(iter([picked])):
                # 40 bits of each hash are enough to count what two sets share
                own = [np.unique(x >> np.uint64(24)) for x in shingle_sets(raws, width)]
                yield pd.DataFrame({"h": rows["h"].to_numpy(), "own": [
                    x.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes() for x in own]})

    def opened(raw: bytes) -> np.ndarray:
        wide = np.zeros((len(raw) // 5, 8), np.uint8)
        wide[:, 3:] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
        return wide.view(">u8").ravel()

    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            ok = []
            for a, b in zip(rows["a"], rows["b"]):
                a, b = opened(a), opened(b)
                both = len(np.intersect1d(a, b, assume_unique=True))
                ok.append(100 * both >= percent * (len(a) + len(b) - both))
            yield rows.loc[np.array(ok, bool), ["u", "v"]]

    # rows of equal id and text have one set: one of them is enough
    made = docs.select(_row_hash(), "text").mapInPandas(sets, "h long, own binary").groupBy("h").agg(F.first("own").alias("own"))
    full = (pairs.join(made.select(F.col("h").alias("hu"), F.col("own").alias("a")), "hu")
            .join(made.select(F.col("h").alias("hv"), F.col("own").alias("b")), "hv"))
    with arrow_rows(docs.sparkSession):
        return stored(full.select("u", "v", "a", "b").mapInPandas(link, "u long, v long").distinct(), "links")


def linked_components(docs: DataFrame, pairs: DataFrame, width: int, percent: int,
                      known: DataFrame | None = None) -> DataFrame:
    """``node, root`` of the components of the candidate pairs (u, hu, v, hv, far) that
    link, and of the ``known`` components given in the same form.

    Pairs within one component need no check. Without ``known`` components each
    node's closest pair is verified first, so that most others need none.
    """
    links = known.select(F.col("node").alias("u"), F.col("root").alias("v")) if known is not None else None
    if known is None:
        near = F.struct("far", "u", "v", "hu", "hv")
        sides = pairs.select(F.col("u").alias("node"), near.alias("p")).union(
            pairs.select(F.col("v").alias("node"), near.alias("p")))
        first = sides.groupBy("node").agg(F.min("p").alias("p")).select("p.*").distinct()
        links = verified(docs, first, width, percent)
        known = components(links)
        pairs = pairs.join(first.select("u", "v"), ["u", "v"], "left_anti")
    of = lambda end: known.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
    apart = pairs.join(of("u"), "u", "left").join(of("v"), "v", "left").where(
        F.coalesce("root_u", "u") != F.coalesce("root_v", "v"))
    apart = stored(apart.select("u", "hu", "v", "hv"), "apart")
    return stored(components(links.union(verified(docs, apart, width, percent))), "roots")


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4,
                       percent: int = 85) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles``, ``component_id``."""
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = profiles(docs, frequent_shingles(docs, width), width, percent)
    filled = rows.where("n > 0")
    classes = filled.groupBy("n", "f1", "f2").agg(F.min("rid").alias("rid"), F.min("doc_id").alias("least"))
    classes = stored(classes, "classes")
    reps = filled.join(classes.select("rid"), "rid", "left_semi")
    groups = reps.groupBy("n", "p1", "p2").agg(F.min("rid").alias("gid"), F.count(F.lit(1)).alias("members"))
    members = stored(reps.join(groups, ["n", "p1", "p2"]).select("rid", "gid", "members", "n", "sketch", "wide", "h"),
                     "members")
    heads = members.where("rid = gid").select("gid", F.col("sketch").alias("head"), F.col("wide").alias("wide_head"))
    radius = (members.where("members > 1").join(heads, "gid")
              .select("gid", _distance("sketch", "head").alias("d"), _wide_distance("wide", "wide_head").alias("w"))
              .groupBy("gid").agg(F.max("d").alias("rad"), F.max("w").alias("wide_rad")))
    heads = heads.join(radius, "gid", "left").select(
        F.col("gid").alias("rid"), F.coalesce("rad", F.lit(0)).cast("long").alias("rad"),
        F.coalesce("wide_rad", F.lit(0)).cast("long").alias("wide_rad"))
    whole = filled.join(heads, "rid").select(F.col("rid").alias("gid"), "n", "prefix", "sketch", "rad", "wide", "wide_rad")
    shared = shared_prefixes(whole)
    whole = stored(whole.select("gid", "sketch", "rad", "wide", "wide_rad"), "groups")
    side = lambda g, r, n, s, w, h: members.select(
        F.col("gid").alias(g), F.col("rid").alias(r), F.col("n").alias(n), F.col("sketch").alias(s),
        F.col("wide").alias(w), F.col("h").alias(h))
    need = F.ceil(percent * (F.col("na") + F.col("nb")) / (100 + percent))

    def expanded(group_pairs: DataFrame) -> DataFrame:
        full = (group_pairs.join(side("g1", "u", "na", "sa", "wa", "hu"), "g1")
                .join(side("g2", "v", "nb", "sb", "wb", "hv"), "g2")
                .where("g1 <> g2 or u < v").withColumn("far", _distance("sa", "sb")))
        most = F.col("na") + F.col("nb") - 2 * need
        return stored(full.where(F.col("far") <= most).withColumn("wide_far", _wide_distance("wa", "wb"))
                      .where(F.col("wide_far") <= most)
                      .select("u", "hu", "v", "hv", F.greatest("far", "wide_far").alias("far")), "pairs")

    # first the closest candidates between components, then all that still lie between them
    own = members.where("members > 1 and rid = gid").select(F.col("gid").alias("g1"), F.col("gid").alias("g2"))
    labels, roots = whole.select("gid", F.col("gid").alias("label")), None
    for turn in range(ROUNDS + 1):
        shared = open_shingles(shared, labels)
        found = candidate_groups(shared, whole, percent, turn < ROUNDS, wide=turn > 0)
        roots = linked_components(docs, expanded(found if turn else found.union(own)), width, percent, roots)
        if turn < ROUNDS:
            ends = members.join(roots, members["rid"] == roots["node"], "left").groupBy("gid").agg(
                F.min(F.coalesce("root", "rid")).alias("a"), F.max(F.coalesce("root", "rid")).alias("b"))
            labels = ends.select("gid", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(-1 - F.col("gid")).alias("label"))
    named = classes.join(roots, classes["rid"] == roots["node"], "left").select(
        "n", "f1", "f2", "least", F.coalesce("root", "rid").alias("root"))
    names = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(names, "root").select("n", "f1", "f2", "component")
    return rows.select("doc_id", "n", "f1", "f2").join(named, ["n", "f1", "f2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def distinct_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of every component: the one of least id (then least text hash)."""
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"),
                        row_key(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("_key"))
    found = jaccard_components(keyed, "_key", "_text", **options)
    stay = stored(found.where("doc_id = component_id").groupBy(F.col("doc_id").alias("_key"))
                  .agg(F.count(F.lit(1)).alias("_rows")), "stay")
    kept = keyed.select("_row", "_key").join(stay, "_key")
    single, repeated = kept.where("_rows = 1"), kept.where("_rows > 1").dropDuplicates(["_key"])
    return single.unionByName(repeated).select("_row.*")  # the struct keeps columns of clashing names apart
