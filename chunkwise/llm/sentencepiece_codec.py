"""SentencePiece encoding and decoding by a max-plus parallel scan.

Given a public model's pieces and scores, a text's encoding is the segmentation into
pieces of greatest total score (characters outside the vocabulary become byte pieces
at a score below all others; of equal totals, at every end the earliest start wins).
As in such models, a blank becomes the mark U+2581 and one mark is put in front.

A document longer than ``chunk_chars`` is split into chunks that separate tasks
work on. The state at a chunk's border is how many characters the piece across it
has already taken, at most one less than the longest piece:

1. each chunk gives its transfer matrix, the best score from every entry state to
   every exit state;
2. an associative scan of the matrices in the max-plus algebra gives the best score
   of every state at every border;
3. each chunk, given the scores at its entry, is backtraced on its own for each exit
   state it can end in: the pieces, and the entry state that they come from;
4. the exit-to-entry maps are chained from the end and pick one row a chunk.

Pieces hold the mark only in front, so no piece crosses a place where a mark follows
another character. Between such places segmentations do not depend on each other;
distinct stretches are worked out side by side, some thousand at a time, in chunks as
in short documents, and remembered for a while. Matrices are only worked out before the
first and after the last such place of a chunk: what lies between adds the same to all.

Decoding maps ids to bytes and takes off the front mark. A literal U+2581 of a text
is coded as bytes, so it is not taken for a blank and every text decodes to itself.

Defined cases: a null or empty text has no ids, no ids decode to the empty text;
ids that are null decode to the empty text; repeated rows each get their ids; an
empty table gives no rows; the columns named in ``keep`` are carried along.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, filterfalse

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwise.llm.common import arrow_rows, slices, stored

MARK = "▁"
#: Stands for a literal mark while encoding; a lone surrogate is in no UTF-8 text.
LITERAL = "\udfff"
#: Parts stretches of texts that do not hold it, a code point that is no character.
PART = "\ufdd0"
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
NONE = -np.inf
#: Exit state of the ids that all exits of a chunk share.
COMMON = -1


#: Long documents, or chunks of them, that go to Python at once.
LONG_ROWS = 64
#: Stretches up to this length are worked out together, unless they are few.
TOGETHER = 64
FEW = 500


def longer(key: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Hashes of strings with one more character."""
    key = (key + code.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return key ^ (key >> np.uint64(29))


def slot_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Vocabulary:
    pieces: dict[str, tuple[int, float]]
    bytes_of: list[bytes]  # by id
    byte_ids: list[int]  # by byte
    unknown: float  # score of a character without a piece

    def __post_init__(self):
        self.longest = max(map(len, self.pieces), default=1)
        #: character -> [id or None, score, deeper characters]
        self.trie: dict = {}
        for piece, (i, score) in self.pieces.items():
            level = self.trie
            for n, ch in enumerate(piece, 1):
                node = level.setdefault(ch, [None, 0.0, {}])
                if n == len(piece):
                    node[0], node[1] = i, score
                level = node[2]
        inner = any(MARK in p.lstrip(MARK) for p in self.pieces)
        self.alone = [c for c in "\n\t\r\x0b\x0c" if not any(c in p for p in self.pieces)]
        alone = "".join(map(re.escape, self.alone))
        #: texts part before a mark (unless some piece holds an inner one) and around
        #: white space that is in no piece
        self.stretches = re.compile("[\\s\\S]+" if inner else
                                    f"{MARK}*[^{MARK}{alone}]+|{MARK}+" + (f"|[{alone}]" if alone else ""))
        self.cut = None if inner else re.compile(f"(?<=[^{MARK}]){MARK}")

        self._tabulate()

    def cut_up(self, text: str) -> list[str]:
        """The stretches of an escaped text, maybe with empty ones between."""
        if self.cut is None or MARK + MARK in text or PART in text:
            return self.stretches.findall(text)
        for c in self.alone:
            if c in text:
                text = text.replace(c, PART + c + PART)
        return text.replace(MARK, PART + MARK).split(PART)

    def _tabulate(self) -> None:
        """Pieces as arrays, and the hashes of all beginnings of pieces in an open hash table."""
        known = list(self.pieces.items())
        self.piece_ids = np.array([i for _, (i, _) in known] + [-1], np.int32)
        self.piece_scores = np.array([s for _, (_, s) in known] + [NONE])
        codes = np.frombuffer("".join(p for p, _ in known).encode("utf-32-le", "surrogatepass"), "<u4")
        sizes = np.array([len(p) for p, _ in known], np.int64)
        first = np.cumsum(sizes) - sizes
        key, begun, whole = np.zeros(len(known), np.uint64), [], np.zeros(len(known), np.uint64)
        for n in range(1, self.longest + 1):
            own = np.flatnonzero(sizes >= n)
            key[own] = longer(key[own], codes[first[own] + n - 1])
            begun.append(key[own])
            whole[sizes == n] = key[sizes == n]
        left = np.unique(np.concatenate(begun or [key]))
        self.bits = max(8, (4 * len(left)).bit_length())
        self.slots = np.zeros(1 << self.bits, np.uint64)
        at = slot_of(left, self.bits)
        while len(left):
            free = np.flatnonzero(self.slots[at] == 0)
            taken = free[np.unique(at[free], return_index=True)[1]]
            self.slots[at[taken]] = left[taken]
            left, at = np.delete(left, taken), (np.delete(at, taken) + 1) & ((1 << self.bits) - 1)
        self.piece_at = np.full(1 << self.bits, len(known), np.int32)  # the number behind the last one for no piece
        self.piece_at[self.places(whole)] = np.arange(len(known))

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Slots of such hashes, -1 for those of no beginning of a piece."""
        at = slot_of(keys, self.bits)
        there = self.slots[at]
        out = np.where(there == keys, at, -1)
        open_ = np.flatnonzero((there != keys) & (there != 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            there = self.slots[at[open_]]
            met = there == keys[open_]
            out[open_[met]] = at[open_[met]]
            open_ = open_[~met & (there != 0)]
        return out

    @property
    def states(self) -> int:
        return self.longest


def load(path: str = DEFAULT_MODEL) -> Vocabulary:
    """Read a model's vocabulary (on the driver; tasks get it broadcast)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, bytes_of, byte_ids = {}, [], [0] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            bytes_of.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            bytes_of.append(b"")
        else:
            pieces[piece] = (i, model.get_score(i))
            bytes_of.append(piece.replace(MARK, " ").encode("utf-8"))
    return Vocabulary(pieces, bytes_of, byte_ids, min((s for _, s in pieces.values()), default=0.0) - 10)


def escaped(text: str) -> str:
    return text.replace(MARK, LITERAL).replace(" ", MARK)


class Coder:
    """Encodes stretches and chunks; remembers the last stretches, about ``limit`` to twice ``limit``."""

    def __init__(self, vocabulary: Vocabulary, limit: int = 100_000):
        self.v, self.memo, self.older, self.limit = vocabulary, {}, {}, limit

    def lattice(self, text: str, size: int, seed: list[float]) -> tuple[list[float], list[int]]:
        """Best scores at 0 .. size + states - 1 and the starts of the last pieces.

        ``seed`` are scores at the first places; pieces start before ``size`` and may
        end behind it. A start of -1 means that the seed itself is best.
        """
        n, root, unknown = len(text), self.v.trie, self.v.unknown
        score = [NONE] * (size + self.v.longest)
        score[:len(seed)] = seed[:len(score)]
        start = [-1] * len(score)
        for p in range(size):
            base = score[p]
            if base == NONE:
                continue
            node = root.get(text[p])
            if (node is None or node[0] is None) and base + unknown > score[p + 1]:
                score[p + 1], start[p + 1] = base + unknown, p
            q = p + 1
            while node is not None:
                if node[0] is not None and base + node[1] > score[q]:
                    score[q], start[q] = base + node[1], p
                if q == n:
                    break
                node = node[2].get(text[q])
                q += 1
        return score, start

    def ids(self, text: str, start: list[int], end: int) -> tuple[list[int], int]:
        """Ids of the best path that ends at ``end`` and the place it begins at."""
        pieces = []
        while start[end] >= 0:
            pieces.append(text[start[end]:end])
            end = start[end]
        out: list[int] = []
        for piece in reversed(pieces):
            found = self.v.pieces.get(piece)
            if found is not None:
                out.append(found[0])
            else:
                raw = MARK.encode() if piece == LITERAL else piece.encode("utf-8", "surrogatepass")
                out += [self.v.byte_ids[b] for b in raw]
        return out, end

    def stretch(self, text: str) -> bytes:
        """Packed ids of a stretch that no piece crosses the ends of."""
        ids = self.ids(text, self.lattice(text, len(text), [0.0])[1], len(text))[0]
        return struct.pack(f"<{len(ids)}i", *ids)

    def joined(self, parts: list[list[str]], at_once: int = 8_192) -> list[bytes]:
        """Packed ids of lists of stretches; short ones not yet known are worked out together."""
        if len(self.memo) >= self.limit:
            self.memo, self.older = {}, self.memo
        unknown = set(filterfalse(self.memo.__contains__, chain.from_iterable(parts)))
        ids = {s: self.older.get(s) if s else b"" for s in unknown}
        fresh = sorted((s for s, known in ids.items() if known is None and len(s) <= TOGETHER), key=len, reverse=True)
        for a in range(0, len(fresh) if len(fresh) >= FEW else 0, at_once):
            some = fresh[a:a + at_once]
            ids.update(zip(some, self.together(some)))
        for s, known in ids.items():
            if known is None:  # few, long, or with characters outside the vocabulary
                ids[s] = self.stretch(s)
        self.memo.update(ids)
        return [b"".join(map(self.memo.__getitem__, own)) for own in parts]

    def together(self, texts: list[str]) -> list[bytes | None]:
        """Packed ids of stretches, longest first: the lattices of all of them side by side."""
        v, none = self.v, len(self.v.pieces)
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.cumsum(size) - size
        room = np.repeat(begin + size, size) - np.arange(len(codes))
        at, key, pieces = np.arange(len(codes)), np.zeros(len(codes), np.uint64), []
        for n in range(min(v.longest, int(size[0]))):  # by length - 1: the piece from each character on
            key = longer(key, codes[at + n])
            slot = v.places(key)
            begun = np.flatnonzero(slot >= 0)
            own = np.full(len(codes), none, np.int32)
            own[at[begun]] = v.piece_at[slot[begun]]
            pieces.append(own)
            begun = begun[room[at[begun]] > n + 1]
            at, key = at[begun], key[begun]
        score = np.full((int(size[0]) + 1, len(texts)), NONE)
        took = np.zeros(score.shape, np.int8)  # length of the last piece
        score[0] = 0.0
        here = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")  # stretches of at least so many characters
        for end in range(1, int(size[0]) + 1):
            m = here[end - 1]
            best, last = np.full(m, NONE), np.zeros(m, np.int8)
            for n in range(min(end, v.longest), 0, -1):  # of equal totals the earliest start wins
                piece = pieces[n - 1][begin[:m] + end - n]
                own = np.flatnonzero(piece != none)
                value = score[end - n, own] + v.piece_scores[piece[own]]
                better = value > best[own]
                own = own[better]
                best[own], last[own] = value[better], n
            score[end, :m], took[end, :m] = best, last
        whole = score[size, np.arange(len(texts))] > NONE
        out = np.zeros((len(texts), int(size[0])), np.int32)
        end, count, own = np.where(whole, size, 0), np.zeros(len(texts), np.int64), np.flatnonzero(whole)
        while len(own):
            count[own] += 1
            n = took[end[own], own].astype(np.int64)
            end[own] -= n
            for length in np.unique(n):
                some = own[n == length]
                out[some, -count[some]] = v.piece_ids[pieces[length - 1][begin[some] + end[some]]]
            own = own[end[own] > 0]
        raw, width = out.astype("<i4").tobytes(), 4 * out.shape[1]
        return [raw[(i + 1) * width - 4 * c:(i + 1) * width] if ok else None
                for i, (c, ok) in enumerate(zip(count.tolist(), whole.tolist()))]

    def encode(self, text: str) -> bytes:
        """Packed ids of a whole text."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Packed ids of whole texts."""
        return self.joined([self.v.cut_up(MARK + escaped(t)) if t else [] for t in texts])

    def parts(self, body: str, size: int) -> tuple[int, int] | None:
        """First and last place of a chunk that no piece crosses, if there is any."""
        first = self.v.cut.search(body, 0, size) if self.v.cut else None
        if first is None:
            return None
        last = body.rfind(MARK, 0, size)
        while body[last - 1] == MARK:  # the front one of a row of marks
            last -= 1
        return first.start(), max(last, first.start())

    def matrix(self, body: str, size: int) -> np.ndarray:
        """Transfer matrix of a chunk, up to a constant; ``body`` has the next characters after ``size``.

        What lies between the first and the last place that no piece crosses adds the same
        to all paths, so it decides nothing and is left out.
        """
        k = self.v.states
        out = np.full((k, k), NONE)
        cut = self.parts(body, size)
        entries = [[NONE] * i + [0.0] for i in range(min(k, size + 1))]
        if cut is None:
            for i, seed in enumerate(entries):
                out[i] = self.lattice(body, size, seed)[0][size:size + k]
            return out
        first, last = cut
        head = np.full(k, NONE)
        for i, seed in enumerate(entries[:first + 1]):
            head[i] = self.lattice(body[:first], first, seed)[0][first]
        tail = np.array(self.lattice(body[last:], size - last, [0.0])[0][size - last:size - last + k])
        return head[:, None] + tail[None, :]

    def middle(self, body: str, size: int) -> list[str]:
        """Stretches between the first and the last place of a chunk that no piece crosses."""
        cut = self.parts(body, size)
        return self.v.cut_up(body[cut[0]:cut[1]]) if cut else []

    def paths(self, body: str, size: int, seed: list[float]) -> Iterator[tuple[int, int, bytes]]:
        """(exit state, entry state, packed ids) of each exit that can be reached.

        What all exits share comes first, once, as exit ``COMMON``.
        """
        k = self.v.states
        pack = lambda ids: np.array(ids, "<i4").tobytes()
        cut = self.parts(body, size)
        if cut is None:
            score, start = self.lattice(body, size, seed)
            for j in range(k):
                if score[size + j] > NONE:
                    ids, entry = self.ids(body, start, size + j)
                    yield j, entry, pack(ids)
            return
        first, last = cut
        score, start = self.lattice(body[:first], first, seed[:first + 1])
        if score[first] == NONE:
            return
        ids, entry = self.ids(body[:first], start, first)
        yield COMMON, entry, pack(ids) + self.joined([self.middle(body, size)])[0]
        score, start = self.lattice(body[last:], size - last, [0.0])
        for j in range(k):
            if score[size - last + j] > NONE:
                yield j, entry, pack(self.ids(body[last:], start, size - last + j)[0])


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus products of stacked matrices."""
    return (a[:, :, :, None] + b[:, None, :, :]).max(2)


def scan(matrices: np.ndarray) -> np.ndarray:
    """Inclusive products of all prefixes, in log2(n) rounds of pairwise products."""
    out, step = matrices.copy(), 1
    while step < len(out):
        left, right = out[:-step].copy(), out[step:].copy()
        for at in range(0, len(left), 256):  # bounds the temporaries
            out[step + at:step + at + 256] = max_plus(left[at:at + 256], right[at:at + 256])
        step *= 2
    return out


def _chunks(docs: DataFrame, chunk_chars: int, reach: int) -> DataFrame:
    """Chunk rows of long documents: ``rid, chunk, last, size, body``; the first chunk of a
    document also has its ``kept`` columns and ``sha``."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for rid, text, kept, sha in zip(frame["rid"], frame["text"], frame["kept"], frame["sha"]):
                whole = " " + text  # the mark in front; chunks travel as they are and are escaped where used
                at = range(0, len(whole), chunk_chars)
                for some in range(0, len(at), 64):
                    own = at[some:some + 64]
                    bodies = [whole[a:a + chunk_chars + reach] for a in own]
                    yield pd.DataFrame({
                        "rid": rid, "chunk": range(some, some + len(own)), "last": [a == at[-1] for a in own],
                        "size": [min(chunk_chars, len(whole) - a) for a in own],
                        "kept": [None if some + i else kept for i in range(len(own))],
                        "sha": [None if some + i else sha for i in range(len(own))],
                        "body": [b.encode("utf-8", "surrogatepass") for b in bodies]})

    kind = docs.schema["kept"].dataType.simpleString()
    return docs.mapInPandas(cut, f"rid long, chunk int, last boolean, size int, kept {kind}, sha string, body binary")


def decoded(ids: np.ndarray, bytes_of: list[bytes]) -> bytes:
    """UTF-8 of the text that packed ids stand for."""
    return b"".join(map(bytes_of.__getitem__, ids.tolist()))[1:]


def decoded_rows(rows: list[np.ndarray], bytes_of: list[bytes], at_once: int = 1 << 18) -> Iterator[bytes]:
    """``decoded`` of many rows of ids, some ``at_once`` ids together."""
    flat, size = np.frombuffer(b"".join(bytes_of), np.uint8), np.fromiter(map(len, bytes_of), np.int64, len(bytes_of))
    first, run, n = np.cumsum(size) - size, [], 0
    for i, row in enumerate(rows, 1):
        run.append(row)
        n += len(row)
        if n >= at_once or i == len(rows):
            ids = np.concatenate(run)
            ends = np.append(0, np.cumsum(size[ids]))
            raw = flat[np.repeat(first[ids] - ends[:-1], size[ids]) + np.arange(ends[-1])].tobytes()
            edges = ends[np.cumsum([0] + [len(x) for x in run])].tolist()
            yield from (raw[a + 1:b] for a, b in zip(edges, edges[1:]))
            run, n = [], 0


def _encode_long(docs: DataFrame, shared, chunk_chars: int, check: bool) -> DataFrame:
    """``kept, ids, round_trip`` of long documents (kept, text, sha) by the four steps."""
    k = shared.value.states
    if chunk_chars <= k:
        raise ValueError(f"chunk_chars must exceed the longest piece ({k})")
    numbered = docs.withColumn("rid", F.monotonically_increasing_id())
    with arrow_rows(docs.sparkSession, LONG_ROWS):
        chunks = stored(_chunks(numbered, chunk_chars, k).repartition("rid", "chunk"), "chunks")

    def matrices(frames):
        coder = Coder(shared.value)
        for f in frames:
            yield pd.DataFrame({"rid": f["rid"], "chunk": f["chunk"], "m": [
                coder.matrix(escaped(b.decode("utf-8", "surrogatepass")), s).tobytes()
                for b, s in zip(f["body"], f["size"])]})

    def borders(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("chunk")
        products = scan(np.stack([np.frombuffer(m).reshape(k, k) for m in own["m"]]))
        start = np.full(k, NONE)
        start[0] = 0.0
        seeds = np.concatenate([start[None], products[:-1, 0, :]])
        return pd.DataFrame({"rid": own["rid"], "chunk": own["chunk"], "seed": [s.tobytes() for s in seeds]})

    def paths(frames):
        coder = Coder(shared.value)
        for some in (f.iloc[at:at + 32] for f in frames for at in range(0, len(f), 32)):
            bodies = [escaped(b.decode("utf-8", "surrogatepass")) for b in some["body"]]
            coder.joined([coder.middle(body, size) for body, size in zip(bodies, some["size"])])  # known from now on
            rows = []
            for rid, chunk, last, size, seed, body in zip(*(some[c] for c in ("rid", "chunk", "last", "size", "seed")), bodies):
                found = coder.paths(body, size, np.frombuffer(seed).tolist())
                rows += [(rid, chunk, j, i, ids) for j, i, ids in found if j <= 0 or not last]
            yield pd.DataFrame(rows, columns=["rid", "chunk", "leave", "enter", "ids"])

    def chain(own: pd.DataFrame) -> pd.DataFrame:
        step = {(c, j): i for c, j, i in zip(own["chunk"], own["leave"], own["enter"])}
        state, out = 0, []
        for chunk in range(own["chunk"].max(), -1, -1):
            out.append((own["rid"].iloc[0], chunk, state))
            state = step[chunk, state]
        return pd.DataFrame(out, columns=["rid", "chunk", "leave"])

    def joined(frames):
        for f in (f.iloc[at:at + LONG_ROWS] for f in frames for at in range(0, len(f), LONG_ROWS)):
            ids = [np.frombuffer(b"".join(x["ids"] for x in parts), "<i4") for parts in f["parts"]]
            yield pd.DataFrame({"kept": list(f["kept"]), "ids": ids, "round_trip": [
                not check or hashlib.sha256(decoded(x, shared.value.bytes_of)).hexdigest() == sha
                for x, sha in zip(ids, f["sha"])]})

    seeds = (chunks.select("rid", "chunk", "size", "body").mapInPandas(matrices, "rid long, chunk int, m binary")
             .groupBy("rid").applyInPandas(borders, "rid long, chunk int, seed binary"))
    with arrow_rows(docs.sparkSession, LONG_ROWS):
        traced = stored(chunks.select("rid", "chunk", "last", "size", "body").join(seeds, ["rid", "chunk"])
                        .mapInPandas(paths, "rid long, chunk int, leave int, enter int, ids binary"), "paths")
    steps = traced.select("rid", "chunk", "leave", "enter")
    chosen = steps.groupBy("rid").applyInPandas(chain, "rid long, chunk int, leave int")
    # what all exits share, most of the ids, needs no choice and travels once only
    wanted = traced.where(F.col("leave") == COMMON).drop("enter").unionByName(
        traced.where(F.col("leave") != COMMON).drop("enter").join(chosen, ["rid", "chunk", "leave"]))
    parts = wanted.groupBy("rid").agg(
        F.array_sort(F.collect_list(F.struct("chunk", "leave", "ids"))).alias("parts"))
    firsts = chunks.where("chunk = 0").select("rid", "kept", "sha")
    kind = docs.schema["kept"].dataType.simpleString()
    return parts.join(firsts, "rid").mapInPandas(joined, f"kept {kind}, ids array<int>, round_trip boolean")


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
           chunk_chars: int = 16_384, check: bool = False) -> DataFrame:
    """``keep`` columns and ``ids`` (array<int>) of every whole text; with ``check`` also
    ``round_trip``, whether the ids decode to the very text."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    kept = rows.schema["kept"].dataType.simpleString()

    def short(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder(shared.value)
        for part, raws in slices(frames):
            ids = [np.frombuffer(raw, "<i4") for raw in coder.encode_all(part["text"].tolist())]
            yield pd.DataFrame({"kept": list(part["kept"]), "ids": ids, "round_trip": [
                not check or decoded(x, shared.value.bytes_of) == raw for x, raw in zip(ids, raws)]})

    is_long = F.length("text") > chunk_chars
    brief = rows.where(~is_long).mapInPandas(short, f"kept {kept}, ids array<int>, round_trip boolean")
    long = rows.where(is_long).withColumn("sha", F.sha2("text", 256) if check else F.lit(None).cast("string"))
    out = brief.unionByName(_encode_long(long, shared, chunk_chars, check))
    return out.select("kept.*", "ids", *["round_trip"][:check])


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", output: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids in ``output``."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary.bytes_of)

    @F.pandas_udf("string")
    def text_of(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = shared.value
        for column in columns:
            rows = [np.zeros(0, np.int64) if own is None else own for own in column]
            yield pd.Series([raw.decode("utf-8", "replace") for raw in decoded_rows(rows, table)], dtype=object)

    return encoded.withColumn(output, text_of(F.col(ids)))


def digest(docs: DataFrame, vocabulary: Vocabulary, **options) -> DataFrame:
    """Per document: counts, the ids, and whether ``decode`` gives the very text back."""
    keyed = docs.select("doc_id", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
                        F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"), "text")
    coded = decode(encode(keyed, vocabulary, keep=("doc_id", "n_chars", "sha"), **options), vocabulary)
    return coded.select("doc_id", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        (F.sha2("decoded", 256) == F.col("sha")).alias("round_trip"))
