"""Personal data by fixed patterns and by bootstrapped contextual extraction.

The base kinds (email, ip, card, phone) are found in every whole text and are always
reported. They are the seeds: the words around them induce lexical patterns, and
patterns that mostly hold seeds of one kind discover identifiers that no base pattern
describes.

* An instance is a mention's lower-case text: a base span, or a candidate (a word with a
  digit or '@', trimmed of outer punctuation, ``LEAST_CHARS`` or longer, outside every
  base span).
* A mention's context is the two words before and the word after; it induces the
  patterns "w2 w1 _", "w1 _" and "w1 _ v1".
* Graph: distinct (instance, context) pairs, each standing in its three patterns. Copies
  of a document add nothing to it.
* Round: a pattern's trust in a kind is the sum of its distinct instances' scores for
  that kind over their number plus one. Patterns with ``min_trust`` and ``min_known``
  known instances of the kind (seeds, or discovered in an earlier round) are accepted; a
  trust above one half names at most one kind. A candidate's score for a kind is the mean over
  its contexts of the best accepted pattern there; from ``min_score`` on it counts as
  discovered, with that score, in the next round. Scores are whole millionths, so the
  order of summation cannot change a decision.

Every mention of a discovered instance is reported as kind ``context_<kind>``. All
scoring is joins and aggregates over Spark tables; hot instances and hot patterns are
reduced before the shuffle, and lookups against them are salted.

Defined cases: a null text is empty; a null id is kept; repeated rows each get their
result; places before the first and after the last word count as the words '^' and '$';
words of over ``LONG`` characters stand in the graph as their SHA-256; an empty table
gives no rows; columns other than the named ones are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwise.llm.common import WORD_CLASS, stored
from chunkwise.operators.skew import salted_lookup_join

KINDS = ("email", "ip", "card", "phone")
LEAST_CHARS, LONG = 5, 64
ONE = 1_000_000  # a score of one, in millionths

_WORD = re.compile(WORD_CLASS)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_CORE = re.compile(r"[A-Za-z0-9@+](?:.*[A-Za-z0-9])?", re.DOTALL)


# ----------------------------------------------------------------------------
# spans of one text
# ----------------------------------------------------------------------------

def _emails(text: str) -> Iterator[tuple[int, int]]:
    """An address starts where the run of local characters before its '@' starts, or where
    the address before it ends; looking back from each '@' keeps long runs linear."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """A chain of dotted numbers gives a match for each four of its parts from the left."""
    for chain in _DOTTED.finditer(text):
        if chain.group().count(".") < 3:
            continue
        parts, at = chain.group().split("."), chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def luhn(digits: str) -> bool:
    twice = [2 * int(d) - 9 * (d > "4") for d in digits[-2::-2]]
    return (sum(twice) + sum(map(int, digits[-1::-2]))) % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) of every base span, sorted."""
    found = (_emails, _ips, _cards, _phones)
    return sorted((s, rank, e) for rank, spans in enumerate(found) for s, e in spans(text))


def _short(word: str) -> str:
    return word if len(word) <= LONG else sha256(word.encode("utf-8", "surrogatepass")).hexdigest()


def mentions(text: str) -> list[tuple[int, int, int, str, str, str, str]]:
    """(start, end, rank, instance, w2, w1, v1) of base spans and candidates (rank -1)."""
    if not _MARK.search(text):
        return []
    base = base_spans(text)
    words = [m.span() for m in _WORD.finditer(text)]
    starts = [s for s, _ in words]
    found, taken, b = [(s, e, rank) for s, rank, e in base], -1, 0
    for s, e in words:
        if not _MARK.search(text, s, e):
            continue
        while b < len(base) and base[b][0] < e:  # the furthest end of the base spans begun so far
            taken, b = max(taken, base[b][2]), b + 1
        core = _CORE.search(text, s, e)
        if core and taken <= s and core.end() - core.start() >= LEAST_CHARS and _MARK.search(core.group()):
            found.append((core.start(), core.end(), -1))
    out = []
    for s, e, rank in sorted(found):
        first, last = bisect_right(starts, s) - 1, bisect_right(starts, e - 1) - 1
        before = [text[words[first][0]:s]] if words[first][0] < s else []
        before = ["^", "^", *[text[a:z] for a, z in words[max(0, first - 2):first]], *before]
        after = text[e:words[last][1]] or (text[slice(*words[last + 1])] if last + 1 < len(words) else "$")
        w2, w1 = before[-2:]
        out.append((s, e, rank, *(_short(w.lower()) for w in (text[s:e], w2, w1, after))))
    return out


# ----------------------------------------------------------------------------
# the graph
# ----------------------------------------------------------------------------

MENTION = "struct<start:int,end:int,rank:int,value:string,w2:string,w1:string,v1:string>"


def find_mentions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``_row, doc_id, mentions``: one row per row of ``docs``, without its text."""
    schema = f"_row long, doc_id string, mentions array<{MENTION}>"

    def run(frames):
        for pdf in frames:
            names = ("start", "end", "rank", "value", "w2", "w1", "v1")
            yield pd.DataFrame({"_row": pdf["_row"], "doc_id": pdf["doc_id"], "mentions": [
                [dict(zip(names, m)) for m in mentions(t if isinstance(t, str) else "")] for t in pdf["text"]]})

    named = docs.select(F.monotonically_increasing_id().alias("_row"),
                        F.col(f"`{doc_id}`").cast("string").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return named.mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def graph(found: DataFrame) -> DataFrame:
    """``value, seed, w2, w1, v1``: distinct (instance, context) pairs; ``seed`` is the rank of
    the instance's base kind, -1 for candidates."""
    each = found.select(F.explode("mentions").alias("m")).select("m.*")
    pairs = each.groupBy("value", "w2", "w1", "v1").agg(F.max("rank").alias("rank"))
    # a text that is a base span somewhere is a seed wherever it stands: the kind of the most contexts, then as listed
    seeds = (pairs.where("rank >= 0").groupBy("value", "rank").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("value").agg(F.max(F.struct("n", (-F.col("rank")).alias("r"))).alias("best"))
             .select("value", (-F.col("best.r")).alias("seed")))
    return salted_lookup_join(pairs.drop("rank"), seeds, ["value"], "left").withColumn("seed", F.coalesce("seed", F.lit(-1)))


def _patterns(w2: str = "w2", w1: str = "w1", v1: str = "v1"):
    return F.explode(F.array(F.concat(F.lit("2:"), w2, F.lit(" "), w1), F.concat(F.lit("1:"), w1),
                             F.concat(F.lit("m:"), w1, F.lit(" "), v1))).alias("pattern")


def trusted_patterns(scored: DataFrame, min_trust: float, min_known: int) -> DataFrame:
    """``pattern, kind, trust`` of accepted patterns, from ``value, w2, w1, v1, kind, score``."""
    members = (scored.select("value", "kind", "score", _patterns()).groupBy("pattern", "value")
               .agg(F.first("kind").alias("kind"), F.first("score").alias("score")))
    per_kind = members.groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("hits"))
    best = per_kind.groupBy("pattern").agg(
        F.sum("n").alias("n"), F.max(F.when(F.col("kind") >= 0, F.struct(
            "hits", (-F.col("kind")).alias("k"), F.col("n").alias("known")))).alias("best"))
    trust = F.expr("best.hits div (n + 1)")
    return (best.where(F.col("best.known") >= min_known)
            .select("pattern", (-F.col("best.k")).alias("kind"), trust.alias("trust"))
            .where(F.col("trust") >= int(min_trust * ONE)))


def discovered(edges: DataFrame, rounds: int = 3, min_trust: float = 0.8, min_known: int = 5,
               min_score: float = 0.8, target_rows: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """Tables ``value, kind, score`` of discovered instances and ``pattern, kind, trust``."""
    spark = edges.sparkSession
    known = spark.createDataFrame([], "value string, kind int, score long")
    patterns = None
    for _ in range(rounds):
        own = salted_lookup_join(edges, known, ["value"], "left", target_rows)
        scored = own.select("value", "w2", "w1", "v1",
                            F.when(F.col("seed") >= 0, F.col("seed")).otherwise(F.coalesce("kind", F.lit(-1))).alias("kind"),
                            F.when(F.col("seed") >= 0, F.lit(ONE)).otherwise(F.coalesce("score", F.lit(0))).alias("score"))
        patterns = stored(trusted_patterns(scored, min_trust, min_known), "patterns")
        open_edges = edges.where("seed < 0")
        total = open_edges.groupBy("value").agg(F.count(F.lit(1)).alias("contexts"))
        hits = salted_lookup_join(open_edges.select("value", "w2", "w1", "v1", _patterns()), patterns, ["pattern"],
                                  "inner", target_rows)
        best = hits.groupBy("value", "w2", "w1", "v1", "kind").agg(F.max("trust").alias("trust"))
        score = (best.groupBy("value", "kind").agg(F.sum("trust").alias("hits")).join(total, "value")
                 .withColumn("score", F.expr("hits div contexts")).where(F.col("score") >= int(min_score * ONE)))
        known = stored(score.groupBy("value").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("b"))
                       .select("value", (-F.col("b.k")).alias("kind"), "b.score"), "discovered")
    return known, patterns


def extract(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``doc_id, base, extra``: sorted arrays of (start, rank, kind, end), one row per row of
    ``docs``. Options as for ``discovered``."""
    found = stored(find_mentions(docs, doc_id, text), "mentions")
    edges = stored(graph(found), "contexts")
    known, _ = discovered(edges, **options)
    names = F.array(*[F.lit(k) for k in KINDS])
    open_ = found.select("_row", F.explode(F.filter("mentions", lambda m: m["rank"] < 0)).alias("m")) \
        .select("_row", "m.start", "m.end", "m.value")
    extra = (salted_lookup_join(open_, known.select("value", "kind"), ["value"], "inner")
             .groupBy("_row").agg(F.array_sort(F.collect_list(F.struct(
                 "start", (F.col("kind") + len(KINDS)).alias("rank"),
                 F.concat(F.lit("context_"), F.get(names, F.col("kind"))).alias("kind"), "end"))).alias("extra")))
    base = F.array_sort(F.transform(F.filter("mentions", lambda m: m["rank"] >= 0), lambda m: F.struct(
        m["start"].alias("start"), m["rank"].alias("rank"), F.get(names, m["rank"]).alias("kind"), m["end"].alias("end"))))
    none = F.expr("cast(array() as array<struct<start:int,rank:int,kind:string,end:int>>)")
    return found.join(extra, "_row", "left").select("doc_id", base.alias("base"),
                                                    F.coalesce("extra", none).alias("extra"))


def span_text(spans):
    """``kind:start:end`` of spans by start, then kind as listed, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(extracted: DataFrame) -> DataFrame:
    """The contract's columns from ``extract``, and the number of discovered spans."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return extracted.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
                            F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
                            span_text(F.concat("base", "extra")).alias("spans"),
                            F.size("extra").cast("long").alias("n_context"))
