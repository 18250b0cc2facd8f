"""Secret scan with corpus-wide ownership frequency (DataFrame functions only).

Candidates are found in every whole text by four patterns. ``assign``, ``access``
and ``hex`` are the base kinds and are always reported. ``owned`` candidates are
long mixed tokens outside every base span; they are reported when the corpus shows
their value under few owners and repositories. For each candidate value (by SHA-256) the
corpus gives the number of distinct owners and of distinct repositories: values seen
under at most ``max_owners`` owners and in at most ``max_repos`` repositories are
owner-specific and look live, others are widely copied examples.

Positions come from ``split`` and ``regexp_extract_all`` of the same pattern: the
pieces between matches and the matches alternate, so their code-point lengths add
up to the offsets.

Defined cases: a null text is empty; a null owner or repository counts as one
owner or repository of its own (the empty name); repeated rows each get their
result; an empty table gives no rows; columns other than the named ones are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwise.llm.common import stored
from chunkwise.operators.skew import salted_lookup_join

#: Fixed patterns of the base kinds. Both letter cases are spelled out, so that no
#: engine folds further Unicode letters into them.
KEYWORDS = ("[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
            "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]")
ASSIGN = rf"""({KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
TOKEN = "[A-Za-z0-9+/_=-]+"
#: kind, pattern, group that holds the value, least length of the value, and a
#: pattern that every text with a kept match contains.
KINDS = (
    ("assign", ASSIGN, 2, 12, KEYWORDS),
    ("access", ACCESS, 0, 18, "AKIA[A-Z0-9]"),
    ("hex", HEX, 0, 16, "[0-9a-f]{16}"),
    ("owned", TOKEN, 0, 20, "[A-Za-z0-9+/_=-]{20}"),
)
RUN = 128
SPAN = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"


def _spans(text: Column, rank: int) -> Column:
    """Kept matches of one kind as structs, in order of start.

    The pieces between matches and the matches are paired and walked once, the offset
    carried along. Spans are gathered in runs of ``RUN``, as appending copies an array.
    """
    kind, pattern, group, least, needed = KINDS[rank]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    pieces = F.arrays_zip(F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
                          F.transform(found, F.length).alias("size"), value.alias("value"))
    mixed = lambda v: (v.rlike("[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]")
                       if kind == "owned" else F.lit(True))
    keep = lambda x: x["size"].isNotNull() & (F.length(x["value"]) >= least) & mixed(x["value"])

    def step(seen: Column, x: Column) -> Column:
        start = seen["at"] + x["gap"]
        end = start + F.coalesce(x["size"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"),
                        F.sha2(x["value"], 256).alias("value"))
        kept, full = keep(x), F.size(seen["run"]) >= RUN
        return F.struct(
            end.alias("at"),
            F.when(~kept, seen["run"]).when(full, F.array(span)).otherwise(F.concat(seen["run"], F.array(span))).alias("run"),
            F.when(kept & full, F.concat(seen["runs"], F.array(seen["run"]))).otherwise(seen["runs"]).alias("runs"))

    spans = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {SPAN})").alias("run"),
                                         F.expr(f"cast(array() as array<{SPAN}>)").alias("runs")),
                        step, lambda seen: F.concat(F.flatten(seen["runs"]), seen["run"]))
    return F.when(text.rlike(needed), spans).otherwise(F.expr(f"cast(array() as {SPAN})"))


def find_candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``_base`` and ``_all``: base spans and mixed tokens, wherever they stand."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = F.concat(*[_spans(body, rank) for rank in range(3)])
    return docs.withColumn("_base", F.array_sort(base)).withColumn("_all", _spans(body, 3))


def outside_base(found: DataFrame) -> DataFrame:
    """``found`` with ``_tokens``, the mixed tokens outside every base span, for ``_all``. Both
    columns should be stored: worked out in the same step, spans would be found anew a token."""
    inside = lambda t, b: (b["start"] < t["end"]) & (t["start"] < b["end"])
    return found.withColumn("_tokens", F.filter("_all", lambda t: ~F.exists("_base", lambda b: inside(t, b)))).drop("_all")


def ownership(candidates: DataFrame) -> DataFrame:
    """``value, n_owners, n_repos`` from rows ``value, owner, repo``.

    Owners are counted first, each with its own repositories, so a value held by
    very many rows is reduced on the map side before either shuffle.
    """
    per_owner = (candidates.groupBy("value", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
                 .groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repos")))
    return per_owner.groupBy("value").agg(F.count(F.lit(1)).alias("n_owners"),
                                          F.sum("repos").alias("n_repos"))


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 owner: str = "source", repo: str = "lang", max_owners: int = 2, max_repos: int = 3,
                 keep: tuple[str, ...] = (), target_rows: int = 100_000) -> DataFrame:
    """One row per input row: ``doc_id``, ``base`` and ``extra`` spans, ``n_live``,
    ``n_copied``, and the columns of ``keep`` gathered in the struct ``kept``.

    ``owner`` names the owner column; a repository is the pair of ``owner`` and
    ``repo``. ``n_live`` counts spans whose value has at most ``max_owners`` owners and
    ``max_repos`` repositories, ``n_copied`` the other ones among base spans and mixed
    tokens.
    """
    named = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"),
                        F.coalesce(F.col(f"`{owner}`").cast("string"), F.lit("")).alias("owner"),
                        F.coalesce(F.col(f"`{repo}`").cast("string"), F.lit("")).alias("repo"),
                        *([F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept")] if keep else []))
    found = find_candidates(named).select("doc_id", "owner", "repo", "_base", "_all", *["kept"][:len(keep)],
                                          F.monotonically_increasing_id().alias("_row"))
    found = outside_base(stored(found, "secrets"))
    spans = found.select("_row", "owner", "repo", F.explode(F.concat("_base", "_tokens")).alias("s"))
    per_row = spans.groupBy("_row", F.col("s.value").alias("value")).agg(
        F.first("owner").alias("owner"), F.first("repo").alias("repo"), F.count(F.lit(1)).alias("n"))
    owned = ownership(per_row).where((F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)).select("value")
    live = salted_lookup_join(per_row.select("_row", "value", "n"),
                              owned.withColumn("live", F.lit(True)), ["value"], "inner", target_rows)
    live = live.groupBy("_row").agg(F.collect_set("value").alias("_live"),
                                    F.sum("n").alias("n_live"))
    out = found.join(live, "_row", "left")
    known = F.coalesce("_live", F.expr("cast(array() as array<string>)"))
    return out.select(
        *["kept"][:len(keep)], "doc_id", F.col("_base").alias("base"),
        F.filter("_tokens", lambda t: F.array_contains(known, t["value"])).alias("extra"),
        F.coalesce("n_live", F.lit(0).cast("long")).alias("n_live"),
        (F.size("_base") + F.size("_tokens") - F.coalesce("n_live", F.lit(0))).cast("long").alias("n_copied"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(scanned: DataFrame) -> DataFrame:
    """The contract's columns from ``scan_secrets``."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.concat("base", "extra")).alias("spans"), "n_live", "n_copied")


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", mask: str = "<secret>",
           **options) -> DataFrame:
    """``docs`` with every reported span (base and owned) of ``text`` replaced by ``mask``.

    Spans that overlap are replaced together. Null texts stay null, and all columns
    and rows are kept.
    """
    scanned = scan_secrets(docs, doc_id, text, keep=tuple(docs.columns), **options)
    body = F.col("kept").getField(text)
    spans = F.array_sort(F.concat("base", "extra"))
    step = lambda a, s: F.struct(
        F.greatest(a["at"], s["end"]).alias("at"),
        F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(
            a["out"], F.substring(body, a["at"] + 1, s["start"] - a["at"]), F.lit(mask))).alias("out"))
    masked = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                         lambda a: F.concat(a["out"], F.substring(body, a["at"] + 1, F.length(body))))
    clean = F.when(F.size(spans) > 0, masked).otherwise(body)
    return scanned.select(*[(clean if c == text else F.col("kept").getField(c)).alias(c)
                            for c in docs.columns])
