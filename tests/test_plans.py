"""Physical-plan properties that the scale design relies on."""

import re

import numpy as np
from pyspark.sql import functions as F

from chunkwise.operators import sinks
from chunkwise.operators.knn import ann_join, build_ivf_index, knn_search
from chunkwise.operators.sessions import take_until
from chunkwise.plans import flows

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_knn_streams_the_corpus_without_exchange(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    q = e.select(F.col("vec_id").alias("query_id"), "embedding")
    res = knn_search(q, e.select("vec_id", "embedding"), 5, "cosine", corpus_ids=["vec_id"], dim=64,
                     strategy="broadcast")
    assert res.bounded
    p = plan_of(res.hits)
    kernel = p[p.index("MapInPandas"):]
    assert "Exchange" not in kernel                     # corpus scan feeds the kernel directly
    assert "WindowGroupLimit" in p and "Partial" in p   # top-k cut before the only shuffle
    assert p.count("Exchange") == 1


def test_page_numbers_never_window_over_a_whole_file(spark):
    p = plan_of(flows.chunks(spark, SF))
    windows = [ln for ln in p.splitlines() if "row_number()" in ln]
    assert windows and all("_rng" in ln for ln in windows)


def test_merges_combine_map_side(spark):
    b = spark.createDataFrame([("k", 0, 0, "a")], "key string, chunk_index int, seq int, payload string")
    p = plan_of(sinks.merge_latest(None, b, ["key"], ["seq", "chunk_index"]))
    assert "partial_max" in p and "Window" not in p


def test_sentinel_cut_aggregates_before_joining(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    p = plan_of(take_until(ev, ["user_id"], ["ts", "event_id"], "event_type", "error"))
    assert "partial_min" in p and "Window" not in p


def test_ann_reads_only_probed_cells(spark):
    rng = np.random.default_rng(0)
    pts = np.vstack([rng.normal(loc=c, scale=0.1, size=(40, 3)) for c in (0, 5, 10, 15)])
    c = spark.createDataFrame([(i, pts[i].tolist()) for i in range(len(pts))], "id long, embedding array<double>")
    q = spark.createDataFrame([(1, pts[0].tolist())], "query_id long, embedding array<double>")
    index = build_ivf_index(c, 4, "l2sq", dim=3, seed=1)
    hits = ann_join(q, index, 3, 1)
    p = plan_of(hits)
    scan = [ln for ln in p.splitlines() if "ivf-index" in ln][0]
    assert re.search(r"PartitionFilters: \[[^\]]*\(?cell#\d+ (=|IN) ", scan), scan
    assert hits.count() == 3


def test_hot_file_is_spread_over_tasks(spark):
    """A file holding a third of all pages: a per-file window puts it in one task,
    the range-cut numbering spreads it."""
    from pyspark.sql import Window
    from chunkwise.operators.numbering import row_number_within

    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("f"), (F.col("id") % 97).cast("string")))
        .alias("file"), F.col("id").alias("doc_id"))
    plain = df.withColumn("page", F.row_number().over(Window.partitionBy("file").orderBy("doc_id")))
    ours = row_number_within(df, ["file"], "doc_id", out="page", rows_per_range=1_000)

    def max_share(x):
        # page is referenced, so the numbering cannot be pruned away
        sizes = x.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count(F.lit(1)).alias("count"), F.max("page").alias("m")).collect()
        return max(r["count"] for r in sizes) / n

    # measure the hash layout over 16 partitions, not AQE's merging of tiny ones
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        assert max_share(plain) >= 1 / 3
        assert max_share(ours) < 0.2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)



def test_hot_session_is_salted(spark):
    """A session with a third of all events: its rows join their stop row in
    several tasks, and the result is the same as an unsalted cut."""
    from chunkwise.operators.skew import hot_keys

    n = 30_000
    ev = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50 + 1).alias("user_id"),
        F.col("id").alias("event_id"),
        F.when(F.col("id") == 20_001, F.lit("ERROR"))                 # the hot session's first stop
        .when((F.col("id") % 3 != 0) & (F.col("id") % 997 == 5), F.lit("error"))
        .otherwise(F.lit("view")).alias("event_type"))
    hot = {r["user_id"]: r["_ns"] for r in hot_keys(ev, ["user_id"], 1_000).collect()}
    assert hot == {0: 10}
    got = take_until(ev, ["user_id"], ["event_id"], "event_type", "error", target_rows=1_000)
    want = take_until(ev, ["user_id"], ["event_id"], "event_type", "error", target_rows=n)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.where("user_id = 0").count() == len(range(0, 20_001, 3))


def test_no_registered_query_plans_a_cross_join(spark):
    from chunkwise.plans.queries import QUERIES

    offenders = []
    for name, fn in QUERIES.items():
        if name == "run_compare":          # orchestration of other queries, no plan of its own
            continue
        p = plan_of(fn(spark, SF))
        if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p:
            offenders.append(name)
    assert offenders == []


def test_page_numbering_shuffles_the_text_once(spark):
    """Window, counts and join share their keys, so the rows meet one exchange (none is
    broadcast here, as on a large table)."""
    from chunkwise.operators.numbering import row_number_within

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("source", "doc_id", "text")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = row_number_within(docs, ["source"], "doc_id", out="page", base=0)
        p = numbered._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        nodes = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", p)
        assert nodes and sum("text#" in n for n in nodes) == 1
        nulls = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, None).when(F.col("doc_id") % 3 == 1, "").otherwise("x"))
        got = row_number_within(nulls, ["source"], "doc_id", out="page").groupBy("source").agg(
            F.count(F.lit(1)).alias("n"), F.max("page").alias("m"), F.countDistinct("page").alias("d")).collect()
        assert len(got) == 3 and all(r["n"] == r["m"] == r["d"] for r in got)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_questions_shuffle_neither_vectors_nor_chunk_texts_of_the_store(spark):
    store = flows.ingest(flows.chunks(spark, SF))
    hits = flows.retrieve(flows.questions(spark, SF), store, 5, 3)
    p = hits._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    moved = re.findall(r"\(\d+\) (?:Exchange|FlatMapCoGroupsInPandas)\nInput \[\d+\]: \[([^\]]*)\]", p)
    assert not any("embedding#" in n for n in moved)
    # the payload meets the hits after a semi-join with their ids: whatever moves then is k rows a question
    assert p.count("LeftSemi") >= 1
    same = flows.retrieve(flows.questions(spark, SF), store, 5, 3, strategy="blocked")
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(hits) == key(same)
