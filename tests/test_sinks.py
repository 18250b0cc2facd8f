"""Store write semantics."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwise.operators import sinks
from chunkwise.session import scratch_path
from chunkwise.sources.store import scan_store

SCHEMA = "key string, chunk_index int, seq int, payload string"


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted(tuple(r) for r in df.select("key", "chunk_index", "seq", "payload").collect())


def test_upsert_and_insert_if_absent_differ(spark):
    b1 = batch(spark, [("k1", 0, 0, "a"), ("k2", 1, 0, "a"), ("k2", 2, 0, "a2")])
    b2 = batch(spark, [("k1", 0, 1, "b"), ("k3", 0, 1, "b")])
    up = sinks.merge_latest(sinks.merge_latest(None, b1, ["key"], ["seq", "chunk_index"]), b2,
                            ["key"], ["seq", "chunk_index"])
    ins = sinks.merge_first(sinks.merge_first(None, b1, ["key"], ["seq", "chunk_index"]), b2,
                            ["key"], ["seq", "chunk_index"])
    assert rows(up) == [("k1", 0, 1, "b"), ("k2", 2, 0, "a2"), ("k3", 0, 1, "b")]
    assert rows(ins) == [("k1", 0, 0, "a"), ("k2", 1, 0, "a"), ("k3", 0, 1, "b")]
    # replaying a batch changes nothing for upsert / insert-if-absent ...
    assert rows(sinks.merge_latest(up, b2, ["key"], ["seq", "chunk_index"])) == rows(up)
    assert rows(sinks.merge_first(ins, b2, ["key"], ["seq", "chunk_index"])) == rows(ins)
    # ... and doubles an append
    ap = sinks.append(None, b2)
    ap2 = sinks.append(ap, b2)
    assert ap2.count() == 2 * ap.count() == 4
    assert ap2.select("id").distinct().count() == 4


def test_delete_where_is_literal(spark):
    df = spark.createDataFrame([("a", 1), ("*", 2), (None, 3)], "file string, n int")
    assert sorted(r["n"] for r in sinks.delete_where(df, "file", "*").collect()) == [1, 3]
    assert sinks.delete_where(df, "file", "zzz").count() == 3


def test_prefix_scan_is_pushed_down(spark):
    path = scratch_path(spark, "t-store")
    df = spark.createDataFrame([("doc::a", 1), ("a", 2), ("doc:b", 3)], "id string, n int")
    sinks.write_store(df, path)
    scanned = scan_store(spark, path, prefix="doc:")
    assert sorted(r["n"] for r in scanned.collect()) == [1, 3]
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(id,doc:)" in plan


def test_reset_create_and_dimension_check(spark):
    table = "t_store_dim"
    sinks.reset_store(spark, table)
    schema = T.StructType([T.StructField("file", T.StringType()),
                           T.StructField("embedding", T.ArrayType(T.FloatType()))])
    sinks.create_store(spark, table, schema, 3, "cosine", location=scratch_path(spark, table))
    sinks.create_store(spark, table, schema, 3, "cosine")   # get-or-create
    ok = spark.createDataFrame([("f", [1.0, 2.0, 3.0])], "file string, embedding array<float>")
    sinks.insert_into_store(spark, table, ok)
    assert spark.table(table).count() == 1
    bad = spark.createDataFrame([("g", [1.0])], "file string, embedding array<float>")
    with pytest.raises(Exception, match="vector length must be 3"):
        sinks.insert_into_store(spark, table, bad)
    assert sinks.reset_store(spark, table) is True
    assert sinks.reset_store(spark, table) is False


def test_bucketed_store_merges_move_only_the_batch(spark):
    b1 = spark.range(600).select(F.concat(F.lit("k"), (F.col("id") % 200).cast("string")).alias("key"),
                                 F.col("id").cast("int").alias("chunk_index"), F.lit(0).alias("seq"),
                                 F.lit("a").alias("payload"))
    b2 = spark.range(300).select(F.concat(F.lit("k"), (F.col("id") % 250).cast("string")).alias("key"),
                                 F.col("id").cast("int").alias("chunk_index"), F.lit(1).alias("seq"),
                                 F.lit("b").alias("payload"))
    base = sinks.merge_latest(None, b1, ["key"], ["seq", "chunk_index"])
    sinks.write_bucketed_store(base, "bk_v0", ["key"], 4, scratch_path(spark, "bk_v0"))
    order = ["seq", "chunk_index"]
    sinks.merge_bucketed(spark, "bk_v0", b2, ["key"], order, True, "bk_up", scratch_path(spark, "bk_up"))
    sinks.merge_bucketed(spark, "bk_v0", b2, ["key"], order, False, "bk_ins", scratch_path(spark, "bk_ins"))
    cols = spark.table("bk_v0").columns
    want_up = sinks.merge_latest(spark.table("bk_v0"), b2, ["key"], order).select(*cols)
    want_ins = sinks.merge_first(spark.table("bk_v0"), b2, ["key"], order).select(*cols)
    assert sorted(map(tuple, spark.table("bk_up").collect())) == sorted(map(tuple, want_up.collect()))
    assert sorted(map(tuple, spark.table("bk_ins").collect())) == sorted(map(tuple, want_ins.collect()))
    # a batch that arrives late leaves newer rows alone
    sinks.merge_bucketed(spark, "bk_up", b1, ["key"], order, True, "bk_late", scratch_path(spark, "bk_late"))
    assert sorted(map(tuple, spark.table("bk_late").collect())) == sorted(map(tuple, want_up.collect()))
    # the stored side of the merge join is read bucketed, with no exchange above it
    picked = sinks._pick(b2.repartition(4, "key"), ["key"], order, latest=True)
    plan = spark.table("bk_v0").join(picked, "key", "full_outer")._jdf.queryExecution() \
        .executedPlan().toString()
    scan_line = [ln for ln in plan.splitlines() if "bk_v0" in ln][0]
    assert "Bucketed: true" in scan_line
    assert plan.count("Exchange") == 1


def test_appended_ids_are_stored(spark):
    path = scratch_path(spark, "append")
    rows = spark.createDataFrame([("a",), ("a",)], "payload string")
    sinks.append_to_store(rows, path)
    store = sinks.append_to_store(rows, path)
    ids = sorted(r.id for r in store.collect())
    assert len(set(ids)) == 4 and ids == sorted(r.id for r in store.collect())
