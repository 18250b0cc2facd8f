"""Registered queries: one per operator group of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the driver's tables
(or data Spark derives from them). Columns are aliased to the names used by the
DuckDB oracle in ``chunkwise.plans.oracle``.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwise.functions.text import chunk_key, preview, words
from chunkwise.functions.vectors import (cosine_distance, cosine_similarity, l2_norm,
                                         l2sq_distance)
from chunkwise.operators import metrics as M
from chunkwise.operators import sinks
from chunkwise.operators.chunking import chunk
from chunkwise.operators.coded import build_codes, coded_search
from chunkwise.operators.encode import HashEncoder, embed, hash_counts, hash_vectors
from chunkwise.operators.hits import merge_hits as merge_hits_op
from chunkwise.operators.hits import select_hits, with_defaults, with_payload
from chunkwise.operators.knn import ann_join as ann_join_op
from chunkwise.operators.knn import build_ivf_index, knn, knn_search, valid_vectors
from chunkwise.operators.outside import Once
from chunkwise.operators.pruned_knn import knn_join_pruned as knn_join_pruned_op
from chunkwise.operators.rag import answer_once, context, generate, merged_context
from chunkwise.operators.sessions import take_until
from chunkwise.operators.skew import salted_lookup_join
from chunkwise.operators.vector_index import VectorIndex, create_index, live_cells, search_index, write_batch
from chunkwise.plans import flows
from chunkwise.session import scratch_path
from chunkwise.sources.files import extract_pages, scan_files, text_pages
from chunkwise.sources.store import scan_keyed_store, write_keyed_store
from chunkwise.sources.tables import pages_view, read_table
from chunkwise.streaming.ingest import (compact_store, delete_from_store, ingest_stream, read_store,
                                        run_to_end)
from chunkwise.streaming.questions import answer_stream

DIM = 64
R = 6  # decimals kept for float distances computed in different summation orders


def _r(c) -> F.Column:
    """Round to R decimals; a rounded zero is +0.0 whatever its sign."""
    rounded = F.round(c, R)
    return F.when(rounded == 0, F.lit(0.0)).otherwise(rounded)


# --- text and keys ---------------------------------------------------------------

def tokenize_words(spark: SparkSession, sf: str) -> DataFrame:
    ws = words("text")
    return read_table(spark, sf, "documents").select(
        "doc_id", F.size(ws).cast("int").alias("n_words"), F.array_join(ws, " ").alias("joined"))


def chunk_pages(spark: SparkSession, sf: str) -> DataFrame:
    return flows.chunks(spark, sf).select(
        "file", "page", "chunk_index", "chunk", F.size(words("chunk")).cast("int").alias("n_words"))


def chunk_keys(spark: SparkSession, sf: str) -> DataFrame:
    key = chunk_key("file", "page", "chunk")
    return flows.chunks(spark, sf).select(
        "file", "page", "chunk_index", key.alias("key"), F.sha2(key, 256).alias("key_sha"))


def chunk_preview(spark: SparkSession, sf: str) -> DataFrame:
    return flows.chunks(spark, sf).select(
        "file", "page", "chunk_index", preview("chunk", 50).alias("preview50"),
        preview("chunk", 200).alias("preview200"))


# --- sinks -------------------------------------------------------------------------

def _batches(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two ingests of every page: 300-word windows (seq 0, payload 'a'), then a
    re-ingest with 200-word windows (seq 1, payload 'b'). Pages short enough to
    give the same chunk text collide on the key; longer pages add new keys."""
    pages = pages_view(spark, sf)
    cols = ["key", "file", "page", "chunk_index", "chunk", "seq", "payload"]
    out = []
    for seq, size, payload in ((0, 300, "a"), (1, 200, "b")):
        ch = chunk(pages, "text", size, 50, keep=["file", "page"])
        out.append(ch.withColumn("key", chunk_key("file", "page", "chunk"))
                   .withColumn("seq", F.lit(seq)).withColumn("payload", F.lit(payload)).select(*cols))
    return out[0], out[1]


def _store_cols(df: DataFrame) -> DataFrame:
    return df.select("key", "file", "page", "chunk_index", "seq", "payload")


def upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    b1, b2 = _batches(spark, sf)
    store = sinks.merge_latest(None, b1, ["key"], ["seq", "chunk_index"])
    store = sinks.merge_latest(store, b2, ["key"], ["seq", "chunk_index"])
    return _store_cols(store)


def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    b1, b2 = _batches(spark, sf)
    store = sinks.merge_first(None, b1, ["key"], ["seq", "chunk_index"])
    store = sinks.merge_first(store, b2, ["key"], ["seq", "chunk_index"])
    return _store_cols(store)


def append_all(spark: SparkSession, sf: str) -> DataFrame:
    b1, b2 = _batches(spark, sf)
    path = scratch_path(spark, "append")
    sinks.append_to_store(b1, path)
    return _store_cols(sinks.append_to_store(b2, path))


def delete_where_file(spark: SparkSession, sf: str) -> DataFrame:
    pages = pages_view(spark, sf)
    kept = sinks.delete_where(sinks.delete_where(pages, "file", "src3"), "file", "*")
    return kept.select("file", "page", "text")


def reset_and_create(spark: SparkSession, sf: str) -> DataFrame:
    """Drop, declare, fill (dimension-checked) and read back a store table."""
    table = f"chunk_store_{uuid.uuid4().hex[:12]}"
    sinks.reset_store(spark, table)
    schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("page", T.IntegerType()),
                           T.StructField("chunk_index", T.IntegerType()), T.StructField("chunk", T.StringType()),
                           T.StructField("embedding", T.ArrayType(T.FloatType()))])
    path = scratch_path(spark, table)
    sinks.create_store(spark, table, schema, DIM, "cosine", location=path)
    sinks.insert_into_store(spark, table, hash_vectors(flows.chunks(spark, sf), "chunk", DIM))
    sinks.reset_store(spark, table)  # the catalog forgets the table, its files at ``path`` stay
    return spark.read.parquet(path).groupBy("file").agg(F.count(F.lit(1)).alias("n_chunks"))


def store_prefix_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Keys written with and without the index prefix; the scan sees the former."""
    ch = flows.chunks(spark, sf)
    rows = (ch.select(chunk_key(prefix="doc::").alias("id"), "file", "page", "chunk_index")
            .unionByName(ch.select(chunk_key(prefix="").alias("id"), "file", "page", "chunk_index")))
    path = write_keyed_store(rows, scratch_path(spark, "prefix-store"), rows_per_file=20_000)
    return scan_keyed_store(spark, path, prefix="doc:")


PAGES_PER_FILE = 4_096


def _text_files(spark: SparkSession, sf: str) -> str:
    """Write ``documents`` as text files, one folder per source, pages separated
    by form feeds (range-partitioned, so a large source spans many files; a file, which is
    read whole, has at most ``PAGES_PER_FILE`` pages)."""
    path = scratch_path(spark, "text-files")
    (read_table(spark, sf, "documents")
     .repartitionByRange("source", "doc_id").sortWithinPartitions("source", "doc_id")
     .select("source", "text").write.partitionBy("source")
     .option("lineSep", "\u000c").option("maxRecordsPerFile", PAGES_PER_FILE).text(path))
    return path


def scan_text_files(spark: SparkSession, sf: str) -> DataFrame:
    """O1 + O2: list the text files and split them back into pages."""
    files = scan_files(spark, _text_files(spark, sf), suffix=".txt")
    return text_pages(files, keep=["source"]).select("source", "text")


def form_feed_pages(content: bytes) -> list[str]:
    """Pages of a text file; a form feed ends a page."""
    return content.decode("utf-8").removesuffix("\f").split("\f")


def extract_file_pages(spark: SparkSession, sf: str) -> DataFrame:
    """O1 + O2 with a caller's extractor (bytes to pages, in Arrow batches)."""
    files = scan_files(spark, _text_files(spark, sf), suffix=".txt")
    pages = extract_pages(files, form_feed_pages)
    return pages.select(F.regexp_extract("file", "source=([^/]*)/", 1).alias("source"), "text")


class Picky(HashEncoder):
    """The hashed encoder, raising for texts with '$$$' (to show that others go on)."""

    def __call__(self, texts: list[str]):
        if any("$$$" in t for t in texts):
            raise ValueError("cannot encode '$$$'")
        return super().__call__(texts)


def ingest_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """O2 + V5 + P13: every document as a file, the German ones in an encoding that the
    extractor cannot read, and an encoder that raises for some chunks. All rows of the
    store and all rejected inputs, after one write."""
    docs = read_table(spark, sf, "documents")
    content = F.when(F.col("lang") == "de", F.encode("text", "UTF-16")).otherwise(F.encode("text", "UTF-8"))
    files = docs.select(F.concat(F.lit("doc"), F.col("doc_id")).alias("file"), content.alias("content"))
    store, rejects = flows.ingest_apart(files, form_feed_pages, Once(lambda: Picky(DIM), f"picky-{DIM}"), DIM)
    cols = ["file", "page", "chunk_index", "chunk"]
    failed = F.when(F.col("page").isNull(), F.lit("extract")).otherwise(F.lit("encode"))
    return store.select(*cols, F.size("embedding").alias("dim"), F.lit(None).cast("string").alias("failed")) \
        .unionByName(rejects.select(*cols, F.lit(0).alias("dim"), failed.alias("failed")))


# --- vectors -------------------------------------------------------------------------

def _embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "embeddings")


def vector_norms(spark: SparkSession, sf: str) -> DataFrame:
    e = _embeddings(spark, sf)
    return e.select("vec_id", _r(l2_norm("embedding")).alias("norm"),
                    F.size("embedding").cast("int").alias("dim"))


def _with_centroid(spark: SparkSession, sf: str) -> DataFrame:
    """Each vector with the mean vector of its label (aggregated per (label, dim))."""
    e = _embeddings(spark, sf)
    per_dim = (e.select("label", F.posexplode("embedding").alias("pos", "x"))
               .groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("m")))
    cents = per_dim.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("centroid"))
    return salted_lookup_join(e, cents, ["label"], "inner")


def cosine_distance_centroid(spark: SparkSession, sf: str) -> DataFrame:
    return _with_centroid(spark, sf).select(
        "vec_id", "label", _r(cosine_distance("embedding", "centroid")).alias("distance"))


def cosine_similarity_centroid(spark: SparkSession, sf: str) -> DataFrame:
    return _with_centroid(spark, sf).select(
        "vec_id", "label", _r(cosine_similarity("embedding", "centroid")).alias("similarity"))


def l2sq_distance_centroid(spark: SparkSession, sf: str) -> DataFrame:
    return _with_centroid(spark, sf).select(
        "vec_id", "label", _r(l2sq_distance("embedding", "centroid")).alias("distance"))


def _vectors_with_blanks(spark: SparkSession, sf: str) -> DataFrame:
    """Label 0: no vector, label 1: empty vector, label 2: one component short."""
    e = _embeddings(spark, sf)
    vec = (F.when(F.col("label") == 0, F.lit(None).cast("array<float>"))
           .when(F.col("label") == 1, F.array().cast("array<float>"))
           .when(F.col("label") == 2, F.slice("embedding", 1, DIM - 1))
           .otherwise(F.col("embedding")))
    return e.select("vec_id", "label", vec.alias("embedding"))


def valid_vectors_q(spark: SparkSession, sf: str) -> DataFrame:
    v = valid_vectors(_vectors_with_blanks(spark, sf), "embedding", DIM)
    return v.select("vec_id", "label", F.size("embedding").cast("int").alias("dim"))


def hash_embed(spark: SparkSession, sf: str) -> DataFrame:
    return hash_counts(flows.chunks(spark, sf), "chunk", ["file", "page", "chunk_index"], DIM)


def embed_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The pluggable encoder path (Python encoder in Arrow batches), shown sparse."""
    v = embed(flows.chunks(spark, sf), "chunk", HashEncoder(DIM), DIM)
    return (v.select("file", "page", "chunk_index", F.posexplode("embedding").alias("bucket", "x"))
            .where(F.col("x") > 0)
            .select("file", "page", "chunk_index", F.col("bucket").cast("int").alias("bucket"),
                    F.col("x").cast("long").alias("cnt")))


# --- search -------------------------------------------------------------------------

def _hits_out(hits: DataFrame) -> DataFrame:
    return hits.select("query_id", F.col("rank").cast("int").alias("rank"),
                       F.col("vec_id").alias("id"), _r("distance").alias("distance"))


def knn_single(spark: SparkSession, sf: str) -> DataFrame:
    """The vector with the smallest id searched against every vector."""
    e = _embeddings(spark, sf)
    first = e.orderBy("vec_id").select("embedding").first()["embedding"]
    top = knn(e, first, 5, "cosine", ids=["vec_id"])
    return top.select(F.col("vec_id").alias("id"), F.col("rank").cast("int").alias("rank"),
                      _r("distance").alias("distance"))


# --- fixed values: the sentence searched right after ingest ---------------------
SMOKE_QUESTION = "Efficient search in vector databases"
# ------------------------------------------------------------------------------


def smoke_search(spark: SparkSession, sf: str) -> DataFrame:
    """J1 + P7 + P8: one fixed sentence against the whole chunk store, five best
    chunks shown as 200-character previews."""
    store = flows.ingest(flows.chunks(spark, sf))
    vector = HashEncoder(DIM)([SMOKE_QUESTION])[0].tolist()
    top = knn(store, vector, 5, "cosine", ids=flows.CHUNK_IDS)
    return top.select(F.col("rank").cast("int").alias("rank"), "file", "page", "chunk_index",
                      preview("chunk", 200).alias("preview"), "distance")


def _self_queries(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    e = _embeddings(spark, sf)
    return e.select(F.col("vec_id").alias("query_id"), "embedding"), e.select("vec_id", "embedding")


def knn_join_cosine(spark: SparkSession, sf: str, strategy: str = "blocked") -> DataFrame:
    q, c = _self_queries(spark, sf)
    return _hits_out(knn_search(q, c, 5, "cosine", corpus_ids=["vec_id"], dim=DIM,
                                strategy=strategy).hits)


def knn_join_l2sq(spark: SparkSession, sf: str, strategy: str = "blocked") -> DataFrame:
    q, c = _self_queries(spark, sf)
    return _hits_out(knn_search(q, c, 5, "l2sq", corpus_ids=["vec_id"], dim=DIM,
                                strategy=strategy).hits)


def knn_join_blocked(spark: SparkSession, sf: str) -> DataFrame:
    """The blocked (no-broadcast) physical form of J2; same rows as knn_join_cosine."""
    q, c = _self_queries(spark, sf)
    return _hits_out(knn_search(q, c, 5, "cosine", corpus_ids=["vec_id"], dim=DIM,
                                strategy="blocked").hits)


def knn_two_stage(spark: SparkSession, sf: str) -> DataFrame:
    """S3 + P8: fetch 5, keep 3, hit fields with the text payload."""
    hits = flows.retrieve(flows.questions(spark, sf), flows.ingest(flows.chunks(spark, sf)), 5, 3)
    return select_hits(hits.withColumn("rank", F.col("rank").cast("int")))


def _ann(spark: SparkSession, sf: str, cells: int, nprobe: int) -> DataFrame:
    q, c = _self_queries(spark, sf)
    index = build_ivf_index(c, cells, "cosine", ids=["vec_id"], dim=DIM, seed=7)
    return _hits_out(ann_join_op(q, index, 5, nprobe))


def knn_join_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """J2 exact with pivots and triangle inequalities; the same rows as knn_join_l2sq."""
    q, c = _self_queries(spark, sf)
    return _hits_out(knn_join_pruned_op(q, c, 5, "l2sq", corpus_ids=["vec_id"], dim=DIM))


CODE_GROUPS = 16


def knn_coded(spark: SparkSession, sf: str) -> DataFrame:
    """S3 with a coded first stage: 20 fetched by 16-byte codes, 5 kept by exact distance
    (the tests assert a recall of 0.9)."""
    q, c = _self_queries(spark, sf)
    store = build_codes(c, "cosine", ids=["vec_id"], dim=DIM, groups=CODE_GROUPS)
    return _hits_out(coded_search(q, store, c, 20, 5))


#: Share of the cells that the registered approximate search probes, over both tables. The
#: test vectors have no structure at all; vectors of real texts need far less.
PROBE_SHARE = 0.185


def _new_index(c: DataFrame) -> VectorIndex:
    return create_index(c, scratch_path(c.sparkSession, "vector-index"), c.count(), "cosine", ids=["vec_id"], dim=DIM, seed=7)


def ann_join(spark: SparkSession, sf: str, compared: list | None = None) -> DataFrame:
    """J3 approximate: two overlapping tables of cells, ``PROBE_SHARE`` of the cells probed
    (the tests assert a recall of 0.9 with at most a fifth of the pairs compared)."""
    q, c = _self_queries(spark, sf)
    index = _new_index(c)
    write_batch(index, c, breadth=None)
    cells = live_cells(spark, index).count()
    return _hits_out(search_index(q, index, 5, math.ceil(PROBE_SHARE * cells / index.tables ** 2), breadth=None,
                                  compared=compared))


def ann_index_writes(spark: SparkSession, sf: str) -> DataFrame:
    """J3 + O4 + O9: an index after three batches and a delete, all cells probed. The second
    batch adds vectors, the third replaces those of label 3 by their reverse, and the ids of
    label 7 are deleted."""
    e = _embeddings(spark, sf).select("vec_id", "label", "embedding")
    index = _new_index(e.select("vec_id", "embedding"))
    write_batch(index, e.where("label < 5").select("vec_id", "embedding"))
    write_batch(index, e.where("label >= 5").select("vec_id", "embedding"))
    write_batch(index, e.where("label = 3").select("vec_id", F.reverse("embedding").alias("embedding")),
                delete=e.where("label = 7").select("vec_id"))
    return _hits_out(search_index(e.select(F.col("vec_id").alias("query_id"), "embedding"), index, 5, None))


def ann_join_full_probe(spark: SparkSession, sf: str) -> DataFrame:
    """J3 probing every cell: equals exact J2."""
    return _ann(spark, sf, 8, 8)


def hits_payload_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """J5 + P9: hits carry document payload (doc_id = 3 x vec_id); missing -> defaults."""
    q, c = _self_queries(spark, sf)
    res = knn_search(q, c, 3, "cosine", corpus_ids=["vec_id"], dim=DIM)
    hits = res.hits.withColumn("doc_id", F.col("vec_id") * 3)
    payload = pages_view(spark, sf, keep_doc_id=True).select(
        "doc_id", "file", "page", F.col("text").alias("chunk"))
    joined = with_payload(hits, payload, ["doc_id"], how="left", hits_bounded=res.bounded)
    out = with_defaults(joined.select("query_id", "rank", "file", "page", "chunk", "distance"))
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "file", "page",
                      "chunk", _r("distance").alias("distance"))


def merge_hits(spark: SparkSession, sf: str) -> DataFrame:
    """A1: five hits per question merged into one record."""
    hits = flows.retrieve(flows.questions(spark, sf), flows.ingest(flows.chunks(spark, sf)), 5)
    m = merge_hits_op(hits)
    return m.select("query_id", F.array_join("chunks", "\n").alias("chunks"), "file", "page",
                    "distance", "n_hits")


def context_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Squared-L2 search, five hits merged into one record per question, one scored line."""
    hits = flows.retrieve(flows.questions(spark, sf), flows.ingest(flows.chunks(spark, sf)), 5,
                          metric="l2sq")
    return merged_context(merge_hits_op(hits))


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Streaming ingest of the documents written as text files, read back with
    upsert semantics."""
    store = scratch_path(spark, "stream-store")
    run_to_end(ingest_stream(spark, _text_files(spark, sf), store, suffix=".txt", dim=DIM))
    return read_store(spark, store, "upsert").select("chunk_index", "chunk")


def stream_delete(spark: SparkSession, sf: str) -> DataFrame:
    """O9 in the streaming log: documents ingested, the chunks of index 1 deleted, then the
    German documents ingested once more by another stream, which the delete leaves alone."""
    store = scratch_path(spark, "stream-store")
    run_to_end(ingest_stream(spark, _text_files(spark, sf), store, suffix=".txt", dim=DIM))
    delete_from_store(spark, store, "chunk_index", 1)
    again = scratch_path(spark, "more-text-files")
    (read_table(spark, sf, "documents").where("lang = 'de'").select("source", "text")
     .write.partitionBy("source").option("lineSep", "\u000c").option("maxRecordsPerFile", PAGES_PER_FILE).text(again))
    run_to_end(ingest_stream(spark, again, store, suffix=".txt", dim=DIM))
    compacted = compact_store(spark, store, scratch_path(spark, "compacted"))
    return read_store(spark, compacted, "upsert").select("chunk_index", "chunk")


def stream_answers(spark: SparkSession, sf: str) -> DataFrame:
    """The question loop as a stream: benchmark questions arrive as JSON lines
    (one session), are answered against the ingested chunk store, and the
    answers are read back."""
    qdir = scratch_path(spark, "question-files")
    (read_table(spark, sf, "benchmark")
     .select(F.lit("bench").alias("session"), F.col("item_id").alias("seq"), F.col("text").alias("query"))
     .write.json(qdir))
    store = flows.ingest(flows.chunks(spark, sf))
    out = scratch_path(spark, "answers")
    run_to_end(answer_stream(spark, qdir, store, out, stub_client))
    return spark.read.parquet(out).select("seq", "answer")


def context_scored(spark: SparkSession, sf: str) -> DataFrame:
    hits = flows.retrieve(flows.questions(spark, sf), flows.ingest(flows.chunks(spark, sf)), 5, 3)
    return context(hits, "scored")


def context_plain(spark: SparkSession, sf: str) -> DataFrame:
    hits = flows.retrieve(flows.questions(spark, sf), flows.ingest(flows.chunks(spark, sf)), 3)
    return context(hits, "plain")


def rag_prompts(spark: SparkSession, sf: str) -> DataFrame:
    return flows.rag_prompts(spark, sf).select("query_id", "context", "prompt")


def stub_client(prompts: list[str]) -> list[str]:
    """A deterministic stand-in for a language model (SQL: 'answer-' || md5 prefix)."""
    return ["answer-" + hashlib.md5(p.encode("utf-8")).hexdigest()[:16] for p in prompts]


def upper_client(prompts: list[str]) -> list[str]:
    """A second stand-in, so that runs over two models can be compared."""
    return [p[-200:].upper() for p in prompts]


def rag_answers(spark: SparkSession, sf: str) -> DataFrame:
    return generate(flows.rag_prompts(spark, sf), stub_client).select("query_id", "answer")


def unreachable(prompts: list[str]) -> list[str]:
    raise ConnectionError("no model is there")


def rag_answers_kept(spark: SparkSession, sf: str) -> DataFrame:
    """G4 + M3: answers kept by prompt, with the seconds of their call. The second run finds
    every answer in the store and calls nothing (its client always raises)."""
    prompts, path = flows.rag_prompts(spark, sf), scratch_path(spark, "kept-answers")
    answer_once(prompts, stub_client, path, model="stub")
    again = answer_once(prompts, unreachable, path, model="stub")
    return again.select("query_id", "answer", F.col("error").isNull().alias("answered"),
                        (F.col("seconds") >= 0).alias("timed"), "tries")


# --- sessions and metrics --------------------------------------------------------------

def take_until_sentinel(spark: SparkSession, sf: str) -> DataFrame:
    ev = read_table(spark, sf, "events")
    return take_until(ev, ["user_id"], ["ts", "event_id"], "event_type", "ERROR") \
        .select("user_id", "event_id", "event_type")


def store_stats(spark: SparkSession, sf: str) -> DataFrame:
    return M.store_stats(flows.encode(flows.chunks(spark, sf), "chunk", DIM))


def store_stats_merged(spark: SparkSession, sf: str) -> DataFrame:
    """A3 over ten batches, from the statistics that each write left behind."""
    rows, path = flows.encode(flows.chunks(spark, sf), "chunk", DIM), scratch_path(spark, "batches")
    vectors = scratch_path(spark, "vectors")
    rows.withColumn("batch", F.pmod(F.xxhash64("file", "page"), F.lit(10))).write.partitionBy("batch").parquet(vectors)
    for i in range(10):
        batch = spark.read.parquet(vectors).where(F.col("batch") == i).drop("batch")
        M.write_with_stats(batch, path, f"seq={i}")
    return M.merged_stats(spark, path)


def ingest_summary(spark: SparkSession, sf: str) -> DataFrame:
    return M.ingest_summary(flows.chunks(spark, sf))


def run_compare(spark: SparkSession, sf: str) -> DataFrame:
    """M1-M4: ingest the chunked documents under each write mode, then answer the
    benchmark questions from that store; every run is timed and compared."""
    log = scratch_path(spark, "run-log")
    vecs = flows.encode(flows.chunks(spark, sf), "chunk", DIM).withColumn("key", chunk_key())
    modes = {
        "upsert": lambda df: sinks.merge_latest(None, df, ["key"], ["chunk_index"]),
        "insert_if_absent": lambda df: sinks.merge_first(None, df, ["key"], ["chunk_index"]),
        "append": lambda df: sinks.append(None, df),
    }
    for store, op in modes.items():
        rid = f"{store}-{uuid.uuid4().hex[:8]}"
        path = scratch_path(spark, rid)
        records = [M.timed_write(op(vecs), path, rid, store, "hash64", "stub")]
        stored = spark.read.parquet(path).select(*flows.CHUNK_IDS, "chunk", "embedding")
        for llm, client in (("stub", stub_client), ("upper", upper_client)):
            records.append(M.timed_answers(
                lambda: generate(flows.rag_prompts(spark, sf, store=stored), client),
                scratch_path(spark, f"answers-{rid}-{llm}"), f"{rid}-{llm}", store, "hash64", llm))
        M.append_runs(spark, records, log)
    return M.compare(M.read_runs(spark, log)).select("store", "encoder", "llm", "phase", "runs", "rows",
                                                       "bytes", "avg_seconds")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "tokenize_words": tokenize_words,
    "chunk_pages": chunk_pages,
    "chunk_keys": chunk_keys,
    "chunk_preview": chunk_preview,
    "upsert_latest": upsert_latest,
    "insert_if_absent": insert_if_absent,
    "append_all": append_all,
    "reset_and_create": reset_and_create,
    "delete_where_file": delete_where_file,
    "store_prefix_scan": store_prefix_scan,
    "scan_text_files": scan_text_files,
    "extract_file_pages": extract_file_pages,
    "ingest_rejects": ingest_rejects,
    "stream_ingest": stream_ingest,
    "vector_norms": vector_norms,
    "cosine_distance_centroid": cosine_distance_centroid,
    "cosine_similarity_centroid": cosine_similarity_centroid,
    "l2sq_distance_centroid": l2sq_distance_centroid,
    "valid_vectors": valid_vectors_q,
    "hash_embed": hash_embed,
    "embed_batches": embed_batches,
    "knn_single": knn_single,
    "smoke_search": smoke_search,
    "knn_join_cosine": knn_join_cosine,
    "knn_join_l2sq": knn_join_l2sq,
    "knn_join_blocked": knn_join_blocked,
    "knn_join_pruned": knn_join_pruned,
    "knn_two_stage": knn_two_stage,
    "knn_coded": knn_coded,
    "ann_join": ann_join,
    "ann_join_full_probe": ann_join_full_probe,
    "ann_index_writes": ann_index_writes,
    "hits_payload_defaults": hits_payload_defaults,
    "merge_hits": merge_hits,
    "context_merged": context_merged,
    "context_scored": context_scored,
    "context_plain": context_plain,
    "rag_prompts": rag_prompts,
    "rag_answers": rag_answers,
    "rag_answers_kept": rag_answers_kept,
    "stream_delete": stream_delete,
    "stream_answers": stream_answers,
    "take_until_sentinel": take_until_sentinel,
    "store_stats": store_stats,
    "store_stats_merged": store_stats_merged,
    "ingest_summary": ingest_summary,
    "run_compare": run_compare,
}
