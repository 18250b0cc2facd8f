"""The retrieval flow as compositions of operators.

ingest:   pages -> chunks (P1-P3) -> vectors (V5) -> store
question: questions -> vectors -> k nearest chunks (J2/J3) -> payload (J5)
          -> context (G1/G2) -> prompt (G3, every question kept: J4) -> answer (G4)
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwise.operators.chunking import chunk
from chunkwise.operators.encode import DEFAULT_HASH_DIM, HashEncoder, embed
from chunkwise.operators.hits import keep_queries, with_payload
from chunkwise.operators.knn import knn_search
from chunkwise.operators.outside import write_apart
from chunkwise.operators.rag import DEFAULT_TEMPLATE, context, generate, prompt
from chunkwise.session import scratch_path
from chunkwise.sources.files import extract_pages
from chunkwise.sources.tables import pages_view, read_table

CHUNK_IDS = ["file", "page", "chunk_index"]


def chunks(spark: SparkSession, sf_dir: str, size: int = 300, overlap: int = 50) -> DataFrame:
    """``file, page, chunk_index, chunk`` for every page of ``documents``."""
    return chunk(pages_view(spark, sf_dir), "text", size, overlap, keep=["file", "page"])


def encode(df: DataFrame, text: str, dim: int = DEFAULT_HASH_DIM, out: str = "embedding") -> DataFrame:
    """The flow's encoder: the hashed encoder through the pluggable batch path.

    Measured faster than the JVM-only form (word buckets are memoised per task;
    vocabularies are skewed) and identical to it bucket for bucket.
    """
    return embed(df, text, HashEncoder(dim), dim, out)


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items as a batch of typed questions: ``query_id, query``."""
    return read_table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def ingest(chunk_df: DataFrame, dim: int = DEFAULT_HASH_DIM, path: str | None = None,
           encoder: Callable | None = None) -> DataFrame:
    """Write chunks with their vectors as a store table and return it, read back.

    Searching the written store cuts the lineage (a lost executor recomputes
    from the table, not from the documents), and lets the distance stage read
    only ids and vectors while the payload join reads only ids and text.
    """
    spark = chunk_df.sparkSession
    path = path or scratch_path(spark, "chunk-store")
    rows = chunk_df.select(*CHUNK_IDS, "chunk")
    store = embed(rows, "chunk", encoder, dim) if encoder is not None else encode(rows, "chunk", dim)
    store.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def ingest_apart(files: DataFrame, extractor: Callable[[bytes], list[str]], encoder: Callable,
                 dim: int = DEFAULT_HASH_DIM, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Ingest ``file, content`` where a failing file or chunk leaves all others alone.

    One pass and one write. Returns the store (``file, page, chunk_index, chunk,
    embedding``) and the rejected inputs, which have ``error`` too: a file that the
    extractor raised for (null page), or a chunk that the encoder raised for.
    """
    pages = extract_pages(files, extractor, errors="error")
    rows = chunk(pages, "text", keep=["file", "page", "error"], pass_on="error")
    rows = embed(rows, "chunk", encoder, dim, errors="error")
    return write_apart(rows.select(*CHUNK_IDS, "chunk", "embedding", "error"),
                       path or scratch_path(files.sparkSession, "store-apart"))


def retrieve(question_df: DataFrame, store: DataFrame, k_fetch: int = 5,
             k_keep: int | None = None, metric: str = "cosine",
             dim: int = DEFAULT_HASH_DIM, strategy: str = "auto",
             encoder: Callable | None = None) -> DataFrame:
    """Hits with payload: ``query_id, rank, file, page, chunk_index, chunk, distance``.

    ``store`` has ``file, page, chunk_index, chunk, embedding`` (see ``ingest``).
    Questions are embedded with ``encoder`` (the one the store was built with;
    default: the hashed encoder). Fetch ``k_fetch`` and keep the first ``k_keep`` (S3). A
    handful of questions is broadcast, so neither vectors nor chunk texts of the store are
    shuffled; a batch of questions beyond the broadcast limit is searched block by block.
    """
    questions_only = question_df.select("query_id", "query")
    qv = (embed(questions_only, "query", encoder, dim) if encoder is not None
          else encode(questions_only, "query", dim))
    res = knn_search(qv, store.select(*CHUNK_IDS, "embedding"), k_fetch, metric,
                     query_id="query_id", corpus_ids=CHUNK_IDS, dim=dim, strategy=strategy)
    hits = res.hits
    if k_keep is not None:
        hits = hits.where(F.col("rank") <= k_keep)
    return with_payload(hits, store.select(*CHUNK_IDS, "chunk"), CHUNK_IDS,
                        how="left", hits_bounded=res.bounded) \
        .select("query_id", "rank", *CHUNK_IDS, "chunk", "distance")


def rag_prompts(spark: SparkSession, sf_dir: str, style: str = "scored", k_fetch: int = 5,
                k_keep: int | None = 3, template: str = DEFAULT_TEMPLATE,
                store: DataFrame | None = None) -> DataFrame:
    """``query_id, query, context, prompt`` for every benchmark question.

    ``store`` is a written chunk store (see ``ingest``); by default the
    documents are chunked and ingested first.
    """
    qs = questions(spark, sf_dir)
    store = store if store is not None else ingest(chunks(spark, sf_dir))
    hits = retrieve(qs, store, k_fetch, k_keep)
    ctx = context(hits, style)
    return prompt(keep_queries(qs, ctx).withColumn("context", F.coalesce("context", F.lit(""))),
                  template)


def rag_answers(spark: SparkSession, sf_dir: str, client: Callable[[list[str]], list[str]],
                **kw) -> DataFrame:
    return generate(rag_prompts(spark, sf_dir, **kw), client)
