"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Views ``documents``, ``embeddings``, ``benchmark``, ``events`` ... are the
driver's parquet tables. Shared steps are CTE fragments built below; the hashed
encoder is expressed sparsely (counts per bucket, joined on bucket), which gives
bit-identical cosine distances to the dense Spark kernel because every operand
is an exact integer until the final sqrt, divide and subtract.
"""

from __future__ import annotations

from chunkwise.functions.text import KEY_PREFIX, WHITESPACE
from chunkwise.operators.rag import DEFAULT_TEMPLATE, _template_parts

DIM = 64
STEP, SIZE = 250, 300


def _words(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, '{WHITESPACE}'), lambda x: x <> '')"


def _bucket(expr: str) -> str:
    return f"CAST(CAST(('0x' || substr(md5(lower({expr})), 1, 8)) AS BIGINT) % {DIM} AS INTEGER)"


def _r6(expr: str) -> str:
    return f"(CASE WHEN round({expr}, 6) = 0 THEN CAST(0 AS DOUBLE) ELSE round({expr}, 6) END)"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


PAGES_V = """pages_v AS (
  SELECT doc_id, source AS file,
         CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS INTEGER) AS page, text
  FROM documents)"""

CHUNKS = [PAGES_V, f"""page_words AS (SELECT file, page, {_words('text')} AS w FROM pages_v)""",
          f"""chunk_starts AS (
  SELECT file, page, w, CAST(unnest(generate_series(0, (len(w) - 1) // {STEP})) AS INTEGER) AS chunk_index
  FROM page_words WHERE len(w) > 0)""",
          f"""chunks AS (
  SELECT file, page, chunk_index,
         w[chunk_index * {STEP} + 1 : chunk_index * {STEP} + {SIZE}] AS cw,
         array_to_string(w[chunk_index * {STEP} + 1 : chunk_index * {STEP} + {SIZE}], ' ') AS chunk
  FROM chunk_starts)"""]

CHUNK_COUNTS = f"""chunk_counts AS (
  SELECT file, page, chunk_index, {_bucket('x')} AS bucket, count(*) AS cnt
  FROM (SELECT file, page, chunk_index, unnest(cw) AS x FROM chunks)
  GROUP BY ALL)"""

QUESTIONS = "questions AS (SELECT item_id AS query_id, text AS query FROM benchmark)"


def _hits(k_fetch: int, k_keep: int | None = None) -> list[str]:
    keep = k_keep if k_keep is not None else k_fetch
    keep = min(keep, k_fetch)
    return CHUNKS + [CHUNK_COUNTS, QUESTIONS, f"""q_counts AS (
  SELECT query_id, {_bucket('x')} AS bucket, count(*) AS cnt
  FROM (SELECT query_id, unnest({_words('query')}) AS x FROM questions)
  GROUP BY ALL)""",
        "q_norm AS (SELECT query_id, sum(cnt * cnt) AS n2 FROM q_counts GROUP BY ALL)",
        "c_norm AS (SELECT file, page, chunk_index, sum(cnt * cnt) AS n2 FROM chunk_counts GROUP BY ALL)",
        """dots AS (
  SELECT q.query_id, c.file, c.page, c.chunk_index, sum(q.cnt * c.cnt) AS dot
  FROM q_counts q JOIN chunk_counts c ON q.bucket = c.bucket GROUP BY ALL)""",
        """scored AS (
  SELECT d.query_id, d.file, d.page, d.chunk_index,
         1 - CAST(d.dot AS DOUBLE) / sqrt(CAST(qn.n2 * cn.n2 AS DOUBLE)) AS distance
  FROM dots d JOIN q_norm qn ON qn.query_id = d.query_id
  JOIN c_norm cn ON cn.file = d.file AND cn.page = d.page AND cn.chunk_index = d.chunk_index)""",
        """ranked AS (
  SELECT query_id, file, page, chunk_index, distance,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 9), file, page, chunk_index) AS INTEGER) AS rank
  FROM scored)""",
        f"""hits AS (
  SELECT r.query_id, r.rank, r.file, r.page, r.chunk_index, c.chunk, r.distance
  FROM ranked r JOIN chunks c ON c.file = r.file AND c.page = r.page AND c.chunk_index = r.chunk_index
  WHERE r.rank <= {keep})"""]


def _context_cte(style: str) -> str:
    if style == "scored":
        line = ("'From ' || file || ' (page ' || CAST(page AS VARCHAR) || ', chunk ' || chunk || "
                "') with similarity ' || printf('%.2f', distance)")
    else:
        line = "'From ' || file || ' (page ' || CAST(page AS VARCHAR) || '): ' || chunk"
    return f"""ctx AS (
  SELECT query_id, string_agg({line}, chr(10) ORDER BY rank) AS context FROM hits GROUP BY query_id)"""


def _prompt_expr(slots: dict[str, str]) -> str:
    parts = [_q(v) if kind == "lit" else f"coalesce(CAST({slots[v]} AS VARCHAR), '')"
             for kind, v in _template_parts(DEFAULT_TEMPLATE)]
    return " || ".join(parts)


RAG_PROMPTS_SELECT = f"""SELECT q.query_id, coalesce(ctx.context, '') AS context,
       {_prompt_expr({'context': "coalesce(ctx.context, '')", 'query': 'q.query'})} AS prompt
FROM questions q LEFT JOIN ctx ON ctx.query_id = q.query_id"""

def _chunks_sized(name: str, size: int, step: int) -> str:
    return f"""{name} AS (
  SELECT file, page, CAST(i AS INTEGER) AS chunk_index,
         array_to_string(w[i * {step} + 1 : i * {step} + {size}], ' ') AS chunk
  FROM (SELECT file, page, w, unnest(generate_series(0, (len(w) - 1) // {step})) AS i
        FROM page_words WHERE len(w) > 0))"""


KEY_COLS = (f"{_q(KEY_PREFIX)} || file || '_page_' || CAST(page AS VARCHAR) || '_chunk_' || chunk AS key, "
            "file, page, chunk_index, chunk")

KEYED = [f"keyed AS (SELECT {KEY_COLS} FROM chunks)",
         _chunks_sized("chunks200", 200, 150),
         f"b1 AS (SELECT {KEY_COLS}, 0 AS seq, 'a' AS payload FROM chunks)",
         f"b2 AS (SELECT {KEY_COLS}, 1 AS seq, 'b' AS payload FROM chunks200)"]
STORE_COLS = "key, file, page, chunk_index, seq, payload"

EMB = "e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
COS = "1 - list_dot_product({a}, {b}) / sqrt(list_dot_product({a}, {a}) * list_dot_product({b}, {b}))"
L2SQ = "pow(list_distance({a}, {b}), 2)"


def _self_knn(metric: str, k: int) -> list[str]:
    dist = (COS if metric == "cosine" else L2SQ).format(a="q.v", b="c.v")
    return [EMB, f"""pairs AS (SELECT q.vec_id AS query_id, c.vec_id AS id, {dist} AS distance FROM e q, e c)""",
            f"""knn AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 9), id) AS INTEGER) AS rank,
         id, distance FROM pairs QUALIFY rank <= {k})"""]


def _knn_select() -> str:
    return f"SELECT query_id, rank, id, {_r6('distance')} AS distance FROM knn"


CENTROIDS = [EMB, """per_dim AS (
  SELECT label, pos, avg(x) AS m
  FROM (SELECT label, unnest(range(0, len(embedding))) AS pos, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings)
  GROUP BY ALL)""", "cents AS (SELECT label, list(m ORDER BY pos) AS centroid FROM per_dim GROUP BY label)",
             """wc AS (SELECT e.vec_id, x.label, e.v AS a, c.centroid AS b
  FROM e JOIN embeddings x ON x.vec_id = e.vec_id JOIN cents c ON c.label = x.label)"""]

SQL: dict[str, str] = {
    "tokenize_words": f"""SELECT doc_id, CAST(len(w) AS INTEGER) AS n_words, array_to_string(w, ' ') AS joined
FROM (SELECT doc_id, {_words('text')} AS w FROM documents)""",
    "chunk_pages": _with(*CHUNKS) + "SELECT file, page, chunk_index, chunk, CAST(len(cw) AS INTEGER) AS n_words FROM chunks",
    "chunk_keys": _with(*CHUNKS, *KEYED) + "SELECT file, page, chunk_index, key, sha256(key) AS key_sha FROM keyed",
    "chunk_preview": _with(*CHUNKS) + """SELECT file, page, chunk_index, substring(chunk, 1, 50) || '...' AS preview50,
       substring(chunk, 1, 200) || '...' AS preview200 FROM chunks""",
    "upsert_latest": _with(*CHUNKS, *KEYED) + f"""SELECT {STORE_COLS} FROM (SELECT * FROM b1 UNION ALL SELECT * FROM b2)
QUALIFY row_number() OVER (PARTITION BY key ORDER BY seq DESC, chunk_index DESC) = 1""",
    "insert_if_absent": _with(*CHUNKS, *KEYED,
                              "f1 AS (SELECT * FROM b1 QUALIFY row_number() OVER (PARTITION BY key ORDER BY seq, chunk_index) = 1)",
                              "f2 AS (SELECT * FROM b2 QUALIFY row_number() OVER (PARTITION BY key ORDER BY seq, chunk_index) = 1)")
    + f"SELECT {STORE_COLS} FROM f1 UNION ALL SELECT {STORE_COLS} FROM f2 WHERE key NOT IN (SELECT key FROM f1)",
    "append_all": _with(*CHUNKS, *KEYED) + f"SELECT {STORE_COLS} FROM b1 UNION ALL SELECT {STORE_COLS} FROM b2",
    "reset_and_create": _with(*CHUNKS) + "SELECT file, count(*) AS n_chunks FROM chunks GROUP BY file",
    "delete_where_file": _with(PAGES_V) + """SELECT file, page, text FROM pages_v
WHERE file IS DISTINCT FROM 'src3' AND file IS DISTINCT FROM '*'""",
    "store_prefix_scan": _with(*CHUNKS) + f"""SELECT * FROM (
  SELECT {_q(KEY_PREFIX)} || file || '_page_' || CAST(page AS VARCHAR) || '_chunk_' || chunk AS id, file, page, chunk_index FROM chunks
  UNION ALL
  SELECT file || '_page_' || CAST(page AS VARCHAR) || '_chunk_' || chunk AS id, file, page, chunk_index FROM chunks)
WHERE starts_with(id, 'doc:')""",
    "scan_text_files": "SELECT source, text FROM documents",
    "extract_file_pages": "SELECT source, text FROM documents",
    "vector_norms": f"""SELECT vec_id, {_r6("sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))")} AS norm,
       CAST(len(embedding) AS INTEGER) AS dim FROM embeddings""",
    "cosine_distance_centroid": _with(*CENTROIDS) + f"SELECT vec_id, label, {_r6(COS.format(a='a', b='b'))} AS distance FROM wc",
    "cosine_similarity_centroid": _with(*CENTROIDS) + f"""SELECT vec_id, label,
       {_r6('list_dot_product(a, b) / sqrt(list_dot_product(a, a) * list_dot_product(b, b))')} AS similarity FROM wc""",
    "l2sq_distance_centroid": _with(*CENTROIDS) + f"SELECT vec_id, label, {_r6(L2SQ.format(a='a', b='b'))} AS distance FROM wc",
    "valid_vectors": f"""WITH blanked AS (
  SELECT vec_id, label,
         CASE WHEN label = 0 THEN NULL WHEN label = 1 THEN CAST([] AS FLOAT[])
              WHEN label = 2 THEN embedding[1:{DIM - 1}] ELSE embedding END AS embedding
  FROM embeddings)
SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS dim FROM blanked
WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(embedding) = {DIM}""",
    "hash_embed": _with(*CHUNKS, CHUNK_COUNTS) + "SELECT file, page, chunk_index, bucket, cnt FROM chunk_counts",
    "embed_batches": _with(*CHUNKS, CHUNK_COUNTS) + "SELECT file, page, chunk_index, bucket, cnt FROM chunk_counts",
    "knn_single": _with(EMB, "q AS (SELECT v AS qv FROM e ORDER BY vec_id LIMIT 1)",
                        f"d AS (SELECT e.vec_id AS id, {COS.format(a='e.v', b='q.qv')} AS distance FROM e, q)")
    + f"""SELECT id, CAST(row_number() OVER (ORDER BY round(distance, 9), id) AS INTEGER) AS rank, {_r6('distance')} AS distance
FROM d QUALIFY rank <= 5""",
    "knn_join_cosine": _with(*_self_knn("cosine", 5)) + _knn_select(),
    "knn_join_l2sq": _with(*_self_knn("l2sq", 5)) + _knn_select(),
    "knn_join_pruned": _with(*_self_knn("l2sq", 5)) + _knn_select(),
    "knn_join_blocked": _with(*_self_knn("cosine", 5)) + _knn_select(),
    "ann_join_full_probe": _with(*_self_knn("cosine", 5)) + _knn_select(),
    "ann_index_writes": _with(EMB, """now AS (SELECT x.vec_id, CASE WHEN x.label = 3 THEN list_reverse(e.v) ELSE e.v END AS v
  FROM embeddings x JOIN e ON e.vec_id = x.vec_id WHERE x.label <> 7)""",
                              f"pairs AS (SELECT q.vec_id AS query_id, c.vec_id AS id, {COS.format(a='q.v', b='c.v')} AS distance FROM e q, now c)",
                              """knn AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 9), id) AS INTEGER) AS rank,
         id, distance FROM pairs QUALIFY rank <= 5)""") + _knn_select(),
    "knn_two_stage": _with(*_hits(5, 3)) + "SELECT query_id, rank, file, page, chunk, distance FROM hits",
    "hits_payload_defaults": _with(*_self_knn("cosine", 3), PAGES_V) + f"""SELECT k.query_id, k.rank,
       coalesce(p.file, 'Unknown file') AS file, coalesce(CAST(p.page AS VARCHAR), 'Unknown page') AS page,
       coalesce(p.text, 'Unknown chunk') AS chunk, {_r6('k.distance')} AS distance
FROM knn k LEFT JOIN pages_v p ON p.doc_id = k.id * 3""",
    "merge_hits": _with(*_hits(5)) + """SELECT query_id, string_agg(chunk, chr(10) ORDER BY rank) AS chunks,
       arg_min(file, rank) AS file, arg_min(page, rank) AS page, min(distance) AS distance,
       CAST(count(*) AS INTEGER) AS n_hits
FROM hits GROUP BY query_id""",
    "context_scored": _with(*_hits(5, 3), _context_cte("scored")) + "SELECT query_id, context FROM ctx",
    "context_plain": _with(*_hits(3), _context_cte("plain")) + "SELECT query_id, context FROM ctx",
    "rag_prompts": _with(*_hits(5, 3), _context_cte("scored")) + RAG_PROMPTS_SELECT,
    "rag_answers": _with(*_hits(5, 3), _context_cte("scored"), "prompts AS (" + RAG_PROMPTS_SELECT + ")")
    + "SELECT query_id, 'answer-' || substr(md5(prompt), 1, 16) AS answer FROM prompts",
    "rag_answers_kept": _with(*_hits(5, 3), _context_cte("scored"), "prompts AS (" + RAG_PROMPTS_SELECT + ")")
    + """SELECT query_id, 'answer-' || substr(md5(prompt), 1, 16) AS answer, true AS answered, true AS timed,
       CAST(1 AS INTEGER) AS tries FROM prompts""",
    "ingest_rejects": _with(f"""files AS (SELECT 'doc' || CAST(doc_id AS VARCHAR) AS file, text,
         coalesce(lang = 'de', false) AND text <> '' AS broken FROM documents)""",
                            f"""file_words AS (SELECT file, {_words('text')} AS w FROM files WHERE NOT broken)""",
                            f"""file_chunks AS (SELECT file, CAST(i AS INTEGER) AS chunk_index,
         array_to_string(w[i * {STEP} + 1 : i * {STEP} + {SIZE}], ' ') AS chunk
  FROM (SELECT file, w, unnest(generate_series(0, (len(w) - 1) // {STEP})) AS i FROM file_words WHERE len(w) > 0))""")
    + f"""SELECT file, CAST(0 AS INTEGER) AS page, chunk_index, chunk,
       CAST(CASE WHEN contains(chunk, '$$$') THEN 0 ELSE {DIM} END AS INTEGER) AS dim,
       CASE WHEN contains(chunk, '$$$') THEN 'encode' END AS failed FROM file_chunks
UNION ALL SELECT file, NULL, NULL, NULL, 0, 'extract' FROM files WHERE broken""",
    "take_until_sentinel": """SELECT user_id, event_id, event_type FROM (
  SELECT *, max(CAST(lower(event_type) = 'error' AS INTEGER)) OVER (
      PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop
  FROM events) WHERE stop = 0""",
    "store_stats": _with(*CHUNKS) + f"""SELECT count(*) AS n_records, CAST({DIM} AS INTEGER) AS min_dim,
       CAST({DIM} AS INTEGER) AS max_dim, count(DISTINCT file) AS n_files,
       CAST(count(*) * {DIM} * 4 AS BIGINT) AS vector_bytes, CAST(sum(strlen(chunk)) AS BIGINT) AS text_bytes
FROM chunks""",
    "ingest_summary": _with(*CHUNKS) + """SELECT file, count(DISTINCT page) AS n_pages, count(*) AS n_chunks,
       CAST(sum(strlen(chunk)) AS BIGINT) AS text_bytes FROM chunks GROUP BY file""",
}

def _l2_hits(k: int) -> list[str]:
    """Dense squared-L2 hits over hashed counts: every (question, chunk) pair,
    since chunks sharing no bucket still have a finite L2 distance."""
    base = _hits(k)
    names = [c.split(" AS (")[0] for c in base]
    keep = base[:names.index("dots") + 1]
    return keep + ["""scored AS (
  SELECT qn.query_id, cn.file, cn.page, cn.chunk_index,
         CAST(qn.n2 + cn.n2 - 2 * coalesce(d.dot, 0) AS DOUBLE) AS distance
  FROM q_norm qn CROSS JOIN c_norm cn
  LEFT JOIN dots d ON d.query_id = qn.query_id AND d.file = cn.file AND d.page = cn.page
                   AND d.chunk_index = cn.chunk_index)"""] + base[names.index("scored") + 1:]


SQL["context_merged"] = _with(*_l2_hits(5)) + """SELECT query_id,
       'From ' || arg_min(file, rank) || ' (page ' || CAST(arg_min(page, rank) AS VARCHAR) || ', chunk '
       || string_agg(chunk, chr(10) ORDER BY rank) || ') with similarity ' || printf('%.2f', min(distance)) AS context
FROM hits GROUP BY query_id"""

SQL["stream_ingest"] = _with(*CHUNKS) + """SELECT chunk_index, chunk FROM chunks
QUALIFY row_number() OVER (PARTITION BY file, page, chunk ORDER BY chunk_index DESC) = 1"""

SQL["store_stats_merged"] = SQL["store_stats"]
SQL["stream_delete"] = _with(*CHUNKS) + """SELECT chunk_index, chunk FROM (
  SELECT * FROM chunks WHERE chunk_index <> 1
  QUALIFY row_number() OVER (PARTITION BY file, page, chunk ORDER BY chunk_index DESC) = 1)
UNION ALL SELECT chunk_index, chunk FROM (
  SELECT c.* FROM chunks c JOIN pages_v p USING (file, page) JOIN documents d USING (doc_id) WHERE d.lang = 'de'
  QUALIFY row_number() OVER (PARTITION BY c.file, c.page, c.chunk ORDER BY c.chunk_index DESC) = 1)"""


def _smoke_hits() -> list[str]:
    from chunkwise.plans.queries import SMOKE_QUESTION
    base = _hits(5)
    names = [c.split(" AS (")[0] for c in base]
    base[names.index("questions")] = f"questions AS (SELECT CAST(0 AS BIGINT) AS query_id, {_q(SMOKE_QUESTION)} AS query)"
    return base


SQL["smoke_search"] = _with(*_smoke_hits()) + """SELECT rank, file, page, chunk_index,
       substring(chunk, 1, 200) || '...' AS preview, distance FROM hits"""

SQL["stream_answers"] = (_with(*_hits(5, 3), _context_cte("scored"), "prompts AS (" + RAG_PROMPTS_SELECT + ")")
                         + "SELECT query_id AS seq, 'answer-' || substr(md5(prompt), 1, 16) AS answer FROM prompts")
