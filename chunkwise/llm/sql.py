"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from chunkwise.llm.secret_scan import ACCESS, ASSIGN, HEX, TOKEN

_WORD = r"[^\x20\x09-\x0D]+"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _kind(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    p = _quoted(pattern)
    return f"""
    SELECT rid, owner, repo, {rank} AS rank, '{kind}' AS kind, m[i] AS found, v[i] AS value,
           list_sum(list_transform(g[1:i], lambda x: length(x)))
             + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s
    FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i
          FROM (SELECT rid, owner, repo, string_split_regex(t, {p}) AS g,
                       regexp_extract_all(t, {p}, 0) AS m, regexp_extract_all(t, {p}, {group}) AS v
                FROM d))
    WHERE length(v[i]) >= {least}"""


OP1 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
                  coalesce(source, '') AS owner, coalesce(lang, '') AS repo FROM documents),
base AS ({_kind(0, 'assign', ASSIGN, 2, 12)} UNION ALL {_kind(1, 'access', ACCESS, 0, 18)}
         UNION ALL {_kind(2, 'hex', HEX, 0, 16)}),
tokens AS (SELECT * FROM ({_kind(3, 'owned', TOKEN, 0, 20)}) t
  WHERE regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = t.rid AND b.s < t.s + length(t.found)
                                           AND t.s < b.s + length(b.found))),
cand AS (SELECT * FROM base UNION ALL SELECT * FROM tokens),
live AS (SELECT value FROM cand GROUP BY value HAVING count(DISTINCT owner) <= 2 AND count(DISTINCT (owner, repo)) <= 3),
flagged AS (SELECT c.*, c.value IN (SELECT value FROM live) AS is_live,
                   kind || ':' || s || ':' || (s + length(found)) AS span FROM cand c),
per AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign,
               count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
               coalesce(string_agg(span, ',' ORDER BY s, rank) FILTER (rank < 3), '') AS base,
               coalesce(string_agg(span, ',' ORDER BY s, rank) FILTER (rank < 3 OR is_live), '') AS spans,
               count(*) FILTER (is_live) AS n_live, count(*) FILTER (NOT is_live) AS n_copied
        FROM flagged GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN per USING (rid)
"""

OP4 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '{_WORD}') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM d),
win AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n
        FROM (SELECT rid, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
              FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w))),
rep AS (SELECT rid, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM win WHERE n > 1) GROUP BY rid),
tops AS (SELECT rid, max(n) AS top FROM (SELECT rid, x, count(*) AS n
           FROM (SELECT rid, unnest(words) AS x FROM w) GROUP BY rid, x) GROUP BY rid),
m AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(top, 0) AS top,
             length(regexp_replace(t, '[^A-Z]', '', 'g')) AS uppers,
             length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS letters,
             len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS lettered
      FROM w LEFT JOIN rep USING (rid) LEFT JOIN tops USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 5 * n_symbols > n_words
            OR (2 * uppers > letters AND letters > 0) OR 10 * lettered < 6 * n_words
            OR 4 * top > n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM m
"""

OP6 = rf"""
WITH RECURSIVE
d AS (SELECT row_number() OVER () AS rid, doc_id,
             regexp_extract_all(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
s AS (SELECT DISTINCT rid, array_to_string(w[i:i + 3], ' ') AS g
      FROM (SELECT rid, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
link AS (SELECT a.rid AS u, b.rid AS v FROM s a JOIN s b ON a.g = b.g AND a.rid <> b.rid
         JOIN n x ON x.rid = a.rid JOIN n y ON y.rid = b.rid
         GROUP BY a.rid, b.rid, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach AS (SELECT rid AS u, rid AS v FROM d UNION SELECT r.u, l.v FROM reach r JOIN link l ON l.u = r.v)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (rid)
JOIN (SELECT r.u AS rid, min(t.doc_id) AS component_id FROM reach r JOIN d t ON t.rid = r.v GROUP BY r.u) c USING (rid)
"""

OP11 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT rid) >= 30),
l AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT d.lang, d.source, any_value(coalesce(s.n, 0)) AS n
      FROM d LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) s USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS cnt,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.n + 5 * l.v)::HUGEINT AS p,
             1 + (1000000000::HUGEINT * (k.n + 5)) // (l.n + 5 * l.v)::HUGEINT AS q
      FROM g JOIN l USING (lang) JOIN kept k USING (lang)
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
x AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE cnt > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

_CRC = """xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''),
        lambda x: ascii(x)::BIGINT), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"""
_TAB = """list_transform(range(0, 256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""


def _leaf(text: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars", text)
    return "sha256(" + " || ".join(
        f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')" for f in fields) + ")"


def _tree(name: str, leaves: str, levels: int) -> str:
    """CTEs of a tree of eight: {name}0.. (tree, pos, h), {name}s0.. (siblings), {name}top."""
    out = [f"{name}0 AS MATERIALIZED ({leaves})"]
    for k in range(levels):
        out.append(f"""{name}n{k} AS MATERIALIZED (SELECT tree FROM {name}{k} GROUP BY tree HAVING count(*) > 1),
{name}{k + 1} AS MATERIALIZED (SELECT tree, pos // 8 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h
  FROM {name}{k} SEMI JOIN {name}n{k} USING (tree) GROUP BY ALL),
{name}s{k} AS MATERIALIZED (SELECT tree, pos,
  coalesce(string_agg(h, '') OVER (PARTITION BY tree, pos // 8 ORDER BY pos
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(h, '') OVER (PARTITION BY tree, pos // 8 ORDER BY pos
    ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k} SEMI JOIN {name}n{k} USING (tree))""")
    tops = " UNION ALL ".join(f"SELECT tree, any_value(h) AS h FROM {name}{k} GROUP BY tree HAVING count(*) = 1"
                              for k in range(levels + 1))
    return ",\n".join([*out, f"{name}top AS ({tops})"])


def _fold(name: str, tree: str, start: str, levels: int) -> str:
    """CTEs {name}0..{name}levels: (rid, tree, pos, cur, proof) folded through the siblings of ``tree``."""
    out = [f"{name}0 AS MATERIALIZED ({start})"]
    for k in range(levels):
        out.append(f"""{name}{k + 1} AS MATERIALIZED (SELECT rid, tree, p.pos // 8 AS pos,
  CASE WHEN s.l IS NULL THEN cur ELSE sha256(s.l || cur || s.r) END AS cur,
  proof || coalesce(s.l || s.r, '') AS proof FROM {name}{k} p LEFT JOIN {tree}s{k} s USING (tree, pos))""")
    return ",\n".join(out)


OP12 = f"""
WITH t AS (SELECT {_TAB} AS tab),
docs AS (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce('+' || lang, '') AS tree,
       {_leaf('text')} AS leaf, CASE WHEN {_CRC} % 3 = 0 THEN {_leaf('low')} ELSE {_leaf('text')} END AS shown
     FROM docs, t),
o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
{_tree("a", "SELECT tree, pos, leaf AS h FROM o", 8)},
{_tree("b", "SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, h FROM atop", 4)},
place AS (SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS pos FROM atop),
{_fold("f", "a", "SELECT rid, tree, pos, shown AS cur, '' AS proof FROM o", 8)},
{_fold("g", "b", "SELECT f.rid, '' AS tree, p.pos, f.cur, f.proof FROM f8 f JOIN place p USING (tree)", 4)}
SELECT o.doc_id, o.leaf, atop.h AS subroot, btop.h AS root, sha256(g.proof) AS proof_sha256,
       g.cur AS folded_root, g.cur = btop.h AS verified
FROM o JOIN g4 g USING (rid) JOIN atop ON atop.tree = o.tree, btop
"""

SQL = {"op12_merkle_manifest": OP12, "op11_source_divergence": OP11, "op6_ngram_jaccard_join": OP6, "op1_secret_scans": OP1, "op4_quality_rules": OP4}
