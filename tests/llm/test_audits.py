"""Source divergence, Merkle manifest and contextual extraction against plain versions."""

import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkwise.llm import merkle_manifest, pii, source_divergence

from .conftest import DOCS


# source divergence

def plain_audit(rows, min_docs, top):
    words, docs, counts = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        counts[lang, source].update(terms)
        words[lang].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in counts}:
        kept = [t for t in docs[lang] if docs[lang][t] >= min_docs]
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}
        whole = share(words[lang])
        own = {s: share(c) for (g, s), c in counts.items() if g == lang}
        for s, p in own.items():
            pairs = [(sum(abs(p[t] - q[t]) for t in kept), o) for o, q in own.items() if o != s]
            terms = [(p[t] - whole[t], t) for t in kept if counts[lang, s][t] and p[t] > whole[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found)
                        if part == "pair" or i < top]
    return sorted(out)


def random_texts(rng, n):
    words = ["a", "Bc", "überaus", "ABCDEFGH", "abcdefghi", "sixteenletterswo", "seventeenletterswo", "x" * 70, "ñ" * 20,
             "漢字", "e1f", "end.", "_", "🙂", "q" * 8, "q" * 9, "tab\tline\n", "\u0085", "K"]
    return [rng.choice([None, "", " ".join(rng.choice(words) for _ in range(rng.randint(1, 40)))]) for _ in range(n)]


@pytest.mark.parametrize("min_docs,source_block,term_block", [(1, 256, 4096), (6, 2, 3), (99, 2, 3)])
def test_divergence_equals_a_plain_version(spark, monkeypatch, min_docs, source_block, term_block):
    monkeypatch.setattr(source_divergence, "SOURCE_BLOCK", source_block)
    monkeypatch.setattr(source_divergence, "TERM_BLOCK", term_block)
    rng = random.Random(min_docs)
    rows = [(i, t, rng.choice([None, "", "en", "de"]), rng.choice([None, "", "s1", "s2", "é", "Z"]), 0)
            for i, t in enumerate(random_texts(rng, 160))] + [(0, None, "fr", "only", 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("term", F.lit(1)).withColumn("value", F.lit(2))
    got = sorted(map(tuple, source_divergence.audit(docs, min_docs, 4).collect()))
    assert got == plain_audit(rows, min_docs, 4)


def test_packed_runs_equal_a_counter(monkeypatch):
    rng = random.Random(4)
    runs, want, docs_of, names = source_divergence.TermRuns(), Counter(), defaultdict(set), [("l", "a"), ("l", "b")]
    doc = 0
    for _ in range(5):
        texts = [t or "" for t in random_texts(rng, 30)]
        groups = np.array([rng.randint(0, 1) for _ in texts], np.uint32)
        raw = [t.encode() for t in texts]
        bounds = np.cumsum([0, *map(len, raw)])
        runs.add(np.frombuffer(b"".join(raw), np.uint8), bounds, groups)
        for t, g in zip(raw, groups):
            for term in re.findall(rb"[A-Za-z\x80-\xff]+", t):
                want[int(g), term.lower()] += 1
                docs_of[int(g), term.lower()].add(doc)
            doc += 1
        if rng.random() < 0.5:
            runs.merge()
    got = {(names.index((r["lang"], r["source"])), r["term"].encode()): (r["n"], r["docs"])
           for b in runs.emit(names) for r in b.to_pylist()}
    assert got == {k: (n, len(docs_of[k])) for k, n in want.items()} and runs.buckets == {}


def test_radix_order_is_the_stable_order():
    rng = np.random.default_rng(2)
    for _ in range(20):
        a, b = rng.integers(0, 2**63, 50).astype(np.uint64) % np.uint64(rng.integers(2, 2**62)), rng.integers(0, 3, 50).astype(np.uint32)
        assert (source_divergence.sorted_order([a, b]) == np.lexsort((b, a))).all()


# Merkle manifest

def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    doc_id, _, lang, source, n = row
    enc = [("-" if v is None else f"{len(str(v).encode())}:{v}") for v in (doc_id, source, lang, n, text)]
    return h(*enc)


def plain_proofs(nodes):
    """Root and, for each node, its siblings as (left, right) by level."""
    place, proofs = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, at in enumerate(place):
            run = at - at % 8
            proofs[i].append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + 8])))
            place[i] = at // 8
        nodes = [h(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], proofs


def plain_manifest(rows):
    langs = defaultdict(list)
    for row in rows:
        langs[row[2]].append((row[0] is not None, row[0] or 0, plain_leaf(row, row[1]), row))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: plain_proofs([x[2] for x in sorted(langs[lang], key=lambda x: x[:3])]) for lang in order}
    root, tops = plain_proofs([trees[lang][0] for lang in order])
    out = []
    for lang, top in zip(order, tops):
        for (_, _, leaf, row), own in zip(sorted(langs[lang], key=lambda x: x[:3]), trees[lang][1]):
            text, proof = row[1], own + top
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and text is not None:
                text = re.sub("[A-Z]", lambda m: m.group().lower(), text)
            folded = plain_leaf(row, text)
            for left, right in proof:
                folded = h(left, folded, right)
            out.append((row[0], leaf, trees[lang][0], root, h(*[x for p in proof for x in p]), folded, folded == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("n,block_levels", [(1, 3), (8, 1), (9, 1), (75, 1), (700, 1), (700, 0), (700, 2), (90, 3)])
def test_manifest_equals_a_plain_tree(spark, n, block_levels):
    rng = random.Random(n)
    langs = [None, "", "en", "en", "en", "en", "é", "Z"] + [f"l{i}" for i in range(9)] if n == 90 else [None, "en", "en", "en"]
    rows = [(rng.choice([None, *range(n)]) if i % 9 == 0 else i * 7919 - 50, rng.choice([None, "", "Some TEXT é", "plain"]), rng.choice(langs),
             rng.choice([None, "", "src1"]), rng.choice([None, 0, 12])) for i in range(n)]
    rows += rows[:n // 5]
    docs = spark.createDataFrame(rows, DOCS).withColumn("leaf", F.lit(1)).withColumn("tree", F.lit("x")).withColumn("n", F.lit(0))
    proved = merkle_manifest.manifest(docs, tampered=merkle_manifest.tamper_mark(F.col("doc_id")), block_levels=block_levels)
    got = sorted(map(tuple, merkle_manifest.digest(proved).collect()), key=str)
    assert got == plain_manifest(rows)
    assert {r[6] for r in got} <= {True, False} and (n < 9 or {r[6] for r in got} == {True, False})


def test_large_ids_beside_null_stay_exact(spark):
    rows = [(None, "a", "en", "s", 1), (2**62 + 1, "b", "en", "s", 1)]
    got = merkle_manifest.manifest(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id for r in got} == {None, 2**62 + 1}


# contextual extraction

BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(re.sub(r"\D", "", s)) <= 19 and plain_luhn(re.sub(r"\D", "", s))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(re.sub(r"\D", "", s)) <= 15),
}


def plain_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain_base(text):
    return sorted((m.start(), rank, m.end()) for rank, (p, ok) in enumerate(BASE.values())
                  for m in re.finditer(p, text) if ok(m.group()))


def random_text(rng):
    bits = ["4111 1111 1111 1111", "4111-1111-1111-1112", "79927398713", "30569309025904", "1.2.3.4", "256.1.1.1", ".5", "1.2.3.4.5.6.7.8",
            "+1 (017) 555-7713", "+49", "(0) 89", "-", " ", "\n", "a.b@c.d", "@", "x@y", "me@h-1.org_z@q.r", "é", "🙂", "00001.2.3.4", "+", "12",
            "mail:", "%+-@a.b.", "٣"]
    return "".join(rng.choice(bits) for _ in range(rng.randint(1, 12)))


def test_base_spans_equal_plain_regexes():
    rng = random.Random(8)
    for _ in range(4000):
        text = random_text(rng)
        assert pii.base_spans(text) == plain_base(text), text


def test_base_spans_of_long_runs_are_linear():
    assert pii.base_spans("x" * 200_000 + "@") == [] and pii.base_spans("7" * 200_000) == []
    assert pii.base_spans("a@b.c" + "+1" * 100_000) == [(0, 0, 5)]


def plain_extract(texts, rounds, min_trust, min_known, min_score):
    """The graph in dictionaries: discovered instances by kind."""
    seeds, contexts = defaultdict(Counter), defaultdict(set)
    for text in set(texts):
        for _, _, rank, value, *context in pii.mentions(text or ""):
            contexts[value].add(tuple(context))
    kinds = defaultdict(set)  # (value, context) -> greatest rank
    for text in set(texts):
        for _, _, rank, value, *context in pii.mentions(text or ""):
            kinds[value, tuple(context)].add(rank)
    for (value, _), ranks in kinds.items():
        if max(ranks) >= 0:
            seeds[value][max(ranks)] += 1
    seed = {v: min(c, key=lambda k: (-c[k], k)) for v, c in seeds.items()}
    of = lambda c: (("2", c[0], c[1]), ("1", c[1]), ("m", c[1], c[2]))
    known = {}
    for _ in range(rounds):
        score = {v: (seed[v], 10**6) if v in seed else known.get(v, (-1, 0)) for v in contexts}
        members = defaultdict(set)
        for v, cs in contexts.items():
            for c in cs:
                for p in of(c):
                    members[p].add(v)
        trusted = {}
        for p, vs in members.items():
            by = defaultdict(list)
            for v in vs:
                if score[v][0] >= 0:
                    by[score[v][0]].append(score[v][1])
            if by:
                k = min(by, key=lambda k: (-sum(by[k]), k))
                trust = sum(by[k]) // (len(vs) + 1)
                if len(by[k]) >= min_known and trust >= min_trust * 10**6:
                    trusted[p] = (k, trust)
        known = {}
        for v, cs in contexts.items():
            if v in seed:
                continue
            by = Counter()
            for c in cs:
                best = Counter()
                for p in of(c):
                    if p in trusted:
                        best[trusted[p][0]] = max(best[trusted[p][0]], trusted[p][1])
                by.update(best)
            found = [(by[k] // len(cs), k) for k in by if by[k] // len(cs) >= min_score * 10**6]
            if found:
                s, k = max(found, key=lambda x: (x[0], -x[1]))
                known[v] = (k, s)
    return known


def planted(rng):
    """Documents in which 'call me at _' and 'mail to: _' hold seeds, then identifiers of other shapes."""
    texts = [f"w{i} please call me at +1 (0{i:02d}) 555-1{i:03d} today" for i in range(12)]
    texts += ["now call me at 555-0199 today", "so call me at ext4417 today", "call me at ext4417"] * 2
    texts += [f"u{i} mail to: user{i}@host.org thanks" for i in range(9)] + ["mail to: bob@localhost thanks", "MAIL to: bob@localhost"]
    texts += [f"number {rng.randint(10**5, 10**6)} of many" for _ in range(20)] + ["in 2024a we saw 99999", None, ""]
    texts += [f"x{i} reach ext4417 or 555-0199 or desk-{i}77 now" for i in range(3)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"min_trust": 0.5, "min_known": 2, "min_score": 0.3, "rounds": 4})])
def test_extraction_equals_plain_graph(spark, make_docs, seed, options):
    rng = random.Random(seed)
    texts = planted(rng) + ([random_text(rng) + " " + random_text(rng) for _ in range(60)] if seed == 2 else [])
    full = {"rounds": 3, "min_trust": 0.8, "min_known": 5, "min_score": 0.8} | options
    known = plain_extract(texts, **full)
    assert "555-0199" in known if seed == 2 else "bob@localhost" in known
    out = pii.digest(pii.extract(make_docs([(i, t, "en", "s") for i, t in enumerate(texts)]), target_rows=3, **options)).collect()
    for r in out:
        found = pii.mentions(texts[r.doc_id] or "")
        base = plain_base(texts[r.doc_id] or "")
        extra = [(s, 4 + known[v][0], e) for s, e, rank, v, *_ in found if rank < 0 and v in known]
        names = [*BASE, *[f"context_{k}" for k in BASE]]
        show = lambda spans: ",".join(f"{names[k]}:{s}:{e}" for s, k, e in sorted(spans))
        assert r.spans == show(base + extra) and r.base_sha256 == sha256(show(base).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == i for _, k, _ in base) for i in range(4))
        assert r.n_context == len(extra)
    assert len(out) == len(texts)


def test_copies_do_not_make_a_pattern_trusted(spark, make_docs):
    texts = ["write to: a@b.org now"] * 50 + ["write to: id77 now"]
    out = pii.digest(pii.extract(make_docs([(i, t, "en", "s") for i, t in enumerate(texts)]))).collect()
    assert all(r.n_context == 0 for r in out)
