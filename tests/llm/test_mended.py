"""Leaks at the start of a text, languages beside crowds of copies, passages within one text."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from chunkwise.llm import decontamination, language_id, substring_dedup


def least_distance(item, text):
    """Least edit distance of ``item`` to any substring of ``text``, by dynamic programming."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def mutated(rng, item, edits, letters):
    out = list(item)
    for _ in range(edits):
        at, kind = rng.randrange(len(out)), rng.random()
        if kind < 0.5:
            out[at] = rng.choice(letters)
        elif kind < 0.75:
            out.insert(at, rng.choice(letters))
        elif len(out) > 1:
            del out[at]
    return "".join(out)


def test_leaks_equal_dynamic_programming_wherever_they_stand():
    rng = random.Random(12)
    words = ["is", "the", "question", "in", "ab"]
    trials = leaks = 0
    while trials < 20_000:
        if trials % 2:
            item = (rng.choice(["ab", "abc", "aab"]) * 12)[:rng.randint(10, 30)]
        else:
            item = " ".join(rng.choice(words) for _ in range(rng.randint(3, 6)))
        item = decontamination.normal(item)
        finder = decontamination.Finder([item], 0.1)
        budget = int(0.1 * len(item))
        for _ in range(10):
            body = mutated(rng, item, rng.randint(0, budget + 1), "abc ")
            front = "" if trials % 3 else "".join(rng.choice("abcxyz ") for _ in range(60))
            text = decontamination.normal(front + body + rng.choice(["", " zzz", "ab", "q" * 20]))
            want = least_distance(item, text)
            got = finder.search(text).get(0)
            assert (got is not None) == (want <= budget), (item, text, want, got)
            if got:
                leaks += 1
                assert got[0] == want, (item, text)
            trials += 1
    assert leaks > 5_000


def test_copies_crowd_no_language_out_of_the_sample(spark, make_docs):
    word = lambda i: str(i).translate(str.maketrans("0123456789", "abcdefghij"))
    rows = [(i, f"the english text {word(i)} of many", "en", "s") for i in range(600)]
    rows += [(1000 + i, f"le texte français {word(i)} parmi", "fr", "s") for i in range(600)]
    rows += [(9000 + i, text, "en", "s") for i, text in enumerate(["one copied english text"] * 8000)]
    docs = make_docs(rows)
    least = docs.where("lang = 'en'").orderBy(F.pmod(F.xxhash64("text"), F.lit(1 << 30))).first().text
    crowd = docs.unionByName(make_docs([(20_000 + i, least, "en", "s") for i in range(3000)]))
    spans, langs = language_id.sample(crowd, per_lang=100, spans=2000)
    assert langs.count("en") == langs.count("fr") == 2000
    assert len(set(s for s, l in zip(spans, langs) if l == "en")) > 50      # not the words of one text
    _, most = language_id.sample(crowd, per_lang=100, spans=10, max_langs=1)
    assert set(most) <= {"en", "fr"} and len(set(most)) == 1


def test_no_passage_repeats_its_own_words(spark, make_docs):
    rng = random.Random(3)
    block = " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(60))
    other = " ".join(f"v{rng.randint(0, 10**6)}" for _ in range(30))
    out = substring_dedup.repeated_passages(make_docs(["word " * 300, f"{block} {other} {block}", "a b c " * 100])).collect()
    assert out and {r.doc_id for r in out} == {1}                            # a true repeat inside one text is found
    for r in out:
        assert r.start_word >= r.ref_start_word + r.ref_n_words or r.ref_start_word >= r.start_word + r.n_words


def test_wide_sketches_bound_the_difference_of_long_sets():
    from chunkwise.llm import jaccard_join

    rng = np.random.default_rng(5)
    for n in (1100, 1500, 2047, 2049, 5000, 20_000):
        for share in (0.0, 0.5, 0.9, 1.0):
            m = int(n * rng.uniform(0.85, 1.0))
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            same = int(share * min(n, m))
            b = np.unique(np.concatenate([a[:same], rng.integers(0, 2**63, m - same).astype(np.uint64)]))
            true = len(np.setxor1d(a, b))
            got = jaccard_join.wide_distance(jaccard_join.wide_sketch(a), jaccard_join.wide_sketch(b))
            assert got <= true
            if share < 0.6 and min(n, m) > 1024:  # beyond what 80 % may differ by: seen as too far
                assert got > len(a) + len(b) - 2 * -(-80 * (len(a) + len(b)) // 180)
    assert jaccard_join.wide_sketch(np.arange(1024, dtype=np.uint64)) is None and jaccard_join.wide_distance(None, b"") == 0


def test_long_texts_of_one_stock_passage_are_no_candidates(spark, make_docs):
    from chunkwise.llm import jaccard_join

    rng = random.Random(9)
    words = lambda n: [f"w{rng.randint(0, 10**7)}" for _ in range(n)]
    stock = words(80)
    texts = [" ".join(words(900) + stock + words(900)) for _ in range(24)]
    near = texts[0].split()
    near[40] = "changed"
    texts.append(" ".join(near))
    docs = make_docs(texts)
    made, count = [], jaccard_join.candidate_groups

    def counted(*a, **k):
        out = count(*a, **k)
        made.append(out.count())
        return out

    jaccard_join.candidate_groups = counted
    try:
        got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()}
    finally:
        jaccard_join.candidate_groups = count
    assert got == {i: 0 if i == 24 else i for i in range(25)}
    assert made[-1] <= 1                                       # of 276 pairs of unlike texts that share the passage


def test_many_equal_rows_are_verified_once(spark, make_docs):
    from chunkwise.llm import jaccard_join

    rng = random.Random(10)
    a = [f"w{rng.randint(0, 10**6)}" for _ in range(200)]
    b = a[:100] + ["changed"] + a[101:]
    docs = make_docs([(None, " ".join(t), "en", "s") for t in (a, b) for _ in range(2000)])
    got = jaccard_join.jaccard_components(docs).groupBy("n_shingles", "component_id").count().collect()
    assert [(r.n_shingles, r.component_id, r["count"]) for r in got] == [(197, None, 4000)]


def test_registered_codec_returns_ids_that_decode(spark):
    from chunkwise.llm import sentencepiece_codec as sp
    from chunkwise.llm.queries import op7_sentencepiece

    out = op7_sentencepiece(spark, "/root/testdata/sf0.001")
    assert dict(out.dtypes)["ids"] == "array<int>"
    rows = out.collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    v = sp.load()
    for r in rows:
        assert r.round_trip and r.n_tokens == len(r.ids)
        assert b"".join(v.bytes_of[i] for i in r.ids)[1:].decode() == (texts[r.doc_id] or "")



def test_shapes_of_words():
    from chunkwise.llm import quality_classifier as qc

    def plain(word):
        out = re.sub(rb"[a-z\x80-\xff]+", b"a", re.sub(rb"[0-9]+", b"0", re.sub(rb"[A-Z]+", b"A", word)))
        return re.sub(rb"(.)\1+", rb"\1\1", out, flags=re.S)

    rng = random.Random(2)
    words = [bytes(rng.choice(b"ABab09!!?-\xc3\xa9\n") for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    assert [qc.shape(w) for w in words] == [plain(w) for w in words]
    slots = qc.word_slots(words, 1 << 16)
    assert slots.shape == (3000, 2) and (slots == np.array([qc.word_slots([w], 1 << 16)[0] for w in words])).all()


def test_repositories_decide_beside_owners(spark, make_docs):
    from chunkwise.llm import secret_scan

    spread, own = "Aa1" * 8, "Bb2" * 8
    docs = make_docs([(i, f"see {spread} here", f"l{i}", "one") for i in range(4)] + [(9, f"our {own} key", "en", "one")])
    out = {r.doc_id: r for r in secret_scan.digest(secret_scan.scan_secrets(docs)).collect()}
    assert out[9].spans == "owned:4:28" and out[0].spans == ""            # one owner, four repositories
    wide = {r.doc_id: r for r in secret_scan.digest(secret_scan.scan_secrets(docs, max_repos=4)).collect()}
    assert wide[0].spans == "owned:4:28"


def test_a_text_of_many_keys_takes_seconds(spark, make_docs):
    import time

    from chunkwise.llm import secret_scan

    text = " ".join(f"token={i:016d} k" for i in range(6_000))
    docs = make_docs([text])
    started = time.perf_counter()
    r = secret_scan.digest(secret_scan.scan_secrets(docs)).collect()[0]
    assert r.n_assign == 6_000 and r.n_hex == 6_000
    assert time.perf_counter() - started < 60


def test_stages_keep_columns_of_their_own_inner_names(spark, make_docs):
    from chunkwise.llm import jaccard_join

    docs = make_docs(["one text to keep", "a leaked item of the benchmark", "one text to keep"]).withColumn(
        "_key", F.lit("k")).withColumn("_rows", F.lit(7)).withColumn("_row", F.lit(1)).withColumn("_text", F.lit("t"))
    items = spark.createDataFrame([(1, "a leaked item of the benchmark")], "item_id long, text string")
    left = decontamination.drop_leaking(docs, items)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r._key, r._rows, r["_row"], r._text) for r in left.collect()) == [(0, "k", 7, 1, "t"), (2, "k", 7, 1, "t")]
    alone = jaccard_join.distinct_documents(docs, width=5, percent=80)
    assert alone.columns == docs.columns
    assert sorted((r.doc_id, r._key, r._rows) for r in alone.collect()) == [(0, "k", 7), (1, "k", 7)]


def test_the_join_sends_few_whole_texts_to_python_at_once(spark, make_docs, monkeypatch):
    from chunkwise.llm import common, jaccard_join

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, stored = spark.conf.get(key), [], jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda df, name: seen.append((name, int(spark.conf.get(key)))) or stored(df, name))
    docs = make_docs([f"one two three four five six seven {i % 3}" for i in range(30)])
    assert {r.component_id for r in jaccard_join.jaccard_components(docs).collect()} <= {0, 1, 2}
    assert {n for name, n in seen if name in ("profiles", "links")} == {common.TEXT_ROWS}
    assert spark.conf.get(key) == before
