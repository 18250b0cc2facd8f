"""Nothing that the corpus shows is left out, however rare or frequent it is."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkwise.llm import lm_scoring, sentencepiece_codec, substring_dedup
from tests.llm.test_operators import naive_log10
from tests.llm.test_passages import covered, words


@pytest.mark.parametrize("bits", [20, 2])
def test_rare_contexts_keep_nodes_of_their_own(spark, make_docs, monkeypatch, bits):
    monkeypatch.setattr(lm_scoring, "WINDOW_BITS", bits)  # with 2, most windows go through the join
    train, other = [b"ab" * 20_000, b"xyzq", b"xyzq"], [b"xyzq", b"xyza", b"", b"\xc3\xa9x"]
    docs = make_docs([t.decode() for t in train + other])
    out = {r.doc_id: r.score for r in lm_scoring.score_texts(docs, F.col("doc_id") < len(train)).collect()}
    for i, text in enumerate(other, len(train)):
        assert math.isclose(out[i], naive_log10(train, text, lm_scoring.DEPTH, 1), rel_tol=1e-6)


def test_the_table_of_nodes_is_the_tree_in_memory(spark, make_docs):
    train = ["abab", "abba c", "", None, "né né"]
    counts = lm_scoring.count_corpus(make_docs(train))
    tree = lm_scoring.learn(counts)
    texts = [(t or "").encode() for t in train]
    out = lm_scoring.score_texts(make_docs(train), F.lit(True)).orderBy("doc_id").collect()
    assert np.allclose([r.score for r in out], lm_scoring.code_lengths(tree, texts), rtol=1e-4)


def test_with_no_training_text_all_decisions_have_one_half(spark, make_docs):
    out = lm_scoring.score_texts(make_docs(["ab", None]), F.lit(None).cast("boolean")).orderBy("doc_id").collect()
    assert np.allclose([r.score for r in out], [24 * math.log10(0.5), 8 * math.log10(0.5)])
    assert lm_scoring.score_texts(make_docs([]), F.lit(True)).collect() == []


def test_a_passage_all_of_whose_seeds_are_crowded_is_found_by_default(spark, make_docs):
    rng = random.Random(31)
    texts, wanted = [], []
    for _ in range(6):
        passage = words(rng, 64)
        fuzzy = [w if (i + 1) % 8 else f"edit{rng.random()}" for i, w in enumerate(passage)]
        wanted.append(len(texts))
        texts += [words(rng, 40) + passage + words(rng, 40), words(rng, 30) + fuzzy + words(rng, 50)]
        for at in range(0, 64, 8):  # every stretch between two edits stands in twelve more texts
            texts += [words(rng, 20) + passage[at:at + 8] + words(rng, 20) for _ in range(12)]
    out = substring_dedup.repeated_passages(make_docs([" ".join(t) for t in texts])).collect()
    assert {frozenset((r.doc_id, r.ref_doc_id)) for r in out} == {frozenset((at, at + 1)) for at in wanted}
    assert [at for at in wanted if not covered(out, at, 40, 104)] == []


def test_short_chains_are_dropped_only_where_they_give_no_passage():
    rng = random.Random(8)
    dropped = 0
    for _ in range(300):
        base = [f"w{rng.randint(0, 300)}" for _ in range(120)]
        every = rng.choice((5, 6, 8, 40))
        a = [f"a{rng.random()}" if rng.random() < 1 / every else w for w in base]
        b = [f"b{rng.random()}" for _ in range(rng.randint(0, 60))] + base[rng.randint(0, 60):rng.randint(70, 120)]
        shared = [(i, j) for i in range(len(a) - 3) for j in range(len(b) - 3) if a[i:i + 4] == b[j:j + 4]]
        for pos, ref in zip(shared, shared[1:]):
            if pos[0] < ref[0] and pos[1] < ref[1] and ref[0] - pos[0] < 21 and ref[1] - pos[1] < 21:
                at, to = np.array([pos[0], ref[0]]), np.array([pos[1], ref[1]])
                low, high = max(0, pos[1] - 25), ref[1] + 4 + 25
                if substring_dedup.hopeless(a, b[low:high], at, to - low, 25, (low > 0, high < len(b))):
                    dropped += 1
                    assert substring_dedup.fitting(a, b, at, to, 50, 0.8) == []
    assert dropped > 50


def test_long_texts_go_to_python_few_at_a_time(spark, make_docs, monkeypatch):
    key, seen, plain = "spark.sql.execution.arrow.maxRecordsPerBatch", [], sentencepiece_codec.stored
    monkeypatch.setattr(sentencepiece_codec, "stored", lambda df, name: seen.append(int(spark.conf.get(key))) or plain(df, name))
    docs = make_docs(["some words of a text " * 40, "brief", None])
    out = sentencepiece_codec.encode(docs, sentencepiece_codec.load(), chunk_chars=100, check=True).collect()
    assert len(seen) == 2 and max(seen) <= 100
    assert sorted(r.doc_id for r in out) == [0, 1, 2] and all(r.round_trip for r in out)
