"""What the steps of the training-data operators leave on disk, hold and send."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from chunkwise.llm import common, jaccard_join, sentencepiece_codec, substring_dedup, words


def awkward_texts(rng: random.Random) -> list[str]:
    return ["", " ", "\n", "\n\n a\n", " \n", "a \t b  c", "x" * 70 + " y " + "Z" * 64, "日本 語\r\n",
            "﷐ x", "▁ x▁"] + ["".join(rng.choice(" \n\tabCé日▁﷐.1") for _ in range(rng.randint(0, 300)))
                                      for _ in range(200)]


def test_shuffle_files_of_a_stored_step_are_gone(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {f for f in map(str, (files.getAllFiles().apply(i) for i in range(files.getAllFiles().size())))
                        if "shuffle_" in f}
    before = shuffled()
    kept = common.stored(spark.range(2000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count(), "lean")
    for _ in range(50):
        left = shuffled() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert sum(r["count"] for r in kept.collect()) == 2000


def test_shingles_of_many_texts_at_once_are_those_of_each():
    raws = [t.encode() for t in awkward_texts(random.Random(4))] + [b"ab " * 100_000 + b"q" * 300_000 + b" c"]
    for width in (4, 5):
        whole = []
        for raw in raws:
            own = raw.lower().split()
            n = min(width, len(own))
            whole.append({tuple(own[i:i + n]) for i in range(len(own) - n + 1)} if own else set())
        found = jaccard_join.shingle_sets(raws, width)
        assert [len(x) for x in found] == [len(x) for x in whole]
        for i, j in zip(range(len(raws)), [*range(1, len(raws)), 0]):
            assert len(np.intersect1d(found[i], found[j])) == len(whole[i] & whole[j])


def test_words_have_the_same_hash_wherever_they_stand():
    h, n = words.hashed_words([b"One two " + b"x" * 65, b"", b"TWO\tone " + b"X" * 65 + b"\n" + b"x" * 64])
    assert n.tolist() == [3, 0, 4]
    assert h[[0, 1, 2]].tolist() == h[[4, 3, 5]].tolist() and len(set(h.tolist())) == 4


def test_words_around_a_chain_travel_as_words():
    own = b"a b c d e f g h".split()
    assert substring_dedup.around(own, 3, 5, 2) == b"b c d e f g"
    assert substring_dedup.around(own, 1, 8, 4) == b" ".join(own)


def test_stretches_by_parting_are_those_of_the_pattern():
    vocabulary = sentencepiece_codec.load()
    for text in awkward_texts(random.Random(5)):
        marked = sentencepiece_codec.MARK + sentencepiece_codec.escaped(text)
        assert [s for s in vocabulary.cut_up(marked) if s] == vocabulary.stretches.findall(marked)


def test_rows_of_ids_decoded_together_are_those_of_each():
    vocabulary = sentencepiece_codec.load()
    coder = sentencepiece_codec.Coder(vocabulary)
    rows = [np.frombuffer(raw, "<i4") for raw in coder.encode_all(awkward_texts(random.Random(6)))]
    for at_once in (1, 50, 1 << 18):
        together = list(sentencepiece_codec.decoded_rows(rows, vocabulary.bytes_of, at_once))
        assert together == [sentencepiece_codec.decoded(x, vocabulary.bytes_of) for x in rows]


def test_stages_of_the_pipeline_send_few_whole_texts_to_python_at_once(spark, make_docs, monkeypatch):
    import corpus_pipeline

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, stored = spark.conf.get(key), [], corpus_pipeline.stored
    monkeypatch.setattr(corpus_pipeline, "stored", lambda df, name: seen.append((name, int(spark.conf.get(key)))) or stored(df, name))
    docs = make_docs(["some words of a text", "other words", ""]).withColumn("lang", F.lit("en")).withColumn("source", F.lit("s"))
    left = corpus_pipeline.identified(spark, docs, "")
    assert left.columns == docs.columns
    assert corpus_pipeline.tokenized(spark, left, "").count() == left.count() == 2
    assert dict(seen) == {"identified": common.TEXT_ROWS, "tokenized": common.TEXT_ROWS}
    assert spark.conf.get(key) == before
