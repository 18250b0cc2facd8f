"""Nulls, empty and long texts, repeated rows, empty tables, clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chunkwise.llm import (decontamination, jaccard_join, language_id, lm_scoring, merkle_manifest, pii,
                           quality_classifier, quality_rules, secret_scan, sentencepiece_codec,
                           source_divergence, substring_dedup, toxicity)

from .conftest import AWKWARD, DOCS


def labels_of(spark):
    return spark.createDataFrame([(i, 1, i % 2) for i in range(2, 8)] + [(None, 1, 1), (3, None, None)],
                                 "doc_id long, quality int, toxic int")


def items_of(spark):
    return spark.createDataFrame([(1, None), (2, ""), (3, "same id, another"), (3, "same id, another")],
                                 "item_id long, text string")


ROW_WISE = {  # one output row per input row
    "op1": lambda spark, docs: secret_scan.digest(secret_scan.scan_secrets(docs)),
    "op3": lambda spark, docs: toxicity.classify(docs, labels_of(spark)),
    "op4": lambda spark, docs: quality_rules.digest(quality_rules.cascade(docs)),
    "op5": lambda spark, docs: quality_classifier.classify(docs),
    "op6": lambda spark, docs: jaccard_join.jaccard_components(docs),
    "op7": lambda spark, docs: sentencepiece_codec.digest(docs, sentencepiece_codec.load()),
    "op9": lambda spark, docs: lm_scoring.classify(docs),
    "op10": lambda spark, docs: language_id.classify(docs),
    "op12": lambda spark, docs: merkle_manifest.digest(merkle_manifest.manifest(
        docs, tampered=merkle_manifest.tamper_mark(F.col("doc_id")), block_levels=1)),
    "op13": lambda spark, docs: pii.digest(pii.extract(docs)),
}
PAIR_WISE = {
    "op2": lambda spark, docs: substring_dedup.repeated_passages(docs),
    "op8": lambda spark, docs: decontamination.find_leaks(docs, items_of(spark)),
    "op11": lambda spark, docs: source_divergence.audit(docs, 1),
}


@pytest.mark.parametrize("name", [*ROW_WISE, *PAIR_WISE])
def test_empty_table(spark, name):
    out = (ROW_WISE | PAIR_WISE)[name](spark, spark.createDataFrame([], DOCS))
    assert out.count() == 0


@pytest.mark.parametrize("name", ROW_WISE)
def test_every_row_has_a_result_and_clashing_columns_change_nothing(spark, awkward, clashing, name):
    ids = sorted((r[0] is not None, r[0]) for r in AWKWARD)
    plain = ROW_WISE[name](spark, awkward).toPandas()
    got = sorted((i == i and i is not None, None if i != i else i) for i in plain["doc_id"])
    assert [x[1] for x in got if x[0]] == [x[1] for x in ids if x[0]] and len(got) == len(ids)
    other = ROW_WISE[name](spark, clashing).toPandas()
    assert list(other.columns) == list(plain.columns)
    order = [c for c in plain.columns if plain[c].dtype.kind not in "f"]
    key = lambda df: df.astype(str).sort_values(order).reset_index(drop=True)[order]
    assert key(plain).equals(key(other))


def test_pairs_on_awkward_rows(spark, awkward, clashing):
    for docs in (awkward, clashing):
        leaks = PAIR_WISE["op8"](spark, docs).collect()
        assert sorted((r.doc_id, r.item_id, r.distance) for r in leaks) == [(5, 3, 0), (5, 3, 0)]
        assert PAIR_WISE["op2"](spark, docs).count() == 0


def test_divergence_of_awkward_rows(spark, awkward, clashing):
    rows = [sorted(map(tuple, PAIR_WISE["op11"](spark, docs).collect())) for docs in (awkward, clashing)]
    assert rows[0] == rows[1]
    groups = {r[:2] for r in rows[0]}
    assert ("es", "src3") not in groups and ("en", "src1") in groups and ("", "") in groups  # alone; others; nulls
    assert [(r[3], r[5]) for r in rows[0] if r[:3] == ("en", "src2", "term")] == [("word", 1)]


def test_repeated_rows_get_equal_results(spark, awkward):
    for name in ("op1", "op4", "op6"):
        rows = ROW_WISE[name](spark, awkward).where("doc_id = 5").collect()
        assert len(rows) == 3 and len({tuple(r) for r in rows}) == 2 - (name == "op1")


def test_defined_values(spark, awkward):
    jac = {(r.doc_id, r.n_shingles): r.component_id for r in ROW_WISE["op6"](spark, awkward).collect()}
    assert jac[0, 0] == 0 and jac[2, 0] == 2 and jac[3, 0] == 3
    assert jac[None, 2] is None and jac[4, 1] == 4 and jac[6, 1] == 6
    lang = {r.doc_id: (r.lang_pred, r.score) for r in ROW_WISE["op10"](spark, awkward).collect()}
    assert lang[0] == lang[2] == lang[3] == ("und", 0.0) and lang[6][0] != "und"
    lm = {r.doc_id: r for r in ROW_WISE["op9"](spark, awkward).collect()}
    assert lm[0].n_tokens == 1 and lm[4].n_tokens == 40_001
    assert all(r.round_trip for r in ROW_WISE["op7"](spark, awkward).collect())


def test_pipeline_takes_awkward_rows(spark, awkward, tmp_path):
    items_of(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = awkward.withColumn("extra", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), "t")
        assert docs.columns == [*DOCS.names, "extra"], name
    left = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    ids = [r.doc_id for r in left]
    assert 0 not in ids and 2 not in ids and 3 not in ids and ids.count(5) == 1
    empty = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        empty = corpus_pipeline.stored(stage(spark, empty, str(tmp_path)), "t")
    assert empty.count() == 0
