"""Quality classifier: neither null texts nor copies fill the training sample."""

from chunkwise.llm import quality_classifier


def test_nulls_and_copies_do_not_fill_the_sample(spark, make_docs):
    good = [f"The quick fox number {i} went over the quiet hill and slept well. It was happy there." for i in range(60)]
    bad = [f"$$$ BUY {i} NOW!!! ### @@@ WIN {i} $$$ CLICK %%% !!! FREE ### $$$" for i in range(60)]
    rows = [None] * 300 + [" \n"] * 300 + [bad[0]] * 300 + good + bad
    docs = make_docs(rows)
    texts = quality_classifier.sample(docs.select("doc_id", "text"), 100)
    assert len(texts) == 100 and len(set(texts)) == 100 and all(t and t.strip() for t in texts)
    out = {r.doc_id: r.score for r in quality_classifier.classify(docs, train_rows=100).collect()}
    assert min(out[900 + i] for i in range(60)) > max(out[960 + i] for i in range(60))
