"""Recall of the registered approximate search against the exact join."""

import pytest

from chunkwise.plans import queries


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_registered_ann_join_finds_nine_of_ten_neighbours(spark, sf):
    pairs = lambda df: {(r["query_id"], r["id"]) for r in df.select("query_id", "id").collect()}
    want = pairs(queries.knn_join_cosine(spark, f"/root/testdata/{sf}"))
    got = pairs(queries.ann_join(spark, f"/root/testdata/{sf}"))
    assert len(got & want) >= 0.9 * len(want) > 0
