"""Vector functions and the vector guard."""

import numpy as np
from pyspark.sql import functions as F

from chunkwise.functions.vectors import cosine_distance, cosine_similarity, l2_norm, l2sq_distance
from chunkwise.operators.knn import valid_vectors


def test_vector_functions_against_numpy(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(20):
        a, b = rng.normal(size=8), rng.normal(size=8)
        rows.append((i, a.astype(np.float32).tolist(), b.astype(np.float32).tolist()))
    df = spark.createDataFrame(rows, "id int, a array<float>, b array<float>")
    out = df.select("id", "a", "b", cosine_distance("a", "b").alias("cd"),
                    cosine_similarity("a", "b").alias("cs"), l2sq_distance("a", "b").alias("l2"),
                    l2_norm("a").alias("n")).collect()
    for r in out:
        a, b = np.array(r["a"], dtype=np.float64), np.array(r["b"], dtype=np.float64)
        cs = a @ b / np.sqrt((a @ a) * (b @ b))
        assert abs(r["cs"] - cs) < 1e-12
        assert abs(r["cd"] - (1 - cs)) < 1e-12
        assert abs(r["l2"] - ((a - b) ** 2).sum()) < 1e-9
        assert abs(r["n"] - np.sqrt(a @ a)) < 1e-12


def test_edge_vectors(spark):
    df = spark.createDataFrame([
        (1, [0.0, 0.0], [1.0, 0.0]),      # zero vector: no cosine distance
        (2, [1.0, 2.0], [1.0, 2.0]),      # equal
        (3, [1.0, 0.0], [-1.0, 0.0]),     # opposite
        (4, [1.0, 0.0, 0.0], [1.0, 0.0]),  # wrong length
        (5, None, [1.0, 0.0]),
    ], "id int, a array<float>, b array<float>")
    got = {r["id"]: (r["cd"], r["l2"]) for r in
           df.select("id", cosine_distance("a", "b").alias("cd"), l2sq_distance("a", "b").alias("l2")).collect()}
    assert got[1][0] is None and got[1][1] == 1.0
    assert abs(got[2][0]) < 1e-15 and got[2][1] == 0.0
    assert abs(got[3][0] - 2.0) < 1e-15 and got[3][1] == 4.0
    assert got[4] == (None, None)
    assert got[5] == (None, None)


def test_l2sq_is_twice_cosine_on_unit_vectors(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").limit(50)
    pairs = e.alias("x").join(e.alias("y"), F.col("x.vec_id") == F.col("y.vec_id") + 1)
    for r in pairs.select(cosine_distance("x.embedding", "y.embedding").alias("c"),
                          l2sq_distance("x.embedding", "y.embedding").alias("l")).collect():
        assert abs(r["l"] - 2 * r["c"]) < 1e-6


def test_valid_vectors(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [1.0, 2.0]), (4, [1.0, 2.0, 3.0])],
                               "id int, v array<float>")
    assert sorted(r["id"] for r in valid_vectors(df, "v", 3).collect()) == [4]
    assert sorted(r["id"] for r in valid_vectors(df, "v").collect()) == [3, 4]


def test_valid_vectors_reports_rejects(spark):
    from pyspark.sql import Observation
    df = spark.createDataFrame([(1, None), (2, []), (3, [1.0, 2.0]), (4, [1.0, 2.0, 3.0])],
                               "id int, v array<float>")
    obs = Observation("vectors")
    assert valid_vectors(df, "v", 3, observation=obs).count() == 1
    assert obs.get == {"rows": 4, "rejected": 3}


def test_hashed_encoder_forms_agree(spark):
    from chunkwise.operators.encode import HashEncoder, embed, hash_counts, hash_vectors, hash_vectors_arrow
    texts = ["The cat SAT on the mat", "  ünïcode  wörds\u2003and\ttabs ", "", None, "a a a a b",
             "İstanbul ΟΔΟΣ ΣΑΣ Straße ẞ ǅ"]     # special casing: JVM and Python agree
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    jvm = {r["id"]: list(r["embedding"]) for r in hash_vectors(df, "text", 16).collect()}
    arrow = {r["id"]: list(r["embedding"]) for r in hash_vectors_arrow(df, "text", 16).collect()}
    batch = {r["id"]: list(r["embedding"]) for r in embed(df, "text", HashEncoder(16), 16).collect()}
    local = HashEncoder(16)([t or "" for t in texts])
    assert jvm == arrow == batch
    for i in range(len(texts)):
        assert jvm[i] == local[i].tolist()
    sparse = {(r["id"], r["bucket"]): r["cnt"] for r in hash_counts(df, "text", ["id"], 16).collect()}
    dense = {(i, b): int(v) for i, vec in jvm.items() for b, v in enumerate(vec) if v}
    assert sparse == dense
    assert sum(jvm[4]) == 5 and max(jvm[4]) >= 4
