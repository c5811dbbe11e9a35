from hypothesis import given, settings
from hypothesis import strategies as st

from shardsmith.functions.hashing import bucket_py, djb2_hash, djb2_py, hash_bucket

# Hash vectors from FIXTURES.md section 4: (string, bucket n=8, bucket n=1000003)
VECTORS = [("", 5, 5381), ("0", 5, 177621), ("42", 3, 861660), ("abc", 3, 485384), ("é", 6, 177806), ("4294967296", 1, 920148)]


def test_python_model_vectors():
    for s, b8, bm in VECTORS:
        assert bucket_py(s, 8) == b8
        assert bucket_py(s, 1000003) == bm
    assert djb2_py("abc") == 193485963


def test_spark_vectors(spark):
    df = spark.createDataFrame([(s,) for s, _, _ in VECTORS] + [(None,)], "k string")
    rows = df.select("k", hash_bucket("k", 8).alias("b8"), hash_bucket("k", 1000003).alias("bm"), djb2_hash("k").alias("h")).collect()
    got = {r.k: (r.b8, r.bm) for r in rows}
    for s, b8, bm in VECTORS:
        assert got[s] == (b8, bm), s
    assert [r for r in rows if r.k is None][0].h is None


def test_non_bmp_counts_surrogate_units(spark):
    keys = ["a😀b", "😀", "𝄞x", "日本語"]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").select("k", djb2_hash("k").alias("h")).collect()
    for r in rows:
        assert r.h == djb2_py(r.k)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=60))
def test_spark_matches_model(spark, keys):
    rows = spark.createDataFrame([(k,) for k in keys], "k string").select("k", djb2_hash("k").alias("h"), hash_bucket("k", 7).alias("b")).collect()
    for r in rows:
        assert r.h == djb2_py(r.k)
        assert r.b == bucket_py(r.k, 7)


def test_long_key_is_whole_text(spark):
    text = "x" * 5000 + "é" * 3000
    (h,) = spark.createDataFrame([(text,)], "k string").select(djb2_hash("k")).first()
    assert h == djb2_py(text)
