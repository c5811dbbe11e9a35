"""Findings of the third round, each of which held before."""

import re
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shardsmith.llm import common, ngram_join, pairs, revisits

RECORD = "record_id bigint, record_type string, url string, time bigint, status int, headers map<string,string>, payload string"


def test_payloads_move_once(spark, capsys):
    """Payloads of responses are in one exchange: they are not moved again after they have been reduced."""
    revisits.resolve_revisits(spark.createDataFrame([], RECORD)).explain("formatted")
    moved = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", capsys.readouterr().out)
    assert len(moved) > 3
    assert sum(bool(re.search(r"__payload|first#", columns)) for columns in moved) == 1


def test_links_in_place_are_few(spark):
    """Where all pairs of a list link, a link for each component comes out, not one for each pair."""
    n, base = 60, np.arange(1, 101, dtype=np.uint64)
    sets = [np.sort(np.append(base, np.uint64(1000 + i))) for i in range(n)]
    lists = spark.createDataFrame([(k, i, 101, i // 2) for k in (1, 2) for i in range(n)], "list long, cid long, n long, comp long")
    shingles = spark.createDataFrame([(i, s.tobytes(), b"\x00") for i, s in enumerate(sets)], "cid long, shingles binary, prints binary")
    always = lambda x, y, n, m: np.ones(len(x), bool)
    for name in (None, "test_partners"):
        got = pairs.links_in_place(lists, shingles, always, 3, 4, name).collect()
        assert len(got) == n // 2 - 1
        forest = pairs.Forest(n // 2)
        for a, b in got:
            forest.join(a // 2, b // 2)
        assert len(set(forest.roots().tolist())) == 1


def test_links_in_place_of_some(spark):
    """Chains and single sets: the links join what the links of all pairs join, and nothing else."""
    sets = [np.arange(1 + 10 * i, 101 + 10 * i, dtype=np.uint64) for i in range(12)] + [np.arange(10_000, 10_100, dtype=np.uint64), np.arange(20_000, 20_100, dtype=np.uint64)]
    lists = spark.createDataFrame([(1, i, 100, i) for i in range(len(sets))], "list long, cid long, n long, comp long")
    shingles = spark.createDataFrame([(i, s.tobytes(), b"\x00") for i, s in enumerate(sets)], "cid long, shingles binary, prints binary")
    got = pairs.links_in_place(lists, shingles, lambda x, y, n, m: np.ones(len(x), bool), 3, 4).collect()
    assert {abs(a - b) for a, b in got} == {1} and len(got) == 11


def test_lists_without_repeats(spark):
    """Equal lists are one, with their number; others stay, whole."""
    rows = [(t, g, 10) for t in (1, 2, 3) for g in (5, 6, 7)] + [(4, 5, 10), (4, 6, 10), (8, 5, 10), (8, 9, 11)]
    got = ngram_join._without_repeats(spark.createDataFrame(rows, "token long, gid long, n long")).collect()
    want = {(1, g, 10, 3) for g in (5, 6, 7)} | {(4, 5, 10, 1), (4, 6, 10, 1), (8, 5, 10, 1), (8, 9, 11, 1)}
    assert {(r.token, r.gid, r.n, r.weight) for r in got} == want and len(got) == len(want)


def test_key_place(spark):
    """Classes are told by half of their digests, the other half if two share one, else by the whole."""
    digests = lambda *pairs: spark.createDataFrame([(bytearray(a + b),) for a, b in pairs], "sid binary")
    x, y, z = (bytes([i]) * 8 for i in (1, 2, 3))
    assert ngram_join._key_place(digests((x, x), (y, x), (z, y))) == (0, 8)
    assert ngram_join._key_place(digests((x, x), (x, y), (z, z))) == (8, 8)
    assert ngram_join._key_place(digests((x, x), (x, y), (y, y))) == (0, 16)


def test_keys_and_bitmaps_pass_what_is_wanted(spark, monkeypatch):
    """No key that is among the wanted is kept back, negative ones and a full table included; nor a pair that links."""
    keys = spark.range(0, 300).select(F.xxhash64("id").alias("key"))
    assert keys.filter(ngram_join._may_be_among(keys, "key")("key")).count() == 300
    others = spark.range(1000, 2000).select(F.xxhash64("id").alias("key"))
    assert others.filter(ngram_join._may_be_among(keys, "key")("key")).count() < 10
    monkeypatch.setattr(ngram_join, "KEY_BITS", 64)
    assert keys.filter(ngram_join._may_be_among(keys, "key")("key")).count() == 300


def test_ngram_join_by_whole_digests(spark, monkeypatch):
    """The components are the same by whichever bytes classes go."""
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[:50] + [f"x{i}"])) for i in range(6)] + [(10 + i, f"{i} " + " ".join(words[::-1][: 20 + i])) for i in range(3)] + [(20, "a b"), (21, "a b"), (22, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    for place in ((0, 8), (8, 8), (0, 16)):
        monkeypatch.setattr(ngram_join, "_key_place", lambda _, p=place: p)
        seen.append(sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs).collect()))
    assert seen[0] == seen[1] == seen[2] and {c for d, _, c in seen[0] if d < 6} == {0} and {c for d, _, c in seen[0] if d in (20, 21)} == {20}


def test_small_batches(spark):
    """Texts go to Python in batches of bounded bytes within the block, and as before after it or if the session says."""
    docs = spark.range(0, 9000, 1, 1).select(F.repeat(F.lit("word "), 800).alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())], names=["size"])

    made = docs.mapInArrow(sizes, "size long")
    with common.small_batches(spark):
        got = [r["size"] for r in made.collect()]
    assert sum(got) > 30 << 20 and max(got) < 1.1 * common.BATCH_BYTES
    assert spark.conf.get(common.BATCH_CONF, None) is None
    spark.conf.set(common.BATCH_CONF, "12345")
    try:
        with common.small_batches(spark):
            assert spark.conf.get(common.BATCH_CONF) == "12345"
        assert spark.conf.get(common.BATCH_CONF) == "12345"
    finally:
        spark.conf.unset(common.BATCH_CONF)


def test_ngram_join_works_on_small_batches(spark, monkeypatch):
    """All that the join writes is written in small batches, and packing or counting in portions gives the same components."""
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[:50] + [f"x{i}"])) for i in range(9)] + [(20 + i, f"{i} " + " ".join(words[::-1][: 20 + i])) for i in range(4)] + [(30, "a b"), (31, "a b"), (32, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    seen, write = set(), ngram_join.materialize
    monkeypatch.setattr(ngram_join, "materialize", lambda df, name: (seen.add(spark.conf.get(common.BATCH_CONF, None)), write(df, name))[1])
    found = lambda: sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs).collect())
    whole = found()
    assert seen == {str(common.BATCH_BYTES)} and spark.conf.get(common.BATCH_CONF, None) is None
    assert {c for d, _, c in whole if d < 9} == {0} and {c for d, _, c in whole if d in (30, 31)} == {30}
    monkeypatch.setattr(ngram_join, "PACKED", 30)
    monkeypatch.setattr(ngram_join, "CHUNK", 40)  # fewer than some sets have
    assert found() == whole


def test_repeated_in_place():
    """Values found more than once and their counts, without a second array of the chunk's size."""
    rng = np.random.default_rng(3)
    for n, high in ((0, 5), (1, 5), (2, 1), (1000, 3), (1000, 700), (1000, 1 << 60)):
        x = rng.integers(0, high, n, dtype=np.uint64)
        t, c = np.unique(x, return_counts=True)
        got = ngram_join.repeated(x.copy())
        assert (got[0] == t[c > 1]).all() and (got[1] == c[c > 1]).all() and got[1].dtype == np.int64
    chunk = rng.integers(0, 1 << 60, 1 << 20, dtype=np.uint64)
    tracemalloc.start()
    ngram_join.repeated(chunk)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < chunk.nbytes / 2
