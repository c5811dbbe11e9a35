"""op1_ngram_join: what it writes and moves stays small beside its input, however many buckets there are."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardsmith.llm import common, ngram_join

WORDS = [f"word{i}" for i in range(300)]


def near_copies(n: int, seed: int) -> list[tuple[int, str]]:
    """Documents of which every three are near copies or equal, some without words."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        if i % 3 == 0:
            base = rng.choices(WORDS, k=rng.randrange(3, 120))
        rows.append((i, " ".join(base + [f"end{i}"] * (i % 2))))
    return [*rows, (n, None), (n + 1, " \n")]


def found(docs):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs).collect())


def by_hand(rows):
    sets = {}
    for i, text in rows:
        w = (text or "").lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    comp = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]):
                x, y = sorted((comp[a], comp[b]))
                comp.update({k: x for k, v in comp.items() if v == y})
    return sorted((i, len(s), comp[i]) for i, s in sets.items())


def test_a_posting_has_few_bytes_in_many_buckets():
    """A posting takes few bytes more in many buckets than in one, and fewer than a hash and a digest."""
    rng = np.random.default_rng(1)
    tokens = [rng.integers(0, 1 << 64, 30, np.uint64) for _ in range(4000)]
    many = [np.zeros(30, bool)] * 4000
    keys = [rng.bytes(8) for _ in tokens]
    each = []
    for buckets in (1, 300):
        batch = ngram_join.pack_rows(keys, tokens, many, 48, buckets)
        each.append(sum(len(x) for c in ("token", "steps") for x in batch.column(c).to_pylist() if x) / 120_000)
        assert batch.num_rows == buckets + 1 and batch.column("classes")[buckets].as_py() == b"".join(keys)
    assert max(each) < 7.5 and each[1] < 1.1 * each[0]


@pytest.mark.parametrize("bits, postings, packed, most", [((48, 56, 64), 400_000, 1 << 20, 1 << 20), ((64,), 7, 100, 1 << 20), ((3, 5, 64), 50, 300, 0), ((56, 64), 11, 1, 3)])
def test_components_by_any_packing(spark, monkeypatch, bits, postings, packed, most):
    """Few or many buckets and packs, long or short tokens, any order of the shingles: the same components, right ones."""
    rows = near_copies(60, 4)
    rows += [(100 + i, rows[i][1]) for i in range(0, 60, 7)]
    for name, value in (("TOKEN_BITS", bits), ("BUCKET_POSTINGS", postings), ("PACKED", packed), ("MOST_COUNTED", most)):
        monkeypatch.setattr(ngram_join, name, value)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs.repartition(3)) == by_hand(rows)


def test_copies_that_pass_the_table_of_keys(spark, monkeypatch):
    """Where the table of keys tells nothing apart and packs come twice, copies are still one class."""
    rows = near_copies(12, 5)
    docs = spark.createDataFrame(rows + [(i + 20, t) for i, t in rows], "doc_id long, text string").repartitionByRange(2, "doc_id")
    monkeypatch.setattr(ngram_join, "KEY_BITS", 64)
    assert found(docs) == by_hand(rows + [(i + 20, t) for i, t in rows])


def test_postings_not_gathered(spark):
    """Postings of very common shingles are passed on by document, whole."""
    rows = near_copies(12, 6)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = ngram_join._sets(docs, 5, "doc_id", "text")
    classes = made.filter("n > 0").groupBy("sid").agg(F.min(F.struct("id", common.ROW_KEY)).alias("rep"), F.max("n").alias("n"))
    often = np.empty(0, np.uint64), np.empty(0, np.int64)
    kept = [ngram_join._postings(docs, classes, often, (0, 8), 48, 5, common_, 5, 3, 4, "doc_id", "text") for common_ in (1 << 16, 0)]
    listed, whole = ({(r.pack, r.at, r.token) for r in k.filter("class is null").collect()} for k in kept)
    per = [len(ngram_join.prefix(s, often, 3, 4)) for s in {ngram_join.set_id(s): s for s in (ngram_join.shingle_set(common.WordHasher(), t, 5) for _, t in rows) if len(s)}.values()]
    assert len(whole) == sum(per) and listed < whole
    assert {bytes(r["class"]) for r in kept[1].filter("token is null").collect()} == {bytes(r.sid[:8]) for r in classes.collect()}


def test_token_bits():
    assert ngram_join.token_bits(np.array([1 << 16, 2 << 16], np.uint64)) == 48
    assert ngram_join.token_bits(np.array([1 << 8, 2 << 8], np.uint64)) == 56
    assert ngram_join.token_bits(np.array([1, 2, 1 << 40], np.uint64)) == 64
    assert ngram_join.token_bits(np.empty(0, np.uint64)) == 48


def test_texts_are_kept_not_sets(spark, monkeypatch):
    """What is kept of the candidates has fewer bytes than their sets, and shuffles end with what is written."""
    rng = random.Random(7)
    texts = [" ".join(rng.choices(WORDS, k=600)) for _ in range(20)]
    docs = spark.createDataFrame([(i, f"{texts[i // 2]} end{i % 2}") for i in range(40)], "doc_id long, text string")
    kept, seen, write = [], set(), ngram_join.materialize

    def spy(df, name):
        seen.add(spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None))
        out = write(df, name)
        if name == "ngram_candidates":
            kept.append(out)
        return out

    monkeypatch.setattr(ngram_join, "materialize", spy)
    assert [c for _, _, c in found(docs)] == [i // 2 * 2 for i in range(40)]
    [sets] = kept
    data = sum(F.octet_length(c) for c, kind in sets.dtypes if kind == "binary")
    assert sets.count() == 40 and sets.agg(F.sum(data)).head()[0] < 40 * 596 * 8 / 2
    assert seen == {"true"} and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
