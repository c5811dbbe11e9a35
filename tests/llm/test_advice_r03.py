"""Cases of the third review, each of which failed or gave a wrong result before."""

from conftest import SF01
from pyspark.sql import Observation
from pyspark.sql import functions as F

from shardsmith.llm import queries, revisits, secrets


def test_forest_after_observe(spark):
    """The forest scores in a session in which some query has used ``observe``."""
    seen = Observation("before_the_forest")
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 5
    assert queries.op6_secret_forest(spark, SF01).filter("score is not null").count() > 0


def test_forest_sample_by_label(spark):
    """A label that is rare beside the bound of the sample is in the sample."""
    rows = [(i, f"order {10**14 + i}") for i in range(400)] + [(1000 + i, f'token = "{i:040x}"') for i in range(3)]
    docs = spark.createDataFrame([(i, t, "src/a") for i, t in rows], "doc_id bigint, text string, source string")
    found = secrets.with_features(secrets.findings(docs), secrets.dictionary(docs))
    assert secrets.train(secrets.label_by_format(found), max_labelled=20) is not None


RECORD = "record_id bigint, record_type string, url string, time bigint, status int, headers map<string,string>, payload string"


def resolved(spark, rows):
    out = revisits.resolve_revisits(spark.createDataFrame(rows, RECORD).repartition(3))
    return sorted((r.record_type, r.url, r.time, r.outcome, r.refers_to, r.payload) for r in out.collect())


def test_revisits_of_equal_and_null_ids(spark):
    """Each revisit gets the payload of its own URL, however ids repeat or lack."""
    tag = {"ETag": "1"}
    rows = [
        (1, "response", "http://a/x", 1, 200, tag, "one"), (2, "response", "http://b/y", 1, 200, tag, "two"),
        (3, "revisit", "http://a/x", 5, 304, tag, None), (3, "revisit", "http://b/y", 5, 304, tag, None),
        (None, "revisit", "http://a/x", 6, 304, tag, None), (None, "revisit", "http://b/y", 6, 304, tag, None),
        (None, "response", "http://c/z", 1, 200, tag, "three"), (9, "revisit", "http://c/z", 2, 304, tag, None),
        (1, "response", "http://d/q", 1, 200, tag, "four"), (1, "revisit", "http://d/q", 2 * 86_400, 304, tag, None),
        (1, "revisit", "http://d/q", 2 * 86_400, 304, tag, None),
    ]
    got = [r for r in resolved(spark, rows) if r[0] == "revisit"]
    assert got == sorted([
        ("revisit", "http://a/x", 5, "resolved", 1, "one"), ("revisit", "http://b/y", 5, "resolved", 2, "two"),
        ("revisit", "http://a/x", 6, "resolved", 1, "one"), ("revisit", "http://b/y", 6, "resolved", 2, "two"),
        ("revisit", "http://c/z", 2, "resolved", None, "three"),
        *[("revisit", "http://d/q", 2 * 86_400, "resolved", 1, "four")] * 2,
    ])


def test_revisits_ties(spark):
    """Responses of equal time go by the greatest id; those of equal id too give one answer, the same each time."""
    tag = {"ETag": "1"}
    rows = [(i, "response", "http://a/x", 1, 200, tag, f"p{i}") for i in (None, 4, 7, 5)] + [(7, "response", "http://a/x", 1, 200, tag, "other")]
    rows += [(50 + i, "revisit", "http://a/x", 2, 304, tag, None) for i in range(4)] + [(60, "revisit", "http://a/x", 1, 304, tag, None)]
    seen = {tuple(resolved(spark, rows[k:] + rows[:k])) for k in (0, 3, 6)}
    assert len(seen) == 1
    got = [r for r in seen.pop() if r[0] == "revisit"]
    assert [r[3] for r in got if r[2] == 1] == ["no_response"]
    assert {(r[3], r[4]) for r in got if r[2] == 2} == {("resolved", 7)} and len({r[5] for r in got if r[2] == 2}) == 1
