"""Every registered query against its DuckDB oracle, at sf0.001 (the driver
does the same at sf0.01; ``python tests/oracle_compare.py`` runs that)."""

from conftest import SF001
from oracle_compare import compare


def test_all_queries_match_oracle(spark):
    res = compare(spark, SF001, verbose=False)
    bad = {k: v for k, v in res.items() if v.get("ok") is False}
    assert not bad, bad


def test_entry_smoke(spark):
    import __spark_entry__ as E

    rows = E.entry(spark).collect()
    assert [r.shard for r in rows] == list(range(8)) and sum(r.docs for r in rows) == 1000
    assert set(E.oracle_sql()) <= set(E.queries())
