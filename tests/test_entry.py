"""Driver contract: entry runs, every oracle key is a query key."""

import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "rec_rank", "rec_id", "mutual"]
    assert df.count() > 0


def test_keys_consistent():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 95
