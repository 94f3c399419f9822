import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["qid", "pid", "score", "rank"]
    assert len(rows) > 0
    assert all(1 <= r["rank"] <= 10 for r in rows)


def test_oracle_keys_are_registered():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 30
