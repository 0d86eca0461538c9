import __spark_entry__ as entry


def test_entry_gives_candidates(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "candidate_rank" in df.columns


def test_each_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
