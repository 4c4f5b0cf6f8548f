import __spark_entry__ as entry


def test_flagship_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["video_id", "frame", "num_persons", "posed", "primary_pos"] and df.count() > 0


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
