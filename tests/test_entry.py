"""The driver contract: entry runs, every query has a callable, names align."""

import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and len(df.columns) > 10


def test_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 100


def test_geo_edges(spark):
    from wakeline.functions.geo import haversine_sql

    r = spark.sql(
        f"SELECT {haversine_sql('0.0D', '179.99D', '0.0D', '-179.99D')} AS a,"
        f" {haversine_sql('10.0D', '10.0D', '10.0D', '10.0D')} AS b,"
        f" {haversine_sql('0.0D', '0.0D', '0.0D', '180.0D')} AS c"
    ).first()
    assert r.a < 2.3 and r.b == 0.0 and abs(r.c - 3.14159265 * 6371.0088) < 1e-3
