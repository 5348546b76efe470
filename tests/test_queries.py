import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from loomlog.plans import catalogue, inventory

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or v != v:
            return None
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    return sorted((tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False)), key=lambda r: tuple((x is not None, x or "") for x in r))


@pytest.mark.parametrize("name", sorted(inventory.SQL))
def test_query_equals_its_sql(spark, db, name):
    got, want = catalogue.QUERIES[name](spark, DIR).toPandas(), db.sql(catalogue.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_stream_adds_no_event_twice(spark):
    assert catalogue.QUERIES["stream_dedup"](spark, DIR).count() == spark.read.parquet(f"{DIR}/events.parquet").count()


def test_entry_and_registration(spark):
    assert entry.entry(spark).limit(1).count() == 1
    assert set(catalogue.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
