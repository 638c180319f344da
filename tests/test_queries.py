"""Every query with SQL equals it, and every other one runs."""

import duckdb
import pytest

import __spark_entry__ as entry
from terrapack.plans import catalog

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return c


def values(df):
    cols = sorted(df.columns)
    return sorted((tuple(r) for r in df[cols].astype(object).where(df[cols].notna(), None).values.tolist()), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, SMALL).toPandas()
    if name in catalog.ORACLES:
        want = duck.sql(catalog.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns) and values(got) == values(want)
    else:
        assert len(got) > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_no_tile_fails(spark):
    assert catalog.QUERIES["q_star_tiles"](spark, SMALL).filter("error is not null").count() == 0
