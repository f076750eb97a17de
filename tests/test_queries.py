import duckdb
import pytest

from docweave.plans import registry
from tests.conftest import SF, rows_of

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, db, name):
    got, want = registry.QUERIES[name](spark, SF).toPandas(), db.sql(registry.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) and rows_of(got) == rows_of(want)


def test_entry_and_names(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
