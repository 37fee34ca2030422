"""Every registered query with SQL against DuckDB on the smallest tables; others must give rows."""

import duckdb
import pytest

import __spark_entry__
from voltfleet.plans import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def rows(frame, columns):
    def plain(value):
        if value is None or value != value:
            return "~"
        return f"{value:.5f}" if isinstance(value, float) else f"{float(value):.5f}" if isinstance(value, int) else str(value)

    return sorted(tuple(plain(v) for v in row) for row in frame[columns].astype(object).where(frame[columns].notna(), None).values.tolist())


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, FOLDER).toPandas()
    expected = duck.execute(registry.ORACLE[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    assert len(got) == len(expected)
    a, b = rows(got, columns), rows(expected, columns)
    for x, y in zip(a, b, strict=True):
        for u, v in zip(x, y, strict=True):
            assert u == v or abs(float(u) - float(v)) < 2e-4, (x, y)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_query_without_sql_gives_rows(spark, name):
    """Rows, no column without a name, and no column that is null throughout."""
    got = registry.QUERIES[name](spark, FOLDER).toPandas()
    assert len(got) and len(set(got.columns)) == len(got.columns)
    assert not [c for c in got.columns if got[c].isna().all() and c not in ("dte_mean", "months", "crossing")]


def test_entry_has_every_query_and_runs(spark):
    names = __spark_entry__.queries()
    assert set(registry.QUERIES) <= set(names)
    assert set(__spark_entry__.oracle_sql()) <= set(names)
    assert __spark_entry__.entry(spark).count() == 15
