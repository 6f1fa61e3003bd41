"""Every registered query with SQL gives the rows of its SQL on the smallest tables."""

import duckdb
import pytest
from conftest import TINY

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{TINY}/{t}.parquet'")
    return connection


def rows(table, columns):
    clean = lambda x: None if isinstance(x, float) and x != x else round(x, 6) if isinstance(x, float) else x
    return sorted(str([clean(row[c]) for c in columns]) for row in table.to_pylist())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, oracle, name):
    """Row by row with their types: an integer column with nulls stays one."""
    got = entry.queries()[name](spark, TINY).toArrow()
    wanted = oracle.execute(entry.oracle_sql()[name]).to_arrow_table()
    columns = sorted(wanted.column_names)
    assert sorted(got.column_names) == columns
    assert got.num_rows > 0 or wanted.num_rows == 0
    assert rows(got, columns) == rows(wanted, columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
