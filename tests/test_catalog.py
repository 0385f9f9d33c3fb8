"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import compare
from qaloom.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in compare.TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES])
def test_query_equals_its_sql(spark, con, name):
    verdict, _ = compare.compare(spark, con, SF, name)
    assert verdict.startswith("ok") or (name not in catalog.ORACLES and verdict.startswith("rows only")), verdict


def test_entry(spark):
    import __spark_entry__

    rows = __spark_entry__.entry(spark).collect()
    assert {r.split for r in rows} == {"train", "validation", "test"} and sum(r.n_rows for r in rows) == 34
