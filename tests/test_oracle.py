"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

import check_oracle  # noqa: E402
from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from eventmart.plans import ORACLES, QUERIES  # noqa: E402

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables here")
ROWS_ONLY = {"mart_kmeans_centers", "mart_kmeans_assignments", "event_tree_predictions", "event_tree_error"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in check_oracle.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_only_unrepeatable_queries_lack_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, str(SF_DIR))
    got = result.toPandas()
    if name in ROWS_ONLY:
        assert len(got) > 0
        return
    cursor = duck.execute(ORACLES[name])
    assert check_oracle.differing_types(result, cursor.description) == []
    want = cursor.df()
    assert sorted(got.columns) == sorted(want.columns)
    assert check_oracle.normal(got) == check_oracle.normal(want)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("zone", ["America/New_York"])
def test_results_do_not_depend_on_the_session_zone(spark, zone):
    names = ["account_mart", "scan_event_table", "event_search_docs", "event_label_features"]
    before = {n: check_oracle.normal(queries()[n](spark, str(SF_DIR)).toPandas()) for n in names}
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for n in names:
            assert check_oracle.normal(queries()[n](spark, str(SF_DIR)).toPandas()) == before[n]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
