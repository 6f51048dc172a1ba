"""The registered queries against their SQL on the smallest tables."""

import os
import pathlib

import duckdb
import pytest

import __spark_entry__ as entry
from shelfline.plans.views import TABLES
from tools.check import compare, normalised

FOLDER = "/root/testdata/sf0.001"
QUICK = [
    "rfm_features", "demand_features", "date_features", "join_external", "point_in_time_join", "point_in_time_demand",
    "latest_feature_lookup", "abc_xyz_matrix", "eoq", "reorder_alerts", "revenue_deciles", "iqr_outliers", "describe_all",
    "dq_score", "dq_unique", "drift_report", "js_divergence", "classification_metrics", "retention_actions_rules",
    "churn_heatmap_pivot", "scan_csv_typed", "scan_bronze_table", "merge_upsert_customer", "weather_normalise",
    "sliding_windows", "rolling_origin_cutoffs", "kpss_test", "experiment_summary", "stratified_split",
]
NAMES = sorted(entry.oracle_sql()) if os.environ.get("SHELFLINE_ALL") else QUICK

pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="test tables are not on this machine")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    yield con
    con.close()


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, db, name):
    df = entry.queries()[name](spark, FOLDER)
    mine = normalised(df.columns, [tuple(r) for r in df.collect()])
    cursor = db.execute(entry.oracle_sql()[name])
    theirs = normalised([c[0] for c in cursor.description], cursor.fetchall())
    assert compare(mine, theirs) is None


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).columns == ["customer_id", "recency_days", "frequency", "monetary", "avg_basket_size", "rfm_score"]
