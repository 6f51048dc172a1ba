import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfline.functions import calendar as cal
from shelfline.operators import features as ft

D, T = dt.date, dt.datetime


def sales(spark, data):
    return spark.createDataFrame(data, "customer_id string, ts timestamp_ntz, total_amount double")


def test_rfm_window_is_inclusive_and_open_ended(spark):
    df = sales(spark, [
        ("a", T(2024, 1, 2, 5), 10.0),  # exactly 90 days before
        ("a", T(2024, 1, 1, 23), 99.0),  # one day too old
        ("b", T(2024, 4, 3, 1), 5.0),  # after the snapshot
    ])
    got = {r["customer_id"]: r for r in ft.customer_rfm(df, "2024-04-01").collect()}
    assert (got["a"]["recency_days"], got["a"]["frequency"], got["a"]["monetary"]) == (90, 1, 10.0)
    assert got["b"]["recency_days"] == -2
    assert [r["customer_id"] for r in ft.customer_rfm(df, "2024-04-01", bounded=True).collect()] == ["a"]


def test_minmax_score_by_hand(spark):
    df = sales(spark, [("a", T(2024, 3, 31), 100.0), ("a", T(2024, 3, 30), 100.0), ("b", T(2024, 3, 1), 50.0)])
    got = {r["customer_id"]: r["rfm_score"] for r in ft.rfm_features(df, "2024-04-01").collect()}
    assert got["a"] == pytest.approx(5.0, abs=1e-6)
    assert got["b"] == pytest.approx(1.0, abs=1e-6)


def test_minmax_score_of_equal_customers(spark):
    df = sales(spark, [("a", T(2024, 3, 31), 10.0), ("b", T(2024, 3, 31), 10.0)])
    scores = [r["rfm_score"] for r in ft.rfm_features(df, "2024-04-01").collect()]
    assert scores == pytest.approx([5 * 0.30 + 1 * 0.35 + 1 * 0.35] * 2)


def daily(spark, values, sku="s"):
    start = D(2024, 1, 1)
    data = [(sku, start + dt.timedelta(days=2 * i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "product_id string, date date, quantity double")


def test_rolling_features_wait_for_full_windows(spark):
    got = ft.demand_features(daily(spark, [float(i) for i in range(1, 16)])).orderBy("date").collect()
    assert [r["rolling_mean_7d"] for r in got[:6]] == [None] * 6
    assert got[6]["rolling_mean_7d"] == 4.0  # rows, not calendar days
    assert got[6]["rolling_std_7d"] == pytest.approx(2.160246899)
    assert got[12]["rolling_mean_14d"] is None and got[13]["rolling_mean_14d"] == 7.5
    assert got[14]["rolling_mean_30d"] is None
    assert (got[7]["lag_1d"], got[7]["lag_7d"], got[7]["lag_14d"]) == (7.0, 1.0, None)
    assert got[6]["momentum_7d"] == pytest.approx(3 / 4)


def test_a_null_inside_the_window_blocks_it(spark):
    got = ft.rolling_means(daily(spark, [1.0, None, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0]), sizes=(7,)).orderBy("date").collect()
    assert [r["rolling_mean_7d"] for r in got] == [None] * 8 + [6.0]


def test_calendar_columns(spark):
    days = spark.createDataFrame([(D(2021, 1, 3),), (D(2024, 3, 31),), (D(2024, 2, 29),), (D(2024, 5, 3),)], "date date")
    got = {r["date"]: r for r in ft.date_features(days).collect()}
    assert (got[D(2021, 1, 3)]["day_of_week"], got[D(2021, 1, 3)]["week_of_year"]) == (7, 53)
    assert got[D(2024, 3, 31)]["is_quarter_end"] and got[D(2024, 3, 31)]["is_month_end"]
    assert got[D(2024, 2, 29)]["is_month_end"] and not got[D(2024, 2, 29)]["is_quarter_end"]
    assert got[D(2024, 5, 3)]["is_weekend"]  # a Friday counts by default
    later = {r["date"]: r for r in ft.date_features(days, weekend_from_iso=6).collect()}
    assert not later[D(2024, 5, 3)]["is_weekend"]


def test_holiday_distances(spark):
    days = spark.createDataFrame([(D(2023, 12, 30),), (D(2024, 1, 26),), (D(2024, 2, 3),), (D(2027, 1, 8),)], "date date")
    got = [(r["days_to_next_holiday"], r["days_since_last_holiday"], r["is_promotional_period"]) for r in ft.date_features(days).orderBy("date").collect()]
    assert got == [(2, 999, True), (0, 0, True), (51, 8, False), (999, 8, False)]
    none = ft.date_features(days, holidays=[]).first()
    assert (none["days_to_next_holiday"], none["days_since_last_holiday"], none["is_promotional_period"]) == (999, 999, False)


def test_holiday_calendar_size():
    assert len(cal.holiday_dates()) == 37


def test_extreme_weather_treats_missing_as_false(spark):
    df = spark.createDataFrame([(41.0, None), (None, 51.0), (None, None), (40.0, 50.0)], "temp_c double, rain_mm double")
    assert [r[2] for r in ft.with_extreme_weather(df).collect()] == [True, True, False, False]


def test_cpi_join_fans_out_without_the_year(spark):
    demand = spark.createDataFrame([("a", D(2024, 3, 1), 1.0)], "category string, date date, q double")
    cpi = spark.createDataFrame([("a", 3, 2023, 1.0, 0.1), ("a", 3, 2024, 2.0, 0.2)], "category string, month int, year int, cpi_index double, cpi_mom_change double")
    assert ft.join_cpi(demand, cpi).count() == 2
    assert [r["cpi_index"] for r in ft.join_cpi(demand, cpi, by_year=True).collect()] == [2.0]
    assert ft.join_cpi(demand.drop("category"), cpi).columns == ["date", "q", "month"]


def test_churn_risk_on_demand(spark):
    df = spark.createDataFrame([(1.9, 61, 5001.0), (2.0, 61, 5000.0), (1.0, 60, 1000.0), (None, 99, None)], "rfm_score double, recency_days int, monetary double")
    got = [(r["high_risk_flag"], r["clv_tier"]) for r in ft.churn_risk_on_demand(df).collect()]
    assert got == [(True, "high"), (False, "medium"), (False, "low"), (False, "low")]


def test_catalogue_and_references():
    assert len(ft.ALL_REFERENCES) == 21
    assert ft.service_columns("demand")[0] == "rolling_mean_7d" and len(ft.service_columns("demand")) == 16
    with pytest.raises(KeyError):
        ft.resolve_references(["customer_rfm_fv:nope"])


def test_point_in_time_uses_each_view_ttl(spark):
    at = T(2024, 1, 15)
    entities = spark.createDataFrame([("c", "p", at)], "customer_id string, product_id string, event_timestamp timestamp_ntz")
    rfm = spark.createDataFrame([("c", at - dt.timedelta(days=6), 9, 9, 9.0, 9.0, 9.0)], "customer_id string, event_ts timestamp_ntz, recency_days long, frequency long, monetary double, avg_basket_size double, rfm_score double")
    demand = spark.createDataFrame([("p", at - dt.timedelta(days=2), 1.0), ("p", at + dt.timedelta(days=1), 7.0)], "product_id string, event_ts timestamp_ntz, lag_1d double")
    out = ft.point_in_time_features(entities, {"customer_rfm_fv": rfm, "sku_demand_fv": demand}, "event_timestamp", ["customer_rfm_fv:recency_days", "sku_demand_fv:lag_1d"]).first()
    assert (out["recency_days"], out["lag_1d"]) == (9, None)


def test_materialize_latest_picks_the_newest_inside_the_range(spark):
    view = ft.FeatureView("v", ("k",), 1, ("x",))
    src = spark.createDataFrame([("a", T(2024, 1, 1), 1), ("a", T(2024, 1, 5), 2), ("a", T(2024, 2, 1), 3), ("b", T(2023, 1, 1), 4)], "k string, event_ts timestamp_ntz, x int")
    got = ft.materialize_latest(view, src, "2024-01-01", "2024-01-31").collect()
    assert [(r["k"], r["x"]) for r in got] == [("a", 2)]


def test_latest_lookup_expires(spark):
    ids = spark.createDataFrame([("a",), ("b",)], "product_id string")
    src = spark.createDataFrame([("a", T(2024, 1, 4, 12), 1.0), ("b", T(2024, 1, 3), 2.0)], "product_id string, event_ts timestamp_ntz, lag_1d double")
    out = ft.latest_feature_lookup(ids, {"sku_demand_fv": src}, "2024-01-05", ["sku_demand_fv:lag_1d"])
    assert {r["product_id"]: r["lag_1d"] for r in out.collect()} == {"a": 1.0, "b": None}


def test_moving_average_is_per_key(spark):
    df = daily(spark, [float(i) for i in range(8)], "a").unionByName(daily(spark, [1.0] * 3, "b"))
    got = ft.moving_average(df, ["product_id"], "date", "quantity").filter(F.col("ma7").isNotNull()).collect()
    assert sorted(r["ma7"] for r in got) == [3.0, 4.0]
