import random

import pytest
from pyspark.sql import functions as F

from shelfline.operators import inventory as inv


def skus(spark, revenue):
    return spark.createDataFrame([(f"s{i}", float(r)) for i, r in enumerate(revenue)], "sku_id string, total_revenue double")


def classes(df):
    return {r["sku_id"]: r["abc_class"] for r in df.collect()}


def test_abc_boundary_is_inclusive(spark):
    assert classes(inv.abc_class(skus(spark, [70, 20, 10]))) == {"s0": "A", "s1": "B", "s2": "C"}


def test_abc_ties_go_by_id_and_zero_total_is_c(spark):
    assert classes(inv.abc_class(skus(spark, [35, 35, 20, 10]))) == {"s0": "A", "s1": "A", "s2": "B", "s3": "C"}
    zero = inv.abc_class(skus(spark, [0, 0]))
    assert set(classes(zero).values()) == {"C"} and {r["revenue_pct"] for r in zero.collect()} == {0.0}


def test_abc_with_a_third_of_rows_equal(spark):
    df = inv.abc_class(skus(spark, [0] * 300 + list(range(1, 601))))
    got = df.collect()
    assert len(got) == 900 and {r["abc_class"] for r in got if r["total_revenue"] == 0} == {"C"}


@pytest.mark.parametrize("a,b", [(0, 0.9), (0.9, 0.7), (0.7, 1), (0.5, 0.5)])
def test_abc_thresholds_must_rise(spark, a, b):
    with pytest.raises(ValueError):
        inv.abc_class(skus(spark, [1]), a=a, b=b)


def test_xyz_edges(spark):
    df = spark.createDataFrame([("one", 5.0), ("zero", 0.0), ("zero", 0.0), ("y", 1.0), ("y", 3.0), ("z", 0.0), ("z", 0.0), ("z", 9.0), ("x", 10.0), ("x", 11.0)], "sku_id string, demand double")
    got = {r["sku_id"]: (r["xyz_class"], round(r["cv"], 3)) for r in inv.xyz_class(df, "sku_id", "demand").collect()}
    assert got == {"one": ("X", 0.0), "zero": ("X", 0.0), "y": ("Y", 0.707), "z": ("Z", 1.732), "x": ("X", 0.067)}


def test_xyz_ratio_on_a_limit(spark):
    """Mean 32 and deviation 16: a ratio of exactly 0.5 is class Y in any order of the rows."""
    demand = [26, 8, 50, 41, 37, 40, 16, 10, 16, 51, 27, 45, 34, 22, 40, 7, 57, 67, 47, 19, 27, 41, 31, 29, 46, 21, 9]
    r, rows = random.Random(5), []
    for k in range(40):
        rows += [(f"s{k}", float(v)) for v in r.sample(demand, len(demand))]
    df = spark.createDataFrame(rows, "sku_id string, demand double")
    for dealt in (df, df.repartition(7)):
        got = inv.xyz_class(dealt, "sku_id", "demand").collect()
        assert len(got) == 40 and {(g["mean_demand"], g["std_demand"], g["cv"], g["xyz_class"]) for g in got} == {(32.0, 16.0, 0.5, "Y")}
    parts = spark.createDataFrame([("a", 0.1), ("a", 0.3)], "sku_id string, demand double")
    assert inv.xyz_class(parts, "sku_id", "demand").first()["std_demand"] == pytest.approx(0.02**0.5)


def eoq(spark, d, s, h, c, lt, std=None):
    df = spark.createDataFrame([(float(d), float(s), float(h), float(c), float(lt), std)], "d double, s double, h double, c double, lt double, std double")
    cols = inv.eoq_columns(F.col("d"), F.col("s"), F.col("h"), F.col("c"), F.col("lt"), daily_std=F.col("std"))
    return df.select(*[v.alias(k) for k, v in cols.items()]).first().asDict()


def test_eoq_by_hand(spark):
    got = eoq(spark, 3650, 100, 20, 50, 16)
    # H = 10; EOQ = sqrt(73000) = 270.2; safety = 1.65·sqrt(10)·4 = 20.9
    assert got["eoq"] == 270 and got["safety_stock"] == 21 and got["reorder_point_units"] == 181
    assert got["orders_per_year"] == 13.5 and got["avg_cycle_stock"] == 135
    assert eoq(spark, 3650, 100, 20, 50, 16, 2.0)["safety_stock"] == 13


@pytest.mark.parametrize("bad", [(0, 100, 20, 50), (3650, 0, 20, 50), (3650, 100, 0, 50), (3650, 100, 20, -1)])
def test_eoq_of_unusable_input_is_zero(spark, bad):
    assert set(eoq(spark, *bad, 10).values()) == {0.0}


def test_order_quantity_floor(spark):
    df = spark.createDataFrame([(0.001, 5000.0), (0.0, 5.0), (10.0, 0.0)], "d double, c double")
    assert [r[0] for r in df.select(inv.order_quantity(F.col("d"), F.col("c"))).collect()] == [1, 0, 0]


def test_dead_stock(spark):
    df = spark.createDataFrame([(180, 10), (181, 10), (900, 10), (20, 0)], "days_since_last_sale int, avg_lead_time int")
    got = [(r["dead_stock_flag"], r["dead_stock_score"]) for r in inv.dead_stock(df).collect()]
    assert got == [(False, 18.0), (True, 18.1), (True, 50.0), (False, 20.0)]
    assert inv.dead_stock(df.drop("avg_lead_time")).first()["dead_stock_score"] == 12.86


def test_reorder_alerts_use_rounded_days_and_defaults(spark):
    stock = spark.createDataFrame([("a", 704, 10), ("b", 141, 141), ("c", 301, 999), ("d", 1, 0), ("e", 31, 0)], "sku_id string, current_stock int, reorder_point int")
    demand = spark.createDataFrame([("a", 100.0), ("b", 10.0), ("d", 0.0), ("e", 1.0)], "sku_id string, avg_daily_demand double")
    got = {r["sku_id"]: (r["days_until_stockout"], r["urgency"], r["below_reorder_point"]) for r in inv.reorder_alerts(stock, demand).collect()}
    assert got == {
        "a": (7.0, "Critical", False), "b": (14.1, "Medium", False), "c": (30.1, "OK", True),
        "d": (10.0, "High", False), "e": (31.0, "OK", False)}
    plain = inv.reorder_alerts(stock.drop("reorder_point"), None).filter("sku_id = 'b'").first()
    assert plain["avg_daily_demand"] == 10.0 and plain["below_reorder_point"] is False


def test_stockout_days_on_a_tie_round_to_even(spark):
    """261 in stock at 100 units a year and 2 at 200 last 952.65 and 3.65 days; the doubles lie a last bit beside it."""
    stock = spark.createDataFrame([("a", 261, 1.0), ("b", 2, 1.0)], "sku_id string, current_stock int, unit_cost double")
    demand = spark.createDataFrame([("a", 100 / 365), ("b", 200 / 365)], "sku_id string, avg_daily_demand double")
    alerts = inv.reorder_alerts(stock, demand)
    want = {"a": 952.6, "b": 3.6}
    assert {r["sku_id"]: r["days_until_stockout"] for r in alerts.collect()} == want
    listed = inv.reorder_recommendations(inv.demand_per_sku(stock, demand, "sku_id"))
    assert {r["sku_id"]: r["days_until_stockout"] for r in listed.collect()} == want


def test_reorder_order_and_demand_forms(spark):
    stock = spark.createDataFrame([("a", 500), ("b", 60), ("c", 50), ("d", 50)], "sku_id string, current_stock int")
    assert [r["sku_id"] for r in inv.by_urgency(inv.reorder_alerts(stock, None)).collect()] == ["c", "d", "b", "a"]
    p50 = spark.createDataFrame([("a", 4.0), ("a", 6.0)], "sku_id string, p50 double")
    got = {r["sku_id"]: r["avg_daily_demand"] for r in inv.demand_per_sku(stock, p50, "sku_id").collect()}
    assert got == {"a": 5.0, "b": 10.0, "c": 10.0, "d": 10.0}
    twice = spark.createDataFrame([("a", 2.0, 1), ("a", 9.0, 2)], "sku_id string, avg_daily_demand double, date int")
    assert inv.demand_per_sku(stock, twice, "sku_id").filter("sku_id = 'a'").first()["avg_daily_demand"] == 2.0


def test_recommendations(spark):
    df = spark.createDataFrame([("a", 1000, 1.0, 10.0), ("b", 5, 2.0, 3.0)], "sku_id string, current_stock int, avg_daily_demand double, unit_cost double")
    got = {r["sku_id"]: (r["recommended_qty"], r["po_value"], r["urgency"]) for r in inv.reorder_recommendations(df, use_eoq=False).collect()}
    assert got == {"a": (0, 0.0, "OK"), "b": (55, 165.0, "Critical")}
    assert inv.reorder_recommendations(df).filter("sku_id = 'a'").first()["recommended_qty"] == 234


def test_lead_time_stats(spark):
    df = spark.createDataFrame([("s", 10), ("s", 20), ("one", 5)], "supplier string, lead_time_days int")
    got = {r["supplier"]: (r["cv_pct"], r["unreliable"]) for r in inv.lead_time_stats(df).collect()}
    assert got == {"s": (47.1, True), "one": (None, False)}


def test_service_levels(spark):
    df = spark.createDataFrame([("a", 3650.0, 100.0, 20.0, 50.0, 16)], "sku_id string, annual_demand double, order_cost double, holding_pct double, unit_cost double, lead_time_days int")
    got = {r["service_level"]: r["safety_stock"] for r in inv.service_level_scenarios(df).collect()}
    assert got == {"90%": 16, "95%": 21, "98%": 26, "99%": 29}
