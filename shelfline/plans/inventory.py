"""Inventory queries over the ERP and sales views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.scalars import stock_urgency
from shelfline.operators import inventory as inv
from shelfline.operators.ordered import newest_per_key
from shelfline.plans.registry import query
from shelfline.plans.views import Tables

DAYS = 2499.0  # calendar length of the sales history, used to turn units into a daily rate


def sku_revenue(t: Tables) -> DataFrame:
    return t.lines().groupBy(F.col("product_id").alias("sku_id")).agg(F.sum("total_amount").alias("total_revenue"))


REVENUE_SQL = """
WITH rev AS (SELECT CAST(l_partkey AS VARCHAR) AS sku_id,
                    sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS total_revenue
             FROM lineitem GROUP BY 1),
cum AS (SELECT *, sum(total_revenue) OVER (ORDER BY total_revenue DESC, sku_id ROWS UNBOUNDED PRECEDING) AS upto,
               sum(total_revenue) OVER () AS total FROM rev),
abc AS (SELECT sku_id, CAST(total_revenue AS DOUBLE) AS total_revenue,
               CAST(total_revenue AS DOUBLE) / CAST(total AS DOUBLE) AS revenue_pct,
               CAST(upto AS DOUBLE) / CAST(total AS DOUBLE) AS cumulative_pct,
               CASE WHEN upto <= total * 0.7 THEN 'A' WHEN upto <= total * 0.9 THEN 'B' ELSE 'C' END AS abc_class
        FROM cum)
"""


@query(
    "abc_class",
    REVENUE_SQL
    + """SELECT sku_id, total_revenue, round(revenue_pct, 9) AS revenue_pct,
       round(cumulative_pct, 9) AS cumulative_pct, abc_class FROM abc""",
)
def abc_class(t: Tables) -> DataFrame:
    out = inv.abc_class(sku_revenue(t))
    return out.withColumns(
        {
            "total_revenue": F.col("total_revenue").cast("double"),
            "revenue_pct": F.round("revenue_pct", 9),
            "cumulative_pct": F.round("cumulative_pct", 9),
        }
    )


XYZ_SQL = """
m AS (SELECT CAST(l_partkey AS VARCHAR) AS sku_id, date_trunc('month', l_shipdate) AS month, sum(l_quantity) AS demand
      FROM lineitem GROUP BY 1, 2),
s AS (SELECT sku_id, avg(demand) AS mean_demand, coalesce(stddev_samp(demand), 0) AS std_demand FROM m GROUP BY 1),
xyz AS (SELECT *, CASE WHEN mean_demand > 0 THEN std_demand / mean_demand ELSE 0 END AS cv,
               CASE WHEN (CASE WHEN mean_demand > 0 THEN std_demand / mean_demand ELSE 0 END) < 0.5 THEN 'X'
                    WHEN (CASE WHEN mean_demand > 0 THEN std_demand / mean_demand ELSE 0 END) < 1.0 THEN 'Y' ELSE 'Z' END AS xyz_class
        FROM s)
"""


def monthly_demand(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(
        F.col("l_partkey").cast("string").alias("sku_id"), F.date_trunc("month", "l_shipdate").alias("month")
    ).agg(F.sum("l_quantity").alias("demand"))


@query(
    "xyz_class",
    "WITH "
    + XYZ_SQL
    + """SELECT sku_id, round(mean_demand, 6) AS mean_demand, round(std_demand, 6) AS std_demand,
       round(cv, 6) AS cv, xyz_class FROM xyz""",
)
def xyz_class(t: Tables) -> DataFrame:
    out = inv.xyz_class(monthly_demand(t), "sku_id", "demand")
    return out.withColumns({c: F.round(c, 6) for c in ("mean_demand", "std_demand", "cv")})


@query(
    "supplier_leadtime_stats",
    """
SELECT supplier, round(avg(lead_time_days), 6) AS mean_days, round(stddev_samp(lead_time_days), 6) AS std_days,
       min(lead_time_days) AS min_days, max(lead_time_days) AS max_days,
       round_even(stddev_samp(lead_time_days) / avg(lead_time_days) * 100, 1) AS cv_pct,
       round_even(stddev_samp(lead_time_days) / avg(lead_time_days) * 100, 1) > 30 AS unreliable,
       stddev_samp(lead_time_days) / avg(lead_time_days) > 0.3 AS unreliable_exact
FROM lead_times GROUP BY 1""",
    "lead_times",
)
def supplier_leadtime_stats(t: Tables) -> DataFrame:
    out = inv.lead_time_stats(t.lead_times())
    return out.withColumns({"mean_days": F.round("mean_days", 6), "std_days": F.round("std_days", 6)})


def eoq_input(t: Tables) -> DataFrame:
    """Yearly demand per SKU with cost and lead time; a SKU that never sold has zero demand."""
    annual = F.coalesce(F.col("total_units"), F.lit(0.0)) * 365 / DAYS
    return t.erp().select(
        F.col("product_id").alias("sku_id"), annual.alias("annual_demand"), F.lit(150.0).alias("order_cost"),
        F.lit(20.0).alias("holding_pct"), "unit_cost", "lead_time_days",
    )


EOQ_SQL = """
WITH i AS (SELECT product_id AS sku_id, coalesce(total_units, 0) * 365 / 2499.0::DOUBLE AS d, 150.0::DOUBLE AS s,
                  20.0::DOUBLE / 100 * unit_cost AS h, unit_cost, lead_time_days FROM erp),
z AS (SELECT * FROM (VALUES ('90%', 1.28::DOUBLE), ('95%', 1.65::DOUBLE), ('98%', 2.05::DOUBLE), ('99%', 2.33::DOUBLE)) v(service_level, z)),
c AS (SELECT *, h > 0 AND d > 0 AND s > 0 AS valid, CASE WHEN h > 0 THEN sqrt(2 * d * s / h) END AS eoq, d / 365 AS daily,
             z * sqrt(greatest(d / 365, 1.0::DOUBLE)) * sqrt(lead_time_days) AS ss FROM i CROSS JOIN z),
q AS (SELECT sku_id, service_level, z, CASE WHEN valid THEN round_even(eoq, 0) ELSE 0 END AS eoq,
             CASE WHEN valid THEN round_even(ss, 0) ELSE 0 END AS safety_stock,
             CASE WHEN valid THEN round_even(daily * lead_time_days + ss, 0) ELSE 0 END AS reorder_point_units,
             CASE WHEN valid THEN round_even(d * unit_cost + d / eoq * s + (eoq / 2 + ss) * h, 2) ELSE 0 END AS total_annual_cost,
             CASE WHEN valid THEN round_even(d / eoq, 1) ELSE 0 END AS orders_per_year,
             CASE WHEN valid THEN round_even(eoq / 2, 0) ELSE 0 END AS avg_cycle_stock FROM c)
"""


@query(
    "eoq",
    EOQ_SQL
    + """SELECT sku_id, eoq, safety_stock, reorder_point_units, total_annual_cost, orders_per_year, avg_cycle_stock
FROM q WHERE service_level = '95%'""",
    "erp",
)
def eoq(t: Tables) -> DataFrame:
    columns = inv.eoq_columns(
        F.col("annual_demand"), F.col("order_cost"), F.col("holding_pct"), F.col("unit_cost"), F.col("lead_time_days")
    )
    return eoq_input(t).select("sku_id", *[c.alias(n) for n, c in columns.items()])


@query(
    "service_level_eoq",
    EOQ_SQL + "SELECT sku_id, service_level, z, eoq, safety_stock, reorder_point_units, total_annual_cost FROM q",
    "erp",
)
def service_level_eoq(t: Tables) -> DataFrame:
    return inv.service_level_scenarios(eoq_input(t)).select(
        "sku_id", "service_level", "z", "eoq", "safety_stock", "reorder_point_units", "total_annual_cost"
    )


@query(
    "dead_stock",
    """
SELECT product_id AS sku_id, CAST(snapshot_date - last_sale AS INT) AS days_since_last_sale, lead_time_days AS avg_lead_time,
       snapshot_date - last_sale > 180 AS dead_stock_flag,
       round_even(least(50.0::DOUBLE, (snapshot_date - last_sale)::DOUBLE / greatest(lead_time_days, 1)), 2) AS dead_stock_score
FROM erp WHERE last_sale IS NOT NULL""",
    "erp",
)
def dead_stock(t: Tables) -> DataFrame:
    stock = t.erp().filter("last_sale IS NOT NULL").select(
        F.col("product_id").alias("sku_id"),
        F.datediff("snapshot_date", "last_sale").alias("days_since_last_sale"),
        F.col("lead_time_days").alias("avg_lead_time"),
    )
    return inv.dead_stock(stock)


def stock_levels(t: Tables) -> DataFrame:
    return t.erp().select(
        F.col("product_id").alias("sku_id"), F.col("stock_quantity").alias("current_stock"), "reorder_point", "unit_cost"
    )


def recent_demand(t: Tables) -> DataFrame:
    """Units per sold day of the last year, one row per SKU sold in that time."""
    recent = t.lines().filter(F.col("ts") >= F.lit("2000-11-04").cast("timestamp_ntz"))
    return recent.groupBy(F.col("product_id").alias("sku_id")).agg(
        (F.sum("quantity") / F.lit(365.0)).alias("avg_daily_demand")
    )


ALERT_SQL = """
WITH rd AS (SELECT CAST(l_partkey AS VARCHAR) AS sku_id, sum(CAST(l_quantity AS INT)) / 365.0::DOUBLE AS avg_daily_demand
            FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-11-04' GROUP BY 1),
j AS (SELECT product_id AS sku_id, stock_quantity AS current_stock, reorder_point, unit_cost,
             greatest(coalesce(avg_daily_demand, 10.0::DOUBLE), 0.1::DOUBLE) AS avg_daily_demand
      FROM erp LEFT JOIN rd ON product_id = sku_id),
a AS (SELECT *, round_even(current_stock / avg_daily_demand, 1) AS days_until_stockout FROM j),
al AS (SELECT *, CASE WHEN days_until_stockout <= 7 THEN 'Critical' WHEN days_until_stockout <= 14 THEN 'High'
                      WHEN days_until_stockout <= 30 THEN 'Medium' ELSE 'OK' END AS urgency FROM a)
"""


@query(
    "demand_lookup_join",
    ALERT_SQL + "SELECT sku_id, current_stock, round(avg_daily_demand, 6) AS avg_daily_demand FROM al",
    "erp",
)
def demand_lookup_join(t: Tables) -> DataFrame:
    out = inv.demand_per_sku(stock_levels(t), recent_demand(t), "sku_id")
    return out.select("sku_id", "current_stock", F.round("avg_daily_demand", 6).alias("avg_daily_demand"))


@query(
    "demand_lookup_p50",
    """
WITH p AS (SELECT CAST(l_partkey AS VARCHAR) AS sku_id, avg(l_quantity) AS p50 FROM lineitem
           GROUP BY 1)
SELECT product_id AS sku_id, round(greatest(coalesce(p50, 10.0::DOUBLE), 0.1::DOUBLE), 6) AS avg_daily_demand
FROM erp LEFT JOIN p ON product_id = sku_id""",
    "erp",
)
def demand_lookup_p50(t: Tables) -> DataFrame:
    forecast = t.lines().select(
        F.col("product_id").alias("sku_id"), F.col("quantity").alias("p50")
    )
    out = inv.demand_per_sku(stock_levels(t), forecast, "sku_id")
    return out.select("sku_id", F.round("avg_daily_demand", 6).alias("avg_daily_demand"))


@query(
    "reorder_alerts",
    ALERT_SQL
    + """SELECT sku_id, current_stock, reorder_point, round(avg_daily_demand, 6) AS avg_daily_demand,
       days_until_stockout, urgency, current_stock < reorder_point AS below_reorder_point FROM al""",
    "erp",
)
def reorder_alerts(t: Tables) -> DataFrame:
    out = inv.reorder_alerts(stock_levels(t), recent_demand(t))
    return out.drop("unit_cost").withColumn("avg_daily_demand", F.round("avg_daily_demand", 6))


@query(
    "stock_urgency",
    ALERT_SQL
    + """SELECT sku_id, days_until_stockout, urgency,
       CASE WHEN days_until_stockout <= 7 THEN 'Critical' WHEN days_until_stockout <= 14 THEN 'High' ELSE 'Medium' END AS urgency_three
FROM al""",
    "erp",
)
def stock_urgency_query(t: Tables) -> DataFrame:
    out = inv.reorder_alerts(stock_levels(t), recent_demand(t))
    three = stock_urgency(F.col("days_until_stockout"), with_ok=False)
    return out.select("sku_id", "days_until_stockout", "urgency", three.alias("urgency_three"))


@query(
    "reorder_sort",
    ALERT_SQL
    + """SELECT sku_id, urgency, days_until_stockout FROM al
ORDER BY CASE urgency WHEN 'Critical' THEN 0 WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END, days_until_stockout, sku_id""",
    "erp",
)
def reorder_sort(t: Tables) -> DataFrame:
    """All alerts, the most urgent first."""
    alerts = inv.reorder_alerts(stock_levels(t), recent_demand(t))
    return inv.by_urgency(alerts).select("sku_id", "urgency", "days_until_stockout")


@query(
    "reorder_recommendations",
    ALERT_SQL
    + """, r AS (SELECT *, CASE WHEN unit_cost > 0 THEN greatest(1, CAST(round_even(sqrt(2 * (avg_daily_demand * 365) * 150.0::DOUBLE / (unit_cost * 0.2::DOUBLE)), 0) AS BIGINT)) ELSE 0 END AS q,
          greatest(0, CAST(round_even(avg_daily_demand * 30 - current_stock, 0) AS BIGINT)) AS p FROM al)
SELECT sku_id, current_stock, days_until_stockout, urgency, CAST(q AS BIGINT) AS recommended_qty,
       CAST(p AS BIGINT) AS recommended_qty_plain, round_even(q * unit_cost, 2) AS po_value,
       (SELECT count(*) FROM al WHERE urgency = 'Critical') AS critical_count
FROM r""",
    "erp",
)
def reorder_recommendations(t: Tables) -> DataFrame:
    stock = inv.demand_per_sku(stock_levels(t), recent_demand(t), "sku_id")
    both = inv.reorder_recommendations(stock, use_eoq=False).withColumnRenamed("recommended_qty", "recommended_qty_plain")
    out = inv.reorder_recommendations(both)
    critical = out.agg(F.count_if(F.col("urgency") == "Critical")).scalar()
    return out.select(
        "sku_id", "current_stock", "days_until_stockout", "urgency", "recommended_qty",
        F.col("recommended_qty_plain").cast("long").alias("recommended_qty_plain"), "po_value", critical.alias("critical_count"),
    )


@query(
    "dedup_first",
    """
SELECT CAST(l_partkey AS VARCHAR) AS sku_id, CAST(l_orderkey AS BIGINT) AS order_key, l_linenumber AS line_number, l_quantity AS quantity
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity, l_extendedprice) = 1""",
)
def dedup_first(t: Tables) -> DataFrame:
    order = [F.col(c) for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")]
    first = newest_per_key(t.lineitem, ["l_partkey"], order)
    return first.select(
        F.col("l_partkey").cast("string").alias("sku_id"), F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"), F.col("l_quantity").alias("quantity"),
    )


MATRIX_SQL = (
    REVENUE_SQL.rstrip()
    + ",\n"
    + XYZ_SQL
    + """, jn AS (SELECT abc_class, xyz_class, unit_cost * stock_quantity * 0.2::DOUBLE AS holding,
                 stock_quantity <= reorder_point AS at_risk
          FROM abc JOIN xyz USING (sku_id) JOIN erp ON product_id = sku_id)
"""
)


@query(
    "abc_xyz_matrix",
    MATRIX_SQL
    + """SELECT coalesce(abc_class, 'All') AS abc_class, coalesce(xyz_class, 'All') AS xyz_class, count(*) AS sku_count,
       count(*) FILTER (WHERE at_risk) AS at_risk, round(avg(holding), 4) AS avg_holding_cost
FROM jn GROUP BY ROLLUP (abc_class, xyz_class)""",
    "erp",
)
def abc_xyz_matrix(t: Tables) -> DataFrame:
    abc = inv.abc_class(sku_revenue(t)).select("sku_id", "abc_class")
    xyz = inv.xyz_class(monthly_demand(t), "sku_id", "demand").select("sku_id", "xyz_class")
    erp = t.erp().select(
        F.col("product_id").alias("sku_id"),
        (F.col("unit_cost") * F.col("stock_quantity") * F.lit(0.2)).alias("holding"),
        (F.col("stock_quantity") <= F.col("reorder_point")).alias("at_risk"),
    )
    out = abc.join(xyz, "sku_id").join(erp, "sku_id").rollup("abc_class", "xyz_class").agg(
        F.count(F.lit(1)).alias("sku_count"), F.count_if("at_risk").alias("at_risk"),
        F.round(F.avg("holding"), 4).alias("avg_holding_cost"),
    )
    return out.withColumns(
        {c: F.coalesce(c, F.lit("All")) for c in ("abc_class", "xyz_class")}
    )


@query(
    "inventory_kpis",
    ALERT_SQL
    + """, k AS (SELECT al.urgency, al.current_stock / al.avg_daily_demand AS days_of_supply,
                 al.unit_cost * al.current_stock * 0.2::DOUBLE AS holding_cost,
                 least(1.0::DOUBLE, coalesce(e.snapshot_date - e.last_sale, 999) / 365.0::DOUBLE) AS dead_risk
          FROM al JOIN erp e ON product_id = sku_id)
SELECT count(*) AS total_skus, count(*) FILTER (WHERE urgency = 'Critical') AS critical_alerts,
       count(*) FILTER (WHERE days_of_supply > 90) AS overstock, count(*) FILTER (WHERE dead_risk > 0.7) AS dead_risk_skus,
       count(*) FILTER (WHERE holding_cost > 10000) AS high_holding_cost,
       count(*) FILTER (WHERE days_of_supply > 90 AND holding_cost > 10000) AS quadrant_slow_expensive,
       count(*) FILTER (WHERE days_of_supply > 90 AND holding_cost <= 10000) AS quadrant_slow_cheap,
       count(*) FILTER (WHERE days_of_supply <= 90 AND holding_cost > 10000) AS quadrant_fast_expensive,
       count(*) FILTER (WHERE days_of_supply <= 90 AND holding_cost <= 10000) AS quadrant_fast_cheap
FROM k""",
    "erp",
)
def inventory_kpis(t: Tables) -> DataFrame:
    idle = F.coalesce(F.datediff("snapshot_date", "last_sale"), F.lit(999)) / F.lit(365.0)
    stock = t.erp().select(
        F.col("product_id").alias("sku_id"), F.col("stock_quantity").alias("current_stock"), "reorder_point",
        (F.col("unit_cost") * F.col("stock_quantity") * F.lit(0.2)).alias("holding_cost"),
        F.least(F.lit(1.0), idle).alias("dead_risk"),
    )
    alerts = inv.reorder_alerts(stock, recent_demand(t))
    return inv.inventory_kpis(
        alerts.withColumn("days_of_supply", F.col("current_stock") / F.col("avg_daily_demand"))
    )
