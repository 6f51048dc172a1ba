"""Inventory analytics: ABC and XYZ classes, order quantities, dead stock, reorder alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.scalars import URGENCY_ORDER, half_even, ladder, rank_of, stock_urgency
from shelfline.operators.ordered import newest_per_key, running_totals

# Defaults of the order quantity formulas.
SAFETY_FACTOR = 1.65
SERVICE_LEVELS = {"90%": 1.28, "95%": 1.65, "98%": 2.05, "99%": 2.33}
EOQ_FIELDS = {
    "eoq": 0, "safety_stock": 0, "reorder_point_units": 0, "total_annual_cost": 2,
    "orders_per_year": 1, "avg_cycle_stock": 0,
}
DEFAULT_DEMAND = 10.0
DEMAND_FLOOR = 0.1


def abc_class(
    skus: DataFrame, revenue: str = "total_revenue", sku: str = "sku_id", a: float = 0.70, b: float = 0.90
) -> DataFrame:
    """Cumulative revenue share by falling revenue: A up to ``a``, B up to ``b``, else C.

    The running sum is kept in decimals so that a share of exactly ``a`` cannot flip.
    """
    if not 0 < a < b < 1:
        raise ValueError("thresholds must satisfy 0 < a < b < 1")
    base = skus.withColumn("_money", F.col(revenue).cast(T.DecimalType(18, 4)))
    order = [F.col("_money").desc(), F.col(sku)]
    running = running_totals(base, order, {"_upto": F.col("_money")}, with_totals=True)
    whole, upto = F.col("_upto_total"), F.col("_upto")
    cut_a, cut_b = [whole * F.lit(str(x)).cast(T.DecimalType(6, 4)) for x in (a, b)]

    def share(part: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    abc = F.when(whole == 0, "C").otherwise(ladder([(upto <= cut_a, "A"), (upto <= cut_b, "B")], "C"))
    return running.withColumns(
        {"revenue_pct": share(F.col("_money")), "cumulative_pct": share(upto), "abc_class": abc}
    ).drop("_money", "_upto", "_upto_total")


def exact_std(value: Column) -> Column:
    """Sample standard deviation that does not depend on the order of rows where values are whole numbers.

    Their sums are exact while below 2^53, so a ratio of exactly 0.5 cannot fall below it; other values take the usual aggregate.
    """
    value = value.cast("double")
    n, total, squares = F.count(value), F.sum(value), F.sum(value * value)
    exact = F.bool_and(value == F.rint(value)) & (n * squares < F.lit(float(2**53)))
    return F.when(exact, F.sqrt(F.try_divide(n * squares - total * total, n * (n - 1)))).otherwise(F.stddev_samp(value))


def xyz_class(demand: DataFrame, sku: str, value: str, x: float = 0.5, y: float = 1.0) -> DataFrame:
    """Class by coefficient of variation: X below ``x``, Y below ``y``, else Z."""
    mean, std = F.avg(value), F.coalesce(exact_std(F.col(value)), F.lit(0.0))
    stats = demand.groupBy(sku).agg(mean.alias("mean_demand"), std.alias("std_demand"))
    cv = F.when(F.col("mean_demand") > 0, F.try_divide("std_demand", "mean_demand")).otherwise(0.0)
    return stats.withColumn("cv", cv).withColumn(
        "xyz_class", ladder([(F.col("cv") < x, "X"), (F.col("cv") < y, "Y")], "Z")
    )


def lead_time_stats(lead_times: DataFrame) -> DataFrame:
    days = F.col("lead_time_days")
    stats = lead_times.groupBy("supplier").agg(
        F.avg(days).alias("mean_days"), F.stddev_samp(days).alias("std_days"),
        F.min(days).alias("min_days"), F.max(days).alias("max_days"),
    )
    cv = F.try_divide("std_days", "mean_days")
    return stats.withColumns(
        {
            "cv_pct": half_even(cv * 100, 1),
            "unreliable": F.coalesce(half_even(cv * 100, 1) > 30, F.lit(False)),
            "unreliable_exact": F.coalesce(cv > 0.3, F.lit(False)),
        }
    )


def eoq_columns(
    annual_demand: Column, order_cost: Column, holding_pct: Column, unit_cost: Column,
    lead_days: Column, factor: Column | None = None, daily_std: Column | None = None,
) -> dict[str, Column]:
    """Economic order quantity, safety stock, reorder point, yearly cost, orders, cycle stock.

    Non-positive demand, order cost or holding cost give zeros.
    """
    holding = holding_pct / 100 * unit_cost
    valid = (holding > 0) & (annual_demand > 0) & (order_cost > 0)
    eoq = F.sqrt(F.try_divide(2 * annual_demand * order_cost, holding))
    daily = annual_demand / 365
    std = F.sqrt(F.greatest(daily, F.lit(1.0)))
    if daily_std is not None:
        std = F.coalesce(daily_std, std)
    safety = (F.lit(SAFETY_FACTOR) if factor is None else factor) * std * F.sqrt(lead_days)
    orders = F.try_divide(annual_demand, eoq)
    cycle = eoq / 2
    raw = {
        "eoq": eoq,
        "safety_stock": safety,
        "reorder_point_units": daily * lead_days + safety,
        "total_annual_cost": annual_demand * unit_cost + orders * order_cost + (cycle + safety) * holding,
        "orders_per_year": orders,
        "avg_cycle_stock": cycle,
    }
    return {
        n: F.coalesce(F.when(valid, half_even(c, EOQ_FIELDS[n])), F.lit(0.0)) for n, c in raw.items()
    }


def order_quantity(annual_demand: Column, unit_cost: Column, order_cost: float = 150.0, holding: float = 0.20) -> Column:
    """Order quantity of the recommendation list: at least one unit, zero for unusable input."""
    base = F.try_divide(2 * annual_demand * order_cost, unit_cost * holding)
    valid = (annual_demand > 0) & (unit_cost > 0)
    return F.coalesce(F.when(valid, F.greatest(F.lit(1), half_even(F.sqrt(base), 0).cast("long"))), F.lit(0))


def dead_stock(
    stock: DataFrame, days: str = "days_since_last_sale", lead: str = "avg_lead_time", threshold: int = 180
) -> DataFrame:
    lead_days = F.col(lead) if lead in stock.columns else F.lit(14)
    score = F.least(F.lit(50.0), F.col(days) / F.greatest(lead_days, F.lit(1)))
    return stock.withColumns(
        {"dead_stock_flag": F.col(days) > threshold, "dead_stock_score": half_even(score, 2)}
    )


def demand_per_sku(inventory: DataFrame, demand: DataFrame | None, sku: str) -> DataFrame:
    """Attach the average daily demand: a given average, else the mean P50, else the default."""
    if demand is None:
        return inventory.withColumn("avg_daily_demand", F.lit(DEFAULT_DEMAND))
    if "avg_daily_demand" in demand.columns:
        order = [F.col(c) for c in ("date",) if c in demand.columns] + [F.col("avg_daily_demand").desc()]
        lookup = newest_per_key(demand, [sku], order).select(sku, "avg_daily_demand")
    elif "p50" in demand.columns:
        lookup = demand.groupBy(sku).agg(F.avg("p50").alias("avg_daily_demand"))
    else:
        return inventory.withColumn("avg_daily_demand", F.lit(DEFAULT_DEMAND))
    joined = inventory.join(lookup, sku, "left")
    filled = F.coalesce("avg_daily_demand", F.lit(DEFAULT_DEMAND))
    return joined.withColumn("avg_daily_demand", F.greatest(filled, F.lit(DEMAND_FLOOR)))


def reorder_alerts(
    inventory: DataFrame, demand: DataFrame | None, sku: str = "sku_id", stock: str = "current_stock",
    reorder_point: str = "reorder_point",
) -> DataFrame:
    """Days until stock-out, urgency of the rounded days, and the reorder point flag."""
    out = demand_per_sku(inventory, demand, sku)
    days = half_even(F.col(stock) / F.col("avg_daily_demand"), 1)
    below = F.col(stock) < F.col(reorder_point) if reorder_point in inventory.columns else F.lit(False)
    return out.withColumn("days_until_stockout", days).withColumns(
        {"urgency": stock_urgency(F.col("days_until_stockout")), "below_reorder_point": below}
    )


def by_urgency(alerts: DataFrame, sku: str = "sku_id") -> DataFrame:
    return alerts.orderBy(rank_of(F.col("urgency"), URGENCY_ORDER), "days_until_stockout", sku)


def reorder_recommendations(stock: DataFrame, use_eoq: bool = True) -> DataFrame:
    """Order quantity and value per SKU from current stock and average daily demand."""
    daily = F.greatest(F.col("avg_daily_demand"), F.lit(DEMAND_FLOOR))
    plain = F.greatest(F.lit(0), half_even(daily * 30 - F.col("current_stock"), 0).cast("long"))
    quantity = order_quantity(daily * 365, F.col("unit_cost")) if use_eoq else plain
    days = half_even(F.col("current_stock") / daily, 1)
    return stock.withColumns({"days_until_stockout": days, "recommended_qty": quantity}).withColumns(
        {
            "urgency": stock_urgency(F.col("days_until_stockout")),
            "po_value": half_even(F.col("recommended_qty") * F.col("unit_cost"), 2),
        }
    )


def service_level_scenarios(skus: DataFrame) -> DataFrame:
    """One row per SKU and service level; the fixed scenarios are exploded from a literal."""
    scenarios = F.array(
        *[F.struct(F.lit(n).alias("service_level"), F.lit(z).alias("z")) for n, z in SERVICE_LEVELS.items()]
    )
    spread = skus.select("*", F.inline(scenarios))
    columns = eoq_columns(
        F.col("annual_demand"), F.col("order_cost"), F.col("holding_pct"), F.col("unit_cost"),
        F.col("lead_time_days"), F.col("z"),
    )
    return spread.withColumns(columns)


def safety_stock_from_quantiles(forecast: DataFrame, inventory: DataFrame, sku: str) -> DataFrame:
    """Spread between the high and the middle forecast over the lead time."""
    joined = forecast.join(inventory.select(sku, "lead_time_days"), sku)
    inside = joined.filter(F.col("step") <= F.col("lead_time_days"))
    return inside.groupBy(sku).agg(
        F.max("lead_time_days").alias("lead_time_days"),
        F.sum(F.col("p90") - F.col("p50")).alias("safety_stock"),
    )


def inventory_kpis(stock: DataFrame) -> DataFrame:
    def count_if(c: Column) -> Column:
        return F.count_if(F.coalesce(c, F.lit(False)))

    long_cover, high_cost = F.col("days_of_supply") > 90, F.col("holding_cost") > 10_000
    return stock.agg(
        F.count(F.lit(1)).alias("total_skus"),
        count_if(F.col("urgency") == "Critical").alias("critical_alerts"),
        count_if(long_cover).alias("overstock"),
        count_if(F.col("dead_risk") > 0.7).alias("dead_risk_skus"),
        count_if(high_cost).alias("high_holding_cost"),
        count_if(long_cover & high_cost).alias("quadrant_slow_expensive"),
        count_if(long_cover & ~high_cost).alias("quadrant_slow_cheap"),
        count_if(~long_cover & high_cost).alias("quadrant_fast_expensive"),
        count_if(~long_cover & ~high_cost).alias("quadrant_fast_cheap"),
    )
