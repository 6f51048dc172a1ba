"""Forecasting queries on daily sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline.functions import calendar as cal
from shelfline.operators import forecast as fc
from shelfline.operators import frames as fr
from shelfline.operators import inventory as inv
from shelfline.operators import timeseries as ts
from shelfline.operators.curves import Design
from shelfline.plans import forecast_sql
from shelfline.plans.frames import QUANTILE_SQL, quantile_forecast
from shelfline.plans.registry import query
from shelfline.plans.views import Tables
from shelfline.session import stage_table


def promoted(daily: DataFrame) -> DataFrame:
    """Daily sales with a promotion flag for the first week of each month."""
    return daily.withColumn("is_promotional_period", F.dayofmonth("date") <= 7)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in columns})


GRID_SQL = ", ".join(
    "(VALUES " + ", ".join(f"('{v}')" if isinstance(v, str) else f"({v}::DOUBLE)" for v in values) + f") v{i}({name})"
    for i, (name, values) in enumerate(fc.SEARCH_SPACE.items())
)


@query(
    "param_grid_cross",
    f"SELECT product_id, n_days, {', '.join(fc.SEARCH_SPACE)} FROM (SELECT product_id, count(*) AS n_days FROM daily_sales GROUP BY 1), {GRID_SQL}",
    "daily_sales",
)
def param_grid_cross(t: Tables) -> DataFrame:
    return fc.with_grid(t.daily_sales().groupBy("product_id").agg(F.count(F.lit(1)).alias("n_days")))


def horizon_days(daily: DataFrame, horizon: int = 30) -> DataFrame:
    """The calendar behind the last day of sales: what a promotion calendar knows ahead."""
    last = daily.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    return promoted(last.select(F.explode(F.sequence(F.date_add("a", 1), F.date_add("b", horizon))).alias("date")))


FORECAST_DESIGN = Design(regressors=("is_promotional_period",))


@query("seasonal_forecast", forecast_sql.seasonal(FORECAST_DESIGN, "day(date) <= 7"), "daily_sales")
def seasonal_forecast(t: Tables) -> DataFrame:
    daily = promoted(t.daily_sales())
    out = fc.seasonal_forecast(daily, FORECAST_DESIGN, future=horizon_days(daily))
    return rounded(out, "yhat", "yhat_lower", "yhat_upper", "mape", "rmse", "mae", "coverage")


def with_signals(t: Tables, days: DataFrame) -> DataFrame:
    """Days with the usual temperature of the day of the year, the mean price index of the month, and whether it is a holiday.

    All three are known ahead.
    """
    usual = t.weather().groupBy(F.dayofyear("date").alias("_doy")).agg(F.avg("temp_c").alias("temp_c"))  # a row for each day of a year
    index = t.cpi().groupBy(F.col("month").alias("_month")).agg(F.avg("cpi_index").alias("cpi_index"))  # twelve rows
    joined = days.withColumns({"_doy": F.dayofyear("date"), "_month": F.month("date"), "is_holiday": F.array_contains(cal.holiday_array(), F.col("date"))})
    return joined.join(F.broadcast(usual), "_doy", "left").join(F.broadcast(index), "_month", "left").drop("_doy", "_month")


@query("dual_season_forecast")
def dual_season_forecast(t: Tables) -> DataFrame:
    """SKUs whose season is classed high, all SKUs when none is."""
    daily = stage_table(t.daily_sales(), "daily")
    return fc.dual_season_forecast(with_signals(t, promoted(daily)), ts.strength_classes(daily), future=with_signals(t, horizon_days(daily)))


@query("arima_benchmark")
def arima_benchmark(t: Tables) -> DataFrame:
    daily = stage_table(t.daily_sales(), "daily")
    return fc.arima_benchmark(daily, ts.order_hints(ts.stationarity(daily)))


@query("hpo_grid")
def hpo_grid(t: Tables) -> DataFrame:
    return fc.search_parameters(promoted(t.daily_sales()))


@query("hpo_best")
def hpo_best(t: Tables) -> DataFrame:
    """The best parameters per SKU; SKUs without a finished trial keep the defaults."""
    trials = fc.search_parameters(promoted(t.daily_sales()))
    defaults = {k: F.lit(v) for k, v in fc.DEFAULT_PARAMETERS.items()}
    return fr.best_trial(trials, ["product_id"], list(fc.SEARCH_SPACE), defaults)


@query("error_by_horizon", forecast_sql.by_horizon(Design(weekly=3, yearly=3), fc.CURVE_HORIZONS, fc.MINIMUM_ROWS), "daily_sales")
def error_by_horizon(t: Tables) -> DataFrame:
    """Hold-out errors of every SKU, without its class."""
    daily = t.daily_sales()
    none = t.spark.createDataFrame([], "product_id string, category string")
    return rounded(fc.error_by_horizon(daily, none).drop("tier"), "mape")


@query("mape_vs_horizon")
def mape_vs_horizon(t: Tables) -> DataFrame:
    daily = stage_table(t.daily_sales(), "daily")
    return fc.tier_error_curve(fc.error_by_horizon(daily, ts.strength_classes(daily)))


@query("quantile_forecast")
def quantile_forecast_query(t: Tables) -> DataFrame:
    return fc.quantile_forecast(t.daily_sales())


@query(
    "safety_stock_from_quantiles",
    QUANTILE_SQL
    + """, st AS (SELECT product_id, row_number() OVER (PARTITION BY product_id ORDER BY date) AS step, p50, p90 FROM qf),
lt AS (SELECT p_brand AS product_id, max(CAST(7 + p_partkey % 21 AS INT)) AS lead_time_days FROM part GROUP BY 1)
SELECT product_id, lead_time_days, round(sum(p90 - p50), 6) AS safety_stock FROM st JOIN lt USING (product_id) WHERE step <= lead_time_days GROUP BY 1, 2""",
    "daily_sales",
)
def safety_stock_from_quantiles(t: Tables) -> DataFrame:
    step = F.row_number().over(Window.partitionBy("product_id").orderBy("date"))
    forecast = quantile_forecast(t).withColumn("step", step)
    lead = t.part.groupBy(F.col("p_brand").alias("product_id")).agg(
        F.max((7 + F.col("p_partkey") % 21).cast("int")).alias("lead_time_days")
    )
    out = inv.safety_stock_from_quantiles(forecast, lead, "product_id")
    return out.withColumn("safety_stock", F.round("safety_stock", 6))
