"""Queries for frame-level operators, scalar functions and dashboard figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import scalars as sc
from shelfline.operators import forecast
from shelfline.operators import frames as fr
from shelfline.operators.curves import Design
from shelfline.plans import forecast_sql
from shelfline.plans.monitoring import FORECAST_SQL, naive_forecasts
from shelfline.functions.scalars import percent_error
from shelfline.plans.registry import query
from shelfline.plans.views import Tables

CUT = "2001-10-05"  # first forecast day of the quantile frame


BAND = Design(weekly=3, yearly=3)
BAND_DAYS = 31


def quantile_forecast(t: Tables) -> DataFrame:
    """Forecast of the last month from the sales before it: curves with the quantiles of their residuals."""
    known = t.daily_sales().filter(F.col("date") < F.lit(CUT).cast("date"))
    out = forecast.residual_quantile_forecast(known, BAND_DAYS, BAND)
    return out.withColumns({c: F.round(c, 4) for c in ("p10", "p50", "p90")})


QUANTILE_SQL = "WITH RECURSIVE " + FORECAST_SQL.strip() + ", " + forecast_sql.bands(BAND, f"(SELECT * FROM daily_sales WHERE date < DATE '{CUT}')", BAND_DAYS) + "\n"


@query(
    "enrich_metadata",
    "SELECT 'POS' AS source_system, count(*) AS n, true AS has_timestamp FROM lineitem",
)
def enrich_metadata(t: Tables) -> DataFrame:
    out = fr.enrich_metadata(t.lines(), "POS")
    return out.groupBy("source_system").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("ingestion_timestamp").isNotNull()).alias("has_timestamp")
    )


@query(
    "normalise_demand",
    "SELECT product_id, CAST(date AS TIMESTAMP) AS ds, quantity AS y, date AS restored FROM daily_sales",
    "daily_sales",
)
def normalise_demand(t: Tables) -> DataFrame:
    out = fr.normalise_demand(t.daily_sales())
    return out.withColumn("restored", F.to_date("ds"))


@query(
    "top_skus",
    """SELECT p_brand AS product_id, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS total
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) DESC, 1 LIMIT 20""",
)
def top_skus(t: Tables) -> DataFrame:
    top = fr.top_by_total(t.category_sales(), "brand", F.col("total_amount"), 20)
    return top.select(F.col("brand").alias("product_id"), F.col("total").cast("double").alias("total"))


@query(
    "semi_join_top_skus",
    """WITH top AS (SELECT p_brand FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
       ORDER BY sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) DESC, 1 LIMIT 5)
SELECT product_id, date, quantity FROM daily_sales WHERE product_id IN (SELECT p_brand FROM top)""",
    "daily_sales",
)
def semi_join_top_skus(t: Tables) -> DataFrame:
    top = fr.top_by_total(t.category_sales(), "brand", F.col("total_amount"), 5)
    return fr.keep_top(t.daily_sales(), top.withColumnRenamed("brand", "product_id"), "product_id")


TRIAL_SQL = "WITH " + FORECAST_SQL.strip() + """,
tr AS (SELECT product_id, h AS trial_id, h AS lag_days, avg(abs(y - p) / CASE WHEN abs(y) < 1e-8 THEN 1.0::DOUBLE ELSE abs(y) END) AS m, count(*) AS n
       FROM (SELECT product_id, y, 1 AS h, l1 AS p FROM fc UNION ALL SELECT product_id, y, 7, l7 FROM fc UNION ALL SELECT product_id, y, 30, l30 FROM fc)
       WHERE p IS NOT NULL GROUP BY 1, 2),
tl AS (SELECT product_id, product_id || '/' || lpad(trial_id::VARCHAR, 2, '0') AS trial_id, lag_days,
              CASE WHEN right(product_id, 1) IN ('5', '6') AND lag_days < 30 OR product_id = 'Brand#1' THEN 'FAILED' ELSE 'SUCCESS' END AS status, m AS cv_mape FROM tr)
"""


def trials(t: Tables) -> DataFrame:
    """One trial per SKU and lag; some are marked failed by rule."""
    steps = F.array(*[F.struct(F.lit(h).alias("lag_days"), F.col(f"l{h}").alias("p")) for h in (1, 7, 30)])
    rows = naive_forecasts(t).select("product_id", "y", F.inline(steps)).filter("p IS NOT NULL")
    measured = rows.groupBy("product_id", "lag_days").agg(F.avg(percent_error(F.col("y"), F.col("p"))).alias("cv_mape"))
    failed = (F.substring("product_id", -1, 1).isin("5", "6") & (F.col("lag_days") < 30)) | (F.col("product_id") == "Brand#1")
    return measured.select(
        "product_id", F.concat("product_id", F.lit("/"), F.lpad(F.col("lag_days").cast("string"), 2, "0")).alias("trial_id"),
        "lag_days", F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"), "cv_mape",
    )


@query(
    "top_trials",
    TRIAL_SQL + "SELECT trial_id, lag_days, round(cv_mape, 6) AS cv_mape FROM tl WHERE status = 'SUCCESS' ORDER BY cv_mape, trial_id LIMIT 20",
    "daily_sales",
)
def top_trials(t: Tables) -> DataFrame:
    return fr.top_trials(trials(t)).select("trial_id", "lag_days", F.round("cv_mape", 6).alias("cv_mape"))


@query(
    "best_trial",
    TRIAL_SQL
    + """, g AS (SELECT product_id, min(cv_mape) FILTER (WHERE status = 'SUCCESS') AS m, arg_min(lag_days, cv_mape) FILTER (WHERE status = 'SUCCESS') AS l FROM tl GROUP BY 1)
SELECT product_id, round(m, 6) AS cv_mape, coalesce(l, 14) AS lag_days FROM g""",
    "daily_sales",
)
def best_trial(t: Tables) -> DataFrame:
    out = fr.best_trial(trials(t), ["product_id"], ["lag_days"], {"lag_days": F.lit(14)})
    return out.withColumn("cv_mape", F.round("cv_mape", 6))


@query(
    "winner_by_min",
    "WITH " + FORECAST_SQL.strip()
    + """, m AS (SELECT product_id, avg(abs(y - l1) / CASE WHEN abs(y) < 1e-8 THEN 1.0::DOUBLE ELSE abs(y) END) FILTER (WHERE l1 IS NOT NULL) AS a, avg(abs(y - l7) / CASE WHEN abs(y) < 1e-8 THEN 1.0::DOUBLE ELSE abs(y) END) FILTER (WHERE l7 IS NOT NULL) AS p,
            avg(abs(y - l30) / CASE WHEN abs(y) < 1e-8 THEN 1.0::DOUBLE ELSE abs(y) END) FILTER (WHERE l30 IS NOT NULL) AS u FROM fc GROUP BY 1),
n AS (SELECT product_id, CASE WHEN product_id = 'Brand#2' OR right(product_id, 1) = '3' THEN NULL ELSE a END AS a,
             CASE WHEN product_id = 'Brand#2' THEN NULL ELSE p END AS p, CASE WHEN product_id = 'Brand#2' THEN NULL ELSE u END AS u FROM m)
SELECT product_id, CASE WHEN a IS NOT NULL AND a <= coalesce(p, a) AND a <= coalesce(u, a) THEN 'arima'
                        WHEN p IS NOT NULL AND p <= coalesce(u, p) THEN 'prophet' WHEN u IS NOT NULL THEN 'auto_arima' ELSE 'arima' END AS winner FROM n""",
    "daily_sales",
)
def winner_by_min(t: Tables) -> DataFrame:
    """The smallest of three errors per SKU; a few are NaN by rule."""
    fc = naive_forecasts(t)
    errors = fc.groupBy("product_id").agg(
        *[F.avg(percent_error(F.col("y"), F.col(c))).alias(n) for n, c in (("arima", "l1"), ("prophet", "l7"), ("auto_arima", "l30"))]
    )
    all_gone = F.col("product_id") == "Brand#2"
    nan = F.lit(float("nan"))
    holes = errors.withColumns(
        {
            "arima": F.when(all_gone | F.endswith("product_id", F.lit("3")), nan).otherwise(F.col("arima")),
            "prophet": F.when(all_gone, nan).otherwise(F.col("prophet")),
            "auto_arima": F.when(all_gone, nan).otherwise(F.col("auto_arima")),
        }
    )
    names = {n: F.col(n) for n in ("arima", "prophet", "auto_arima")}
    return holes.select("product_id", sc.winner_by_min(names, "arima").alias("winner"))


@query(
    "union_hist_forecast",
    QUANTILE_SQL
    + f"""SELECT product_id, date, y AS actual, NULL::DOUBLE AS p10, NULL::DOUBLE AS p50, NULL::DOUBLE AS p90, false AS is_forecast FROM fc
WHERE date < DATE '{CUT}' UNION ALL SELECT product_id, date, NULL, p10, p50, p90, true FROM qf""",
    "daily_sales",
)
def union_hist_forecast(t: Tables) -> DataFrame:
    history = t.daily_sales().filter(F.col("date") < F.lit(CUT).cast("date")).withColumnRenamed("quantity", "actual")
    return fr.union_history_forecast(history, quantile_forecast(t))


@query(
    "forecast_summary",
    QUANTILE_SQL + "SELECT product_id, round(sum(p50), 3) AS total_p50, round(avg(p50), 6) AS mean_p50, max(p90) AS max_p90, min(p10) AS min_p10 FROM qf GROUP BY 1",
    "daily_sales",
)
def forecast_summary(t: Tables) -> DataFrame:
    return quantile_forecast(t).groupBy("product_id").agg(
        F.round(F.sum("p50"), 3).alias("total_p50"), F.round(F.avg("p50"), 6).alias("mean_p50"), F.max("p90").alias("max_p90"), F.min("p10").alias("min_p10")
    )


@query(
    "quantile_order_check",
    QUANTILE_SQL
    + """, b AS (SELECT product_id, date, p10, p50, CASE WHEN day(date) % 5 = 0 THEN p50 - 1 ELSE p90 END AS p90 FROM qf)
SELECT product_id, date, p50 AS p10, p50, p50 AS p90 FROM b WHERE p90 >= p50 AND p10 >= 0 AND p50 >= 0""",
    "daily_sales",
)
def quantile_order_check(t: Tables) -> DataFrame:
    """Rows whose band is upside down by rule are rejected; the rest are reported as points."""
    broken = quantile_forecast(t).withColumn(
        "p90", F.when(F.dayofmonth("date") % 5 == 0, F.col("p50") - 1).otherwise(F.col("p90"))
    )
    return fr.point_only(fr.valid_quantiles(broken), include_confidence=False)


SCENARIOS = [
    {"promo_pct": 10, "price_pct": 0, "temp_delta": 0},
    {"promo_pct": 0, "price_pct": 5, "temp_delta": 0},
    {"promo_pct": 20, "price_pct": -5, "temp_delta": 4},
]


@query(
    "whatif_demand",
    QUANTILE_SQL
    + """, s AS (SELECT * FROM (VALUES (10.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE), (0, 5, 0), (20, -5, 4)) v(promo_pct, price_pct, temp_delta)),
b AS (SELECT product_id, sum(p50) AS base_demand FROM qf GROUP BY 1)
SELECT product_id, promo_pct, price_pct, temp_delta, round(base_demand, 3) AS base_demand,
       round(base_demand * (1 + promo_pct / 100 + -1.5::DOUBLE * price_pct / 100 + 0.005::DOUBLE * temp_delta), 3) AS total_demand FROM b, s""",
    "daily_sales",
)
def whatif_demand(t: Tables) -> DataFrame:
    out = fr.whatif_demand(quantile_forecast(t), SCENARIOS, ["product_id"])
    return out.withColumns({c: F.round(c, 3) for c in ("base_demand", "total_demand")})


@query(
    "forecast_workbook_tables",
    QUANTILE_SQL
    + """SELECT 'Forecast' AS sheet, product_id, strftime(date, '%Y-%m-%d') AS date, p50 AS value, NULL AS band FROM qf
UNION ALL SELECT 'MAPE Summary', product_id, NULL, round(m, 6), CASE WHEN m <= 10 THEN 'green' WHEN m <= 15 THEN 'amber' ELSE 'red' END
FROM (SELECT product_id, avg(abs(y - l7) / CASE WHEN abs(y) < 1e-8 THEN 1.0::DOUBLE ELSE abs(y) END) * 100 AS m FROM fc WHERE l7 IS NOT NULL GROUP BY 1)""",
    "daily_sales",
)
def forecast_workbook_tables(t: Tables) -> DataFrame:
    fc = naive_forecasts(t).filter("l7 IS NOT NULL")
    mapes = fc.groupBy("product_id").agg((F.avg(percent_error(F.col("y"), F.col("l7"))) * 100).alias("mape"))
    forecast, summary = fr.workbook_tables(quantile_forecast(t), mapes)
    left = forecast.select(F.lit("Forecast").alias("sheet"), "product_id", "date", F.col("p50").alias("value"))
    right = summary.select(F.lit("MAPE Summary").alias("sheet"), "product_id", F.round("mape", 6).alias("value"), "band")
    return left.unionByName(right, allowMissingColumns=True)


@query(
    "revenue_kpis",
    """
WITH d AS (SELECT store_id, date, sum(total_amount) AS revenue FROM pos GROUP BY 1, 2)
SELECT store_id, CAST(sum(revenue) AS DOUBLE) AS total, round(CAST(sum(revenue) AS DOUBLE) / count(*), 6) AS daily_mean,
       arg_max(date, (revenue, date)) AS peak_day, CAST(max(revenue) AS DOUBLE) AS peak_revenue FROM d GROUP BY 1""",
    "pos",
)
def revenue_kpis(t: Tables) -> DataFrame:
    daily = t.lines().groupBy("store_id", "date").agg(F.sum("total_amount").alias("revenue"))
    total = F.sum("revenue").cast("double")
    return daily.groupBy("store_id").agg(
        total.alias("total"), F.round(total / F.count(F.lit(1)), 6).alias("daily_mean"),
        F.max_by("date", F.struct("revenue", "date")).alias("peak_day"), F.max("revenue").cast("double").alias("peak_revenue"),
    )


@query(
    "category_mix",
    """
SELECT category, CAST(sum(total_amount) AS DOUBLE) AS revenue, round(CAST(sum(total_amount) AS DOUBLE) / (SELECT CAST(sum(total_amount) AS DOUBLE) FROM pos) * 100, 6) AS share_pct,
       CAST(sum(total_amount - CAST(quantity * unit_price * 0.7::DOUBLE AS DECIMAL(18,4))) AS DOUBLE) AS margin
FROM pos GROUP BY 1""",
    "pos",
)
def category_mix(t: Tables) -> DataFrame:
    cost = (F.col("quantity") * F.col("unit_price") * 0.7).cast("decimal(18,4)")
    mix = t.category_sales().groupBy("category").agg(
        F.sum("total_amount").cast("double").alias("revenue"),
        F.sum(F.col("total_amount") - cost).cast("double").alias("margin"),
        F.sum("total_amount").alias("_money"),
    )
    whole = mix.agg(F.sum("_money")).scalar()
    return mix.withColumn("share_pct", F.round(F.col("revenue") / whole.cast("double") * 100, 6)).drop("_money")


@query(
    "retrain_history_summary",
    "WITH " + FORECAST_SQL.strip()
    + """, r AS (SELECT strftime(date, '%Y-%m') AS run, count(*) / 40.0::DOUBLE AS duration_min, avg(abs(y - l7) / CASE WHEN abs(y) < 1e-8 THEN 1.0::DOUBLE ELSE abs(y) END) AS mape_before, avg(abs(y - l1) / CASE WHEN abs(y) < 1e-8 THEN 1.0::DOUBLE ELSE abs(y) END) AS mape_after
        FROM fc WHERE l7 IS NOT NULL GROUP BY 1)
SELECT run, round(duration_min, 6) AS duration_min, duration_min <= 20 AS within_sla, round(mape_before, 6) AS mape_before, round(mape_after, 6) AS mape_after,
       mape_after < mape_before AS improved FROM r""",
    "daily_sales",
)
def retrain_history_summary(t: Tables) -> DataFrame:
    """One run per month: its duration against the 20-minute limit and the error before and after."""
    month = F.date_format("date", "yyyy-MM").alias("run")
    error = {n: F.avg(percent_error(F.col("y"), F.col(c))) for n, c in (("mape_before", "l7"), ("mape_after", "l1"))}
    runs = naive_forecasts(t).filter("l7 IS NOT NULL").groupBy(month).agg(
        (F.count(F.lit(1)) / F.lit(40.0)).alias("duration_min"), *[e.alias(n) for n, e in error.items()]
    )
    return runs.select(
        "run", F.round("duration_min", 6).alias("duration_min"), (F.col("duration_min") <= 20).alias("within_sla"),
        F.round("mape_before", 6).alias("mape_before"), F.round("mape_after", 6).alias("mape_after"),
        (F.col("mape_after") < F.col("mape_before")).alias("improved"),
    )


@query(
    "baseline_scoreboard",
    "WITH " + FORECAST_SQL.strip()
    + """, m AS (SELECT product_id AS model, avg(abs(y - l7) / CASE WHEN abs(y) < 1e-8 THEN 1.0::DOUBLE ELSE abs(y) END) AS mape, right(product_id, 1) = '9' AS failed FROM fc WHERE l7 IS NOT NULL GROUP BY 1),
b AS (SELECT model, CASE WHEN failed THEN 1.0::DOUBLE ELSE mape END AS value FROM m UNION ALL SELECT 'average', avg(mape) FILTER (WHERE NOT failed) FROM m)
SELECT model, 'mape' AS metric, round(value, 6) AS value, 0.10::DOUBLE AS target, CASE WHEN value <= 0.10 THEN 'PASS' ELSE 'FAIL' END AS status FROM b""",
    "daily_sales",
)
def baseline_scoreboard(t: Tables) -> DataFrame:
    fc = naive_forecasts(t).filter("l7 IS NOT NULL")
    results = fc.groupBy(F.col("product_id").alias("model")).agg(F.avg(percent_error(F.col("y"), F.col("l7"))).alias("mape"))
    out = fr.scoreboard(results.withColumn("failed", F.endswith("model", F.lit("9"))), 0.10)
    return out.withColumn("value", F.round("value", 6))


@query(
    "experiment_summary",
    "WITH " + FORECAST_SQL.strip()
    + """, x AS (SELECT * FROM (VALUES ('demand_forecasting', 'mape', 0.10::DOUBLE, 'minimise'), ('churn_prediction', 'mean_score', 0.50::DOUBLE, 'maximise'), ('segmentation', 'silhouette', 0.45::DOUBLE, 'maximise')) v(experiment, metric, target, direction)),
r AS (SELECT 'demand_forecasting' AS experiment, product_id AS run_name, CASE WHEN product_id <> 'Brand#4' THEN avg(abs(y - l7) / CASE WHEN abs(y) < 1e-8 THEN 1.0::DOUBLE ELSE abs(y) END) END AS value FROM fc WHERE l7 IS NOT NULL GROUP BY 2
      UNION ALL SELECT 'churn_prediction', persona, avg(churn_proba) FROM churn_scores GROUP BY 2),
k AS (SELECT r.*, row_number() OVER (PARTITION BY experiment ORDER BY CASE WHEN direction = 'minimise' THEN value ELSE -value END, run_name) AS n FROM r JOIN x USING (experiment) WHERE value IS NOT NULL)
SELECT x.experiment, coalesce(run_name, 'N/A') AS run_name, metric, round_even(value, 4) AS value, target,
       CASE WHEN value IS NULL THEN 'NOT RUN' WHEN (direction = 'minimise' AND value <= target) OR (direction = 'maximise' AND value >= target) THEN 'PASS' ELSE 'FAIL' END AS status
FROM x LEFT JOIN (SELECT * FROM k WHERE n <= 20) k USING (experiment)""",
    "daily_sales churn_scores",
)
def experiment_summary(t: Tables) -> DataFrame:
    # Experiments with their first metric, target and direction.
    experiments = t.spark.createDataFrame(
        [("demand_forecasting", "mape", 0.10, "minimise"), ("churn_prediction", "mean_score", 0.50, "maximise"), ("segmentation", "silhouette", 0.45, "maximise")],
        "experiment string, metric string, target double, direction string",
    )
    fc = naive_forecasts(t).filter("l7 IS NOT NULL")
    demand = fc.groupBy(F.col("product_id").alias("run_name")).agg(F.avg(percent_error(F.col("y"), F.col("l7"))).alias("value"))
    demand = demand.withColumn("value", F.when(F.col("run_name") != "Brand#4", F.col("value")))
    churn = t.churn_scores().groupBy(F.col("persona").alias("run_name")).agg(F.avg("churn_proba").alias("value"))
    runs = demand.withColumn("experiment", F.lit("demand_forecasting")).unionByName(churn.withColumn("experiment", F.lit("churn_prediction")))
    return fr.experiment_summary(experiments, runs)


@query(
    "sku_tier",
    """
WITH top AS (SELECT CAST(l_partkey AS VARCHAR) AS product_id, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS revenue
             FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100)
SELECT product_id, revenue, CASE WHEN revenue >= (SELECT quantile_cont(revenue, 0.66) FROM top) THEN 'A'
       WHEN revenue >= (SELECT quantile_cont(revenue, 0.33) FROM top) THEN 'B' ELSE 'C' END AS tier FROM top""",
)
def sku_tier(t: Tables) -> DataFrame:
    top = fr.top_by_total(t.lines(), "product_id", F.col("total_amount"), 100)
    top = top.select("product_id", F.col("total").cast("double").alias("revenue"))
    # At most one hundred rows, so the built-in exact percentile is bounded.
    cuts = top.agg(F.percentile("revenue", F.array(F.lit(0.33), F.lit(0.66)))).scalar()
    tier = F.when(F.col("revenue") >= F.col("_c")[1], "A").when(F.col("revenue") >= F.col("_c")[0], "B").otherwise("C")
    return top.withColumn("_c", cuts).select("product_id", "revenue", tier.alias("tier"))


@query(
    "future_regressor_join",
    "WITH " + FORECAST_SQL.strip()
    + f""", known AS (SELECT DISTINCT date, day(date) <= 7 AS is_promotional_period FROM fc WHERE day(date) % 2 = 0)
SELECT product_id, date, coalesce(is_promotional_period, false) AS is_promotional_period FROM fc LEFT JOIN known USING (date) WHERE date >= DATE '{CUT}'""",
    "daily_sales",
)
def future_regressor_join(t: Tables) -> DataFrame:
    """Horizon rows with the regressors known for their day; unknown days count as no promotion."""
    daily = t.daily_sales()
    known = daily.select("date").distinct().filter(F.dayofmonth("date") % 2 == 0)
    known = known.withColumn("is_promotional_period", F.dayofmonth("date") <= 7)
    horizon = daily.filter(F.col("date") >= F.lit(CUT).cast("date")).select("product_id", "date")
    return horizon.join(known, "date", "left").fillna(False, ["is_promotional_period"])


# Scalar functions, each over the whole of a given table.


@query(
    "date_arithmetic",
    """SELECT CAST(l_shipdate AS DATE) AS date, CAST(DATE '2001-11-04' - CAST(l_shipdate AS DATE) AS INT) AS days_ago, CAST(l_shipdate AS DATE) - 90 AS window_start,
       CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start, count(*) AS n FROM lineitem GROUP BY ALL""",
)
def date_arithmetic(t: Tables) -> DataFrame:
    days = t.lineitem.groupBy(F.to_date("l_shipdate").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    return days.select(
        "date", F.datediff(F.lit("2001-11-04").cast("date"), "date").alias("days_ago"), F.date_sub("date", 90).alias("window_start"),
        F.trunc("date", "month").alias("month_start"), "n",
    )


@query(
    "date_format_iso",
    "SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS n FROM orders GROUP BY 1",
)
def date_format_iso(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "math_scalars",
    """SELECT p_partkey, round(sqrt(p_retailprice), 6) AS root, round(ln(1 + p_retailprice), 6) AS log1p, round(ln(p_retailprice), 6) AS log,
       abs(p_size - 25) AS distance, greatest(least(p_size, 40), 10) AS clipped, round(sin(2 * pi() * p_size / 7), 6) + 0.0 AS wave FROM part""",
)
def math_scalars(t: Tables) -> DataFrame:
    price, size = F.col("p_retailprice"), F.col("p_size")
    return t.part.select(
        "p_partkey", F.round(F.sqrt(price), 6).alias("root"), F.round(F.log1p(price), 6).alias("log1p"), F.round(F.ln(price), 6).alias("log"),
        F.abs(size - 25).alias("distance"), F.greatest(F.least(size, F.lit(40)), F.lit(10)).alias("clipped"),
        F.round(F.sin(2 * F.pi() * size / 7), 6).alias("wave"),
    )


@query(
    "half_even_round",
    "SELECT p_partkey, round_even(p_size / 4.0::DOUBLE, 1) AS half_even, round(p_size / 4.0::DOUBLE, 1) AS half_up FROM part",
)
def half_even_round(t: Tables) -> DataFrame:
    quarter = F.col("p_size") / F.lit(4.0)
    return t.part.select("p_partkey", F.bround(quarter, 1).alias("half_even"), F.round(quarter, 1).alias("half_up"))


@query(
    "safe_division",
    """WITH d AS (SELECT event_id, CASE WHEN user_id % 10 = 0 THEN 0.0::DOUBLE ELSE value END AS a, value AS b FROM events)
SELECT event_id, round(abs(a - b) / CASE WHEN abs(a) < 1e-8 THEN 1 ELSE abs(a) END, 6) AS percent_error, CASE WHEN a <> 0 THEN round(b / a, 6) END AS ratio FROM d""",
)
def safe_division(t: Tables) -> DataFrame:
    d = t.events.select("event_id", F.when(F.col("user_id") % 10 == 0, 0.0).otherwise(F.col("value")).alias("a"), F.col("value").alias("b"))
    return d.select(
        "event_id", F.round(sc.percent_error(F.col("a"), F.col("b")), 6).alias("percent_error"), F.round(F.try_divide("b", "a"), 6).alias("ratio")
    )


@query(
    "string_scalars",
    """SELECT c_custkey, trim('  ' || c_mktsegment || ' ') AS trimmed, starts_with(c_name, 'Customer#0000000') AS is_low, replace(c_name, '#', '-') AS dashed,
       regexp_replace(lower(trim(c_name)), '[^a-z0-9]+', '_', 'g') AS slug, c_nationkey::VARCHAR || ':' || c_custkey::VARCHAR AS joined FROM customer""",
)
def string_scalars(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("trimmed"), F.startswith("c_name", F.lit("Customer#0000000")).alias("is_low"),
        F.replace("c_name", F.lit("#"), F.lit("-")).alias("dashed"), sc.header_slug(F.col("c_name")).alias("slug"),
        F.concat_ws(":", F.col("c_nationkey").cast("string"), F.col("c_custkey").cast("string")).alias("joined"),
    )


@query(
    "cache_key_md5",
    """SELECT l_partkey, l_suppkey, date, 'demand:' || substr(md5(l_partkey::VARCHAR || ':' || l_suppkey::VARCHAR || ':30:' || strftime(date, '%Y-%m-%d')), 1, 12) AS cache_key
FROM (SELECT DISTINCT l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS date FROM lineitem)""",
)
def cache_key_md5(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("date")).distinct()
    key = sc.demand_cache_key(F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), F.lit(30), F.col("date"))
    return rows.withColumn("cache_key", key)


@query(
    "array_scalars",
    """SELECT o_orderkey, CAST(list_sort([o_custkey % 7, o_custkey % 5, o_custkey % 3])[1] AS BIGINT) AS smallest, array_to_string(['a', 'b', 'c'][1:2] || ['x'], ',') AS appended,
       3::INT AS zipped FROM orders""",
)
def array_scalars(t: Tables) -> DataFrame:
    key = F.col("o_custkey")
    values, names = F.array(key % 7, key % 5, key % 3), F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    return t.orders.select(
        "o_orderkey", F.array_sort(values)[0].alias("smallest"), F.array_join(F.array_append(F.slice(names, 1, 2), F.lit("x")), ",").alias("appended"),
        F.size(F.arrays_zip(values, names)).alias("zipped"),
    )


@query(
    "cast_scalars",
    """SELECT c_custkey, CAST(CAST(c_custkey + 0.0 AS DOUBLE)::BIGINT AS VARCHAR) AS id, DATE '1995-01-01' + CAST(c_custkey % 2000 AS INT) AS day,
       CAST(DATE '1995-01-01' + CAST(c_custkey % 2000 AS INT) AS TIMESTAMP) AS at FROM customer""",
)
def cast_scalars(t: Tables) -> DataFrame:
    text = F.date_format(F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 2000).cast("int")), "yyyy-MM-dd")
    day = text.cast("date")
    return t.customer.select(
        "c_custkey", F.col("c_custkey").cast("double").cast("long").cast("string").alias("id"), day.alias("day"), day.cast("timestamp_ntz").alias("at")
    )
