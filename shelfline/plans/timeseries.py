"""Time-series queries on daily sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.operators import timeseries as ts
from shelfline.operators import unit_root
from shelfline.operators.ordered import day_spine
from shelfline.plans.registry import query
from shelfline.plans.views import Tables
from shelfline.session import stage_table

ORDERED_SQL = """
WITH s AS (SELECT *, row_number() OVER o AS i, count(*) OVER (PARTITION BY product_id) AS n FROM daily_sales
           WINDOW o AS (PARTITION BY product_id ORDER BY date))
"""


@query(
    "differencing",
    """SELECT product_id, date, quantity - prev AS diff, round(ln(1 + quantity), 6) AS log1p
FROM (SELECT *, lag(quantity) OVER (PARTITION BY product_id ORDER BY date) AS prev FROM daily_sales) WHERE prev IS NOT NULL""",
    "daily_sales",
)
def differencing(t: Tables) -> DataFrame:
    out = ts.differenced(t.daily_sales())
    return out.select("product_id", "date", "diff", F.round("log1p", 6).alias("log1p"))


@query(
    "daily_sku_demand",
    """WITH d AS (SELECT brand AS product_id, date, sum(total_amount) AS amount FROM pos GROUP BY 1, 2),
sp AS (SELECT product_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM d GROUP BY 1)
SELECT product_id, date, CAST(coalesce(amount, 0) AS DOUBLE) AS amount FROM sp LEFT JOIN d USING (product_id, date)""",
    "pos",
)
def daily_sku_demand(t: Tables) -> DataFrame:
    daily = t.category_sales().groupBy(F.col("brand").alias("product_id"), "date").agg(F.sum("total_amount").alias("amount"))
    filled = day_spine(daily, "product_id", "date", "amount")
    return filled.select("product_id", "date", F.col("amount").cast("double").alias("amount"))


@query(
    "sliding_windows",
    """WITH w AS (SELECT product_id, date, list(quantity) OVER (PARTITION BY product_id ORDER BY date ROWS BETWEEN CURRENT ROW AND 57 FOLLOWING) AS w FROM daily_sales)
SELECT product_id, date, w[1] AS x_first, w[28] AS x_last, w[29] AS y_first, w[58] AS y_last, list_sum(w[1:28]) AS x_sum, list_sum(w[29:58]) AS y_sum
FROM w WHERE len(w) = 58""",
    "daily_sales",
)
def sliding_windows(t: Tables) -> DataFrame:
    def total(c: str):
        return F.aggregate(c, F.lit(0.0), lambda a, v: a + v)

    return ts.sliding_windows(t.daily_sales()).select(
        "product_id", "date", F.col("x")[0].alias("x_first"), F.col("x")[27].alias("x_last"), F.col("y")[0].alias("y_first"),
        F.col("y")[29].alias("y_last"), total("x").alias("x_sum"), total("y").alias("y_sum"),
    )


@query(
    "train_only_zscore",
    ORDERED_SQL
    + """, b AS (SELECT *, i <= greatest(1, floor((n - 57) * 0.8)) + 57 AS in_train FROM s WHERE n > 57),
m AS (SELECT product_id, avg(quantity) AS mu, stddev_pop(quantity) + 1e-8::DOUBLE AS sd FROM b WHERE in_train GROUP BY 1)
SELECT product_id, date, in_train, round((quantity - mu) / sd, 6) AS z FROM b JOIN m USING (product_id)""",
    "daily_sales",
)
def train_only_zscore(t: Tables) -> DataFrame:
    out = ts.train_only_zscore(t.daily_sales())
    return out.select("product_id", "date", "in_train", F.round("z", 6).alias("z"))


@query(
    "holdout_split",
    ORDERED_SQL + "SELECT product_id, date, quantity, i > n - 30 AS is_test FROM s WHERE n >= 90",
    "daily_sales",
)
def holdout_split(t: Tables) -> DataFrame:
    return ts.holdout_split(t.daily_sales())


@query(
    "rolling_origin_cutoffs",
    """WITH e AS (SELECT product_id, min(date) AS a, max(date) AS b FROM daily_sales GROUP BY 1),
c AS (SELECT product_id, CAST(b - 30 - CAST(k * 30 AS INT) AS DATE) AS cutoff FROM e, range(0, 200) r(k) WHERE b - 30 - CAST(k * 30 AS INT) >= a + 180)
SELECT c.product_id, cutoff, count(*) FILTER (WHERE date <= cutoff) AS n_train, count(*) FILTER (WHERE date > cutoff AND date <= cutoff + 30) AS n_test
FROM c JOIN daily_sales d ON d.product_id = c.product_id GROUP BY 1, 2""",
    "daily_sales",
)
def rolling_origin_cutoffs(t: Tables) -> DataFrame:
    daily = t.daily_sales()
    return ts.cutoff_sizes(daily, ts.rolling_cutoffs(daily))


@query(
    "acf",
    ORDERED_SQL
    + """, c AS (SELECT product_id, i, n, quantity - avg(quantity) OVER (PARTITION BY product_id) AS c FROM s),
g AS (SELECT a.product_id, k AS lag, sum(a.c * b.c) AS g, max(a.n) AS n FROM c a, range(0, 61) r(k) JOIN c b ON true WHERE b.product_id = a.product_id AND b.i = a.i - k GROUP BY 1, 2),
r AS (SELECT product_id, lag, n, g / first(g) OVER (PARTITION BY product_id ORDER BY lag) AS acf FROM g),
h AS (SELECT *, sum(CASE WHEN lag > 0 THEN acf * acf ELSE 0 END) OVER (PARTITION BY product_id ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM r)
SELECT product_id, CAST(lag AS INT) AS lag, round(acf, 6) AS acf, CASE WHEN lag > 0 THEN round(1.96::DOUBLE * sqrt((1 + 2 * before) / n), 6) ELSE 0 END AS half_width
FROM h WHERE lag <= n - 2""",
    "daily_sales",
)
def acf(t: Tables) -> DataFrame:
    out = ts.autocorrelation(t.daily_sales())
    return out.withColumns({"acf": F.round("acf", 6), "half_width": F.round("half_width", 6)})


SEASONAL_SQL = """
WITH tr AS (SELECT *, CASE WHEN count(quantity) OVER w = 7 THEN avg(quantity) OVER w END AS trend FROM daily_sales
            WINDOW w AS (PARTITION BY product_id ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
se AS (SELECT *, avg(quantity - trend) OVER (PARTITION BY product_id, isodow(date)) AS seasonal FROM tr)
"""


@query(
    "seasonal_means",
    SEASONAL_SQL
    + """SELECT product_id, date, quantity, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal, round(quantity - trend - seasonal, 6) AS residual FROM se""",
    "daily_sales",
)
def seasonal_means(t: Tables) -> DataFrame:
    out = ts.seasonal_means(t.daily_sales()).drop("weekday")
    return out.withColumns({c: F.round(c, 6) for c in ("trend", "seasonal", "residual")})


@query(
    "seasonal_summary",
    SEASONAL_SQL
    + """SELECT product_id, arg_max(trend, date) > arg_min(trend, date) AS trend_up, round(stddev_samp(seasonal), 6) AS seasonal_std,
       round(stddev_samp(quantity - trend - seasonal), 6) AS residual_std FROM se WHERE trend IS NOT NULL GROUP BY 1""",
    "daily_sales",
)
def seasonal_summary(t: Tables) -> DataFrame:
    out = ts.seasonal_summary(ts.seasonal_means(t.daily_sales()))
    return out.withColumns({"seasonal_std": F.round("seasonal_std", 6), "residual_std": F.round("residual_std", 6)})


#: Every system is cleared column by column: with k columns cleared its last corner is the residual sum of the first k.
CLEAR = """list_transform(m, lambda r, i: CASE WHEN i <= k THEN r ELSE list_transform(r, lambda v, j: v - r[k] / m[k][k] * m[k][j]) END)"""


def gram_sql(name: str, rows: str) -> str:
    """CTEs to ``name`` (product_id, d, l, rows, m): the summed cross products of the lists ``x`` of ``rows``."""
    return f"""{name}_c AS (SELECT product_id, d, l, i, j, count(*) AS rows, sum(x[i] * x[j]) AS v FROM ({rows}), LATERAL (SELECT unnest(range(1, len(x) + 1)) AS i), LATERAL (SELECT unnest(range(1, i + 1)) AS j) GROUP BY ALL),
{name}_r AS (SELECT product_id, d, l, rows, i, list(v ORDER BY j) AS r FROM (SELECT * FROM {name}_c UNION ALL SELECT product_id, d, l, j, i, rows, v FROM {name}_c WHERE i <> j) GROUP BY ALL),
{name} AS (SELECT product_id, d, l, rows, list(r ORDER BY i) AS m FROM {name}_r GROUP BY ALL)"""


def adf_sql() -> str:
    """CTEs to ``ad`` (product_id, n, adf_lags, adf_p, adf_diff_p); the normal law is summed by Simpson's rule."""
    small = " + ".join(f"{c!r}::DOUBLE * tau ** {i}" for i, c in enumerate(unit_root.TAU_SMALL))
    large = " + ".join(f"{c!r}::DOUBLE * tau ** {i}" for i, c in enumerate(unit_root.TAU_LARGE))
    low, border, high = unit_root.TAU_RANGE
    return f"""known AS (SELECT product_id, date, quantity::DOUBLE AS v, quantity - lag(quantity) OVER (PARTITION BY product_id ORDER BY date) AS w, count(*) OVER (PARTITION BY product_id) AS n FROM daily_sales),
lv AS (SELECT product_id, 0 AS d, date, n, v FROM known WHERE n >= 30 UNION ALL SELECT product_id, 1, date, n, w FROM known WHERE n >= 30 AND w IS NOT NULL),
ce AS (SELECT product_id, d, date, n, v - avg(v) OVER (PARTITION BY product_id, d) AS c FROM lv),
ls AS (SELECT product_id, d, max(n) AS n, list(c ORDER BY date) AS c FROM ce GROUP BY ALL),
df AS (SELECT *, list_transform(c[2:], lambda v, i: v - c[i]) AS dx, greatest(0, least(ceil(12 * (len(c) / 100.0::DOUBLE) ** 0.25::DOUBLE), len(c) // 2 - 2))::INT AS l FROM ls),
tt AS (SELECT *, unnest(range(1, len(dx) + 1))::INT AS t FROM df),
{gram_sql("ga", "SELECT product_id, d, l, list_concat([1.0::DOUBLE, c[t]], list_reverse(dx[t - l:t - 1]), [dx[t]]) AS x FROM tt WHERE t > l")},
ca(product_id, d, l, rows, k, m) AS (SELECT product_id, d, l, rows, 1, m FROM ga UNION ALL SELECT product_id, d, l, rows, k + 1, {CLEAR} FROM ca WHERE k <= l + 2),
be AS (SELECT product_id, d, arg_min(k - 3, (rows * ln(m[l + 3][l + 3] / rows) + 2 * (k - 1), k))::INT AS b FROM ca WHERE k >= 3 GROUP BY ALL),
{gram_sql("gb", "SELECT product_id, d, b AS l, list_concat([1.0::DOUBLE], list_reverse(dx[t - b:t - 1]), [c[t], dx[t]]) AS x FROM tt JOIN be USING (product_id, d) WHERE t > b")},
cb(product_id, d, l, rows, k, m) AS (SELECT product_id, d, l, rows, 1, m FROM gb UNION ALL SELECT product_id, d, l, rows, k + 1, {CLEAR} FROM cb WHERE k <= l + 1),
ta AS (SELECT product_id, d, l, m[l + 2][l + 3] / sqrt(m[l + 2][l + 2] * (m[l + 3][l + 3] - m[l + 2][l + 3] * m[l + 2][l + 3] / m[l + 2][l + 2]) / (rows - l - 2)) AS tau FROM cb WHERE k = l + 2),
zz AS (SELECT *, greatest(-8, least(8, CASE WHEN tau <= {border!r}::DOUBLE THEN {small} ELSE {large} END)) AS z FROM ta),
pp AS (SELECT *, CASE WHEN tau <= {low!r}::DOUBLE THEN 0::DOUBLE WHEN tau >= {high!r}::DOUBLE THEN 1::DOUBLE ELSE 0.5::DOUBLE + z / 3000 / sqrt(2 * pi())
  * list_sum(list_transform(range(0, 1001), lambda q: CASE WHEN q IN (0, 1000) THEN 1 WHEN q % 2 = 1 THEN 4 ELSE 2 END * exp(-(z * q / 1000) * (z * q / 1000) / 2))) END AS p FROM zz),
ad AS (SELECT product_id, max(n) AS n, max(l) FILTER (WHERE d = 0) AS adf_lags, max(p) FILTER (WHERE d = 0) AS adf_p, max(p) FILTER (WHERE d = 1) AS adf_diff_p
  FROM pp JOIN (SELECT DISTINCT product_id, n FROM lv) USING (product_id) GROUP BY 1)"""


ADF_COLUMNS = "product_id, n, adf_lags, round(adf_p, 6) AS adf_p, round(adf_diff_p, 6) AS adf_diff_p, adf_p < 0.05 AS is_stationary_adf, adf_diff_p < 0.05 AS diff_is_stationary"


def adf_rounded(out: DataFrame) -> DataFrame:
    return out.withColumns({c: F.round(c, 6) for c in ("adf_p", "adf_diff_p")})


@query("adf_test", f"WITH RECURSIVE {adf_sql()} SELECT {ADF_COLUMNS} FROM ad", "daily_sales")
def adf_test(t: Tables) -> DataFrame:
    return adf_rounded(ts.adf_test(t.daily_sales()))


PRODUCT_SQL = ORDERED_SQL + """, c AS (SELECT product_id, date, i, n, quantity - avg(quantity) OVER (PARTITION BY product_id) AS c FROM s),
g AS (SELECT a.product_id, k, sum(a.c * b.c) AS g, max(a.n) AS n FROM c a, range(0, 61) r(k) JOIN c b ON true WHERE b.product_id = a.product_id AND b.i = a.i - k GROUP BY 1, 2)
"""

# The SQL sees lags up to 60, far beyond what the rule picks on these series.
KPSS_SQL = """, z AS (SELECT product_id, n, (sum(g) FILTER (WHERE k = 0) + 2 * sum(g) FILTER (WHERE k BETWEEN 1 AND floor(n ** (2 / 9.0::DOUBLE)))) / n AS s0,
            2 * sum(k * g) FILTER (WHERE k BETWEEN 1 AND floor(n ** (2 / 9.0::DOUBLE))) / n AS s1 FROM g GROUP BY 1, 2),
l AS (SELECT product_id, n, CAST(least(floor(1.1447::DOUBLE * ((s1 / s0) * (s1 / s0)) ** (1 / 3.0::DOUBLE) * n ** (1 / 3.0::DOUBLE)), n - 1) AS INT) AS lags FROM z),
v AS (SELECT g.product_id, l.lags, (sum(g) FILTER (WHERE k = 0) + 2 * coalesce(sum((1 - k / (lags + 1.0::DOUBLE)) * g) FILTER (WHERE k BETWEEN 1 AND lags), 0)) / g.n AS var FROM g JOIN l USING (product_id) GROUP BY g.product_id, l.lags, g.n),
e AS (SELECT product_id, sum(p * p) / (max(n) * max(n)) AS eta FROM (SELECT product_id, n, sum(c) OVER (PARTITION BY product_id ORDER BY date) AS p FROM c) GROUP BY 1),
ks AS (SELECT product_id, lags, eta / var AS st FROM v JOIN e USING (product_id)),
kp AS (SELECT *, CASE WHEN st <= 0.347 THEN 0.1::DOUBLE WHEN st <= 0.463 THEN 0.1::DOUBLE + (st - 0.347::DOUBLE) * (-0.05::DOUBLE / 0.116::DOUBLE)
                     WHEN st <= 0.574 THEN 0.05::DOUBLE + (st - 0.463::DOUBLE) * (-0.025::DOUBLE / 0.111::DOUBLE)
                     WHEN st <= 0.739 THEN 0.025::DOUBLE + (st - 0.574::DOUBLE) * (-0.015::DOUBLE / 0.165::DOUBLE) ELSE 0.01 END AS pv FROM ks)
"""


@query(
    "kpss_test",
    PRODUCT_SQL + KPSS_SQL + "SELECT product_id, lags, round(st, 6) AS kpss_stat, round(pv, 6) AS kpss_p, pv > 0.05 AS is_stationary_kpss FROM kp",
    "daily_sales",
)
def kpss_test(t: Tables) -> DataFrame:
    out = ts.kpss_test(t.daily_sales())
    return out.withColumns({"kpss_stat": F.round("kpss_stat", 6), "kpss_p": F.round("kpss_p", 6)})


def tests(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Staged daily sales and their stationarity tests: both are read more than once."""
    daily = stage_table(t.daily_sales(), "daily")
    return daily, stage_table(ts.stationarity(daily), "stationarity")


def tests_sql() -> str:
    """CTEs to ``st``: both tests with the advice."""
    return f"""{adf_sql()},
{PRODUCT_SQL.strip().removeprefix("WITH ")}{KPSS_SQL},
st AS (SELECT *, NOT (adf_p < 0.05) OR NOT (pv > 0.05) AS recommend_differencing FROM ad JOIN kp USING (product_id))"""


@query(
    "stationarity",
    f"""WITH RECURSIVE {tests_sql()}
SELECT {ADF_COLUMNS}, lags, round(st, 6) AS kpss_stat, round(pv, 6) AS kpss_p, pv > 0.05 AS is_stationary_kpss, recommend_differencing FROM st""",
    "daily_sales",
)
def stationarity(t: Tables) -> DataFrame:
    out = adf_rounded(tests(t)[1])
    return out.withColumns({c: F.round(c, 6) for c in ("kpss_stat", "kpss_p")})


@query(
    "arima_order_hint",
    f"WITH RECURSIVE {tests_sql()} SELECT product_id, 2 AS p, CAST(recommend_differencing AS INT) AS d, 1 AS q FROM st WHERE n >= 65",
    "daily_sales",
)
def arima_order_hint(t: Tables) -> DataFrame:
    return ts.order_hints(tests(t)[1])


@query(
    "pacf",
    f"""WITH RECURSIVE {tests_sql()},
moved AS (SELECT product_id, date, quantity, quantity - lag(quantity) OVER (PARTITION BY product_id ORDER BY date) AS step FROM daily_sales),
an AS (SELECT product_id, date, CASE WHEN recommend_differencing THEN step ELSE quantity END AS q FROM moved JOIN st USING (product_id)),
ac AS (SELECT product_id, date, q - avg(q) OVER (PARTITION BY product_id) AS c FROM an WHERE q IS NOT NULL),
al AS (SELECT product_id, list(c ORDER BY date) AS c, count(*) AS n FROM ac GROUP BY 1),
ar AS (SELECT product_id, n, list_transform(range(0, least(30, n // 2 - 1) + 1), lambda k: list_inner_product(c[k + 1:], c[:n - k]) / list_inner_product(c, c)) AS r FROM al),
dl(product_id, n, r, k, phi, error, last) AS (SELECT product_id, n, r, 0, []::DOUBLE[], 1.0::DOUBLE, NULL::DOUBLE FROM ar UNION ALL
  SELECT product_id, n, r, k + 1, list_append(list_transform(phi, lambda v, i: v - nx * phi[k + 1 - i]), nx), error * (1 - nx * nx), nx
  FROM (SELECT *, (r[k + 2] - coalesce(list_sum(list_transform(phi, lambda v, i: v * r[k + 2 - i])), 0)) / error AS nx FROM dl WHERE k < len(r) - 1))
SELECT product_id, k AS lag, round(last, 6) AS pacf, round(1.96::DOUBLE / sqrt(n), 6) AS half_width FROM dl WHERE k > 0""",
    "daily_sales",
)
def pacf(t: Tables) -> DataFrame:
    daily, flags = tests(t)
    out = ts.partial_autocorrelation(ts.analysis_series(daily, flags))
    return out.withColumns({c: F.round(c, 6) for c in ("pacf", "half_width")})


@query("seasonal_strength")
def seasonal_strength(t: Tables) -> DataFrame:
    return ts.strength_classes(t.daily_sales())


@query(
    "dual_seasonality",
    ORDERED_SQL
    + """, c AS (SELECT product_id, i - 1 AS j, n, quantity - avg(quantity) OVER (PARTITION BY product_id) AS c FROM s),
f AS (SELECT product_id, k, max(n) AS n, sum(c * cos(2 * pi() * ((k * j) % n) / n)) AS re, sum(c * sin(2 * pi() * ((k * j) % n) / n)) AS im
      FROM c, LATERAL (SELECT unnest(range(0, n // 2 + 1)) AS k) GROUP BY 1, 2),
w AS (SELECT product_id, k, n, (re * re + im * im) * CASE WHEN k = 0 OR 2 * k = n THEN 1 ELSE 2 END AS pw FROM f),
m AS (SELECT product_id, 3 * median(pw) AS base, count(*) > 365 AS long FROM w GROUP BY 1),
b AS (SELECT product_id, arg_min(pw, (abs(n / k::DOUBLE - 7), k)) AS p7, arg_min(pw, (abs(n / k::DOUBLE - 365), k)) AS p365 FROM w WHERE k > 0 GROUP BY 1)
SELECT product_id, p7 > base AS weekly, long AND p365 > base AS annual, p7 > base AND long AND p365 > base AS dual FROM b JOIN m USING (product_id)""",
    "daily_sales",
)
def dual_seasonality(t: Tables) -> DataFrame:
    return ts.dual_seasonality(t.daily_sales())
