"""Drift and model-quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.scalars import attainment_pct, half_even, mape_band, psi_band, percent_error
from shelfline.operators import drift, features as ft, metrics as mt
from shelfline.plans.quality import SCORE_SQL, suite_scores
from shelfline.operators.ordered import global_rank
from shelfline.plans.registry import query
from shelfline.plans.views import Tables

COLUMNS = ["l_quantity", "l_discount", "l_tax", "l_extendedprice", "price_shifted"]

LONG_SQL = "lg AS (" + " UNION ALL ".join(f"SELECT '{c}' AS col, side, {c} AS v FROM drift_features" for c in COLUMNS) + ")"


def shares_sql(bins: int) -> str:
    index = " + ".join(f"(v >= lo + (hi - lo) / {bins} * {i})::INT" for i in range(1, bins))
    return f"""
WITH {LONG_SQL},
b AS (SELECT col, min(v) AS lo, max(v) AS hi FROM lg GROUP BY 1),
pl AS (SELECT col, side, {index} AS bin FROM lg JOIN b USING (col)),
ct AS (SELECT col, bin, count(*) FILTER (WHERE side = 'reference') AS n_ref, count(*) FILTER (WHERE side = 'production') AS n_prod FROM pl GROUP BY 1, 2),
tt AS (SELECT col, sum(n_ref) AS all_ref, sum(n_prod) AS all_prod FROM ct GROUP BY 1),
sh AS (SELECT b.col, g.bin, coalesce(n_ref, 0) / all_ref::DOUBLE AS p0, coalesce(n_prod, 0) / all_prod::DOUBLE AS q0
       FROM b CROSS JOIN range({bins}) g(bin) JOIN tt USING (col) LEFT JOIN ct ON ct.col = b.col AND ct.bin = g.bin)"""


PSI_SQL = shares_sql(10) + """,
ps AS (SELECT col, greatest(sum((greatest(q0, 1e-8::DOUBLE) - greatest(p0, 1e-8::DOUBLE)) * ln(greatest(q0, 1e-8::DOUBLE) / greatest(p0, 1e-8::DOUBLE))), 0) AS psi FROM sh GROUP BY 1)
"""
JS_SQL = shares_sql(20) + """,
n AS (SELECT col, (p0 + 1e-8::DOUBLE) / (1 + 20 * 1e-8::DOUBLE) AS p, (q0 + 1e-8::DOUBLE) / (1 + 20 * 1e-8::DOUBLE) AS q FROM sh),
js AS (SELECT col, (sum(p * ln(p / ((p + q) / 2))) + sum(q * ln(q / ((p + q) / 2)))) / 2 AS jsd FROM n GROUP BY 1)
"""
KS_PART = """
kc AS (SELECT col, v, count(*) FILTER (WHERE side = 'reference') AS nr, count(*) FILTER (WHERE side = 'production') AS np FROM lg GROUP BY 1, 2),
kr AS (SELECT col, sum(nr) OVER (PARTITION BY col ORDER BY v) / (sum(nr) OVER (PARTITION BY col))::DOUBLE AS fr,
              sum(np) OVER (PARTITION BY col ORDER BY v) / (sum(np) OVER (PARTITION BY col))::DOUBLE AS fp,
              sum(nr) OVER (PARTITION BY col) AS tr, sum(np) OVER (PARTITION BY col) AS tp FROM kc),
kd AS (SELECT col, max(abs(fr - fp)) AS ks, max(tr)::DOUBLE AS n1, max(tp)::DOUBLE AS n2 FROM kr GROUP BY 1),
kl AS (SELECT *, (sqrt(n1 * n2 / (n1 + n2)) + 0.12::DOUBLE + 0.11::DOUBLE / sqrt(n1 * n2 / (n1 + n2))) * ks AS lam FROM kd),
kp AS (SELECT col, ks, CASE WHEN lam < 0.2 THEN 1.0::DOUBLE ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE,
         (SELECT sum(CASE WHEN k % 2 = 1 THEN 2.0::DOUBLE ELSE -2.0::DOUBLE END * exp(-2 * k * k * lam * lam)) FROM range(1, 101) r(k)))) END AS p_value
       FROM kl)
"""


@query("psi", PSI_SQL + 'SELECT col AS "column", round(psi, 6) AS psi FROM ps', "drift_features")
def psi(t: Tables) -> DataFrame:
    return drift.psi(t.drift_features(), COLUMNS).withColumn("psi", F.round("psi", 6))


@query(
    "psi_band",
    PSI_SQL
    + """SELECT col AS "column", CASE WHEN psi > 0.2 THEN 'severe' WHEN psi > 0.1 THEN 'moderate' ELSE 'stable' END AS band FROM ps""",
    "drift_features",
)
def psi_bands(t: Tables) -> DataFrame:
    return drift.psi(t.drift_features(), COLUMNS).select("column", psi_band(F.col("psi")).alias("band"))


@query(
    "broadcast_minmax",
    f"""WITH {LONG_SQL}, b AS (SELECT col, min(v) AS lo, max(v) AS hi FROM lg GROUP BY 1)
SELECT lg.col AS "column", side, lo, hi, round(avg((v - lo) / nullif(hi - lo, 0)), 6) AS mean_position
FROM lg JOIN b USING (col) GROUP BY 1, 2, 3, 4""",
    "drift_features",
)
def broadcast_minmax(t: Tables) -> DataFrame:
    df = t.drift_features()
    long = drift.unpivot_numeric(df, COLUMNS, ["side"])
    position = F.try_divide(F.col("value") - F.col("lo"), F.col("hi") - F.col("lo"))  # a constant column has no positions
    # One bounds row per column of the schema.
    joined = long.join(F.broadcast(drift.value_bounds(df, COLUMNS)), "column")
    return joined.groupBy("column", "side", "lo", "hi").agg(F.round(F.avg(position), 6).alias("mean_position"))


@query(
    "ks_statistic",
    f"WITH {LONG_SQL}, {KS_PART}" + 'SELECT col AS "column", round(ks, 6) AS ks, round(p_value, 6) AS p_value FROM kp',
    "drift_features",
)
def ks_statistic(t: Tables) -> DataFrame:
    out = drift.ks(t.drift_features(), COLUMNS)
    return out.withColumns({"ks": F.round("ks", 6), "p_value": F.round("p_value", 6)})


@query(
    "drift_report",
    PSI_SQL.rstrip()
    + ", "
    + KS_PART
    + """SELECT col AS "column", round_even(psi, 4) AS psi, round_even(ks, 4) AS ks, round_even(p_value, 4) AS p_value,
       psi > 0.2 OR p_value < 0.05 AS drift_detected FROM ps JOIN kp USING (col)""",
    "drift_features",
)
def drift_report(t: Tables) -> DataFrame:
    return drift.drift_report(t.drift_features(), COLUMNS)


@query(
    "js_divergence",
    JS_SQL + 'SELECT col AS "column", round(sqrt(greatest(jsd, 0)), 6) AS distance, round(greatest(jsd, 0), 6) AS divergence FROM js',
    "drift_features",
)
def js_divergence(t: Tables) -> DataFrame:
    distance = drift.js_divergence(t.drift_features(), COLUMNS)
    return distance.select(
        "column", F.round("js", 6).alias("distance"), F.round(F.col("js") * F.col("js"), 6).alias("divergence")
    )


@query(
    "prediction_drift",
    PSI_SQL.rstrip()
    + """, j AS ("""
    + JS_SQL
    + """SELECT col, sqrt(greatest(jsd, 0)) AS js FROM js)
SELECT col AS "column", round(j.js, 6) AS js, round(psi, 6) AS psi, j.js > 0.1 OR psi > 0.2 AS drift_detected
FROM j JOIN ps USING (col) WHERE col = 'price_shifted'""",
    "drift_features",
)
def prediction_drift(t: Tables) -> DataFrame:
    out = drift.prediction_drift(t.drift_features(), "price_shifted")
    return out.withColumns({"js": F.round("js", 6), "psi": F.round("psi", 6)})


@query(
    "psi_summary",
    PSI_SQL
    + """SELECT col AS feature, round_even(psi, 4) AS psi, round_even((SELECT avg(psi) FROM ps), 4) AS overall_drift_score,
       (SELECT count(*) FROM ps WHERE psi > 0.2) AS n_drifted, (SELECT round_even(max(psi), 4) FROM ps) AS max_psi,
       (SELECT arg_max(col, psi) FROM ps) AS max_feature FROM ps
UNION ALL SELECT '_overall_drift_score', round_even(avg(psi), 4), round_even(avg(psi), 4), count(*) FILTER (WHERE psi > 0.2),
       round_even(max(psi), 4), arg_max(col, psi) FROM ps""",
    "drift_features",
)
def psi_summary(t: Tables) -> DataFrame:
    out = drift.psi_summary(drift.psi(t.drift_features(), COLUMNS))
    return out.select(
        F.explode("summary").alias("feature", "psi"), "overall_drift_score", "n_drifted", "max_psi", "max_feature"
    )


@query(
    "json_roundtrip",
    PSI_SQL
    + """SELECT '{' || string_agg('"' || col || '":' || (psi > 0.2)::VARCHAR, ',' ORDER BY col) || '}' AS document,
       count(*) AS n_keys, count(*) FILTER (WHERE psi > 0.2) AS n_true FROM ps""",
    "drift_features",
)
def json_roundtrip(t: Tables) -> DataFrame:
    psis = drift.psi(t.drift_features(), COLUMNS)
    pairs = F.sort_array(F.collect_list(F.struct("column", (F.col("psi") > drift.PSI_LIMIT).alias("drifts"))))
    text = psis.agg(F.to_json(F.map_from_entries(pairs)).alias("document"))  # one entry per column
    back = F.from_json("document", "map<string,boolean>")
    return text.select(
        "document", F.size(back).cast("long").alias("n_keys"),
        F.size(F.filter(F.map_values(back), lambda v: v)).cast("long").alias("n_true"),
    )


@query(
    "shared_columns",
    f"""WITH {LONG_SQL}
SELECT col AS "column", count(*) FILTER (WHERE side = 'reference') AS n_reference,
       count(*) FILTER (WHERE side = 'production') AS n_production
FROM lg WHERE col <> 'price_shifted' GROUP BY 1""",
    "drift_features",
)
def shared_columns(t: Tables) -> DataFrame:
    """Columns of both populations, with their sizes; the production side lacks one column."""
    df = t.drift_features()
    reference = df.filter("side = 'reference'").drop("side")
    production = df.filter("side = 'production'").drop("side", "price_shifted")
    common = drift.shared_columns(reference, production)
    long = drift.unpivot_numeric(drift.both_sides(reference, production), common, ["side"])
    return long.groupBy("column").agg(
        F.count_if(F.col("side") == "reference").alias("n_reference"),
        F.count_if(F.col("side") == "production").alias("n_production"),
    )


# Naive forecasts of daily sales: the value n sold days before.
FORECAST_SQL = """
fc AS (SELECT product_id, date, quantity AS y, lag(quantity, 1) OVER o AS l1, lag(quantity, 7) OVER o AS l7, lag(quantity, 30) OVER o AS l30
       FROM daily_sales WINDOW o AS (PARTITION BY product_id ORDER BY date))
"""


def naive_forecasts(t: Tables) -> DataFrame:
    lags = ft.demand_lags(t.daily_sales(), lags=(1, 7, 30))
    return lags.select(
        "product_id", "date", F.col("quantity").alias("y"),
        F.col("lag_1d").alias("l1"), F.col("lag_7d").alias("l7"), F.col("lag_30d").alias("l30"),
    )


@query(
    "regression_metrics",
    "WITH "
    + FORECAST_SQL
    + """SELECT count(*) AS n, round(sqrt(avg((y - l7) * (y - l7))), 6) AS rmse, round(avg(abs(y - l7)), 6) AS mae,
       round(avg(abs(y - l7) / CASE WHEN abs(y) < 1e-8 THEN 1 ELSE abs(y) END) * 100, 6) AS mape_pct,
       round(1 - sum((y - l7) * (y - l7)) / (var_pop(y) * count(*)), 6) AS r2,
       round(avg((y BETWEEN l7 * 0.5 AND l7 * 1.5)::INT), 6) AS coverage, true AS drifted
FROM fc WHERE l7 IS NOT NULL""",
    "daily_sales",
)
def regression_metrics(t: Tables) -> DataFrame:
    fc = naive_forecasts(t).withColumns({"lo": F.col("l7") * 0.5, "hi": F.col("l7") * 1.5})
    out = mt.regression_metrics(fc, "y", "l7", "lo", "hi")
    return out.withColumns({c: F.round(c, 6) for c in ("rmse", "mae", "mape_pct", "r2", "coverage")})


@query(
    "pinball_loss",
    "WITH "
    + FORECAST_SQL
    + """SELECT round(avg(greatest(0.1::DOUBLE * (y - l1 * 0.6::DOUBLE), (0.1::DOUBLE - 1) * (y - l1 * 0.6::DOUBLE)) + greatest(0.5::DOUBLE * (y - l1), -0.5::DOUBLE * (y - l1))
       + greatest(0.9::DOUBLE * (y - l1 * 1.4::DOUBLE), (0.9::DOUBLE - 1) * (y - l1 * 1.4::DOUBLE))) / 3, 6) AS pinball_loss
FROM fc WHERE l1 IS NOT NULL""",
    "daily_sales",
)
def pinball_loss(t: Tables) -> DataFrame:
    fc = naive_forecasts(t).select(
        "y", F.col("l1").alias("p50"), (F.col("l1") * 0.6).alias("p10"), (F.col("l1") * 1.4).alias("p90")
    )
    return mt.pinball_loss(fc).withColumn("pinball_loss", F.round("pinball_loss", 6))


@query(
    "horizon_mape",
    "WITH "
    + FORECAST_SQL
    + """, u AS (SELECT 1 AS h, y, l1 AS p FROM fc UNION ALL SELECT 7, y, l7 FROM fc UNION ALL SELECT 30, y, l30 FROM fc)
SELECT CAST(h AS INT) AS h, round(avg(abs(y - p) / (abs(y) + 1e-8::DOUBLE)), 6) AS mape, count(*) AS n FROM u WHERE p IS NOT NULL GROUP BY 1""",
    "daily_sales",
)
def horizon_mape(t: Tables) -> DataFrame:
    fc = naive_forecasts(t)
    steps = F.array(*[F.struct(F.lit(h).alias("h"), F.col(f"l{h}").alias("p50")) for h in (1, 7, 30)])
    out = mt.horizon_mape(fc.select("y", F.inline(steps)))
    return out.withColumn("mape", F.round("mape", 6))


def scored(t: Tables) -> DataFrame:
    return t.churn_scores().withColumnsRenamed({"churn_proba": "prediction", "target_churn": "target"})


AUC_SQL = """
g AS (SELECT churn_proba AS s, count(*) FILTER (WHERE target_churn = 1) AS pos, count(*) FILTER (WHERE target_churn = 0) AS neg FROM churn_scores GROUP BY 1),
au AS (SELECT sum(pos * (below + neg / 2.0::DOUBLE)) / (sum(pos) * sum(neg))::DOUBLE AS auc
       FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)),
cm AS (SELECT count(*) FILTER (WHERE churn_proba >= 0.5 AND target_churn = 1) AS tp, count(*) FILTER (WHERE churn_proba >= 0.5 AND target_churn = 0) AS fp,
              count(*) FILTER (WHERE churn_proba < 0.5 AND target_churn = 1) AS fn, count(*) FILTER (WHERE churn_proba < 0.5 AND target_churn = 0) AS tn,
              avg(-CASE WHEN target_churn = 1 THEN ln(greatest(least(churn_proba, 1 - 1e-15::DOUBLE), 1e-15::DOUBLE))
                        ELSE ln(1 - greatest(least(churn_proba, 1 - 1e-15::DOUBLE), 1e-15::DOUBLE)) END) AS log_loss FROM churn_scores)
"""


@query(
    "classification_metrics",
    "WITH "
    + AUC_SQL
    + """SELECT tp, fp, fn, tn, round(log_loss, 6) AS log_loss, round(tp / (tp + fp)::DOUBLE, 6) AS precision,
       round(tp / (tp + fn)::DOUBLE, 6) AS recall, round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 6) AS f1,
       round(auc, 6) AS auc, auc < 0.85 AS drifted FROM cm, au""",
    "churn_scores",
)
def classification_metrics(t: Tables) -> DataFrame:
    out = mt.classification_metrics(scored(t))
    return out.withColumns({c: F.round(c, 6) for c in ("log_loss", "precision", "recall", "f1", "auc")})


@query(
    "roc_curve_points",
    "WITH "
    + AUC_SQL
    + """SELECT s AS threshold, round(sum(neg) OVER (ORDER BY s DESC) / (sum(neg) OVER ())::DOUBLE, 6) AS fpr,
       round(sum(pos) OVER (ORDER BY s DESC) / (sum(pos) OVER ())::DOUBLE, 6) AS tpr FROM g""",
    "churn_scores",
)
def roc_curve_points(t: Tables) -> DataFrame:
    return mt.roc_points(scored(t)).withColumns({"fpr": F.round("fpr", 6), "tpr": F.round("tpr", 6)})


TOP_SQL = """
top AS (SELECT target_churn FROM churn_scores
        QUALIFY row_number() OVER (ORDER BY churn_proba DESC, customer_id) <= greatest(1, floor((SELECT count(*) FROM churn_scores) * 0.2)))
"""


@query(
    "precision_at_top20",
    "WITH " + TOP_SQL + "SELECT count(*) AS n_top, round(avg(target_churn), 6) AS precision_at_top20 FROM top",
    "churn_scores",
)
def precision_at_top20(t: Tables) -> DataFrame:
    out = mt.precision_at_top(scored(t), "customer_id")
    return out.withColumn("precision_at_top20", F.round("precision_at_top20", 6))


METRIC_SQL = f"""
WITH {FORECAST_SQL}, {AUC_SQL}, {TOP_SQL},
m AS (SELECT 'demand_lag1' AS model, 'mape' AS metric, avg(abs(y - l1) / CASE WHEN abs(y) < 1e-8 THEN 1.0::DOUBLE ELSE abs(y) END) AS value FROM fc WHERE l1 IS NOT NULL
      UNION ALL SELECT 'demand_lag7', 'mape', avg(abs(y - l7) / CASE WHEN abs(y) < 1e-8 THEN 1.0::DOUBLE ELSE abs(y) END) FROM fc WHERE l7 IS NOT NULL
      UNION ALL SELECT 'churn', 'auc', auc FROM au
      UNION ALL SELECT 'churn', 'f1', 2 * tp / (2 * tp + fp + fn)::DOUBLE FROM cm
      UNION ALL SELECT 'churn', 'precision_at_top20', avg(target_churn) FROM top)
"""


def lag_metrics(t: Tables) -> DataFrame:
    """Errors of the one-day and the seven-day lag as demand models, in one pass."""
    models = F.array(
        *[F.struct(F.lit(f"demand_lag{n}").alias("model"), F.col(f"l{n}").alias("yhat")) for n in (1, 7)]
    )
    return mt.regression_metrics(naive_forecasts(t).select("y", F.inline(models)), keys=["model"])


def model_metrics(t: Tables) -> DataFrame:
    """Long (model, metric, value) rows of two naive demand models and the churn scores."""
    parts = [
        lag_metrics(t).select("model", F.lit("mape").alias("metric"), (F.col("mape_pct") / 100).alias("value"))
    ]
    named = F.array(*[F.struct(F.lit("churn").alias("model"), F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("auc", "f1")])
    parts.append(mt.classification_metrics(scored(t)).select(F.inline(named)))
    top = mt.precision_at_top(scored(t), "customer_id")
    parts.append(
        top.select(F.lit("churn").alias("model"), F.lit("precision_at_top20").alias("metric"), F.col("precision_at_top20").alias("value"))
    )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "kpi_gate",
    METRIC_SQL
    + """, gt AS (SELECT * FROM (VALUES ('mape', 'minimise', 0.10::DOUBLE, 0.20::DOUBLE), ('auc', 'maximise', 0.90::DOUBLE, 0.60::DOUBLE),
       ('f1', 'maximise', 0.70::DOUBLE, NULL), ('precision_at_top20', 'maximise', 0.50::DOUBLE, NULL)) v(metric, direction, target, hard))
SELECT model, metric, round(value, 6) AS value, direction, target,
       CASE WHEN (direction = 'minimise' AND value <= target) OR (direction = 'maximise' AND value >= target) THEN 'PASS' ELSE 'FAIL' END AS soft_status,
       CASE WHEN hard IS NULL THEN NULL WHEN (direction = 'minimise' AND value <= hard) OR (direction = 'maximise' AND value >= hard) THEN 'PASS' ELSE 'FAIL' END AS hard_status
FROM m JOIN gt USING (metric)""",
    "daily_sales churn_scores",
)
def kpi_gate(t: Tables) -> DataFrame:
    return mt.kpi_gate(model_metrics(t)).withColumn("value", F.round("value", 6))


@query(
    "champion_challenger",
    METRIC_SQL
    + """, p AS (SELECT 'demand' AS model, 'minimise' AS direction, (SELECT value FROM m WHERE model = 'demand_lag7') AS champion,
              (SELECT value FROM m WHERE model = 'demand_lag1') AS challenger, 5.0::DOUBLE AS gate
       UNION ALL SELECT 'churn', 'maximise', 0.7::DOUBLE, (SELECT value FROM m WHERE metric = 'auc'), 0.60::DOUBLE),
r AS (SELECT *, CASE WHEN direction = 'minimise' THEN champion - challenger ELSE challenger - champion END / champion * 100 AS pct,
             CASE WHEN direction = 'minimise' THEN challenger <= gate ELSE challenger >= gate END AS gate_pass FROM p)
SELECT model, direction, round(champion, 6) AS champion, round(challenger, 6) AS challenger, gate, round_even(pct, 2) AS improvement_pct,
       gate_pass, pct >= 5 AS improvement_pass, gate_pass AND pct >= 5 AS promote FROM r""",
    "daily_sales churn_scores",
)
def champion_challenger(t: Tables) -> DataFrame:
    """Two naive demand models, and the churn scores against a fixed champion."""
    mape = {n: F.max(F.when(F.col("model") == f"demand_lag{n}", F.col("mape_pct") / 100)) for n in (1, 7)}
    demand = lag_metrics(t).agg(F.struct(mape[7].alias("old"), mape[1].alias("new")).alias("m")).scalar()
    area = mt.auc(scored(t)).select("auc", demand.alias("m"))
    old, new = F.col("m.old"), F.col("m.new")
    row = area.select(
        F.array(
            F.struct(F.lit("demand").alias("model"), F.lit("minimise").alias("direction"), old.alias("champion"),
                     new.alias("challenger"), F.lit(5.0).alias("gate")),
            F.struct(F.lit("churn").alias("model"), F.lit("maximise").alias("direction"), F.lit(0.7).alias("champion"),
                     F.col("auc").alias("challenger"), F.lit(0.60).alias("gate")),
        ).alias("rows")
    )
    out = mt.champion_challenger(row.select(F.inline("rows")))
    return out.withColumns({"champion": F.round("champion", 6), "challenger": F.round("challenger", 6)})


@query(
    "retrain_decision",
    PSI_SQL.rstrip()
    + ", "
    + FORECAST_SQL
    + """, mp AS (SELECT avg(abs(y - l7) / CASE WHEN abs(y) < 1e-8 THEN 1.0::DOUBLE ELSE abs(y) END) FILTER (WHERE date >= DATE '2000-01-01') AS cur, avg(abs(y - l7) / CASE WHEN abs(y) < 1e-8 THEN 1.0::DOUBLE ELSE abs(y) END) FILTER (WHERE date < DATE '2000-01-01') AS base FROM fc WHERE l7 IS NOT NULL)
SELECT round(cur, 6) AS mape_current, round(base, 6) AS mape_baseline, (SELECT round_even(max(psi), 4) FROM ps) AS max_feature_psi,
       (SELECT max(psi) FROM ps) > 0.2 AS psi_trigger, cur > base * 1.15::DOUBLE AS mape_trigger,
       (SELECT max(psi) FROM ps) > 0.2 OR cur > base * 1.15::DOUBLE AS retrain FROM mp""",
    "drift_features daily_sales",
)
def retrain_decision(t: Tables) -> DataFrame:
    period = F.when(F.col("date") >= F.lit("2000-01-01").cast("date"), "current").otherwise("baseline")
    measured = mt.regression_metrics(naive_forecasts(t).withColumn("period", period), "y", "l7", keys=["period"])
    mapes = measured.agg(
        F.struct(*[F.max(F.when(F.col("period") == n, F.col("mape_pct") / 100)).alias(f"mape_{n}") for n in ("current", "baseline")]).alias("m")
    )
    psis = drift.psi_summary(drift.psi(t.drift_features(), COLUMNS))
    summary = psis.withColumn("_m", mapes.scalar()).select("summary", "_m.mape_current", "_m.mape_baseline")
    out = drift.retrain_decision(summary).drop("summary")
    return out.withColumns({"mape_current": F.round("mape_current", 6), "mape_baseline": F.round("mape_baseline", 6)})


@query(
    "monitor_metrics_rows",
    PSI_SQL.rstrip()
    + ", "
    + AUC_SQL.strip()
    + ", "
    + FORECAST_SQL.strip()
    + ", "
    + SCORE_SQL.strip()[5:]
    + """SELECT 'psi' AS family, col AS label, round(psi, 6) AS value FROM ps
UNION ALL SELECT 'churn_auc', NULL, round(auc, 6) FROM au
UNION ALL SELECT 'demand_mape', product_id, round(avg(abs(y - l7) / CASE WHEN abs(y) < 1e-8 THEN 1.0::DOUBLE ELSE abs(y) END) * 100, 6) FROM fc WHERE l7 IS NOT NULL GROUP BY 2
UNION ALL SELECT 'stockout_rate', NULL, round(count(*) FILTER (WHERE stock_quantity = 0)::DOUBLE / count(*) * 100, 6) FROM erp
UNION ALL SELECT 'dq_score', suite, round(score, 6) FROM s""",
    "drift_features churn_scores daily_sales pos erp",
)
def monitor_metrics_rows(t: Tables) -> DataFrame:
    fc = naive_forecasts(t).filter("l7 IS NOT NULL")
    error = percent_error(F.col("y"), F.col("l7"))
    # Every value also under an internal name, which must not be reported.
    psi_names = F.array(
        *[F.struct(F.concat(F.lit(p), "column").alias("name"), F.col("psi").alias("value")) for p in ("psi_", "psi__")]
    )
    stock = t.erp().agg(
        F.lit("stockout_rate").alias("name"),
        (F.count_if(F.col("stock_quantity") == 0) / F.count(F.lit(1)) * 100).alias("value"),
    )
    parts = [
        drift.psi(t.drift_features(), COLUMNS).select(F.inline(psi_names)),
        mt.auc(scored(t)).select(F.lit("churn_auc").alias("name"), F.col("auc").alias("value")),
        fc.groupBy(F.concat(F.lit("demand_mape_"), "product_id").alias("name")).agg((F.avg(error) * 100).alias("value")),
        stock,
        stock.select(F.lit("not_a_metric").alias("name"), "value"),
        suite_scores(t).select(F.concat(F.lit("dq_score_"), "suite").alias("name"), F.col("score").alias("value")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return drift.metric_rows(out).withColumn("value", F.round("value", 6))


@query(
    "label_join",
    """
WITH act AS (SELECT CAST(o_custkey AS VARCHAR) AS customer_id, CAST(max(o_orderdate) < TIMESTAMP '2001-06-01' AS INT) AS label FROM orders GROUP BY 1)
SELECT customer_id, churn_proba AS prediction, label FROM churn_scores JOIN act USING (customer_id)""",
    "churn_scores",
)
def label_join(t: Tables) -> DataFrame:
    actual = t.orders.groupBy(F.col("o_custkey").cast("string").alias("customer_id")).agg(
        (F.max("o_orderdate") < F.lit("2001-06-01").cast("timestamp_ntz")).cast("int").alias("label")
    )
    return scored(t).join(actual, "customer_id").select("customer_id", "prediction", "label")


MAPE_SQL = "WITH " + FORECAST_SQL + """, mp AS (SELECT product_id, avg(abs(y - l7) / CASE WHEN abs(y) < 1e-8 THEN 1.0::DOUBLE ELSE abs(y) END) * 100 AS mape FROM fc WHERE l7 IS NOT NULL GROUP BY 1)
"""


def sku_mape(t: Tables) -> DataFrame:
    error = percent_error(F.col("y"), F.col("l7"))
    return naive_forecasts(t).filter("l7 IS NOT NULL").groupBy("product_id").agg((F.avg(error) * 100).alias("mape"))


BAND_SQL = "CASE WHEN mape <= 10 THEN 'green' WHEN mape <= 15 THEN 'amber' ELSE 'red' END"


@query("mape_band", MAPE_SQL + f"SELECT product_id, round(mape, 6) AS mape, {BAND_SQL} AS band FROM mp", "daily_sales")
def mape_bands(t: Tables) -> DataFrame:
    return sku_mape(t).select("product_id", F.round("mape", 6).alias("mape"), mape_band(F.col("mape")).alias("band"))


@query(
    "mape_vs_target",
    MAPE_SQL
    + """SELECT product_id, round_even(mape - 10, 2) AS vs_target, (SELECT count(*) FROM mp WHERE mape <= 10) AS n_within,
       (SELECT count(*) FROM mp WHERE mape > 10) AS n_above, round((SELECT avg(mape) FROM mp), 6) AS mean_mape FROM mp""",
    "daily_sales",
)
def mape_vs_target(t: Tables) -> DataFrame:
    mapes = sku_mape(t)
    whole = mapes.agg(
        F.struct(
            F.count_if(F.col("mape") <= 10).alias("n_within"), F.count_if(F.col("mape") > 10).alias("n_above"),
            F.round(F.avg("mape"), 6).alias("mean_mape"),
        ).alias("s")
    ).scalar()
    return mapes.withColumn("_s", whole).select(
        "product_id", half_even(F.col("mape") - 10, 2).alias("vs_target"), "_s.n_within", "_s.n_above", "_s.mean_mape"
    )


@query(
    "mape_leaderboard",
    MAPE_SQL
    + f"SELECT row_number() OVER (ORDER BY mape, product_id) AS place, product_id, round(mape, 6) AS mape, {BAND_SQL} AS band FROM mp",
    "daily_sales",
)
def mape_leaderboard(t: Tables) -> DataFrame:
    """All SKUs by error, numbered without a one-task sort."""
    best = global_rank(sku_mape(t), [F.col("mape"), F.col("product_id")], "place")
    return best.select(
        "place", "product_id", F.round("mape", 6).alias("mape"), mape_band(F.col("mape")).alias("band")
    )


@query(
    "gauge_attainment",
    MAPE_SQL
    + """SELECT product_id, round(mape / 10.0::DOUBLE * 100, 6) AS attainment_pct, mape / 10.0::DOUBLE * 100 <= 100 AS good_inverted,
       mape / 10.0::DOUBLE * 100 >= 100 AS good FROM mp""",
    "daily_sales",
)
def gauge_attainment(t: Tables) -> DataFrame:
    pct = attainment_pct(F.col("mape"), F.lit(10.0))
    return sku_mape(t).select(
        "product_id", F.round(pct, 6).alias("attainment_pct"), (pct <= 100).alias("good_inverted"), (pct >= 100).alias("good")
    )


@query(
    "mlops_kpis",
    MAPE_SQL.rstrip()
    + ", "
    + PSI_SQL.strip()[5:]
    + """SELECT round(avg(mape), 6) AS avg_mape, round(min(mape), 6) AS min_mape, arg_min(product_id, mape) AS best_product,
       (SELECT count(*) FROM ps WHERE psi > 0.2) AS n_drifted, (SELECT count(*) FROM ps) AS n_features,
       (SELECT round(max(psi), 6) FROM ps) AS max_psi, (SELECT arg_max(col, psi) FROM ps) AS max_feature
FROM mp""",
    "daily_sales drift_features",
)
def mlops_kpis(t: Tables) -> DataFrame:
    psis = drift.psi(t.drift_features(), COLUMNS).agg(
        F.struct(
            F.count_if(F.col("psi") > 0.2).alias("n_drifted"), F.count(F.lit(1)).alias("n_features"),
            F.round(F.max("psi"), 6).alias("max_psi"), F.max_by("column", "psi").alias("max_feature"),
        ).alias("s")
    )
    return sku_mape(t).agg(
        F.round(F.avg("mape"), 6).alias("avg_mape"), F.round(F.min("mape"), 6).alias("min_mape"),
        F.min_by("product_id", "mape").alias("best_product"),
    ).withColumn("_s", psis.scalar()).select("avg_mape", "min_mape", "best_product", "_s.*")
