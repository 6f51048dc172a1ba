"""Small frame-level operators: renames, checks, unions, top-k and scenario rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline.functions.scalars import gate_status, half_even, mape_band

# The forecast horizon range.
HORIZONS = (1, 90)
# Demand response to promotion, price and temperature.
PRICE_ELASTICITY = -1.5
TEMPERATURE_EFFECT = 0.005


def enrich_metadata(df: DataFrame, source_system: str) -> DataFrame:
    return df.withColumns({"ingestion_timestamp": F.current_timestamp(), "source_system": F.lit(source_system)})


def normalise_demand(df: DataFrame) -> DataFrame:
    """date/quantity to the forecasting names ds/y."""
    out = df.withColumnsRenamed({"date": "ds", "quantity": "y"})
    return out.withColumns({"ds": F.col("ds").cast("timestamp_ntz"), "y": F.col("y").cast("double")})


def restore_demand(df: DataFrame) -> DataFrame:
    out = df.withColumnsRenamed({"ds": "date", "y": "quantity"})
    return out.withColumn("date", F.to_date("date"))


def clean_ids(df: DataFrame, column: str) -> DataFrame:
    """Trimmed, non-blank ids."""
    return df.withColumn(column, F.trim(column)).filter(F.col(column) != "")


def check_batch(df: DataFrame, column: str) -> DataFrame:
    """Cleaned batch of ids of any size; an empty one is an error."""
    cleaned = clean_ids(df, column)
    if not cleaned.take(1):
        raise ValueError("no ids left after cleaning")
    return cleaned


def check_horizon(days: int) -> int:
    if not HORIZONS[0] <= days <= HORIZONS[1]:
        raise ValueError(f"horizon must lie in {HORIZONS}")
    return days


def valid_quantiles(forecast: DataFrame) -> DataFrame:
    """Rows with non-negative quantiles and p90 >= p50."""
    ordered = F.col("p90") >= F.col("p50")
    return forecast.filter(ordered & (F.col("p10") >= 0) & (F.col("p50") >= 0) & (F.col("p90") >= 0))


def point_only(forecast: DataFrame, include_confidence: bool) -> DataFrame:
    """Without confidence all quantiles repeat the median."""
    if include_confidence:
        return forecast
    return forecast.withColumns({"p10": F.col("p50"), "p90": F.col("p50")})


def union_history_forecast(history: DataFrame, forecast: DataFrame) -> DataFrame:
    """History carries ``actual``, forecast the quantiles; the rest is null."""
    left = history.withColumn("is_forecast", F.lit(False))
    right = forecast.withColumn("is_forecast", F.lit(True))
    return left.unionByName(right, allowMissingColumns=True)


def workbook_tables(rows: DataFrame, mapes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two sheets of a forecast export."""
    forecast = rows.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    return forecast, mapes.withColumn("band", mape_band(F.col("mape")))


def top_by_total(df: DataFrame, key: str, value: Column, n: int) -> DataFrame:
    totals = df.groupBy(key).agg(F.sum(value).alias("total"))
    return totals.orderBy(F.col("total").desc(), key).limit(n)


def keep_top(df: DataFrame, top: DataFrame, key: str) -> DataFrame:
    """Rows of the listed keys; the list is a top-n and therefore small."""
    return df.join(F.broadcast(top.select(key)), key, "left_semi")


def top_trials(trials: DataFrame, n: int = 20) -> DataFrame:
    done = trials.filter(F.col("status") == "SUCCESS")
    return done.orderBy("cv_mape", "trial_id").limit(n)


def best_trial(trials: DataFrame, keys: list[str], params: list[str], defaults: dict[str, Column]) -> DataFrame:
    """Parameters of the smallest error per key; keys without a finished trial get the defaults."""
    done = (F.col("status") == "SUCCESS") & F.col("cv_mape").isNotNull()
    best = trials.groupBy(*keys).agg(
        F.min(F.when(done, F.struct("cv_mape", "trial_id", *params))).alias("b")
    )
    return best.select(
        *keys, F.col("b.cv_mape").alias("cv_mape"),
        *[F.coalesce(F.col(f"b.{p}"), defaults[p]).alias(p) for p in params],
    )


def whatif_demand(forecast: DataFrame, scenarios: list[dict[str, float]], keys: list[str]) -> DataFrame:
    """Total demand under each scenario of promotion %, price % and temperature change."""
    rows = F.array(*[F.struct(*[F.lit(float(s[k])).alias(k) for k in ("promo_pct", "price_pct", "temp_delta")]) for s in scenarios])
    base = forecast.groupBy(*keys).agg(F.sum("p50").alias("base_demand"))
    adjust = (
        F.col("promo_pct") / 100 + F.lit(PRICE_ELASTICITY) * F.col("price_pct") / 100
        + F.lit(TEMPERATURE_EFFECT) * F.col("temp_delta")
    )
    return base.select("*", F.inline(rows)).withColumn("total_demand", F.col("base_demand") * (1 + adjust))


def scoreboard(results: DataFrame, target: float) -> DataFrame:
    """Model rows with target and verdict plus one average row; failures count as 1.0 but not in the mean."""
    value = F.when(F.col("failed"), F.lit(1.0)).otherwise(F.col("mape"))
    rows = results.select("model", F.lit("mape").alias("metric"), value.alias("value"))
    mean = results.agg(
        F.lit("average").alias("model"), F.lit("mape").alias("metric"),
        F.avg(F.when(~F.col("failed"), F.col("mape"))).alias("value"),
    )
    out = rows.unionByName(mean).withColumn("target", F.lit(target))
    return out.withColumn("status", gate_status(F.col("value"), F.col("target"), F.lit("minimise")))


def experiment_summary(experiments: DataFrame, runs: DataFrame, keep: int = 20) -> DataFrame:
    """Best runs per experiment with verdict; an experiment without runs yields one NOT RUN row."""
    signed = F.when(F.col("direction") == "minimise", F.col("value")).otherwise(-F.col("value"))
    known = runs.filter(F.col("value").isNotNull()).join(experiments, "experiment")
    # The per-group rank limit runs before the shuffle, so one busy experiment stays small.
    place = F.row_number().over(Window.partitionBy("experiment").orderBy("_s", "run_name"))
    best = known.withColumn("_s", signed).withColumn("_r", place).filter(F.col("_r") <= keep)
    joined = experiments.join(best.select("experiment", "run_name", "value"), "experiment", "left")
    status = F.when(F.col("value").isNull(), "NOT RUN").otherwise(
        gate_status(F.col("value"), F.col("target"), F.col("direction"))
    )
    return joined.select(
        "experiment", F.coalesce("run_name", F.lit("N/A")).alias("run_name"), "metric",
        half_even(F.col("value"), 4).alias("value"), "target", status.alias("status"),
    )
