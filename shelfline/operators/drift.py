"""Distribution drift between a reference and a production population."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.scalars import half_even
from shelfline.operators.ordered import unpivot_numeric
from shelfline.operators.profiling import numeric_columns
from shelfline.operators.refine import largest_gap

# Drift limits and the floor of a bin's share.
PSI_LIMIT = 0.20
P_LIMIT = 0.05
JS_LIMIT = 0.10
SHARE_FLOOR = 1e-8
MAPE_DEGRADATION = 0.15
SIDES = ("reference", "production")


def shared_columns(reference: DataFrame, production: DataFrame) -> list[str]:
    there = set(numeric_columns(production))
    return [c for c in numeric_columns(reference) if c in there]


def both_sides(reference: DataFrame, production: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One table with a ``side`` column over the shared numeric columns."""
    chosen = list(columns or shared_columns(reference, production))
    parts = [df.select(F.lit(s).alias("side"), *chosen) for s, df in zip(SIDES, (reference, production))]
    return parts[0].unionByName(parts[1])


def value_bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest and largest value of each column over both sides: one row per column."""
    clean = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])
    cells = [F.struct(F.lit(c).alias("column"), F.min(c).alias("lo"), F.max(c).alias("hi")) for c in columns]
    return clean.agg(F.array(*cells).alias("b")).select(F.inline("b"))


def sided_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long form (column, value) with a count of one on the row's side; NaN and null are dropped."""
    long = unpivot_numeric(df, columns, ["side"]).filter("value IS NOT NULL")
    counts = [(F.col("side") == s).cast("int").alias(n) for s, n in zip(SIDES, ("n_ref", "n_prod"))]
    return long.select("column", "value", *counts)


def bin_index(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin by comparison with the inner edges; the largest value falls in the last bin."""
    step = (hi - lo) / bins
    return sum(((value >= lo + step * i).cast("int") for i in range(1, bins)), F.lit(0))


def bin_shares(valued: DataFrame, bounds: DataFrame, bins: int) -> DataFrame:
    """Counts per column and bin on both sides, over the full grid of bins, with side totals."""
    placed = valued.join(F.broadcast(bounds), "column").withColumn(
        "bin", bin_index(F.col("value"), F.col("lo"), F.col("hi"), bins)
    )
    counts = placed.groupBy("column", "bin").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_prod").alias("n_prod"))
    grid = bounds.select("column", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    filled = grid.join(counts, ["column", "bin"], "left").fillna(0, ["n_ref", "n_prod"])
    totals = counts.groupBy("column").agg(F.sum("n_ref").alias("all_ref"), F.sum("n_prod").alias("all_prod"))
    return filled.join(totals, "column", "left").fillna(0, ["all_ref", "all_prod"])


def _psi(shares: DataFrame) -> DataFrame:
    floor = F.lit(SHARE_FLOOR)
    p = F.greatest(F.try_divide("n_ref", "all_ref"), floor)
    q = F.greatest(F.try_divide("n_prod", "all_prod"), floor)
    empty = (F.max("all_ref") == 0) | (F.max("all_prod") == 0)
    value = F.greatest(F.sum((q - p) * F.ln(q / p)), F.lit(0.0))
    return shares.groupBy("column").agg(F.when(empty, 0.0).otherwise(value).alias("psi"))


def psi(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Population stability index per column."""
    return _psi(bin_shares(sided_values(df, columns), value_bounds(df, columns), bins))


def js_divergence(df: DataFrame, columns: Sequence[str], bins: int = 20, form: str = "distance") -> DataFrame:
    """Jensen–Shannon distance (or divergence) over shared bins, natural logarithm; 0 when a side is empty, as for PSI."""
    if form not in ("distance", "divergence"):
        raise ValueError(form)
    shares = bin_shares(sided_values(df, columns), value_bounds(df, columns), bins)
    p, q = [
        (F.try_divide(f"n_{s}", f"all_{s}") + SHARE_FLOOR) / (1 + bins * SHARE_FLOOR) for s in ("ref", "prod")
    ]
    middle = (p + q) / 2
    total = F.greatest((F.sum(p * F.ln(p / middle)) + F.sum(q * F.ln(q / middle))) / 2, F.lit(0.0))
    return shares.groupBy("column").agg(F.coalesce(F.sqrt(total) if form == "distance" else total, F.lit(0.0)).alias("js"))


def kolmogorov_p(d: Column, n1: Column, n2: Column, terms: int = 100) -> Column:
    """Two-sample p-value from the Kolmogorov series with the usual small-sample correction."""
    root = F.sqrt(n1 * n2 / (n1 + n2))
    lam = (root + 0.12 + F.lit(0.11) / root) * d
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2 * k * k * lam * lam),
    )
    return F.when(lam < 0.2, 1.0).otherwise(F.greatest(F.least(series, F.lit(1.0)), F.lit(0.0)))


def _ks(rows: DataFrame) -> DataFrame:
    found = largest_gap(rows).withColumnRenamed("gap", "ks")
    p = F.when(F.col("ks").isNull(), 1.0).otherwise(kolmogorov_p(F.col("ks"), F.col("n_ref"), F.col("n_prod")))
    return found.select("column", F.coalesce("ks", F.lit(0.0)).alias("ks"), p.alias("p_value"))


def ks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Two-sample Kolmogorov–Smirnov statistic and p-value per column."""
    found = _with_all(_ks(sided_values(df, columns)), columns)
    return found.select("column", F.coalesce("ks", F.lit(0.0)).alias("ks"), F.coalesce("p_value", F.lit(1.0)).alias("p_value"))


def _with_all(found: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row for each column, also for those that are null on both sides and so have no values."""
    names = found.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return names.join(found, "column", "left")


def drift_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PSI, KS and the drift flag per column, rounded for reporting.

    Bounds, bins and the grid of the KS statistic are aggregates over the input; only cells that can
    hold the largest gap are read again. No copy of the values is written.
    """
    joined = psi(df, columns).join(_ks(sided_values(df, columns)), "column")
    joined = _with_all(joined, columns).na.fill({"psi": 0.0, "ks": 0.0, "p_value": 1.0})
    flag = (F.col("psi") > PSI_LIMIT) | (F.col("p_value") < P_LIMIT)
    return joined.select(
        "column", half_even(F.col("psi"), 4).alias("psi"), half_even(F.col("ks"), 4).alias("ks"),
        half_even(F.col("p_value"), 4).alias("p_value"), flag.alias("drift_detected"),
    )


def prediction_drift(df: DataFrame, column: str) -> DataFrame:
    joined = js_divergence(df, [column]).join(psi(df, [column]), "column")
    return joined.withColumn("drift_detected", (F.col("js") > JS_LIMIT) | (F.col("psi") > PSI_LIMIT))


def psi_summary(psis: DataFrame) -> DataFrame:
    """One row: the feature map with its mean, how many drift, and the largest."""
    entries = F.sort_array(F.collect_list(F.struct("column", half_even(F.col("psi"), 4).alias("psi"))))  # one per column
    overall = half_even(F.avg("psi"), 4)
    extra = F.array(F.struct(F.lit("_overall_drift_score").alias("column"), overall.alias("psi")))
    return psis.agg(
        F.map_from_entries(F.concat(entries, extra)).alias("summary"),
        overall.alias("overall_drift_score"),
        F.count_if(F.col("psi") > PSI_LIMIT).alias("n_drifted"),
        half_even(F.max("psi"), 4).alias("max_psi"),
        F.max_by("column", "psi").alias("max_feature"),
    )


def retrain_decision(summary: DataFrame) -> DataFrame:
    """One row (summary map, mape_current, mape_baseline): retrain on drift or degradation."""
    features = F.map_filter("summary", lambda k, _: ~k.startswith("_"))
    worst = F.coalesce(F.array_max(F.map_values(features)), F.lit(0.0))
    drift = worst > PSI_LIMIT
    slump = F.col("mape_current") > F.col("mape_baseline") * (1 + MAPE_DEGRADATION)
    return summary.withColumns({"max_feature_psi": worst, "psi_trigger": drift, "mape_trigger": slump}).withColumn(
        "retrain", F.col("psi_trigger") | F.col("mape_trigger")
    )


def metric_rows(metrics: DataFrame) -> DataFrame:
    """Long (name, value) metrics split into family and label; internal and unknown names are dropped."""
    name = F.col("name")
    families = ["demand_mape", "psi", "dq_score"]
    family = F.when(name.isin("churn_auc", "stockout_rate", "api_p95_latency_seconds"), name)
    for f in families:
        family = family.when(name.startswith(f"{f}_"), f)
    label = F.when(family.isin(*families), F.substring(name, F.length(family) + 2, F.length(name)))
    return metrics.select(family.alias("family"), label.alias("label"), "value").filter(
        F.col("family").isNotNull() & ~F.coalesce(F.col("label"), F.lit("")).startswith("_")
    )
