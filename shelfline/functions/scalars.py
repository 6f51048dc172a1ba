"""Small column expressions shared by the jobs. All stay in generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tier limits.
RISK_LIMITS = [(0.80, "Critical"), (0.60, "High"), (0.40, "Medium")]
URGENCY_LIMITS = [(7, "Critical"), (14, "High"), (30, "Medium")]
URGENCY_ORDER = {"Critical": 0, "High": 1, "Medium": 2, "OK": 3}
CLV_ORDER = {"Platinum": 0, "Gold": 1, "Silver": 2, "Bronze": 3}


def ladder(pairs: list[tuple[Column, str]], otherwise: str | None) -> Column:
    """First true condition wins."""
    (first, label), *rest = pairs
    out = F.when(first, label)
    for condition, value in rest:
        out = out.when(condition, value)
    return out.otherwise(otherwise) if otherwise is not None else out


def half_even(value: Column, places: int = 0) -> Column:
    """Round a double half to even after scaling, so that a tie is one even where its binary value is a last bit off.

    ``bround`` looks at the shortest decimal text instead, in which 952.65 may read 952.6500000000001.
    """
    scale = F.lit(float(10**places))
    return F.rint(value * scale) / scale


def risk_tier(p: Column, boundary: str = "inclusive") -> Column:
    """Churn tier. ``inclusive`` tests >=, ``exclusive`` tests >, ``interval`` leaves p outside (0, 1] null."""
    if boundary == "inclusive":
        return ladder([(p >= limit, name) for limit, name in RISK_LIMITS], "Low")
    tier = ladder([(p > limit, name) for limit, name in RISK_LIMITS], "Low")
    if boundary == "exclusive":
        return tier
    if boundary == "interval":
        return F.when((p > 0) & (p <= 1), tier)
    raise ValueError(f"unknown boundary {boundary!r}")


def stock_urgency(days: Column, with_ok: bool = True) -> Column:
    top = "OK" if with_ok else None
    pairs = [(days <= limit, name) for limit, name in URGENCY_LIMITS]
    return ladder(pairs, top) if with_ok else ladder(pairs[:2], "Medium")


def rank_of(value: Column, order: dict[str, int]) -> Column:
    """Sort rank of a named level; unknown names come last."""
    ranks = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    return F.coalesce(F.try_element_at(ranks, value), F.lit(len(order)))


def mape_band(mape: Column) -> Column:
    return ladder([(mape <= 10, "green"), (mape <= 15, "amber")], "red")


def psi_band(psi: Column) -> Column:
    return ladder([(psi > 0.2, "severe"), (psi > 0.1, "moderate")], "stable")


def churn_label(recency: Column, frequency: Column) -> Column:
    return ((recency > 30) & (frequency < 2)).cast("int")


def clv_band(monetary: Column) -> Column:
    return ladder([(monetary > 5000, "high"), (monetary > 1000, "medium")], "low")


def high_risk_flag(score: Column, recency: Column) -> Column:
    """Missing inputs compare as false, as NaN does in a data frame."""
    return F.coalesce(score < 2.0, F.lit(False)) & F.coalesce(recency > 60, F.lit(False))


def extreme_weather(temp: Column, rain: Column) -> Column:
    return F.coalesce(temp > 40, F.lit(False)) | F.coalesce(rain > 50, F.lit(False))


def percent_error(actual: Column, predicted: Column) -> Column:
    """Absolute error relative to the actual value; near-zero actuals divide by one."""
    base = F.when(F.abs(actual) < 1e-8, F.lit(1.0)).otherwise(F.abs(actual))
    return F.abs(actual - predicted) / base


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def winner_by_min(candidates: dict[str, Column], fallback: str) -> Column:
    """Name of the smallest metric; NaN and null are skipped and the first named wins ties."""
    entries = [
        F.when(
            nan_to_null(metric).isNotNull(),
            F.struct(nan_to_null(metric).alias("metric"), F.lit(i).alias("place"), F.lit(name).alias("name")),
        )
        for i, (name, metric) in enumerate(candidates.items())
    ]
    return F.coalesce(F.array_min(F.array_compact(F.array(*entries)))["name"], F.lit(fallback))


def demand_cache_key(sku: Column, store: Column, horizon: Column, day: Column) -> Column:
    digest = F.md5(F.concat_ws(":", sku, store, horizon.cast("string"), F.date_format(day, "yyyy-MM-dd")))
    return F.concat(F.lit("demand:"), F.substring(digest, 1, 12))


def header_slug(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(text)), "[^a-z0-9]+", "_")


def gate_status(value: Column, target: Column, direction: Column) -> Column:
    met = F.when(direction == "minimise", value <= target).otherwise(value >= target)
    return F.when(F.coalesce(met, F.lit(False)), "PASS").otherwise("FAIL")


def attainment_pct(value: Column, threshold: Column) -> Column:
    return value / threshold * 100


def rule_churn_score(recency: Column, frequency: Column, monetary: Column) -> Column:
    """Weighted churn score clipped to [0.02, 0.97]; missing inputs take 30 days, 10 orders, 100 spend."""
    r = F.least(F.coalesce(recency.cast("double"), F.lit(30.0)) / 180, F.lit(1.0))
    f = F.least(F.coalesce(frequency.cast("double"), F.lit(10.0)) / 50, F.lit(1.0))
    m = F.least(F.coalesce(monetary.cast("double"), F.lit(100.0)) / 5000, F.lit(1.0))
    raw = F.lit(0.35) * r + F.lit(0.30) * (1 - f) + F.lit(0.20) * (1 - m)
    return F.greatest(F.least(raw, F.lit(0.97)), F.lit(0.02))


def normal_cdf(z: Column) -> Column:
    """Distribution function of the normal law, by the series with odd double factorials; beyond 8 deviations it is 0 or 1."""
    start = F.struct(z.alias("term"), z.alias("total"))

    def step(at: Column, k: Column) -> Column:
        term = at["term"] * z * z / (2 * k + 1)
        return F.struct(term.alias("term"), (at["total"] + term).alias("total"))

    series = F.aggregate(F.sequence(F.lit(1), F.lit(200)), start, step)["total"]
    inside = F.lit(0.5) + series * F.exp(-z * z / 2) / F.sqrt(2 * F.pi())
    return F.when(z < -8, 0.0).when(z > 8, 1.0).otherwise(inside)
