"""Data-quality rules, compiled into one aggregate pass per table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Pass mark of a suite and the share of rows that range rules must satisfy.
PASS_MARK = 0.98


class QualityError(ValueError):
    """A table failed its quality gate."""


@dataclass(frozen=True)
class Rule:
    kind: str
    column: str
    low: float | None = None
    high: float | None = None
    allowed: tuple = ()
    mostly: float = 1.0

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}"

    def failing(self) -> Column:
        value = F.col(self.column)
        if self.kind == "not_null":
            return value.isNull()
        if self.kind == "between":
            return value.isNotNull() & ~value.between(self.low, self.high)
        if self.kind == "in_set":
            return value.isNotNull() & ~value.isin(*self.allowed)
        raise ValueError(self.kind)

    def considered(self) -> Column:
        return F.lit(True) if self.kind == "not_null" else F.col(self.column).isNotNull()


def not_null(*columns: str) -> list[Rule]:
    return [Rule("not_null", c) for c in columns]


# The rule sets of the two gated tables.
POS_RULES = [
    *not_null("transaction_id", "customer_id", "product_id", "timestamp"),
    Rule("between", "unit_price", 0.01, 10000.0, mostly=0.999),
    Rule("between", "quantity", 1, 1000, mostly=0.999),
    Rule("in_set", "return_flag", allowed=(True, False)),
    Rule("unique", "transaction_id"),
]
ERP_RULES = [
    *not_null("product_id", "store_id", "snapshot_date"),
    Rule("between", "stock_quantity", 0, 999999, mostly=0.999),
    Rule("between", "lead_time_days", 1, 365, mostly=0.99),
    Rule("between", "reorder_point", 0, 999999, mostly=0.99),
]


def _verdict(measured: DataFrame) -> DataFrame:
    ratio = F.coalesce(1 - F.try_divide("n_failing", "n_checked"), F.lit(1.0))
    passed = F.when(F.col("rule").startswith("not_null"), F.col("n_failing") == 0).otherwise(F.col("ratio") >= F.col("mostly"))
    return measured.withColumn("ratio", ratio).withColumn("passed", passed)


def evaluate_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: rows checked, rows failing, share in order, passed."""
    simple = [r for r in rules if r.kind != "unique"]
    parts = []
    if simple:
        rows = df.agg(
            F.array(
                *[
                    F.struct(
                        F.lit(r.name).alias("rule"),
                        F.count_if(r.considered()).alias("n_checked"),
                        F.count_if(r.failing()).alias("n_failing"),
                        F.lit(float(r.mostly)).alias("mostly"),
                    )
                    for r in simple
                ]
            ).alias("rules")
        )
        parts.append(rows.select(F.inline("rules")))
    for r in (r for r in rules if r.kind == "unique"):
        # Every member of a duplicated group fails; groups collapse to counts before the shuffle.
        copies = df.filter(F.col(r.column).isNotNull()).groupBy(r.column).agg(F.count(F.lit(1)).alias("copies"))
        parts.append(
            copies.agg(
                F.lit(r.name).alias("rule"),
                F.coalesce(F.sum("copies"), F.lit(0)).alias("n_checked"),
                F.coalesce(F.sum(F.when(F.col("copies") > 1, F.col("copies"))), F.lit(0)).alias("n_failing"),
                F.lit(float(r.mostly)).alias("mostly"),
            ).select("rule", "n_checked", "n_failing", "mostly")
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return _verdict(out)


def suite_score(results: DataFrame, label: str) -> DataFrame:
    """Share of passed rules; a suite without rules scores 1."""
    passed = F.count_if("passed")
    return results.agg(
        F.lit(label).alias("suite"),
        F.count(F.lit(1)).alias("n_rules"),
        passed.alias("n_passed"),
        F.coalesce(F.try_divide(passed, F.count(F.lit(1))), F.lit(1.0)).alias("score"),
    ).withColumn("meets_threshold", F.col("score") >= PASS_MARK)


def overall_score(scores: DataFrame) -> DataFrame:
    return scores.agg(F.avg("score").alias("overall_score")).withColumn(
        "meets_threshold", F.col("overall_score") >= PASS_MARK
    )


def enforce(score: DataFrame, column: str = "score") -> float:
    """Raise unless the one-row score reaches the pass mark."""
    value = score.first()[column]
    if value < PASS_MARK:
        raise QualityError(f"quality score {value:.4f} is below {PASS_MARK}")
    return value


def null_key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, rows with any missing key, and missing values per key."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(missing).alias("n_bad"),
        *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys],
    )
