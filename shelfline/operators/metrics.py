"""Model quality metrics as aggregates over whole prediction tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.scalars import gate_status, half_even, percent_error
from shelfline.operators.ordered import running_totals
from shelfline.operators.refine import smallest_rows

# Limits below or above which a model counts as degraded.
AUC_FLOOR = 0.85
MAPE_CEILING = 12.0
# Gates (metric, direction, soft target, hard limit or none).
GATES = [
    ("mape", "minimise", 0.10, 0.20),
    ("auc", "maximise", 0.90, 0.60),
    ("f1", "maximise", 0.70, None),
    ("precision_at_top20", "maximise", 0.50, None),
]
PROMOTION_STEP = 5.0


def score_counts(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Positives and negatives per distinct score: everything rank-based starts from here."""
    return scored.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )


def _ranked_counts(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Score counts with the number of negatives at or below each score."""
    return running_totals(score_counts(scored, score, label), [F.col("score")], {"_neg": F.col("neg")})


def _auc() -> Column:
    """Share of positive-negative pairs in the right order; ties count half."""
    wins = F.col("pos") * ((F.col("_neg") - F.col("neg")) + F.col("neg") / 2)
    return F.try_divide(F.sum(wins), (F.sum("pos") * F.sum("neg")).cast("double"))


def auc(scored: DataFrame, score: str = "prediction", label: str = "target") -> DataFrame:
    """Area under the ROC curve with tied scores averaged; null when one class is missing."""
    return _ranked_counts(scored, score, label).agg(
        _auc().alias("auc"), F.sum("pos").alias("n_positive"), F.sum("neg").alias("n_negative")
    )


def classification_metrics(scored: DataFrame, score: str = "prediction", label: str = "target") -> DataFrame:
    """AUC, F1, precision, recall, log-loss and the confusion matrix at 0.5.

    All of them follow from the counts per distinct score, so the scores are read once.
    """
    hit = F.col("score") >= 0.5
    p = F.greatest(F.least(F.col("score"), F.lit(1 - 1e-15)), F.lit(1e-15))
    loss = F.sum(-(F.col("pos") * F.ln(p) + F.col("neg") * F.ln(1 - p)))
    zero = F.lit(0.0)

    def total(side: str, wanted: Column) -> Column:
        return F.coalesce(F.sum(F.when(wanted, F.col(side))), F.lit(0))

    counts = _ranked_counts(scored, score, label).agg(
        total("pos", hit).alias("tp"), total("neg", hit).alias("fp"),
        total("pos", ~hit).alias("fn"), total("neg", ~hit).alias("tn"),
        F.try_divide(loss, F.sum(F.col("pos") + F.col("neg"))).alias("log_loss"), _auc().alias("auc"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "tp", "fp", "fn", "tn", "log_loss",
        F.coalesce(F.try_divide(tp, tp + fp), zero).alias("precision"),
        F.coalesce(F.try_divide(tp, tp + fn), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), zero).alias("f1"),
        "auc", F.coalesce(F.col("auc") < AUC_FLOOR, F.lit(False)).alias("drifted"),
    )


def roc_points(scored: DataFrame, score: str = "prediction", label: str = "target") -> DataFrame:
    """False and true positive rate at every distinct threshold."""
    counts = score_counts(scored, score, label)
    run = running_totals(
        counts, [F.col("score").desc()], {"tp": F.col("pos"), "fp": F.col("neg")}, with_totals=True
    )
    return run.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp"), F.col("fp_total")).alias("fpr"),
        F.try_divide(F.col("tp"), F.col("tp_total")).alias("tpr"),
    )


def precision_at_top(scored: DataFrame, key: str, score: str = "prediction", label: str = "target", share: float = 0.2) -> DataFrame:
    """Mean label of the top share by score; ties go to the smaller key."""
    slim = scored.select(key, score, label)
    ranked = smallest_rows(slim, -F.col(score), [F.col(key)], lambda n: F.greatest(F.lit(1), F.floor(n * F.lit(share))), "_top")
    return ranked.filter("_top").agg(F.count(F.lit(1)).alias("n_top"), F.avg(label).alias("precision_at_top20"))


def regression_metrics(
    forecast: DataFrame, actual: str = "y", predicted: str = "yhat", lower: str | None = None,
    upper: str | None = None, keys: Sequence[str] = (),
) -> DataFrame:
    """RMSE, MAE, MAPE in percent, R² and interval coverage, for the whole table or per ``keys``."""
    y, p = F.col(actual), F.col(predicted)
    residual = (y - p) * (y - p)
    coverage = F.lit(0.9) if lower is None else F.avg(y.between(F.col(lower), F.col(upper)).cast("int"))
    return forecast.filter(y.isNotNull() & p.isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(residual)).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        (F.avg(percent_error(y, p)) * 100).alias("mape_pct"),
        (1 - F.try_divide(F.sum(residual), F.var_pop(y) * F.count(F.lit(1)))).alias("r2"),
        coverage.alias("coverage"),
    ).withColumn("drifted", F.col("mape_pct") > MAPE_CEILING)


def pinball(actual: Column, predicted: Column, q: float) -> Column:
    error = actual - predicted
    return F.greatest(F.lit(q) * error, F.lit(q - 1) * error)


def pinball_loss(forecast: DataFrame, actual: str = "y") -> DataFrame:
    """Mean quantile loss over P10, P50 and P90."""
    y = F.col(actual)
    total = sum((pinball(y, F.col(f"p{int(q * 100)}"), q) for q in (0.1, 0.5, 0.9)), F.lit(0.0))
    return forecast.filter(y.isNotNull() & F.col("p50").isNotNull()).agg((F.avg(total) / 3).alias("pinball_loss"))


def horizon_mape(forecast: DataFrame, horizon: str = "h", actual: str = "y", predicted: str = "p50") -> DataFrame:
    error = F.abs(F.col(actual) - F.col(predicted)) / (F.abs(F.col(actual)) + F.lit(1e-8))
    return forecast.filter(F.col(predicted).isNotNull()).groupBy(horizon).agg(
        F.avg(error).alias("mape"), F.count(F.lit(1)).alias("n")
    )


def kpi_gate(metrics: DataFrame) -> DataFrame:
    """Long metrics (model, metric, value) against soft targets and hard limits."""
    table = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"), F.lit(d).alias("direction"), F.lit(soft).alias("target"),
                F.lit(hard).cast("double").alias("hard_limit"),
            )
            for m, d, soft, hard in GATES
        ]
    )
    gate = F.get(F.filter(table, lambda g: g["metric"] == F.col("metric")), F.lit(0))
    out = metrics.withColumn("_g", gate).filter(F.col("_g").isNotNull())
    hard = gate_status(F.col("value"), F.col("_g.hard_limit"), F.col("_g.direction"))
    return out.select(
        *metrics.columns, F.col("_g.direction").alias("direction"), F.col("_g.target").alias("target"),
        gate_status(F.col("value"), F.col("_g.target"), F.col("_g.direction")).alias("soft_status"),
        F.when(F.col("_g.hard_limit").isNotNull(), hard).alias("hard_status"),
    )


def champion_challenger(pairs: DataFrame) -> DataFrame:
    """Rows (model, metric, direction, champion, challenger, gate): promote past the gate with enough gain.

    All values of a row share one unit.
    """
    lower = F.col("direction") == "minimise"
    gain = F.when(lower, F.col("champion") - F.col("challenger")).otherwise(F.col("challenger") - F.col("champion"))
    pct = F.try_divide(gain, F.col("champion")) * 100
    gate = gate_status(F.col("challenger"), F.col("gate"), F.col("direction")) == "PASS"
    better = F.coalesce(pct >= PROMOTION_STEP, F.lit(False))
    return pairs.withColumns(
        {"improvement_pct": half_even(pct, 2), "gate_pass": gate, "improvement_pass": better, "promote": gate & better}
    )
