"""Customer scoring, segments, retention actions and the single-customer view."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.scalars import half_even, risk_tier, rule_churn_score
from shelfline.operators.metrics import classification_metrics, precision_at_top
from shelfline.operators.refine import smallest_rows
from shelfline.session import stage_table

FEATURES = ["recency_days", "frequency", "monetary", "avg_basket_size", "rfm_score"]

# Cluster profiles (cluster, persona, value tier, channel) and the profile of unknown clusters.
CLUSTER_PROFILES = [
    (0, "Champion", "Platinum", "Email"),
    (1, "Loyal", "Gold", "Push Notification"),
    (2, "Potential Loyalist", "Silver", "Email"),
    (3, "At-Risk VIP", "Gold", "SMS"),
    (4, "New", "Bronze", "In-App"),
    (5, "Lost", "Bronze", "Email"),
    (6, "Potential Loyalist", "Silver", "Push Notification"),
    (7, "At-Risk VIP", "Platinum", "SMS"),
]
#: Profile numbers from the best to the worst for recent and for lapsed clusters.
RECENT_PROFILES = (0, 1, 2, 4)
LAPSED_PROFILES = (7, 3, 6, 5)
UNKNOWN_PROFILE = {"persona": "Unknown", "clv_tier": "Bronze", "recommended_channel": "Email"}

# Actions per persona (action, urgency, channel, lift) and the action for other customers at risk.
PERSONA_ACTIONS = {
    "At-Risk VIP": [
        ("Send personalised win-back email with 20% exclusive discount", "High", "Email", "15-22%"),
        ("Assign VIP account manager for proactive outreach call", "High", "Phone", "12-18%"),
    ],
    "Loyal": [("Award double loyalty points on next purchase to reward frequency", "Medium", "Push", "8-12%")],
    "Lost": [("Launch reactivation SMS: 30-day limited 25% discount", "Critical", "SMS", "6-10%")],
    "Potential Loyalist": [("Invite to loyalty programme with sign-up bonus offer", "Medium", "Email", "10-16%")],
}
OTHER_ACTION = ("Send re-engagement push notification with personalised offer", "Medium", "Push", "5-9%")

# Texts of the contribution rules (channel, lift, text; {d} is the days since the last purchase).
RULE_TEXTS = {
    "recency": ("Email", "12–18%", "Re-engage via personalised email — last purchase was {d} days ago. "
                "Send targeted win-back offer with exclusive discount."),
    "frequency": ("Push Notification", "8–14%", "Offer loyalty reward — purchase frequency has declined. "
                  "Award double loyalty points on next qualifying purchase."),
    "monetary": ("In-App", "6–10%", "Personalised high-value product recommendation based on past purchase affinity "
                 "and browsing history. Upsell via targeted in-app card."),
    "rolling": ("SMS", "10–16%", "Weekly purchase pattern disrupted — send SMS reminder with cart abandonment incentive."),
    "fallback": ("SMS", "10–16%", "Send re-activation SMS with exclusive 15% discount code for next 7 days."),
}


def cluster_profiles(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The profile dimension: a CSV file if given, else the eight fixed profiles."""
    schema = "cluster_id int, persona string, clv_tier string, recommended_channel string"
    if path:
        return spark.read.schema(schema).option("header", True).csv(path)
    return spark.createDataFrame(CLUSTER_PROFILES, schema)


def with_profile(clustered: DataFrame, profiles: DataFrame) -> DataFrame:
    """Left join on the dimension; unknown clusters get the default profile."""
    out = clustered.join(profiles, "cluster_id", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in UNKNOWN_PROFILE.items()})


def fill_feature_nulls(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise KeyError(f"missing feature columns: {missing}")
    return df.fillna(0.0, list(features))


def rule_scores(features: DataFrame) -> DataFrame:
    raw = rule_churn_score(F.col("recency_days"), F.col("frequency"), F.col("monetary"))
    return features.withColumn("_p", raw).select(
        "customer_id", half_even(F.col("_p"), 4).alias("churn_proba"), risk_tier(F.col("_p")).alias("risk_tier")
    )


def leaderboard(scored: DataFrame, n: int) -> DataFrame:
    """The n customers most at risk: a top-k report."""
    return scored.orderBy(F.col("churn_proba").desc(), "customer_id").limit(n)


def _action(rule: str, urgency: Column, days: Column | None = None) -> Column:
    channel, lift, text = RULE_TEXTS[rule]
    body = F.lit(text) if days is None else F.replace(F.lit(text), F.lit("{d}"), days.cast("string"))
    return F.struct(
        body.alias("action"), urgency.alias("urgency"), F.lit(channel).alias("channel"),
        F.lit(lift).alias("expected_lift_pct"),
    )


def retention_actions(
    df: DataFrame, contributions: str = "contributions", recency: str = "recency_days", max_actions: int = 3
) -> DataFrame:
    """Ordered rules on the contribution map; the first ``max_actions`` that fire are kept."""

    def part(name: str) -> Column:
        return F.coalesce(F.try_element_at(F.col(contributions), F.lit(name)), F.lit(0.0))

    days = F.coalesce(F.col(recency), F.lit(45))
    fired = F.array_compact(
        F.array(
            F.when(part("recency_days") > 0.05, _action("recency", F.when(days > 60, "High").otherwise("Medium"), days)),
            F.when(part("frequency") > -0.02, _action("frequency", F.lit("Medium"))),
            F.when(part("monetary") > 0.03, _action("monetary", F.lit("Low"))),
            F.when(part("rolling_mean_7d") > 0.05, _action("rolling", F.lit("High"))),
        )
    )
    fallback = F.array(_action("fallback", F.lit("High")))
    return df.withColumn("actions", F.slice(F.when(F.size(fired) == 0, fallback).otherwise(fired), 1, max_actions))


def persona_actions(scored: DataFrame) -> DataFrame:
    """One row per recommended action; personas without a list get the default above 0.4."""

    def rows(actions) -> Column:
        return F.array(
            *[
                F.struct(*[F.lit(v).alias(n) for n, v in zip(("action", "urgency", "channel", "lift"), a)])
                for a in actions
            ]
        )

    chosen = F.when(F.col("churn_proba") > 0.4, rows([OTHER_ACTION]))
    for persona, actions in PERSONA_ACTIONS.items():
        chosen = F.when(F.col("persona") == persona, rows(actions)).otherwise(chosen)
    return scored.select("customer_id", "persona", "churn_proba", F.inline(chosen))


def stratified_split(df: DataFrame, key: str, label: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Exact hold-out share per label: the rows with the smallest key hashes, found by their cut value."""
    # 52 bits, which a double holds exactly.
    digest = F.shiftright(F.xxhash64(F.col(key), F.lit(seed)), 12)
    return smallest_rows(df, digest, [F.col(key)], lambda n: F.floor(n * F.lit(test_share)), "is_test", [label])


@dataclass(frozen=True)
class ChurnModel:
    """Logistic model on standardised features."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    stds: tuple[float, ...]
    coefficients: tuple[float, ...] = ()
    intercept: float = 0.0

    def scaled(self) -> dict[str, Column]:
        """Standardised features; a constant feature becomes zero."""
        return {
            c: (F.col(c) - F.lit(m)) / F.lit(s) if s else F.lit(0.0)
            for c, m, s in zip(self.features, self.means, self.stds)
        }


def _assembled(df: DataFrame, scaled: dict[str, Column]) -> DataFrame:
    wide = df.withColumns({f"_z_{c}": z for c, z in scaled.items()})
    return VectorAssembler(inputCols=[f"_z_{c}" for c in scaled], outputCol="_x").transform(wide)


def fit_churn_model(train: DataFrame, features: Sequence[str] = FEATURES, label: str = "label") -> ChurnModel:
    """Balanced L2 logistic regression on features scaled by their population deviation.

    The penalty 1/n on a mean loss equals a unit penalty on a summed loss.
    """
    stats = train.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("n1"),
        *[F.avg(c).alias(f"m_{c}") for c in features], *[F.stddev_pop(c).alias(f"s_{c}") for c in features],
    ).first()  # one row
    n, ones = stats["n"], stats["n1"]
    if not 0 < ones < n:
        raise ValueError("training needs both labels")
    model = ChurnModel(
        tuple(features), tuple(stats[f"m_{c}"] for c in features), tuple(stats[f"s_{c}"] for c in features)
    )
    weight = F.when(F.col(label) == 1, n / (2 * ones)).otherwise(n / (2 * (n - ones)))
    logistic = LogisticRegression(
        featuresCol="_x", labelCol=label, weightCol="_w", regParam=1.0 / n, elasticNetParam=0.0,
        standardization=False, maxIter=100,
    ).fit(_assembled(train, model.scaled()).withColumn("_w", weight))
    weights = tuple(float(c) for c in logistic.coefficients)
    return replace(model, coefficients=weights, intercept=float(logistic.intercept))


def score_churn(model: ChurnModel, df: DataFrame) -> DataFrame:
    """Probability as a plain expression, which stays in generated code."""
    logit = F.lit(model.intercept)
    for coefficient, scaled in zip(model.coefficients, model.scaled().values()):
        logit = logit + F.lit(coefficient) * scaled
    return df.withColumn("churn_proba", 1 / (1 + F.exp(-logit)))


def evaluate_churn(model: ChurnModel, test: DataFrame, key: str = "customer_id", label: str = "label") -> DataFrame:
    scored = stage_table(score_churn(model, test).select(key, label, "churn_proba"), "scored")
    top = precision_at_top(scored, key, "churn_proba", label).select("precision_at_top20").scalar()
    return classification_metrics(scored, "churn_proba", label).withColumn("precision_at_top20", top)


def feature_importance(model: ChurnModel, spark: SparkSession) -> DataFrame:
    pairs = list(zip(model.features, model.coefficients))
    frame = spark.createDataFrame(pairs, "feature string, coefficient double")
    return frame.orderBy(F.abs("coefficient").desc(), "feature")


def top_contributions(model: ChurnModel, scored: DataFrame, n_customers: int = 20, n_features: int = 5) -> DataFrame:
    """Exact linear contributions of the riskiest customers, largest first."""
    cells = []
    for (name, scaled), coefficient in zip(model.scaled().items(), model.coefficients):
        value = F.lit(coefficient) * scaled
        cells.append(F.struct((-F.abs(value)).alias("rank"), F.lit(name).alias("feature"), value.alias("contribution")))
    ordered = F.transform(
        F.slice(F.array_sort(F.array(*cells)), 1, n_features),
        lambda c: F.struct(c["feature"].alias("feature"), c["contribution"].alias("contribution")),
    )
    return leaderboard(scored, n_customers).select("customer_id", "churn_proba", ordered.alias("top_features"))


def assign_segments(features: DataFrame, k: int = 8, seed: int = 42, columns: Sequence[str] = ("recency_days", "frequency", "monetary")) -> DataFrame:
    """k-means on standardised customer features, numbered by what the clusters mean (:func:`rank_clusters`).

    The first column is the days since the last purchase, the others measure value.
    """
    base = features.select("customer_id", *[F.col(c).cast(T.DoubleType()).alias(c) for c in columns])
    base = stage_table(base, "segments")  # iterated over many times
    steps = [
        VectorAssembler(inputCols=list(columns), outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
        KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster"),
    ]
    model = Pipeline(stages=steps).fit(base)
    numbers = rank_clusters([tuple(float(x) for x in c) for c in model.stages[-1].clusterCenters()])
    meaning = F.create_map(*[F.lit(x) for pair in enumerate(numbers) for x in pair])
    return model.transform(base).withColumn("cluster_id", F.element_at(meaning, F.col("cluster"))).drop("cluster")


def rank_clusters(centers: Sequence[Sequence[float]]) -> list[int]:
    """Profile number of each centroid (standardised recency first, then measures of value).

    The half with the shorter recency is recent, the other lapsed. Each half is ordered by value and takes its
    profiles from best to worst; ties go to the earlier centroid, and what exceeds the profiles gets new numbers.
    """
    by_recency = sorted(range(len(centers)), key=lambda k: (centers[k][0], k))
    middle = (len(centers) + 1) // 2
    numbers = [0] * len(centers)
    spare = len(CLUSTER_PROFILES)
    for half, profiles in ((by_recency[:middle], RECENT_PROFILES), (by_recency[middle:], LAPSED_PROFILES)):
        for place, k in enumerate(sorted(half, key=lambda k: (-sum(centers[k][1:]), k))):
            if place < len(profiles):
                numbers[k] = profiles[place]
            else:
                numbers[k], spare = spare, spare + 1
    return numbers


def silhouette(clustered: DataFrame) -> float:
    return ClusteringEvaluator(predictionCol="cluster_id", featuresCol="features").evaluate(clustered)


def purchase_timeline(sales: DataFrame, customer: str | None = None) -> DataFrame:
    """Purchases with the marker size of each basket; those of one customer come in time order."""
    chosen = sales if customer is None else sales.filter(F.col("customer_id") == customer)
    marked = chosen.select(
        "customer_id", "ts", "category", "total_amount", "basket_size",
        (F.col("basket_size") * 3 + 6).alias("marker_size"),
    )
    return marked if customer is None else marked.orderBy("ts", "category", "total_amount")
