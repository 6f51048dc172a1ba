"""Customer queries: churn, segments, retention, hub figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.scalars import CLV_ORDER, churn_label, rank_of, risk_tier
from shelfline.operators import customers as cu
from shelfline.operators import features as ft
from shelfline.operators.frames import clean_ids
from shelfline.plans.registry import query
from shelfline.plans.views import PERSONAS, SNAPSHOT, Tables
from shelfline.session import stage_table
from shelfline.sources.readers import scores_for_day


def rfm(t: Tables) -> DataFrame:
    return ft.customer_rfm(t.customer_sales(), SNAPSHOT)


@query(
    "churn_label",
    """SELECT customer_id, recency_days, frequency, CAST(recency_days > 30 AND frequency < 2 AS INT) AS label FROM rfm""",
    "rfm",
)
def churn_labels(t: Tables) -> DataFrame:
    label = churn_label(F.col("recency_days"), F.col("frequency"))
    return rfm(t).select("customer_id", "recency_days", "frequency", label.alias("label"))


@query("churn_rate", "SELECT count(*) AS n, round(avg((recency_days > 30 AND frequency < 2)::INT), 6) AS churn_rate FROM rfm", "rfm")
def churn_rate(t: Tables) -> DataFrame:
    label = churn_label(F.col("recency_days"), F.col("frequency"))
    return rfm(t).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(label), 6).alias("churn_rate"))


def all_customers(t: Tables) -> DataFrame:
    """Every customer with features where the window has sales, nulls elsewhere."""
    ids = t.customer.select(F.col("c_custkey").cast("string").alias("customer_id"))
    return ids.join(rfm(t), "customer_id", "left")


@query(
    "fill_feature_nulls",
    """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, coalesce(recency_days, 0) AS recency_days, coalesce(frequency, 0) AS frequency,
       coalesce(CAST(monetary AS DOUBLE), 0) AS monetary, round(coalesce(CAST(monetary AS DOUBLE) / frequency, 0), 6) AS avg_basket_size
FROM customer LEFT JOIN rfm ON CAST(c_custkey AS VARCHAR) = customer_id""",
    "rfm",
)
def fill_feature_nulls(t: Tables) -> DataFrame:
    out = cu.fill_feature_nulls(all_customers(t), cu.FEATURES[:4])
    return out.withColumn("avg_basket_size", F.round("avg_basket_size", 6))


RULE_SQL = """
WITH r AS (SELECT CAST(c_custkey AS VARCHAR) AS customer_id, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary
           FROM customer LEFT JOIN rfm ON CAST(c_custkey AS VARCHAR) = customer_id),
p AS (SELECT customer_id, recency_days, frequency, monetary, greatest(least(0.35::DOUBLE * least(coalesce(recency_days::DOUBLE, 30) / 180, 1)
        + 0.30::DOUBLE * (1 - least(coalesce(frequency::DOUBLE, 10) / 50, 1)) + 0.20::DOUBLE * (1 - least(coalesce(monetary, 100) / 5000, 1)), 0.97::DOUBLE), 0.02::DOUBLE) AS p FROM r),
s AS (SELECT customer_id, round_even(p, 4) AS churn_proba, CASE WHEN p >= 0.8 THEN 'Critical' WHEN p >= 0.6 THEN 'High' WHEN p >= 0.4 THEN 'Medium' ELSE 'Low' END AS risk_tier FROM p)
"""


@query("churn_rule_score", RULE_SQL + "SELECT * FROM s", "rfm")
def churn_rule_score(t: Tables) -> DataFrame:
    return cu.rule_scores(all_customers(t))


@query(
    "churn_leaderboard",
    RULE_SQL + "SELECT * FROM s ORDER BY churn_proba DESC, customer_id LIMIT 100",
    "rfm",
)
def churn_leaderboard(t: Tables) -> DataFrame:
    return cu.leaderboard(cu.rule_scores(all_customers(t)), 100)


@query(
    "risk_tier",
    """
SELECT customer_id, churn_proba,
       CASE WHEN churn_proba >= 0.8 THEN 'Critical' WHEN churn_proba >= 0.6 THEN 'High' WHEN churn_proba >= 0.4 THEN 'Medium' ELSE 'Low' END AS tier,
       CASE WHEN churn_proba > 0.8 THEN 'Critical' WHEN churn_proba > 0.6 THEN 'High' WHEN churn_proba > 0.4 THEN 'Medium' ELSE 'Low' END AS tier_exclusive,
       CASE WHEN churn_proba <= 0 OR churn_proba > 1 THEN NULL WHEN churn_proba > 0.8 THEN 'Critical' WHEN churn_proba > 0.6 THEN 'High'
            WHEN churn_proba > 0.4 THEN 'Medium' ELSE 'Low' END AS tier_interval
FROM churn_scores""",
    "churn_scores",
)
def risk_tiers(t: Tables) -> DataFrame:
    p = F.col("churn_proba")
    return t.churn_scores().select(
        "customer_id", "churn_proba", risk_tier(p).alias("tier"), risk_tier(p, "exclusive").alias("tier_exclusive"),
        risk_tier(p, "interval").alias("tier_interval"),
    )


@query(
    "scan_scores_for_day",
    "SELECT customer_id, churn_proba AS prediction, target_churn AS target, scored_at, monetary FROM churn_scores WHERE scored_at = DATE '2024-01-16'",
    "churn_scores",
)
def scan_scores_for_day(t: Tables) -> DataFrame:
    return scores_for_day(t.churn_scores(), "2024-01-16")


PROFILE_SQL = "pr AS (SELECT * FROM (VALUES " + ", ".join(str(p) for p in cu.CLUSTER_PROFILES) + ") v(cluster_id, persona, clv_tier, recommended_channel))"
HUB_SQL = f"""
WITH {PROFILE_SQL},
hub AS (SELECT s.customer_id, CAST(s.customer_id AS INT) % 10 AS cluster_id, s.churn_proba, s.monetary, s.persona AS declared,
               coalesce(pr.persona, 'Unknown') AS persona, coalesce(clv_tier, 'Bronze') AS clv_tier,
               coalesce(recommended_channel, 'Email') AS recommended_channel,
               CAST(floor(s.churn_proba * 10) AS INT) AS risk_decile
        FROM churn_scores s LEFT JOIN pr ON pr.cluster_id = CAST(s.customer_id AS INT) % 10)
"""


def hub(t: Tables) -> DataFrame:
    scored = t.churn_scores().withColumnRenamed("persona", "declared")
    clustered = scored.withColumn("cluster_id", (F.col("customer_id").cast("long") % 10).cast("int"))
    out = cu.with_profile(clustered, cu.cluster_profiles(t.spark))
    return out.withColumn("risk_decile", F.floor(F.col("churn_proba") * 10).cast("int"))


@query(
    "cluster_profile_dim",
    HUB_SQL + "SELECT cluster_id, persona, clv_tier, recommended_channel, count(*) AS n_customers FROM hub GROUP BY ALL",
    "churn_scores",
)
def cluster_profile_dim(t: Tables) -> DataFrame:
    return hub(t).groupBy("cluster_id", "persona", "clv_tier", "recommended_channel").agg(
        F.count(F.lit(1)).alias("n_customers")
    )


@query(
    "dimension_default_join",
    HUB_SQL + "SELECT customer_id, cluster_id, persona, clv_tier, recommended_channel FROM hub",
    "churn_scores",
)
def dimension_default_join(t: Tables) -> DataFrame:
    return hub(t).select("customer_id", "cluster_id", "persona", "clv_tier", "recommended_channel")


@query("persona_counts", HUB_SQL + "SELECT persona, count(*) AS n FROM hub GROUP BY 1", "churn_scores")
def persona_counts(t: Tables) -> DataFrame:
    return hub(t).groupBy("persona").agg(F.count(F.lit(1)).alias("n"))


@query(
    "clv_revenue_by_tier",
    HUB_SQL
    + """SELECT clv_tier, CASE clv_tier WHEN 'Platinum' THEN 0 WHEN 'Gold' THEN 1 WHEN 'Silver' THEN 2 ELSE 3 END AS place,
       CAST(sum(CAST(monetary AS DECIMAL(18,4))) AS DOUBLE) AS revenue FROM hub GROUP BY 1""",
    "churn_scores",
)
def clv_revenue_by_tier(t: Tables) -> DataFrame:
    tiers = hub(t).groupBy("clv_tier").agg(F.sum(F.col("monetary").cast("decimal(18,4)")).cast("double").alias("revenue"))
    return tiers.withColumn("place", rank_of(F.col("clv_tier"), CLV_ORDER)).orderBy("place")


PIVOT = PERSONAS + ["Unknown"]


@query(
    "churn_heatmap_pivot",
    HUB_SQL
    + "SELECT risk_decile, "
    + ", ".join(f"count(*) FILTER (WHERE persona = '{p}') AS \"{p}\"" for p in PIVOT)
    + " FROM hub GROUP BY 1",
    "churn_scores",
)
def churn_heatmap_pivot(t: Tables) -> DataFrame:
    wide = hub(t).groupBy("risk_decile").pivot("persona", PIVOT).agg(F.count(F.lit(1)))
    return wide.fillna(0)


@query(
    "customer_filter",
    HUB_SQL
    + """SELECT customer_id, persona, churn_proba FROM hub WHERE persona IN ('Champion', 'At-Risk VIP') AND churn_proba >= 0.6""",
    "churn_scores",
)
def customer_filter(t: Tables) -> DataFrame:
    tiered = hub(t).withColumn("risk_tier", risk_tier(F.col("churn_proba")))
    chosen = F.col("persona").isin("Champion", "At-Risk VIP") & F.col("risk_tier").isin("Critical", "High")
    return tiered.filter(chosen).select("customer_id", "persona", "churn_proba")


@query(
    "customer_kpis",
    HUB_SQL
    + """SELECT count(*) AS total, count(*) FILTER (WHERE churn_proba > 0.6) AS n_at_risk,
       round(count(*) FILTER (WHERE churn_proba > 0.6) * 100 / count(*)::DOUBLE, 6) AS pct_at_risk, round(avg(churn_proba), 6) AS mean_churn,
       round(CAST(sum(CAST(monetary AS DECIMAL(18,4))) AS DOUBLE) / count(*), 6) AS mean_value,
       count(*) FILTER (WHERE churn_proba >= 0.6) AS high_risk_count FROM hub""",
    "churn_scores",
)
def customer_kpis(t: Tables) -> DataFrame:
    p, n = F.col("churn_proba"), F.count(F.lit(1))
    money = F.sum(F.col("monetary").cast("decimal(18,4)")).cast("double")
    return hub(t).agg(
        n.alias("total"), F.count_if(p > 0.6).alias("n_at_risk"),
        F.round(F.count_if(p > 0.6) * 100 / n, 6).alias("pct_at_risk"), F.round(F.avg(p), 6).alias("mean_churn"),
        F.round(money / n, 6).alias("mean_value"),
        F.count_if(risk_tier(p).isin("Critical", "High")).alias("high_risk_count"),
    )


AXES = ["recency_days", "frequency", "monetary"]


@query(
    "segment_profile",
    """
WITH n AS (SELECT CASE CAST(customer_id AS BIGINT) % 6 WHEN 0 THEN 'Champion' WHEN 1 THEN 'Loyal' WHEN 2 THEN 'Potential Loyalist'
                 WHEN 3 THEN 'At-Risk VIP' WHEN 4 THEN 'New' ELSE 'Lost' END AS persona,
       (recency_days - min(recency_days) OVER ()) / (max(recency_days) OVER () - min(recency_days) OVER ())::DOUBLE * 100 AS a0,
       (frequency - min(frequency) OVER ()) / (max(frequency) OVER () - min(frequency) OVER ())::DOUBLE * 100 AS a1,
       (monetary::DOUBLE - min(monetary::DOUBLE) OVER ()) / (max(monetary::DOUBLE) OVER () - min(monetary::DOUBLE) OVER ()) * 100 AS a2 FROM rfm),
a AS (SELECT persona, avg(a0) AS a0, avg(a1) AS a1, avg(a2) AS a2 FROM n GROUP BY 1)
SELECT persona, CAST(0 AS INT) AS position, 'recency_days' AS axis, round(a0, 6) AS value FROM a UNION ALL SELECT persona, 1, 'frequency', round(a1, 6) FROM a
UNION ALL SELECT persona, 2, 'monetary', round(a2, 6) FROM a UNION ALL SELECT persona, 3, 'recency_days', round(a0, 6) FROM a""",
    "rfm",
)
def segment_profile(t: Tables) -> DataFrame:
    """Mean position of each persona on the RFM axes; the first axis repeats to close the polygon."""
    persona = F.element_at(F.array(*[F.lit(p) for p in PERSONAS]), (F.col("customer_id").cast("long") % 6 + 1).cast("int"))
    base = rfm(t)
    bounds = base.agg(F.struct(*[f(c).alias(f"{n}_{c}") for c in AXES for n, f in (("lo", F.min), ("hi", F.max))]).alias("b")).scalar()
    placed = base.withColumns({"persona": persona, "_b": bounds})
    means = placed.groupBy("persona").agg(
        *[F.avg(F.try_divide(F.col(c) - F.col(f"_b.lo_{c}"), F.col(f"_b.hi_{c}") - F.col(f"_b.lo_{c}")) * 100).alias(c) for c in AXES]
    )
    points = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(c).alias("axis"), F.round(c, 6).alias("value"))
            for i, c in enumerate([*AXES, AXES[0]])
        ]
    )
    return means.select("persona", F.inline(points))


CONTRIBUTION_SQL = """
WITH c AS (SELECT customer_id, CASE WHEN recency_days % 7 <> 0 THEN recency_days END AS recency_days, (recency_days - 45) / 500.0::DOUBLE AS r,
                  CASE WHEN frequency > 1 THEN (2 - frequency) / 50.0::DOUBLE END AS f, (CAST(monetary AS DOUBLE) - 100000) / 2000000 AS m,
                  (frequency % 5) / 50.0::DOUBLE AS w FROM rfm),
a AS (SELECT customer_id, coalesce(recency_days, 45) AS d, list_filter([
        CASE WHEN r > 0.05 THEN {'channel': 'Email', 'urgency': CASE WHEN coalesce(recency_days, 45) > 60 THEN 'High' ELSE 'Medium' END} END,
        CASE WHEN coalesce(f, 0) > -0.02 THEN {'channel': 'Push Notification', 'urgency': 'Medium'} END,
        CASE WHEN m > 0.03 THEN {'channel': 'In-App', 'urgency': 'Low'} END,
        CASE WHEN w > 0.05 THEN {'channel': 'SMS', 'urgency': 'High'} END], lambda x: x IS NOT NULL) AS acts FROM c),
b AS (SELECT customer_id, d, CASE WHEN len(acts) = 0 THEN [{'channel': 'SMS', 'urgency': 'High'}] ELSE acts[1:3] END AS acts FROM a)
SELECT customer_id, CAST(i - 1 AS INT) AS position, acts[i].channel AS channel, acts[i].urgency AS urgency,
       acts[i].channel = 'Email' AS names_days
FROM b, LATERAL (SELECT unnest(range(1, len(acts) + 1)) AS i)"""


@query("retention_actions_rules", CONTRIBUTION_SQL, "rfm")
def retention_actions_rules(t: Tables) -> DataFrame:
    """Rules over a contribution map; some customers lack the recency value or the frequency entry."""
    r, f, m = F.col("recency_days"), F.col("frequency"), F.col("monetary")
    entries = F.array_compact(
        F.array(
            F.struct(F.lit("recency_days").alias("k"), ((r - 45) / F.lit(500.0)).alias("v")),
            F.when(f > 1, F.struct(F.lit("frequency").alias("k"), ((2 - f) / F.lit(50.0)).alias("v"))),
            F.struct(F.lit("monetary").alias("k"), ((m - 100000) / 2000000).alias("v")),
            F.struct(F.lit("rolling_mean_7d").alias("k"), (f % 5 / F.lit(50.0)).alias("v")),
        )
    )
    base = rfm(t).withColumns(
        {"contributions": F.map_from_entries(entries), "recency_days": F.when(r % 7 != 0, r)}
    )
    out = cu.retention_actions(base).select("customer_id", "recency_days", F.posexplode("actions").alias("position", "a"))
    days = F.coalesce("recency_days", F.lit(45)).cast("string")
    named = F.contains(F.col("a.action"), F.concat(F.lit("was "), days, F.lit(" days ago")))
    return out.select("customer_id", "position", "a.channel", "a.urgency", named.alias("names_days"))


ACTION_SQL = ", ".join(
    "('{}', '{}', '{}', '{}', '{}')".format(p, *a) for p, actions in cu.PERSONA_ACTIONS.items() for a in actions
)


@query(
    "retention_actions_persona",
    f"""
WITH acts AS (SELECT * FROM (VALUES {ACTION_SQL}) v(persona, action, urgency, channel, lift))
SELECT customer_id, persona, churn_proba, action, urgency, channel, lift FROM churn_scores JOIN acts USING (persona)
UNION ALL
SELECT customer_id, persona, churn_proba, '{cu.OTHER_ACTION[0]}', 'Medium', 'Push', '5-9%' FROM churn_scores
WHERE persona NOT IN (SELECT persona FROM acts) AND churn_proba > 0.4""",
    "churn_scores",
)
def retention_actions_persona(t: Tables) -> DataFrame:
    return cu.persona_actions(t.churn_scores())


@query(
    "clean_id_batch",
    """
SELECT DISTINCT trim(mktseg) AS segment, count(*) OVER (PARTITION BY trim(mktseg)) AS n
FROM (SELECT CASE WHEN c_custkey % 11 = 0 THEN '   ' ELSE '  ' || c_mktsegment || ' ' END AS mktseg FROM customer) WHERE trim(mktseg) <> ''""",
)
def clean_id_batch(t: Tables) -> DataFrame:
    padded = F.when(F.col("c_custkey") % 11 == 0, "   ").otherwise(F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")))
    cleaned = clean_ids(t.customer.select(padded.alias("segment")), "segment")
    return cleaned.groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


@query(
    "customer_timeline",
    """
WITH b AS (SELECT customer_id, ts, category, total_amount, quantity FROM pos)
SELECT customer_id, ts, category, CAST(total_amount AS DOUBLE) AS total_amount, quantity AS basket_size, quantity * 3 + 6 AS marker_size FROM b""",
    "pos",
)
def customer_timeline(t: Tables) -> DataFrame:
    sales = t.pos().select("customer_id", "ts", "category", F.col("total_amount").cast("double"), F.col("quantity").alias("basket_size"))
    return cu.purchase_timeline(sales)


def training_frame(t: Tables) -> DataFrame:
    """Scored RFM features with the churn label; staged because training reads it repeatedly."""
    features = cu.fill_feature_nulls(ft.rfm_features(t.customer_sales(), SNAPSHOT))
    return stage_table(features.withColumn("label", churn_label(F.col("recency_days"), F.col("frequency"))), "training")


@query(
    "stratified_split",
    """WITH l AS (SELECT CAST(recency_days > 30 AND frequency < 2 AS INT) AS label, count(*) AS n FROM rfm GROUP BY 1)
SELECT label, true AS is_test, CAST(floor(n * 0.2::DOUBLE) AS BIGINT) AS n FROM l UNION ALL SELECT label, false, n - CAST(floor(n * 0.2::DOUBLE) AS BIGINT) FROM l""",
    "rfm",
)
def stratified_split(t: Tables) -> DataFrame:
    split = cu.stratified_split(training_frame(t), "customer_id", "label")
    return split.groupBy("label", "is_test").agg(F.count(F.lit(1)).alias("n"))


def fitted(t: Tables):
    split = stage_table(cu.stratified_split(training_frame(t), "customer_id", "label"), "split")
    train, test = split.filter(~F.col("is_test")), split.filter("is_test")
    return cu.fit_churn_model(train), test, split


@query("churn_logistic")
def churn_logistic(t: Tables) -> DataFrame:
    model, test, _ = fitted(t)
    return cu.evaluate_churn(model, test)


@query("feature_importance")
def feature_importance(t: Tables) -> DataFrame:
    model, _, _ = fitted(t)
    return cu.feature_importance(model, t.spark)


@query("top_contributions")
def top_contributions(t: Tables) -> DataFrame:
    model, _, split = fitted(t)
    top = cu.top_contributions(model, cu.score_churn(model, split))
    return top.select("customer_id", "churn_proba", F.posexplode("top_features").alias("position", "f")).select(
        "customer_id", "churn_proba", "position", "f.feature", "f.contribution"
    )


@query("segment_assign")
def segment_assign(t: Tables) -> DataFrame:
    clustered = cu.assign_segments(rfm(t))
    out = cu.with_profile(clustered.drop("raw", "features"), cu.cluster_profiles(t.spark))
    return out.withColumn("silhouette", F.lit(cu.silhouette(clustered)))
