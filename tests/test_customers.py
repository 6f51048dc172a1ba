import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.operators import customers as cu


def features(spark, n=400, seed=42):
    rng = np.random.default_rng(seed)
    data = []
    for i in range(n):
        churned = i < n // 4
        recency = 60 if churned else int(rng.integers(1, 60))
        frequency = 1 if churned else int(rng.integers(1, 40))
        money = float(rng.uniform(20, 3000))
        data.append((f"c{i:04d}", recency, frequency, money, money / frequency, float(rng.uniform(1, 5)), int(recency > 30 and frequency < 2)))
    names = "customer_id string, recency_days int, frequency int, monetary double, avg_basket_size double, rfm_score double, label int"
    return spark.createDataFrame(data, names)


def test_split_is_exact_per_label_and_repeatable(spark, rows):
    df = features(spark)
    split = cu.stratified_split(df, "customer_id", "label")
    sizes = {r["label"]: (r["n"], r["t"]) for r in split.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert all(t == int(n * 0.2) for n, t in sizes.values()) and sum(n for n, _ in sizes.values()) == 400
    again = cu.stratified_split(df.repartition(7), "customer_id", "label")
    assert rows(split, "customer_id", "is_test") == rows(again, "customer_id", "is_test")


def test_churn_model_learns_scores_and_explains(spark):
    df = features(spark)
    split = cu.stratified_split(df, "customer_id", "label")
    model = cu.fit_churn_model(split.filter("NOT is_test"))
    got = cu.evaluate_churn(model, split.filter("is_test")).first()
    assert got["auc"] > 0.95 and got["precision_at_top20"] > 0.9
    ranked = cu.feature_importance(model, spark).collect()
    assert "recency_days" in {ranked[0]["feature"], ranked[1]["feature"]}
    assert [abs(r["coefficient"]) for r in ranked] == sorted((abs(r["coefficient"]) for r in ranked), reverse=True)
    scored = cu.score_churn(model, df)
    top = cu.top_contributions(model, scored).collect()
    assert len(top) == 20 and all(len(r["top_features"]) == 5 for r in top)
    strengths = [abs(c["contribution"]) for c in top[0]["top_features"]]
    assert strengths == sorted(strengths, reverse=True)
    total = sum(c["contribution"] for c in top[0]["top_features"]) + model.intercept
    assert 1 / (1 + np.exp(-total)) == pytest.approx(top[0]["churn_proba"])


def test_training_needs_both_labels(spark):
    with pytest.raises(ValueError):
        cu.fit_churn_model(features(spark).filter("label = 0"))


def test_constant_feature_is_harmless(spark):
    model = cu.fit_churn_model(features(spark).withColumn("rfm_score", F.lit(3.0)))
    assert cu.score_churn(model, features(spark)).filter(F.col("churn_proba").isNull()).count() == 0


def test_missing_features_raise_and_nulls_fill(spark):
    df = features(spark, 8)
    assert cu.fill_feature_nulls(df.withColumn("monetary", F.lit(None).cast("double"))).first()["monetary"] == 0.0
    with pytest.raises(KeyError):
        cu.fill_feature_nulls(df.drop("monetary"))


def test_segments_find_separate_groups(spark):
    rng = np.random.default_rng(1)
    data = [(f"{g}-{i}", float(g * 50 + rng.normal()), float(g * 20 + rng.normal()), float(g * 900 + rng.normal())) for g in range(3) for i in range(40)]
    df = spark.createDataFrame(data, "customer_id string, recency_days double, frequency double, monetary double")
    out = cu.assign_segments(df, k=3)
    groups = out.groupBy(F.substring("customer_id", 1, 1).alias("g")).agg(F.countDistinct("cluster_id").alias("n")).collect()
    assert all(r["n"] == 1 for r in groups) and cu.silhouette(out) > 0.9
    numbers = {r["g"]: r["c"] for r in out.groupBy(F.substring("customer_id", 1, 1).alias("g")).agg(F.first("cluster_id").alias("c")).collect()}
    assert numbers == {"1": 0, "0": 1, "2": 7}  # recent by value, then the lapsed big spenders


def test_clusters_get_the_profile_of_their_rank():
    recent = [(-1.0, 3.0, 3.0), (-1.1, 1.0, 1.0), (-0.9, 0.0, 0.0), (-1.0, -1.0, -1.0)]
    lapsed = [(1.0, -1.0, -1.0), (1.1, 0.0, 0.0), (0.9, 1.0, 1.0), (1.2, 2.0, 2.0)]
    assert cu.rank_clusters(recent + lapsed) == [0, 1, 2, 4, 5, 6, 3, 7]
    assert sorted(cu.rank_clusters([(0.0, 0.0, 0.0)] * 10)) == list(range(10))


def test_timeline(spark):
    df = spark.sql("SELECT 'a' AS customer_id, TIMESTAMP_NTZ '2024-01-01' AS ts, 'x' AS category, 1.0D AS total_amount, 4 AS basket_size UNION ALL SELECT 'b', TIMESTAMP_NTZ '2024-01-01', 'x', 1.0D, 1")
    assert [r["marker_size"] for r in cu.purchase_timeline(df, "a").collect()] == [18]
