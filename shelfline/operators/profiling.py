"""Exploratory statistics of whole tables."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.scalars import half_even
from shelfline.operators.ordered import one_row, unpivot_numeric
from shelfline.operators.refine import exact_quantiles
from shelfline.session import stage_table


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def customer_stats(sales: DataFrame) -> DataFrame:
    amount = F.sum("total_amount")
    return sales.groupBy("customer_id").agg(
        F.count("transaction_id").alias("txn_count"),
        amount.cast("double").alias("total_revenue"),
        (amount.cast("double") / F.count("total_amount")).alias("avg_basket"),
    )


def quantile_buckets(df: DataFrame, value: str, buckets: int, name: str) -> DataFrame:
    """Right-closed quantile buckets 0…: equal edges merge and the smallest value belongs to bucket 0."""
    probs = [i / buckets for i in range(buckets + 1)]
    long = df.select(F.lit(value).alias("column"), F.col(value).alias("value"))
    edges = exact_quantiles(long, probs).select(
        F.array_distinct(F.array(*[F.col(f"q{i}") for i in range(buckets + 1)])).alias("edges")
    )
    inner = F.slice("_edges", F.lit(2), F.greatest(F.size("_edges") - 2, F.lit(0)))
    return (
        df.withColumn("_edges", edges.scalar())
        .withColumn(name, F.size(F.filter(inner, lambda e: e < F.col(value))))
        .drop("_edges")
    )


def revenue_deciles(stats: DataFrame) -> DataFrame:
    stats = stage_table(stats, "stats")  # read three times below
    placed = quantile_buckets(stats, "total_revenue", 10, "revenue_decile")
    total = one_row(stats, revenue=F.sum(F.col("total_revenue").cast("decimal(18,4)")))
    money = F.sum(F.col("total_revenue").cast("decimal(18,4)")).cast("double")
    return (
        placed.groupBy("revenue_decile")
        .agg(
            F.count("customer_id").alias("n_customers"), money.alias("total_revenue"),
            F.avg("txn_count").alias("avg_txn_count"),
        )
        .withColumn(
            "revenue_share_pct", half_even(F.col("total_revenue") / total["revenue"].cast("double") * 100, 2)
        )
    )


def top_share(stats: DataFrame, prob: float = 0.8) -> DataFrame:
    """Customers at or above the revenue percentile and their share of all revenue."""
    stats = stage_table(stats, "stats")  # read twice below
    long = stats.select(F.lit("r").alias("column"), F.col("total_revenue").alias("value"))
    cut = exact_quantiles(long, [prob]).select("q0").scalar()
    money = F.col("total_revenue").cast("decimal(18,4)")
    top = F.col("total_revenue") >= F.col("_cut")
    return (
        stats.withColumn("_cut", cut)
        .agg(
            F.max("_cut").alias("threshold"),
            F.count_if(top).alias("n_top"),
            (F.sum(F.when(top, money)).cast("double") / F.sum(money).cast("double") * 100).alias("share_pct"),
        )
    )


def iqr_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    long = unpivot_numeric(df, columns)
    q = exact_quantiles(long, [0.25, 0.75])
    spread = F.col("q1") - F.col("q0")
    bounds = q.select(
        "column", (F.col("q0") - 1.5 * spread).alias("lower"), (F.col("q1") + 1.5 * spread).alias("upper")
    )
    # One row per column of the schema.
    outside = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    return (
        long.join(F.broadcast(bounds), "column")
        .groupBy("column", "lower", "upper")
        .agg(F.count_if(outside).alias("n_outliers"), F.count(F.lit(1)).alias("_n"))
        .withColumn("outlier_pct", half_even(F.col("n_outliers") / F.col("_n") * 100, 2))
        .drop("_n")
    )


def missing_rate(df: DataFrame, limit: float = 0.05) -> DataFrame:
    rates = df.agg(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.avg(F.col(c).isNull().cast("int")).alias("missing_rate"))
                for c in df.columns
            ]
        ).alias("r")
    )
    return rates.select(F.inline("r")).withColumn("flagged", F.col("missing_rate") > limit)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first occurrence of each full-row duplicate."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return groups.agg(
        F.sum("_copies").alias("n_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("n_duplicates"),
    )


def _whole_columns(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and variance of the columns without nulls: one row, used to build the next aggregate."""
    seen = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.var_samp(c).alias(f"v_{c}") for c in columns],
        *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in columns],
    ).first()
    return {c: (seen[f"m_{c}"], seen[f"v_{c}"] or 0.0) for c in columns if seen[f"n_{c}"] == 0 and seen[f"m_{c}"] is not None}


def correlations(df: DataFrame, columns: Sequence[str], whole: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Pearson correlation of every column pair (each once) in a single pass.

    Columns without nulls share plain sums of centred products, which compile to much less code
    than one correlation aggregate per pair; a pair with nulls uses its complete rows.
    """
    whole = _whole_columns(df, columns) if whole is None else whole
    centred = df.select(
        *columns, *[(F.col(c).cast("double") - F.lit(float(whole[c][0]))).alias(f"_c_{c}") for c in columns if c in whole]
    )
    squares = [F.sum(F.col(f"_c_{c}") * F.col(f"_c_{c}")).alias(f"_s_{c}") for c in columns if c in whole]
    pairs, sums, cells = list(combinations(columns, 2)), [], []
    for i, (a, b) in enumerate(pairs):
        both = a in whole and b in whole
        if both:
            sums.append(F.sum(F.col(f"_c_{a}") * F.col(f"_c_{b}")).alias(f"_p{i}"))
            r = F.try_divide(F.col(f"_p{i}"), F.sqrt(F.col(f"_s_{a}") * F.col(f"_s_{b}")))
        else:
            sums.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_p{i}"))
            r = F.col(f"_p{i}")
        cells.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), r.alias("corr")))
    return centred.agg(*squares, *sums).select(F.inline(F.array(*cells)))


def high_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    strength = F.abs("corr")
    return correlations(df, columns).filter((strength > 0.95) & (strength < 1.0))


def profile_summary(df: DataFrame) -> DataFrame:
    numbers = numeric_columns(df)
    n_columns = len(df.columns)
    missing = sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0))
    base = df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(missing.cast("long")).alias("_missing"))
    copies = duplicate_rows(df).select("n_duplicates").scalar()
    pairs = high_correlations(df, numbers).agg(F.count(F.lit(1))).scalar() if len(numbers) > 1 else F.lit(0)
    return base.select(
        "n_rows", F.lit(n_columns).alias("n_columns"),
        half_even(F.try_divide(F.col("_missing") * 100, F.col("n_rows") * n_columns), 4).alias("missing_cells_pct"),
        half_even(F.try_divide(copies * 100, F.col("n_rows")), 4).alias("duplicate_rows_pct"),
        pairs.alias("n_high_correlations"),
    )


def describe_all(df: DataFrame) -> DataFrame:
    """One row per column: counts, most frequent value for text, moments and quartiles for numbers.

    A column that is neither number nor text, such as a time, is described by its text.
    """
    numbers = numeric_columns(df)
    texts = [c for c in df.columns if c not in numbers]
    parts = []
    if texts:
        long = df.select(*[F.col(c).cast("string").alias(c) for c in texts]).unpivot([], texts, "column", "value")
        counts = long.filter("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        found = counts.groupBy("column").agg(
            F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
            F.min(F.struct((-F.col("n")).alias("n"), "value"))["value"].alias("top"), F.max("n").alias("freq"),
        )
        # A column that is null throughout has no values to count, but a row of its own.
        names = df.sparkSession.createDataFrame([(c,) for c in texts], "column string")
        parts.append(names.join(found, "column", "left").na.fill(0, ["count", "unique"]))
    if numbers:
        long = unpivot_numeric(df, numbers)
        moments = long.groupBy("column").agg(
            F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"), F.max("value").alias("max"),
        )
        quartiles = exact_quantiles(long, [0.25, 0.5, 0.75]).select(
            "column", F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75")
        )
        parts.append(moments.join(quartiles, "column", "left"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def corr_matrix_top_variance(df: DataFrame, top: int = 20) -> DataFrame:
    """Full correlation matrix over the columns of largest variance; columns with nulls are left out."""
    whole = _whole_columns(df, numeric_columns(df))
    chosen = sorted(whole, key=lambda c: (-whole[c][1], c))[:top]
    both = F.array(
        F.struct(F.col("col_a").alias("col_a"), F.col("col_b").alias("col_b")),
        F.struct(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b")),
    )
    return correlations(df, chosen, whole).select(F.inline(both), "corr")


def histogram(df: DataFrame, value: str, bins: int = 60) -> DataFrame:
    """Equal-width bins over the value range; the last bin is closed. Empty bins are kept."""
    known = df.select(F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    b = one_row(known, lo=F.min("v"), hi=F.max("v"))
    width = (F.col("_b.hi") - F.col("_b.lo")) / bins
    index = F.least(F.floor(F.try_divide(F.col("v") - F.col("_b.lo"), width)), F.lit(bins - 1)).cast("int")
    counts = (
        known.withColumn("_b", b)
        .groupBy(F.coalesce(index, F.lit(0)).alias("bin"), F.col("_b.lo").alias("lo"), width.alias("width"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    edges = counts.agg(F.max("lo").alias("lo"), F.max("width").alias("width")).select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "width"
    )
    return edges.join(counts.select("bin", "n"), "bin", "left").select(
        "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("left_edge"), F.coalesce("n", F.lit(0)).alias("n")
    )
