"""Profiling queries over sales and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.operators import profiling as pf
from shelfline.plans.registry import query
from shelfline.plans.views import Tables

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

STATS_SQL = """
WITH st AS (SELECT customer_id, count(*) AS txn_count, CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
                   CAST(sum(total_amount) AS DOUBLE) / count(*) AS avg_basket FROM pos GROUP BY 1)
"""


@query(
    "customer_stats",
    STATS_SQL + "SELECT customer_id, txn_count, total_revenue, round(avg_basket, 6) AS avg_basket FROM st",
    "pos",
)
def customer_stats(t: Tables) -> DataFrame:
    return pf.customer_stats(t.customer_sales()).withColumn("avg_basket", F.round("avg_basket", 6))


@query(
    "revenue_deciles",
    STATS_SQL
    + """, e AS (SELECT list_distinct(quantile_cont(total_revenue, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9])) AS edges FROM st),
d AS (SELECT len(list_filter((SELECT edges FROM e), lambda x: x < total_revenue)) AS revenue_decile, * FROM st)
SELECT CAST(revenue_decile AS INT) AS revenue_decile, count(*) AS n_customers,
       CAST(sum(CAST(total_revenue AS DECIMAL(18,4))) AS DOUBLE) AS total_revenue, round(avg(txn_count), 6) AS avg_txn_count,
       round_even(CAST(sum(CAST(total_revenue AS DECIMAL(18,4))) AS DOUBLE)
                  / (SELECT CAST(sum(CAST(total_revenue AS DECIMAL(18,4))) AS DOUBLE) FROM st) * 100, 2) AS revenue_share_pct
FROM d GROUP BY 1""",
    "pos",
)
def revenue_deciles(t: Tables) -> DataFrame:
    out = pf.revenue_deciles(pf.customer_stats(t.customer_sales()))
    return out.withColumn("avg_txn_count", F.round("avg_txn_count", 6))


@query(
    "top20_revenue_share",
    STATS_SQL
    + """, c AS (SELECT quantile_cont(total_revenue, 0.8) AS cut FROM st)
SELECT round((SELECT cut FROM c), 6) AS threshold, count(*) FILTER (WHERE total_revenue >= (SELECT cut FROM c)) AS n_top,
       round(CAST(sum(CAST(total_revenue AS DECIMAL(18,4))) FILTER (WHERE total_revenue >= (SELECT cut FROM c)) AS DOUBLE)
       / CAST(sum(CAST(total_revenue AS DECIMAL(18,4))) AS DOUBLE) * 100, 6) AS share_pct
FROM st""",
    "pos",
)
def top20_revenue_share(t: Tables) -> DataFrame:
    out = pf.top_share(pf.customer_stats(t.customer_sales()))
    return out.withColumns({"threshold": F.round("threshold", 6), "share_pct": F.round("share_pct", 6)})


LONG_SQL = "lg AS (" + " UNION ALL ".join(f"SELECT '{c}' AS col, {c} AS v FROM lineitem" for c in NUMBERS) + ")"


@query(
    "iqr_outliers",
    f"""
WITH {LONG_SQL},
q AS (SELECT col, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM lg GROUP BY 1),
b AS (SELECT col, q1 - 1.5::DOUBLE * (q3 - q1) AS lower, q3 + 1.5::DOUBLE * (q3 - q1) AS upper FROM q)
SELECT lg.col AS "column", round(lower, 6) AS lower, round(upper, 6) AS upper,
       count(*) FILTER (WHERE v < lower OR v > upper) AS n_outliers,
       round_even(count(*) FILTER (WHERE v < lower OR v > upper)::DOUBLE / count(*) * 100, 2) AS outlier_pct
FROM lg JOIN b USING (col) GROUP BY 1, 2, 3""",
)
def iqr_outliers(t: Tables) -> DataFrame:
    out = pf.iqr_outliers(t.lineitem, NUMBERS)
    return out.withColumns({"lower": F.round("lower", 6), "upper": F.round("upper", 6)})


ALL_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *NUMBERS]
ALL_OTHERS = ["l_returnflag", "l_linestatus", "l_shipdate"]
#: The given tables have no nulls, so some cells of three columns are blanked by rule.
BLANKED = {"l_tax": "l_linenumber <> 3", "l_returnflag": "l_returnflag <> 'N' OR l_quantity > 2", "l_shipdate": "l_linenumber <> 5"}


@query(
    "missing_rate",
    "WITH h AS (SELECT " + ", ".join(f"CASE WHEN {BLANKED.get(c, 'true')} THEN {c} END AS {c}" for c in [*ALL_NUMBERS, *ALL_OTHERS]) + " FROM lineitem)\n"
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(avg(({c} IS NULL)::INT), 6) AS missing_rate, avg(({c} IS NULL)::INT) > 0.05 AS flagged FROM h"""
        for c in [*ALL_NUMBERS, *ALL_OTHERS]
    ),
)
def missing_rate(t: Tables) -> DataFrame:
    holes = t.lineitem.select(*[F.when(F.expr(BLANKED[c]), F.col(c)).alias(c) if c in BLANKED else F.col(c) for c in t.lineitem.columns])
    return pf.missing_rate(holes).withColumn("missing_rate", F.round("missing_rate", 6))


@query(
    "duplicate_rows",
    """
SELECT CAST(sum(c) AS BIGINT) AS n_rows, CAST(sum(c - 1) AS BIGINT) AS n_duplicates
FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)""",
)
def duplicate_rows(t: Tables) -> DataFrame:
    return pf.duplicate_rows(t.lineitem)


@query(
    "profile_summary",
    """
WITH d AS (SELECT side, l_quantity, l_discount, CASE WHEN l_tax > 0.0 THEN l_tax END AS l_tax, l_extendedprice, price_shifted FROM drift_features),
c AS (SELECT corr(l_quantity, l_discount) AS r FROM d UNION ALL SELECT corr(l_quantity, l_tax) FROM d
      UNION ALL SELECT corr(l_quantity, l_extendedprice) FROM d UNION ALL SELECT corr(l_quantity, price_shifted) FROM d
      UNION ALL SELECT corr(l_discount, l_tax) FROM d UNION ALL SELECT corr(l_discount, l_extendedprice) FROM d
      UNION ALL SELECT corr(l_discount, price_shifted) FROM d UNION ALL SELECT corr(l_tax, l_extendedprice) FROM d
      UNION ALL SELECT corr(l_tax, price_shifted) FROM d UNION ALL SELECT corr(l_extendedprice, price_shifted) FROM d)
SELECT count(*) AS n_rows, 6 AS n_columns, round_even(count(*) FILTER (WHERE l_tax IS NULL) * 100 / (count(*) * 6)::DOUBLE, 4) AS missing_cells_pct,
       round_even((count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM d))) * 100 / count(*)::DOUBLE, 4) AS duplicate_rows_pct,
       (SELECT count(*) FROM c WHERE abs(r) > 0.95 AND abs(r) < 1.0) AS n_high_correlations
FROM d""",
    "drift_features",
)
def profile_summary(t: Tables) -> DataFrame:
    holes = t.drift_features().withColumn("l_tax", F.when(F.col("l_tax") > 0, F.col("l_tax")))
    return pf.profile_summary(holes)


@query(
    "high_correlations",
    """
SELECT 'l_extendedprice' AS col_a, 'price_shifted' AS col_b, round(corr(l_extendedprice, price_shifted), 6) AS corr
FROM drift_features HAVING abs(corr(l_extendedprice, price_shifted)) > 0.95""",
    "drift_features",
)
def high_correlations(t: Tables) -> DataFrame:
    df = t.drift_features()
    out = pf.high_correlations(df, pf.numeric_columns(df))
    return out.withColumn("corr", F.round("corr", 6))


DESCRIBE_SQL = "WITH lg AS (" + " UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS v FROM lineitem" for c in ALL_NUMBERS) + "), tx AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS col, " + (f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if c == "l_shipdate" else c) + " AS v, count(*) AS n FROM lineitem GROUP BY 2" for c in ALL_OTHERS
) + """)
SELECT col AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique", (list(v ORDER BY n DESC, v))[1] AS top,
       CAST(max(n) AS BIGINT) AS freq, NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS q25,
       NULL::DOUBLE AS q50, NULL::DOUBLE AS q75, NULL::DOUBLE AS max
FROM tx GROUP BY 1
UNION ALL
SELECT col, count(v), NULL, NULL, NULL, round(avg(v), 6), round(stddev_samp(v), 4), min(v), round(quantile_cont(v, 0.25), 6),
       round(quantile_cont(v, 0.5), 6), round(quantile_cont(v, 0.75), 6), max(v)
FROM lg GROUP BY 1"""


@query("describe_all", DESCRIBE_SQL)
def describe_all(t: Tables) -> DataFrame:
    """All columns of the sales lines."""
    places = {"mean": 6, "std": 4, "q25": 6, "q50": 6, "q75": 6}
    return pf.describe_all(t.lineitem).withColumns({c: F.round(c, n) for c, n in places.items()})


CORR_COLUMNS = NUMBERS + ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query(
    "corr_matrix_top_var",
    " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
        for a in CORR_COLUMNS for b in CORR_COLUMNS if a != b
    ),
)
def corr_matrix_top_var(t: Tables) -> DataFrame:
    return pf.corr_matrix_top_variance(t.lineitem).withColumn("corr", F.round("corr", 6))


@query(
    "histogram_fixed_bins",
    """
WITH b AS (SELECT min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 60 AS w FROM lineitem),
h AS (SELECT least(floor((l_extendedprice - (SELECT lo FROM b)) / (SELECT w FROM b)), 59)::INT AS bin, count(*) AS n FROM lineitem GROUP BY 1)
SELECT CAST(g AS INT) AS bin, round((SELECT lo FROM b) + g * (SELECT w FROM b), 6) AS left_edge, coalesce(n, 0) AS n
FROM range(60) r(g) LEFT JOIN h ON bin = g""",
)
def histogram_fixed_bins(t: Tables) -> DataFrame:
    return pf.histogram(t.lineitem, "l_extendedprice").withColumn("left_edge", F.round("left_edge", 6))
