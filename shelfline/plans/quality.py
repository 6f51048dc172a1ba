"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.operators import quality as dq
from shelfline.plans.registry import query
from shelfline.plans.views import Tables


def pos_checked(t: Tables) -> DataFrame:
    return t.customer_sales().withColumnRenamed("ts", "timestamp")


def pos_results(t: Tables) -> DataFrame:
    return dq.evaluate_rules(pos_checked(t), dq.POS_RULES)


def erp_results(t: Tables) -> DataFrame:
    return dq.evaluate_rules(t.erp(), dq.ERP_RULES)


def rule_sql(rule: dq.Rule, view: str) -> str:
    column = "ts" if rule.column == "timestamp" else rule.column
    checked, value = f"count({column})", column
    if rule.kind == "not_null":
        checked, failing = "count(*)", f"count(*) FILTER (WHERE {value} IS NULL)"
    elif rule.kind == "between":
        failing = f"count(*) FILTER (WHERE NOT ({value} BETWEEN {rule.low} AND {rule.high}))"
    elif rule.kind == "in_set":
        failing = f"count(*) FILTER (WHERE {value} NOT IN (true, false))"
    else:
        return (
            f"SELECT '{rule.name}' AS rule, CAST(sum(c) AS BIGINT) AS n_checked, "
            f"CAST(coalesce(sum(c) FILTER (WHERE c > 1), 0) AS BIGINT) AS n_failing, {rule.mostly}::DOUBLE AS mostly "
            f"FROM (SELECT count(*) AS c FROM {view} WHERE {value} IS NOT NULL GROUP BY {value})"
        )
    return f"SELECT '{rule.name}' AS rule, {checked} AS n_checked, {failing} AS n_failing, {rule.mostly}::DOUBLE AS mostly FROM {view}"


def suite_sql(rules: list[dq.Rule], view: str) -> str:
    union = " UNION ALL ".join(rule_sql(r, view) for r in rules)
    return f"""(SELECT rule, n_checked, n_failing, mostly, 1 - n_failing::DOUBLE / n_checked AS ratio,
       CASE WHEN starts_with(rule, 'not_null') THEN n_failing = 0 ELSE 1 - n_failing::DOUBLE / n_checked >= mostly END AS passed
FROM ({union}))"""


POS_SQL, ERP_SQL = suite_sql(dq.POS_RULES, "pos"), suite_sql(dq.ERP_RULES, "erp")
KINDS = {"dq_not_null": "not_null", "dq_between": "between", "dq_in_set": "in_set", "dq_unique": "unique"}
CHECK_COLUMNS = "suite, rule, n_checked, n_failing, round(ratio, 6) AS ratio, passed"


def register_kind(name: str, kind: str) -> None:
    pos = [r for r in dq.POS_RULES if r.kind == kind]
    erp = [r for r in dq.ERP_RULES if r.kind == kind]
    parts = [f"SELECT 'pos' AS suite, * FROM {suite_sql(pos, 'pos')}"]
    if erp:
        parts.append(f"SELECT 'erp' AS suite, * FROM {suite_sql(erp, 'erp')}")

    @query(name, f"SELECT {CHECK_COLUMNS} FROM ({' UNION ALL '.join(parts)})", "pos erp")
    def run(t: Tables) -> DataFrame:
        out = dq.evaluate_rules(pos_checked(t), pos).withColumn("suite", F.lit("pos"))
        if erp:
            out = out.unionByName(dq.evaluate_rules(t.erp(), erp).withColumn("suite", F.lit("erp")))
        return out.select("suite", "rule", "n_checked", "n_failing", F.round("ratio", 6).alias("ratio"), "passed")


for _name, _kind in KINDS.items():
    register_kind(_name, _kind)


SCORE_SQL = f"""
WITH r AS (SELECT 'pos' AS suite, passed FROM {POS_SQL} UNION ALL SELECT 'erp' AS suite, passed FROM {ERP_SQL}),
s AS (SELECT suite, count(*) AS n_rules, count(*) FILTER (WHERE passed) AS n_passed,
             count(*) FILTER (WHERE passed)::DOUBLE / count(*) AS score FROM r GROUP BY 1)
"""


def suite_scores(t: Tables) -> DataFrame:
    return dq.suite_score(pos_results(t), "pos").unionByName(dq.suite_score(erp_results(t), "erp"))


@query("dq_score", SCORE_SQL + "SELECT suite, n_rules, n_passed, score, score >= 0.98 AS meets_threshold FROM s", "pos erp")
def dq_score(t: Tables) -> DataFrame:
    return suite_scores(t)


@query(
    "dq_overall",
    SCORE_SQL + "SELECT avg(score) AS overall_score, avg(score) >= 0.98 AS meets_threshold FROM s",
    "pos erp",
)
def dq_overall(t: Tables) -> DataFrame:
    return dq.overall_score(suite_scores(t))


@query(
    "null_key_gate",
    """
SELECT 'pos' AS source, count(*) AS n_rows,
       count(*) FILTER (WHERE transaction_id IS NULL OR customer_id IS NULL OR product_id IS NULL) AS n_bad FROM pos
UNION ALL
SELECT 'erp', count(*), count(*) FILTER (WHERE product_id IS NULL OR store_id IS NULL OR snapshot_date IS NULL) FROM erp
UNION ALL
SELECT 'erp_sold', count(*), count(*) FILTER (WHERE last_sale IS NULL OR last_sale >= DATE '2001-11-01') FROM erp""",
    "pos erp",
)
def null_key_gate(t: Tables) -> DataFrame:
    """Rows with a missing key per source; the third row nulls keys on purpose."""
    holes = t.erp().withColumn("last_sale", F.when(F.col("last_sale") < F.lit("2001-11-01").cast("date"), F.col("last_sale")))
    sources = {
        "pos": (t.customer_sales(), ["transaction_id", "customer_id", "product_id"]),
        "erp": (t.erp(), ["product_id", "store_id", "snapshot_date"]),
        "erp_sold": (holes, ["last_sale"]),
    }
    parts = [
        dq.null_key_counts(df, keys).select(F.lit(name).alias("source"), "n_rows", "n_bad")
        for name, (df, keys) in sources.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
