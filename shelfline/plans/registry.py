"""Registry of queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfline.plans.views import SQL_VIEWS, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, uses: str = ""):
    """Register a query; ``uses`` lists the shared views its SQL reads."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql:
            ORACLES[name] = with_views(sql, uses)
        return fn

    return wrap


def with_views(sql: str, uses: str) -> str:
    wanted = uses.split()
    if not wanted:
        return sql.strip()
    heads = ",\n".join(f"{v} AS ({SQL_VIEWS[v].strip()})" for v in wanted)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {heads},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {heads},\n{body[5:]}"
    return f"WITH {heads}\n{body}"
