"""Readers: typed files, lookups, and landed API documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline import files
from shelfline.functions.calendar import HOLIDAYS
from shelfline.operators.refine import fresh, smallest_rows
from shelfline.session import scratch_path
from shelfline.sources import commits


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """CSV with header and explicit schema: a cell that does not parse becomes null."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("sep", sep).csv(path)


def read_by_suffix(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Dispatch on .parquet, .tsv or .csv; anything else is read as CSV."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    reader = spark.read.option("header", True).option("sep", "\t" if path.rstrip("/").endswith(".tsv") else ",")
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table with commits, or a partitioned folder; columns added by later writes are null in older files.

    A plain folder has no schema of its own: a given one saves opening every file footer to merge theirs.
    """
    if commits.last_commit(spark, path) is not None:
        return commits.read(spark, path)
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)
    return reader.parquet(path)


def read_between(
    spark: SparkSession, path: str, time: str, start: str, end: str, schema: T.StructType | None = None
) -> DataFrame:
    """Rows of a year/month partitioned table with ``start <= time < end``; other months are not listed."""
    bounds = [F.lit(v).cast("timestamp_ntz") for v in (start, end)]
    month = F.col("year") * 12 + F.col("month")
    first, last = [F.year(b) * 12 + F.month(b) for b in bounds]
    inside = (F.col(time) >= bounds[0]) & (F.col(time) < bounds[1])
    return read_table(spark, path, schema).filter(month.between(first, last) & inside)


def scores_for_day(scores: DataFrame, day: str) -> DataFrame:
    """Scored customers of one day with the column names monitoring expects."""
    wanted = ["customer_id", "churn_proba", "target_churn", "scored_at", "monetary"]
    extra = [c for c in ("recency_days", "frequency", "rolling_mean_7d", "cpi_index", "temp_c") if c in scores.columns]
    return (
        scores.filter(F.to_date("scored_at") == F.lit(day).cast("date"))
        .select(*wanted, *extra)
        .withColumnsRenamed({"churn_proba": "prediction", "target_churn": "target"})
    )


def scores_over_jdbc(spark: SparkSession, url: str, table: str, day: str, slices: int = 24) -> DataFrame:
    """The same from a database: one predicate per slice of the day, read in parallel."""
    step = 86400 // slices
    at = [f"TIMESTAMP '{day} 00:00:00' + INTERVAL '{i * step}' SECOND" for i in range(slices + 1)]
    predicates = [f"scored_at >= {lo} AND scored_at < {hi}" for lo, hi in zip(at, at[1:])]
    return scores_for_day(spark.read.jdbc(url, table, predicates=predicates), day)


def write_holiday_file(spark: SparkSession) -> str:
    """The fixed calendar as a JSON array file, as a deployment would ship it."""
    path = scratch_path(spark, "holidays")
    spark.createDataFrame(HOLIDAYS, "date string, name string, type string").coalesce(1).write.json(path)
    return path


def load_holidays(spark: SparkSession, path: str) -> DataFrame:
    """JSON array (or lines) of {date, name, type}; a missing file is an empty calendar."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("date", "name", "type")])
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema).withColumn("date", F.to_date("date"))
    first = spark.read.text(path).limit(1).first()
    array = first is not None and first[0].lstrip().startswith("[")
    return spark.read.schema(schema).option("multiLine", array).json(path).withColumn("date", F.to_date("date"))


def keyed_json(documents: DataFrame, column: str, value_type: str) -> DataFrame:
    """Rows (key, value fields…) of JSON objects that map a key to a struct."""
    parsed = documents.select(F.from_json(column, f"map<string,{value_type}>").alias("m"))
    return parsed.select(F.explode("m").alias("key", "value")).select("key", "value.*")


def cpi_filter(cpi: DataFrame, categories: list[str], start: str, end: str) -> DataFrame:
    """Index rows of the named categories with ``start <= date <= end``."""
    inside = F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return cpi.filter(F.col("category").isin(categories) & inside).select(
        "date", "category", "cpi_index", "cpi_mom_change"
    )


def cpi_stub(categories: DataFrame, start: str, end: str) -> DataFrame:
    """Neutral index on every month start in [start, end] for each category."""
    first = F.trunc(F.lit(start).cast("date"), "month")
    months = F.sequence(first, F.lit(end).cast("date"), F.expr("INTERVAL 1 MONTH"))
    return (
        categories.select("category", F.explode(months).alias("date"))
        .filter(F.col("date") >= F.lit(start).cast("date"))
        .select("date", "category", F.lit(100.0).alias("cpi_index"), F.lit(0.0).alias("cpi_mom_change"))
    )


WEATHER_DOCUMENT = "struct<daily:struct<time:array<string>,temperature_2m_mean:array<double>,precipitation_sum:array<double>>>"


def weather_rows(documents: DataFrame, stores: DataFrame, start: str, end: str) -> DataFrame:
    """Landed weather documents (store_id, body) as one row per store and day.

    A document that lacks a value array gives nulls; a store without a usable document gets
    a null row for each day of [start, end].
    """
    parsed = documents.select("store_id", F.from_json("body", WEATHER_DOCUMENT)["daily"].alias("d")).filter(
        F.size("d.time") > 0
    )
    zipped = F.transform(
        F.sequence(F.lit(0), F.size("d.time") - 1),
        lambda i: F.struct(
            F.to_date(F.get(F.col("d.time"), i)).alias("date"),
            F.get(F.col("d.temperature_2m_mean"), i).alias("temp_c"),
            F.get(F.col("d.precipitation_sum"), i).alias("rain_mm"),
        ),
    )
    good = parsed.select("store_id", F.inline(zipped))
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    failed = stores.select("store_id").join(parsed.select("store_id"), "store_id", "left_anti")
    empty = failed.select("store_id", F.explode(days).alias("date"))
    return good.unionByName(empty, allowMissingColumns=True)


def epoch_ms_events(events: DataFrame, column: str = "timestamp") -> DataFrame:
    return events.withColumn(column, F.timestamp_millis(F.col(column)).cast("timestamp_ntz"))


def unpivot_wide_sales(wide: DataFrame, ids: list[str], first_day: str = "2011-01-29") -> DataFrame:
    """Wide day columns d_1, d_2, … to one row per id and date."""
    days = [c for c in wide.columns if c.startswith("d_")]
    long = wide.unpivot(ids, days, "day", "units")
    offset = F.substring_index("day", "_", -1).cast("int") - 1
    return long.select(*ids, F.date_add(F.lit(first_day).cast("date"), offset).alias("date"), "units")


def clean_invoice_sales(*sheets: DataFrame) -> DataFrame:
    """Union of invoice sheets: positive quantity and price, cancellations flagged, ids as text."""
    out = sheets[0]
    for sheet in sheets[1:]:
        out = out.unionByName(sheet)
    kept = out.filter((F.col("Quantity") > 0) & (F.col("UnitPrice") > 0))
    return kept.withColumns(
        {
            "is_cancellation": F.col("Invoice").startswith("C"),
            "CustomerID": F.col("CustomerID").cast("long").cast("string"),
        }
    )


def sample_fraction(df: DataFrame, keys: Sequence[str], fraction: float = 0.10, seed: int = 42) -> DataFrame:
    """An exact share of the rows, the same for every run: those with the smallest hash of seed and keys, then the smallest keys.

    Keys may repeat; where the share ends among rows of equal keys, the smallest of the other columns, as texts, decide.
    """
    names = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    # 13 hex digits are 52 bits, which a double holds exactly.
    digest = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *names)), 1, 13), 16, 10)
    drawn = fresh(df, "drawn")
    others = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in keys]), {"ignoreNullFields": "false"})
    marked = smallest_rows(df, digest, [*[F.col(k) for k in keys], others], lambda n: F.round(n * F.lit(fraction)), drawn)
    return marked.filter(drawn).drop(drawn)


def sample_rows(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """n rows, the same for every run: those with the smallest key hash."""
    digest = F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys]))
    return df.orderBy(digest, *keys).limit(n)
