"""Retail views over the given tables: once as DataFrames, once as SQL for the checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

SNAPSHOT = "2001-11-04"
PERSONAS = ["Champion", "Loyal", "Potential Loyalist", "At-Risk VIP", "New", "Lost"]


def transaction_id() -> Column:
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("transaction_id")


def total_amount() -> Column:
    return (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)").alias("total_amount")


def line_columns() -> list[Column]:
    """The columns of a sales line, from those of lineitem."""
    return [
        transaction_id(),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("store_id"),
        F.col("l_shipdate").alias("ts"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        total_amount(),
        (F.col("l_returnflag") == "R").alias("return_flag"),
    ]


def customer_line_columns() -> list[Column]:
    """The columns of a sales line and its customer, from those of :meth:`Tables.customer_lines`."""
    return [*line_columns(), F.col("o_custkey").cast("string").alias("customer_id")]


class Tables:
    """Access to the given tables of one folder and the retail views on them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def lines(self) -> DataFrame:
        """Sales lines straight from lineitem: no join needed for SKU, store, time and money."""
        return self.lineitem.select(*line_columns())

    def customer_lines(self) -> DataFrame:
        """Lineitem as it is with the customer of its order: plain columns, for jobs that shuffle lines again."""
        orders = self.orders.select("o_orderkey", "o_custkey")
        return self.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    def customer_sales(self) -> DataFrame:
        """Sales lines with their customer: one join, for customer-level jobs. Columns are worked out behind the join, which moves plain ones."""
        return self.customer_lines().select(*customer_line_columns())

    def category_sales(self) -> DataFrame:
        """Sales lines with category and brand: one join, for SKU-level jobs."""
        return self.category_lines().select(*line_columns(), F.col("p_type").alias("category"), F.col("p_brand").alias("brand"))

    def category_lines(self) -> DataFrame:
        """Lineitem as it is with category and brand: plain columns, for jobs that shuffle lines again."""
        part = self.part.select("p_partkey", "p_type", "p_brand")
        return self.lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))

    def pos(self) -> DataFrame:
        part = self.part.select("p_partkey", F.col("p_type").alias("category"), F.col("p_brand").alias("brand"))
        return (
            self.customer_sales()
            .join(part, F.col("part_key") == F.col("p_partkey"))
            .select(
                "transaction_id", "customer_id", "product_id", "store_id", "ts", "quantity",
                "unit_price", "total_amount", "return_flag", "category", "brand",
            )
        )

    def daily_sales(self) -> DataFrame:
        """One row per brand and day, so a series is never longer than the calendar."""
        return (
            self._with_part("l_quantity", part=("p_brand",))
            .groupBy(F.col("p_brand").alias("product_id"), F.to_date("l_shipdate").alias("date"))
            .agg(F.sum("l_quantity").alias("quantity"))
        )

    def _with_part(self, *columns: str, part: tuple[str, ...]) -> DataFrame:
        """Lineitem with part attributes. One join; the aggregates behind it combine before they shuffle."""
        lines = self.lineitem.select("l_partkey", "l_shipdate", *columns)
        return lines.join(self.part.select("p_partkey", *part), F.col("l_partkey") == F.col("p_partkey"))

    def ecommerce(self) -> DataFrame:
        return self.events.select(
            F.col("event_id").cast("string").alias("event_id"),
            F.col("user_id").cast("string").alias("customer_id"),
            F.regexp_extract("props", "[0-9]+", 0).alias("product_id"),
            "event_type", "ts", "value",
        )

    def erp(self) -> DataFrame:
        key = F.col("p_partkey")
        sold = self.lineitem.groupBy("l_partkey").agg(
            F.sum("l_quantity").alias("total_units"), F.to_date(F.max("l_shipdate")).alias("last_sale")
        )
        return self.part.join(sold, key == F.col("l_partkey"), "left").select(
            key.cast("string").alias("product_id"),
            (key % 100).cast("string").alias("store_id"),
            F.to_date(F.lit(SNAPSHOT)).alias("snapshot_date"),
            ((key * 37) % 500).cast("int").alias("stock_quantity"),
            (F.col("p_size") * 5).alias("reorder_point"),
            (7 + key % 21).cast("int").alias("lead_time_days"),
            (key % 100).cast("string").alias("supplier_id"),
            F.col("p_retailprice").alias("unit_cost"),
            "total_units", "last_sale",
        )

    def weather(self) -> DataFrame:
        """One reading per store and day on which that store sold anything."""
        return self.store_weather().withColumn("store_id", F.col("store_id").cast("string"))

    def store_weather(self) -> DataFrame:
        """The readings with the plain key of the store."""
        days = self.lineitem.select(F.col("l_suppkey").alias("store_id"), F.to_date("l_shipdate").alias("date")).distinct()
        doy, store = F.dayofyear("date"), F.col("store_id")
        return days.select(
            "store_id",
            "date",
            ((doy * 7 + store * 3) % 50 - F.lit(5.0)).alias("temp_c"),
            ((doy * 13 + store * 5) % 70 * F.lit(1.0)).alias("rain_mm"),
        )

    def cpi(self) -> DataFrame:
        """One index value per category and calendar month seen in the sales."""
        seen = (
            self._with_part(part=("p_type",))
            .select(F.col("p_type").alias("category"), F.month("l_shipdate").alias("month"))
            .distinct()
        )
        m = F.col("month")
        return seen.select(
            "category", "month",
            (F.lit(100.0) + (m * 3 + F.length("category")) % 10).alias("cpi_index"),
            (((m * 7) % 5 - 2) / F.lit(10.0)).alias("cpi_mom_change"),
        )

    def churn_scores(self) -> DataFrame:
        key = F.col("c_custkey")
        persona = F.element_at(F.array(*[F.lit(p) for p in PERSONAS]), (key % 6 + 1).cast("int"))
        return self.customer.select(
            key.cast("string").alias("customer_id"),
            ((key * 7919 % 1000).cast("double") / 1000).alias("churn_proba"),
            F.when(key * 104729 % 1000 < key * 7919 % 1000, 1).otherwise(0).alias("target_churn"),
            persona.alias("persona"),
            F.col("c_acctbal").alias("monetary"),
            F.date_add(F.lit("2024-01-15").cast("date"), (key % 3).cast("int")).alias("scored_at"),
        )

    def lead_times(self) -> DataFrame:
        return self.lineitem.select(
            F.col("l_suppkey").cast("string").alias("supplier"),
            (1 + (F.col("l_orderkey") * 31 + F.col("l_linenumber")) % 28).cast("int").alias("lead_time_days"),
        )

    def drift_features(self) -> DataFrame:
        reference = F.col("l_shipdate") < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
        price = F.col("l_extendedprice")
        return self.lineitem.select(
            F.when(reference, "reference").otherwise("production").alias("side"),
            "l_quantity", "l_discount", "l_tax", "l_extendedprice",
            F.when(reference, price).otherwise(price * 1.3).alias("price_shifted"),
        )


SQL_VIEWS = {
    "pos": """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
       CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(l_suppkey AS VARCHAR) AS store_id, l_shipdate AS ts, CAST(l_shipdate AS DATE) AS date,
       CAST(l_quantity AS INT) AS quantity, l_extendedprice / l_quantity AS unit_price,
       CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS total_amount,
       l_returnflag = 'R' AS return_flag, p_type AS category, p_brand AS brand
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "daily_sales": """
SELECT p_brand AS product_id, CAST(l_shipdate AS DATE) AS date, SUM(l_quantity) AS quantity
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand, CAST(l_shipdate AS DATE)""",
    "ecommerce": """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS customer_id,
       regexp_extract(props, '[0-9]+', 0) AS product_id, event_type, ts, value
FROM events""",
    "erp": """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, CAST(p_partkey % 100 AS VARCHAR) AS store_id,
       CAST('2001-11-04' AS DATE) AS snapshot_date, CAST((p_partkey * 37) % 500 AS INT) AS stock_quantity,
       p_size * 5 AS reorder_point, CAST(7 + p_partkey % 21 AS INT) AS lead_time_days,
       CAST(p_partkey % 100 AS VARCHAR) AS supplier_id, p_retailprice AS unit_cost,
       d.units AS total_units, d.last_sale
FROM part LEFT JOIN (SELECT l_partkey, SUM(l_quantity) AS units, CAST(MAX(l_shipdate) AS DATE) AS last_sale
                     FROM lineitem GROUP BY l_partkey) d ON l_partkey = p_partkey""",
    "weather": """
SELECT CAST(s AS VARCHAR) AS store_id, d AS date,
       ((dayofyear(d) * 7 + s * 3) % 50) - 5.0::DOUBLE AS temp_c,
       ((dayofyear(d) * 13 + s * 5) % 70) * 1.0::DOUBLE AS rain_mm
FROM (SELECT DISTINCT l_suppkey AS s, CAST(l_shipdate AS DATE) AS d FROM lineitem)""",
    "cpi": """
SELECT category, month, 100.0::DOUBLE + (month * 3 + length(category)) % 10 AS cpi_index,
       ((month * 7) % 5 - 2) / 10.0::DOUBLE AS cpi_mom_change
FROM (SELECT DISTINCT p_type AS category, CAST(month(l_shipdate) AS INT) AS month
      FROM lineitem JOIN part ON l_partkey = p_partkey)""",
    "churn_scores": """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
       CAST((c_custkey * 7919) % 1000 AS DOUBLE) / 1000 AS churn_proba,
       CASE WHEN (c_custkey * 104729) % 1000 < (c_custkey * 7919) % 1000 THEN 1 ELSE 0 END AS target_churn,
       CASE c_custkey % 6 WHEN 0 THEN 'Champion' WHEN 1 THEN 'Loyal' WHEN 2 THEN 'Potential Loyalist'
            WHEN 3 THEN 'At-Risk VIP' WHEN 4 THEN 'New' ELSE 'Lost' END AS persona,
       c_acctbal AS monetary, CAST('2024-01-15' AS DATE) + CAST(c_custkey % 3 AS INT) AS scored_at
FROM customer""",
    "lead_times": """
SELECT CAST(l_suppkey AS VARCHAR) AS supplier,
       CAST(1 + (l_orderkey * 31 + l_linenumber) % 28 AS INT) AS lead_time_days
FROM lineitem""",
    "drift_features": """
SELECT CASE WHEN l_shipdate < TIMESTAMP '1998-01-01 00:00:00' THEN 'reference' ELSE 'production' END AS side,
       l_quantity, l_discount, l_tax, l_extendedprice,
       CASE WHEN l_shipdate < TIMESTAMP '1998-01-01 00:00:00' THEN l_extendedprice
            ELSE l_extendedprice * 1.3::DOUBLE END AS price_shifted
FROM lineitem""",
    # Customer features at the snapshot date, as the feature jobs compute them.
    "rfm": """
SELECT CAST(o_custkey AS VARCHAR) AS customer_id,
       date_diff('day', CAST(max(l_shipdate) AS DATE), DATE '2001-11-04') AS recency_days,
       count(*) AS frequency,
       sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS monetary
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE CAST(l_shipdate AS DATE) >= DATE '2001-11-04' - 90
GROUP BY 1""",
    "rfm_scored": """
SELECT customer_id, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary,
       CAST(monetary AS DOUBLE) / frequency AS avg_basket_size,
       (6 - ((recency_days - min(recency_days) OVER ()) / (max(recency_days) OVER () - min(recency_days) OVER () + 1e-9::DOUBLE) * 4 + 1)) * 0.30::DOUBLE
       + ((frequency - min(frequency) OVER ()) / (max(frequency) OVER () - min(frequency) OVER () + 1e-9::DOUBLE) * 4 + 1) * 0.35::DOUBLE
       + ((CAST(monetary AS DOUBLE) - CAST(min(monetary) OVER () AS DOUBLE)) / (CAST(max(monetary) OVER () AS DOUBLE) - CAST(min(monetary) OVER () AS DOUBLE) + 1e-9::DOUBLE) * 4 + 1) * 0.35::DOUBLE AS rfm_score
FROM rfm""",
}

SQL_VIEWS["sku_daily"] = """
SELECT CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_shipdate AS DATE) AS date, SUM(l_quantity) AS quantity
FROM lineitem GROUP BY 1, 2"""

SQL_VIEWS["demand_features"] = """
SELECT product_id, date, quantity,
       CASE WHEN count(quantity) OVER w7 >= 7 THEN avg(quantity) OVER w7 END AS rolling_mean_7d,
       CASE WHEN count(quantity) OVER w14 >= 14 THEN avg(quantity) OVER w14 END AS rolling_mean_14d,
       CASE WHEN count(quantity) OVER w30 >= 30 THEN avg(quantity) OVER w30 END AS rolling_mean_30d,
       CASE WHEN count(quantity) OVER w7 >= 7 THEN stddev_samp(quantity) OVER w7 END AS rolling_std_7d,
       CASE WHEN count(quantity) OVER w14 >= 14 THEN stddev_samp(quantity) OVER w14 END AS rolling_std_14d,
       lag(quantity, 1) OVER o AS lag_1d, lag(quantity, 7) OVER o AS lag_7d, lag(quantity, 14) OVER o AS lag_14d
FROM daily_sales
WINDOW o AS (PARTITION BY product_id ORDER BY date),
       w7 AS (PARTITION BY product_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
       w14 AS (PARTITION BY product_id ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW),
       w30 AS (PARTITION BY product_id ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"""

SQL_VIEWS["sku_demand_features"] = SQL_VIEWS["demand_features"].replace("daily_sales", "sku_daily")
