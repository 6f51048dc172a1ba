"""Source and sink queries: the given tables are landed as files, read back, and published."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.operators import features as ft
from shelfline.plans.registry import query
from shelfline.plans.views import SNAPSHOT, Tables, customer_line_columns
from shelfline.session import scratch_path
from shelfline.sources import bronze, readers, schemas, writers


def as_landed(sales: DataFrame, *more: str) -> DataFrame:
    return sales.select(
        "transaction_id", "customer_id", "product_id", "store_id", F.col("ts").alias("timestamp"), "quantity",
        "unit_price", F.col("total_amount").cast("double").alias("total_amount"), "return_flag", *more,
    )


def landed_pos(t: Tables) -> DataFrame:
    """Sales as a source system would deliver them."""
    return as_landed(t.customer_sales())


def landed_from_lines(lines: DataFrame) -> DataFrame:
    """As :func:`landed_pos`, from plain lines that are already brought together by month."""
    return as_landed(lines.select(*customer_line_columns(), "year", "month"), "year", "month")


def land_csv(t: Tables, df: DataFrame, name: str) -> str:
    """A delivered feed: CSV files with a header, compressed."""
    path = scratch_path(t.spark, name)
    df.write.option("header", True).option("compression", "gzip").csv(path)
    return path


POS_SUMMARY = """SELECT store_id, count(*) AS n, CAST(sum({q}) AS BIGINT) AS quantity, count({q}) AS n_quantity,
       CAST(sum(total_amount) AS DOUBLE) AS revenue, min(ts) AS first_sale, count(*) FILTER (WHERE return_flag) AS n_returned
FROM pos GROUP BY 1"""


def pos_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity"), F.count("quantity").alias("n_quantity"),
        F.sum(F.col("total_amount").cast("decimal(18,4)")).cast("double").alias("revenue"),
        F.min("timestamp").alias("first_sale"), F.count_if("return_flag").alias("n_returned"),
    )


@query("scan_csv_typed", POS_SUMMARY.format(q="CASE WHEN quantity <> 13 THEN quantity END"), "pos")
def scan_csv_typed(t: Tables) -> DataFrame:
    """Some quantities are written as text that does not parse: they read as null."""
    text = F.when(F.col("quantity") == 13, "thirteen").otherwise(F.col("quantity").cast("string"))
    path = land_csv(t, landed_pos(t).withColumn("quantity", text), "pos-csv")
    return pos_summary(readers.read_csv(t.spark, path, schemas.POS))


@query(
    "scan_parquet",
    "SELECT o_orderpriority, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS total FROM orders GROUP BY 1",
)
def scan_parquet(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,4)")).cast("double").alias("total")
    )


@query(
    "scan_by_suffix",
    """SELECT f AS format, s.s_nationkey, count(*) AS n, round(sum(s_acctbal), 2) AS balance
FROM supplier s, (VALUES ('csv'), ('parquet'), ('tsv')) v(f) GROUP BY ALL""",
)
def scan_by_suffix(t: Tables) -> DataFrame:
    """The supplier table as CSV, TSV and Parquet, read back by suffix."""
    base, out = scratch_path(t.spark, "suffix"), None
    for suffix in ("csv", "tsv", "parquet"):
        path = f"{base}.{suffix}"
        if suffix == "parquet":
            t.supplier.write.parquet(path)
        else:
            t.supplier.write.option("header", True).option("sep", "\t" if suffix == "tsv" else ",").csv(path)
        part = readers.read_by_suffix(t.spark, path, t.supplier.schema).groupBy(F.lit(suffix).alias("format"), "s_nationkey").agg(
            F.count(F.lit(1)).alias("n"), F.round(F.sum("s_acctbal"), 2).alias("balance")
        )
        out = part if out is None else out.unionByName(part)
    return out


def published_pos(t: Tables) -> str:
    path = scratch_path(t.spark, "table")
    writers.append_by_month(t.customer_lines(), path, "l_shipdate", landed_from_lines)
    return path


@query(
    "append_partitioned_ym",
    "SELECT CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, count(*) AS n, CAST(sum(total_amount) AS DOUBLE) AS revenue FROM pos GROUP BY 1, 2",
    "pos",
)
def append_partitioned_ym(t: Tables) -> DataFrame:
    table = readers.read_table(t.spark, published_pos(t))
    return table.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("total_amount").cast("decimal(18,4)")).cast("double").alias("revenue")
    )


@query(
    "scan_bronze_table",
    "SELECT store_id, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS quantity FROM pos GROUP BY 1",
    "pos",
)
def scan_bronze_table(t: Tables) -> DataFrame:
    """A whole published table."""
    rows = readers.read_table(t.spark, published_pos(t))
    return rows.groupBy("store_id").agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity"))


@query(
    "scan_bronze_range",
    "SELECT store_id, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS quantity FROM pos WHERE ts >= TIMESTAMP '1997-03-10' AND ts < TIMESTAMP '1997-06-02' GROUP BY 1",
    "pos",
)
def scan_bronze_range(t: Tables) -> DataFrame:
    """A time range of a published table: only its months are read."""
    rows = readers.read_between(t.spark, published_pos(t), "timestamp", "1997-03-10", "1997-06-02")
    return rows.groupBy("store_id").agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity"))


@query(
    "append_partitioned_date",
    "SELECT CAST(snapshot_date AS DATE) + CAST(CAST(product_id AS INT) % 3 AS INT) AS snapshot_date, count(*) AS n, CAST(sum(stock_quantity) AS BIGINT) AS stock FROM erp GROUP BY 1",
    "erp",
)
def append_partitioned_date(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "erp")
    dated = F.date_add("snapshot_date", (F.col("product_id").cast("long") % 3).cast("int"))
    writers.append_by_column(t.erp().withColumn("snapshot_date", dated), path, "snapshot_date")
    return readers.read_table(t.spark, path).groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("stock_quantity").alias("stock")
    )


@query(
    "schema_evolution_append",
    """SELECT channel, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS quantity
FROM (SELECT NULL AS channel, quantity FROM pos WHERE ts < TIMESTAMP '1999-01-01' UNION ALL SELECT 'store-' || (CAST(store_id AS INT) % 4)::VARCHAR, quantity FROM pos WHERE ts >= TIMESTAMP '1999-01-01') GROUP BY 1""",
    "pos",
)
def schema_evolution_append(t: Tables) -> DataFrame:
    """The second append brings a new column; older rows read as null."""
    path, border = scratch_path(t.spark, "evolving"), F.lit("1999-01-01").cast("timestamp_ntz")
    lines, time = t.customer_lines(), F.col("l_shipdate")
    writers.append_by_month(lines.filter(time < border), path, "l_shipdate", landed_from_lines)
    channel = F.concat(F.lit("store-"), (F.col("store_id").cast("long") % 4).cast("string"))
    writers.append_by_month(lines.filter(time >= border), path, "l_shipdate", lambda d: landed_from_lines(d).withColumn("channel", channel))
    return readers.read_table(t.spark, path).groupBy("channel").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity")
    )


RFM_AT = """SELECT customer_id, DATE '{d}' AS snapshot_date, date_diff('day', max(date), DATE '{d}') AS recency_days, count(*) AS frequency,
       CAST(sum(total_amount) AS DOUBLE) AS monetary FROM pos WHERE date BETWEEN DATE '{d}' - 90 AND DATE '{d}' GROUP BY 1"""


@query(
    "merge_upsert_customer",
    f"""WITH a AS ({RFM_AT.format(d="2001-08-01")}), b AS ({RFM_AT.format(d=SNAPSHOT)}),
c AS (SELECT customer_id, snapshot_date, recency_days, frequency + 100 AS frequency, monetary FROM b WHERE CAST(customer_id AS INT) % 3 = 0)
SELECT * FROM a UNION ALL SELECT * FROM b WHERE CAST(customer_id AS INT) % 3 <> 0 UNION ALL SELECT * FROM c""",
    "pos",
)
def merge_upsert_customer(t: Tables) -> DataFrame:
    """Two snapshots are written, then a third of the second is corrected."""
    path, sales = scratch_path(t.spark, "customer-features"), t.customer_sales()
    columns = ["customer_id", "snapshot_date", "recency_days", "frequency", "monetary"]

    def at(day: str) -> DataFrame:
        rfm = ft.customer_rfm(sales, day, bounded=True)
        return rfm.withColumn("snapshot_date", F.lit(day).cast("date")).select(columns)

    writers.upsert_customer_features(at("2001-08-01"), path)
    writers.upsert_customer_features(at(SNAPSHOT), path)
    fixed = at(SNAPSHOT).filter(F.col("customer_id").cast("long") % 3 == 0)
    writers.upsert_customer_features(fixed.withColumn("frequency", F.col("frequency") + 100), path)
    return readers.read_table(t.spark, path).select(columns)


@query(
    "merge_upsert_sku",
    """SELECT product_id, date, CASE WHEN date >= DATE '2001-06-01' THEN quantity + 1000 ELSE quantity END AS quantity FROM daily_sales""",
    "daily_sales",
)
def merge_upsert_sku(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "sku-features")
    daily = t.daily_sales()
    late = F.col("date") >= F.lit("2001-06-01").cast("date")
    writers.upsert_sku_features(daily.filter(F.col("date") < F.lit("2001-09-01").cast("date")), path)
    writers.upsert_sku_features(daily.filter(late).withColumn("quantity", F.col("quantity") + 1000), path)
    return readers.read_table(t.spark, path).select("product_id", "date", "quantity")


def landed_files(t: Tables) -> dict[str, str]:
    """All four feeds as CSV; the ERP feed has rows without a store."""
    store = F.when(F.col("product_id").cast("long") % 50 != 0, F.col("store_id"))
    erp = t.erp().select("product_id", store.alias("store_id"), "snapshot_date", "stock_quantity", "reorder_point", "lead_time_days", "supplier_id")
    web = t.ecommerce().select(
        "event_id", F.concat(F.lit("s"), "customer_id").alias("session_id"), "customer_id", "product_id", "event_type",
        F.col("ts").alias("timestamp"), F.lit("mobile").alias("device_type"),
    )
    return {
        "pos": land_csv(t, landed_pos(t), "land-pos"),
        "ecommerce": land_csv(t, web, "land-web"),
        "erp": land_csv(t, erp, "land-erp"),
        "external": scratch_path(t.spark, "never-landed"),
    }


INGEST_SQL = """
SELECT 'pos' AS source, 'SUCCESS' AS status, count(*) AS row_count FROM pos UNION ALL SELECT 'ecommerce', 'SUCCESS', count(*) FROM events
UNION ALL SELECT 'erp', 'FAILED', NULL UNION ALL SELECT 'external', 'SKIPPED', NULL"""


@query("ingest_all", INGEST_SQL, "pos")
def ingest_all(t: Tables) -> DataFrame:
    """One feed fails its key gate, one never arrived; the others are published."""
    out = bronze.ingest_all(t.spark, landed_files(t), scratch_path(t.spark, "bronze"), scratch_path(t.spark, "audit"))
    return out.withColumn("status", F.regexp_extract("status", "^[A-Z]+", 0))


@query(
    "run_audit_row",
    """SELECT 'ingest_pos' AS job, 'COMPLETE' AS event, count(*) AS row_count, 9 AS feature_count FROM pos
UNION ALL SELECT 'ingest_pos', 'START', NULL, 0 UNION ALL SELECT 'ingest_ecommerce', 'COMPLETE', count(*), 7 FROM events
UNION ALL SELECT 'ingest_ecommerce', 'START', NULL, 0 UNION ALL SELECT 'ingest_erp', 'FAIL', NULL, 0 UNION ALL SELECT 'ingest_erp', 'START', NULL, 0""",
    "pos",
)
def run_audit_row(t: Tables) -> DataFrame:
    audit = scratch_path(t.spark, "audit")
    bronze.ingest_all(t.spark, landed_files(t), scratch_path(t.spark, "bronze"), audit)
    return t.spark.read.parquet(audit).select("job", "event", "row_count", "feature_count")


@query(
    "export_csv",
    """SELECT customer_id, round(churn_proba, 4) AS churn_proba, persona, count(*) OVER () AS n_exported FROM churn_scores WHERE churn_proba >= 0.8""",
    "churn_scores",
)
def export_csv(t: Tables) -> DataFrame:
    """High-risk customers exported and read back through the marked header."""
    path = scratch_path(t.spark, "export-csv")
    high = t.churn_scores().filter("churn_proba >= 0.8").select("customer_id", "churn_proba", "persona")
    writers.export_csv(high, path)
    schema = "customer_id string, churn_proba double, persona string"
    back = t.spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)
    return back.withColumn("n_exported", back.agg(F.count(F.lit(1))).scalar())


@query(
    "export_parquet",
    "SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 6) AS mean_balance FROM customer GROUP BY 1",
)
def export_parquet(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "export-parquet")
    writers.export_parquet(t.customer, path)
    return t.spark.read.parquet(path).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("c_acctbal"), 6).alias("mean_balance")
    )


@query("export_json", "SELECT product_id, date, quantity FROM daily_sales", "daily_sales")
def export_json(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "export-json")
    writers.export_json(t.daily_sales(), path)
    return t.spark.read.schema("product_id string, date date, quantity double").json(path)


@query(
    "load_keyed_json",
    """WITH b AS (SELECT p_brand, sum(p_size) AS s, count(*) AS n FROM part GROUP BY 1)
SELECT p_brand AS product_id, round(s / n::DOUBLE / 50, 6) AS seasonal_strength, CASE WHEN s / n::DOUBLE > 25 THEN 'high' ELSE 'low' END AS category FROM b WHERE s / n::DOUBLE > 25""",
)
def load_keyed_json(t: Tables) -> DataFrame:
    """One JSON map per part type (SKU to class), written, parsed and filtered to the high class."""
    mean = F.sum("p_size") / F.count(F.lit(1))
    classes = t.part.groupBy("p_brand").agg(mean.alias("m"))
    entry = F.struct((F.col("m") / 50).alias("seasonal_strength"), F.when(F.col("m") > 25, "high").otherwise("low").alias("category"))
    documents = classes.select(F.to_json(F.create_map("p_brand", entry)).alias("body"))
    path = scratch_path(t.spark, "keyed-json")
    documents.write.text(path)
    parsed = readers.keyed_json(t.spark.read.text(path), "value", "struct<seasonal_strength:double,category:string>")
    return parsed.filter("category = 'high'").select(
        F.col("key").alias("product_id"), F.round("seasonal_strength", 6).alias("seasonal_strength"), "category"
    )


def cpi_days(t: Tables) -> DataFrame:
    """Index values dated on month starts of 1999."""
    return t.cpi().withColumn("date", F.make_date(F.lit(1999), "month", F.lit(1)))


@query(
    "cpi_filter",
    """SELECT make_date(1999, month, 1) AS date, category, cpi_index, cpi_mom_change FROM cpi
WHERE category IN ('ECONOMY', 'PROMO') AND make_date(1999, month, 1) BETWEEN DATE '1999-03-01' AND DATE '1999-09-01'""",
    "cpi",
)
def cpi_filter(t: Tables) -> DataFrame:
    path = land_csv(t, cpi_days(t).select("date", "category", "cpi_index", "cpi_mom_change"), "cpi")
    table = readers.read_csv(t.spark, path, "date date, category string, cpi_index double, cpi_mom_change double")
    return readers.cpi_filter(table, ["ECONOMY", "PROMO"], "1999-03-01", "1999-09-01")


@query(
    "cpi_stub_spine",
    """SELECT CAST(d AS DATE) AS date, category, 100.0::DOUBLE AS cpi_index, 0.0::DOUBLE AS cpi_mom_change
FROM (SELECT DISTINCT p_type AS category FROM part), generate_series(DATE '1999-02-01', DATE '2000-01-31', INTERVAL 1 MONTH) g(d)""",
)
def cpi_stub_spine(t: Tables) -> DataFrame:
    categories = t.part.select(F.col("p_type").alias("category")).distinct()
    return readers.cpi_stub(categories, "1999-01-15", "2000-01-31")


@query(
    "weather_normalise",
    """WITH s AS (SELECT store_id, date, temp_c, rain_mm FROM weather WHERE date BETWEEN DATE '2001-10-01' AND DATE '2001-10-31'),
k AS (SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS store_id FROM supplier)
SELECT store_id, date, temp_c, CASE WHEN CAST(store_id AS INT) % 5 <> 1 THEN rain_mm END AS rain_mm FROM s WHERE CAST(store_id AS INT) % 5 <> 0
UNION ALL
SELECT store_id, CAST(d AS DATE), NULL, NULL FROM k, generate_series(DATE '2001-10-01', DATE '2001-10-31', INTERVAL 1 DAY) g(d)
WHERE CAST(store_id AS INT) % 5 = 0 OR store_id NOT IN (SELECT store_id FROM s)""",
    "weather",
)
def weather_normalise(t: Tables) -> DataFrame:
    """One landed document per store and month; some stores failed, some lack the rain array."""
    first, last = "2001-10-01", "2001-10-31"
    month = t.weather().filter(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    days = F.array_sort(F.collect_list(F.struct("date", "temp_c", "rain_mm")))  # at most 31 days
    store = F.col("store_id").cast("long")
    grouped = month.groupBy("store_id").agg(days.alias("d"))
    body = F.to_json(
        F.struct(
            F.struct(
                F.transform("d", lambda x: F.date_format(x["date"], "yyyy-MM-dd")).alias("time"),
                F.transform("d", lambda x: x["temp_c"]).alias("temperature_2m_mean"),
                F.when(store % 5 != 1, F.transform("d", lambda x: x["rain_mm"])).alias("precipitation_sum"),
            ).alias("daily")
        )
    )
    documents = grouped.select("store_id", F.when(store % 5 == 0, F.lit('{"error": true}')).otherwise(body).alias("body"))
    stores = t.supplier.select(F.col("s_suppkey").cast("string").alias("store_id"))
    return readers.weather_rows(documents, stores, first, last)


@query(
    "epoch_ms_events",
    """SELECT event_id, date_trunc('milliseconds', ts) AS "timestamp",
       CASE event_type WHEN 'purchase' THEN 'transaction' WHEN 'click' THEN 'addtocart' ELSE event_type END AS event FROM events""",
)
def epoch_ms_events(t: Tables) -> DataFrame:
    raw = t.events.select(
        "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.when(F.col("event_type") == "purchase", "transaction").when(F.col("event_type") == "click", "addtocart").otherwise(F.col("event_type")).alias("event"),
    )
    return readers.epoch_ms_events(raw)


@query(
    "unpivot_wide_sales",
    """SELECT p_type, DATE '2011-01-29' + CAST(d AS INT) - 1 AS date, coalesce(n, 0) AS units FROM (SELECT DISTINCT p_type FROM part), range(1, 32) r(d)
LEFT JOIN (SELECT p_type AS t, day(l_shipdate) AS dd, CAST(sum(l_quantity) AS BIGINT) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2) ON t = p_type AND dd = d""",
)
def unpivot_wide_sales(t: Tables) -> DataFrame:
    """Sales per day of month as a wide file with columns d_1 … d_31, read as rows."""
    day = F.dayofmonth("date")
    sales = t.category_sales().groupBy(F.col("category").alias("p_type")).agg(
        *[F.coalesce(F.sum(F.when(day == d, F.col("quantity"))), F.lit(0)).alias(f"d_{d}") for d in range(1, 32)]
    )
    return readers.unpivot_wide_sales(sales, ["p_type"])


@query(
    "clean_invoice_sales",
    """WITH a AS (SELECT CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || l_orderkey::VARCHAR AS "Invoice", l_quantity - 5 AS "Quantity", l_extendedprice / l_quantity AS "UnitPrice", l_suppkey AS "CustomerID" FROM lineitem)
SELECT "CustomerID"::VARCHAR AS "CustomerID", starts_with("Invoice", 'C') AS is_cancellation, count(*) AS n, CAST(sum("Quantity") AS BIGINT) AS quantity FROM a WHERE "Quantity" > 0 AND "UnitPrice" > 0 GROUP BY 1, 2""",
)
def clean_invoice_sales(t: Tables) -> DataFrame:
    """Two sheets of invoice lines; customer ids arrive as decimals such as 17.0."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    lines = t.lineitem.select(
        F.concat(F.when(F.col("l_returnflag") == "R", "C").otherwise(""), F.col("l_orderkey").cast("string")).alias("Invoice"),
        (F.col("l_quantity") - 5).alias("Quantity"), price.alias("UnitPrice"), F.col("l_suppkey").cast("double").alias("CustomerID"), "l_shipdate",
    )
    border = F.lit("1998-06-01").cast("timestamp_ntz")
    sheets = [lines.filter(c).drop("l_shipdate") for c in (F.col("l_shipdate") < border, F.col("l_shipdate") >= border)]
    return readers.clean_invoice_sales(*sheets).groupBy("CustomerID", "is_cancellation").agg(
        F.count(F.lit(1)).alias("n"), F.sum("Quantity").cast("long").alias("quantity")
    )


@query(
    "sample_fraction",
    """WITH s AS (SELECT l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR AS transaction_id, l_orderkey AS order_key, l_partkey AS part_key, l_partkey::VARCHAR AS product_id,
  l_suppkey::VARCHAR AS store_id, l_shipdate AS ts, CAST(l_shipdate AS DATE) AS date, CAST(l_quantity AS INT) AS quantity, l_extendedprice / l_quantity AS unit_price,
  CAST(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4)) AS DOUBLE) AS total_amount, l_returnflag = 'R' AS return_flag FROM lineitem)
SELECT * FROM s QUALIFY row_number() OVER (ORDER BY md5('42:' || transaction_id)[:13], transaction_id) <= round(0.1::DOUBLE * count(*) OVER ())""",
)
def sample_fraction(t: Tables) -> DataFrame:
    drawn = readers.sample_fraction(t.lines(), ["transaction_id"])
    return drawn.withColumn("total_amount", F.col("total_amount").cast("double"))


@query("sample_rows", "SELECT * FROM events ORDER BY md5(event_id::VARCHAR), event_id LIMIT 500")
def sample_rows(t: Tables) -> DataFrame:
    return readers.sample_rows(t.events, 500, "event_id")
