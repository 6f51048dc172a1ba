"""Declared schemas of the four landed sources."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DateType, DoubleType, IntegerType, StringType, StructField, StructType, TimestampNTZType

# Names and types of the columns of the landed files, and whether they may be null.
POS = StructType([
    StructField("transaction_id", StringType(), False),
    StructField("customer_id", StringType(), False),
    StructField("product_id", StringType(), False),
    StructField("store_id", StringType(), False),
    StructField("timestamp", TimestampNTZType(), False),
    StructField("quantity", IntegerType(), False),
    StructField("unit_price", DoubleType(), False),
    StructField("total_amount", DoubleType(), False),
    StructField("return_flag", BooleanType(), False),
])
ECOMMERCE = StructType([
    StructField("event_id", StringType(), False),
    StructField("session_id", StringType(), True),
    StructField("customer_id", StringType(), True),
    StructField("product_id", StringType(), False),
    StructField("event_type", StringType(), False),
    StructField("timestamp", TimestampNTZType(), False),
    StructField("device_type", StringType(), True),
])
ERP = StructType([
    StructField("product_id", StringType(), False),
    StructField("store_id", StringType(), False),
    StructField("snapshot_date", DateType(), False),
    StructField("stock_quantity", IntegerType(), False),
    StructField("reorder_point", IntegerType(), True),
    StructField("lead_time_days", IntegerType(), True),
    StructField("supplier_id", StringType(), True),
])
EXTERNAL = StructType([
    StructField("date", DateType(), False),
    StructField("weather_temp_c", DoubleType(), True),
    StructField("weather_rain_mm", DoubleType(), True),
    StructField("cpi_index", DoubleType(), True),
    StructField("competitor_sku_id", StringType(), True),
    StructField("competitor_price", DoubleType(), True),
])
