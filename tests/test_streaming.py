import datetime as dt

from pyspark.sql import functions as F

from shelfline.sources import readers
from shelfline.streaming import jobs

SCHEMA = "user_id string, event_type string, ts timestamp_ntz, value double"


def land(spark, path, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def stream(spark, path):
    return jobs.file_stream(spark, path, spark.createDataFrame([], SCHEMA).schema, 1)


def test_append_resumes_without_repeating(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    land(spark, source, [("a", "x", at(0), 1.0)])
    jobs.stream_append(stream(spark, source), out, state, "WEB")
    land(spark, source, [("b", "x", at(2000), 2.0)])
    jobs.stream_append(stream(spark, source), out, state, "WEB")
    got = spark.read.parquet(out)
    assert sorted(r["user_id"] for r in got.collect()) == ["a", "b"] and got.select("day").distinct().count() == 2


def test_upsert_keeps_the_newest_whatever_the_order(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    land(spark, source, [("a", "x", at(50), 5.0), ("b", "x", at(1), 1.0)])
    land(spark, source, [("a", "x", at(10), 9.0), ("c", "x", at(3), 3.0)])
    rows = stream(spark, source).withColumn("day", F.to_date("ts"))
    jobs.stream_upsert(rows, out, state, ["user_id", "day"], "day", [F.col("ts").desc()])
    assert sorted((r["user_id"], r["value"]) for r in readers.read_table(spark, out).collect()) == [("a", 5.0), ("b", 1.0), ("c", 3.0)]


def test_windows_close_with_the_watermark(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    land(spark, source, [("a", "x", at(5), 1.0), ("a", "x", at(30), 2.0), ("a", "y", at(59), 4.0)])
    land(spark, source, [("a", "x", at(80), 8.0)])
    jobs.stream_windows(stream(spark, source), out, state)
    assert sorted((r["event_type"], r["n"], float(r["total"])) for r in spark.read.parquet(out).collect()) == [("x", 2, 3.0), ("y", 1, 4.0)]


def test_sessions(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    land(spark, source, [("a", "x", at(0), 1.0), ("a", "x", at(29), 1.0), ("a", "x", at(60), 1.0), ("b", "x", at(500), 1.0)])
    jobs.stream_sessions(stream(spark, source), out, state, "user_id")
    assert sorted((r["user_id"], r["n"]) for r in spark.read.parquet(out).collect()) == [("a", 1), ("a", 2)]
