import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shelfline import files
from shelfline.plans import sources as plans
from shelfline.plans.views import Tables
from shelfline.sources import bronze, commits, readers, schemas, writers

D, T = dt.date, dt.datetime
POS_HEADER = "transaction_id,customer_id,product_id,store_id,timestamp,quantity,unit_price,total_amount,return_flag\n"


def put(folder, name, text):
    path = folder / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_cells_that_do_not_parse_become_null(spark, tmp_path):
    path = put(tmp_path, "pos.csv", POS_HEADER + "t1,c,p,s,2024-01-05 10:00:00,two,1.5,3.0,true\nt2,c,p,s,2024-01-05 10:00:00,2,1.5,3.0,false\n")
    got = readers.read_csv(spark, path, schemas.POS).orderBy("transaction_id").collect()
    assert [r["quantity"] for r in got] == [None, 2] and got[0]["unit_price"] == 1.5
    assert got[1]["timestamp"] == T(2024, 1, 5, 10)


def test_suffix_dispatch(spark, tmp_path):
    tsv = put(tmp_path, "a.tsv", "a\tb\n1\tx,y\n")
    other = put(tmp_path, "a.dat", "a,b\n2,z\n")
    assert tuple(readers.read_by_suffix(spark, tsv).first()) == (1, "x,y")
    assert tuple(readers.read_by_suffix(spark, other).first()) == (2, "z")
    spark.range(3).write.parquet(str(tmp_path / "b.parquet"))
    assert readers.read_by_suffix(spark, str(tmp_path / "b.parquet")).count() == 3


def test_holidays_from_array_lines_and_missing_file(spark, tmp_path):
    rows = [{"date": "2024-01-01", "name": "a", "type": "x"}, {"date": "2024-12-25", "name": "b", "type": "y"}]
    array = put(tmp_path, "array.json", json.dumps(rows, indent=1))
    lines = put(tmp_path, "lines.json", "\n".join(json.dumps(r) for r in rows))
    for path in (array, lines):
        assert sorted(r["date"] for r in readers.load_holidays(spark, path).collect()) == [D(2024, 1, 1), D(2024, 12, 25)]
    assert readers.load_holidays(spark, str(tmp_path / "none.json")).count() == 0


def test_keyed_json(spark):
    df = spark.createDataFrame([('{"s1": {"category": "high"}, "s2": {"category": "low"}}',), ("not json",)], "body string")
    assert [tuple(r) for r in readers.keyed_json(df, "body", "struct<category:string>").filter("category = 'high'").collect()] == [("s1", "high")]


def test_cpi_stub_starts_on_month_starts(spark):
    cats = spark.createDataFrame([("a",)], "category string")
    got = [r["date"] for r in readers.cpi_stub(cats, "2024-01-15", "2024-03-01").orderBy("date").collect()]
    assert got == [D(2024, 2, 1), D(2024, 3, 1)]
    assert readers.cpi_stub(cats, "2024-01-01", "2024-01-20").count() == 1


def test_weather_documents(spark):
    good = json.dumps({"daily": {"time": ["2024-01-01", "2024-01-02"], "temperature_2m_mean": [1.0, 2.0]}})
    docs = spark.createDataFrame([("a", good), ("b", "broken"), ("c", '{"daily": {"time": []}}')], "store_id string, body string")
    stores = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "store_id string")
    got = readers.weather_rows(docs, stores, "2024-01-01", "2024-01-02").collect()
    assert len(got) == 8
    assert sorted((r["date"], r["temp_c"], r["rain_mm"]) for r in got if r["store_id"] == "a") == [(D(2024, 1, 1), 1.0, None), (D(2024, 1, 2), 2.0, None)]
    assert all(r["temp_c"] is None for r in got if r["store_id"] != "a")


def test_epoch_and_unpivot_and_invoices(spark):
    ms = spark.createDataFrame([(1433221332117,)], "timestamp long")
    assert readers.epoch_ms_events(ms).first()[0] == T(2015, 6, 2, 5, 2, 12, 117000)
    wide = spark.createDataFrame([("i", 3, 0, 7)], "id string, d_1 int, d_2 int, d_10 int")
    assert sorted((r["date"], r["units"]) for r in readers.unpivot_wide_sales(wide, ["id"]).collect()) == [
        (D(2011, 1, 29), 3), (D(2011, 1, 30), 0), (D(2011, 2, 7), 7)]
    sheet = "Invoice string, Quantity int, UnitPrice double, CustomerID double"
    a = spark.createDataFrame([("1", 2, 1.0, 17850.0), ("C2", 1, 1.0, None)], sheet)
    b = spark.createDataFrame([("3", -1, 1.0, 1.0), ("4", 1, 0.0, 1.0)], sheet)
    assert sorted((r["Invoice"], r["CustomerID"], r["is_cancellation"]) for r in readers.clean_invoice_sales(a, b).collect()) == [
        ("1", "17850", False), ("C2", None, True)]


def test_month_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(i, T(2023, 12, 1) + dt.timedelta(days=i)) for i in range(120)], "id int, timestamp timestamp_ntz")
    writers.append_by_month(df, path)
    got = readers.read_between(spark, path, "timestamp", "2023-12-31", "2024-02-02")
    assert sorted(r["id"] for r in got.collect()) == list(range(30, 63))
    assert "month" in got._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:200]


def upsert(spark, path, data):
    df = spark.createDataFrame(data, "customer_id string, snapshot_date date, monetary double")
    writers.upsert_customer_features(df, path)


def test_upsert_inserts_updates_and_is_idempotent(spark, tmp_path, rows):
    path = str(tmp_path / "silver")
    one, two = D(2024, 1, 1), D(2024, 1, 2)
    upsert(spark, path, [("a", one, 1.0), ("b", one, 2.0), ("a", two, 3.0)])
    change = [("a", one, 9.0), ("c", one, 4.0)]
    for _ in range(2):
        upsert(spark, path, change)
        got = rows(readers.read_table(spark, path), "customer_id", "snapshot_date", "monetary")
        assert got == [("a", one, 9.0), ("a", two, 3.0), ("b", one, 2.0), ("c", one, 4.0)]


def test_upsert_refuses_duplicate_keys_and_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "silver")
    upsert(spark, path, [("a", D(2024, 1, 1), 1.0)])
    with pytest.raises(ValueError):
        upsert(spark, path, [("b", D(2024, 1, 1), 1.0), ("b", D(2024, 1, 1), 2.0)])
    assert readers.read_table(spark, path).count() == 1


def test_upsert_accepts_a_new_column(spark, tmp_path):
    path = str(tmp_path / "sku")
    writers.upsert_sku_features(spark.createDataFrame([("p", D(2024, 1, 1), 1.0)], "product_id string, date date, q double"), path)
    writers.upsert_sku_features(spark.createDataFrame([("p", D(2024, 1, 2), 2.0, 5)], "product_id string, date date, q double, extra int"), path)
    got = {r["date"]: r["extra"] for r in readers.read_table(spark, path).collect()}
    assert got == {D(2024, 1, 1): None, D(2024, 1, 2): 5}


def test_ingest_all_isolates_failures(spark, tmp_path):
    good = put(tmp_path, "pos.csv", POS_HEADER + "t1,c,p,s,2024-01-05 10:00:00,2,1.5,3.0,true\n")
    bad = put(tmp_path, "erp.csv", "product_id,store_id,snapshot_date,stock_quantity,reorder_point,lead_time_days,supplier_id\np,,2024-01-01,1,1,1,s\n")
    audit = str(tmp_path / "audit")
    got = {r["source"]: (r["status"], r["row_count"]) for r in bronze.ingest_all(
        spark, {"pos": good, "erp": bad, "external": str(tmp_path / "missing.csv")}, str(tmp_path / "bronze"), audit).collect()}
    assert got["pos"] == ("SUCCESS", 1) and got["external"] == ("SKIPPED", None) and got["ecommerce"] == ("SKIPPED", None)
    assert got["erp"][0].startswith("FAILED: erp: 1 rows without")
    table = readers.read_table(spark, str(tmp_path / "bronze" / "pos")).first()
    assert (table["year"], table["month"], table["source_system"]) == (2024, 1, "POS")
    assert not files.exists(spark, str(tmp_path / "bronze" / "erp"))
    events = sorted((r["job"], r["event"], r["row_count"]) for r in spark.read.parquet(audit).collect() if r["job"] == "ingest_pos")
    assert events == [("ingest_pos", "COMPLETE", 1), ("ingest_pos", "START", None)]


def test_audit_keeps_every_name(spark, tmp_path):
    writers.audit_row(spark, str(tmp_path / "a"), "j", "COMPLETE", "r", features=[f"f{i}" for i in range(60)])
    got = spark.read.parquet(str(tmp_path / "a")).first()
    assert got["feature_count"] == 60 and len(got["features"]) == 60


def test_csv_export_starts_with_a_byte_order_mark(spark, tmp_path):
    path = tmp_path / "out"
    writers.export_csv(spark.createDataFrame([("é", 1)], "name string, n int").coalesce(1), str(path))
    data = next(path.glob("part-*")).read_bytes()
    assert data.decode("utf-8-sig") == "name,n\né,1\n" and data.startswith(b"\xef\xbb\xbf")


def test_scores_for_day(spark):
    df = spark.createDataFrame([("a", 0.5, 1, T(2024, 1, 15, 23, 59), 1.0), ("b", 0.5, 1, T(2024, 1, 16), 1.0)],
                               "customer_id string, churn_proba double, target_churn int, scored_at timestamp_ntz, monetary double")
    got = readers.scores_for_day(df, "2024-01-15")
    assert [r["customer_id"] for r in got.collect()] == ["a"] and {"prediction", "target"} <= set(got.columns)


def test_samples(spark):
    df = spark.range(1000)
    once, twice = [[r[0] for r in readers.sample_rows(df.repartition(n), 50, "id").collect()] for n in (1, 7)]
    assert once == twice and len(set(once)) == 50
    tenths = [sorted(r[0] for r in readers.sample_fraction(df.repartition(n), ["id"]).collect()) for n in (1, 7)]
    other = sorted(r[0] for r in readers.sample_fraction(df, ["id"], seed=7).collect())
    assert tenths[0] == tenths[1] != other and len(other) == len(tenths[0]) == 100
    repeated = df.selectExpr("cast(null as string) AS id", "id AS _size").unionByName(df.selectExpr("'x' AS id", "id AS _size"))
    drawn = readers.sample_fraction(repeated, ["id"], 0.25)
    assert drawn.count() == 500 and drawn.columns == ["id", "_size"] and drawn.select("id").distinct().count() == 1
    assert readers.sample_fraction(df.limit(0), ["id"]).count() == 0


def test_external_table_by_day(spark, tmp_path):
    path = str(tmp_path / "ext")
    df = spark.createDataFrame([(D(2024, 1, 1), 1.0)], "date date, cpi_index double")
    writers.append_by_column(df, path, "date")
    writers.append_by_column(df.withColumn("extra", F.lit("x")), path, "date")
    assert sorted(str(r["extra"]) for r in readers.read_table(spark, path).collect()) == ["None", "x"]


def test_upsert_reads_only_touched_partitions(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "silver")
    upsert(spark, path, [("a", D(2024, 1, d), 1.0) for d in range(1, 11)])
    plans, original = [], commits.write

    def spy(rows, *args, **kwargs):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return original(rows, *args, **kwargs)

    monkeypatch.setattr(commits, "write", spy)
    upsert(spark, path, [("a", D(2024, 1, 3), 2.0)])
    assert "dynamicpruning" in plans[0].split("PartitionFilters: [")[1].split("]")[0]
    first, second = sorted((tmp_path / "silver" / "data").glob("write_id=*"), key=lambda p: len(list(p.glob("snapshot_date=*"))), reverse=True)
    assert [p.name for p in second.glob("snapshot_date=*")] == ["snapshot_date=2024-01-03"]


def state(spark, path):
    return sorted(tuple(r) for r in readers.read_table(spark, path).collect())


def test_a_write_that_breaks_leaves_the_old_state(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "silver")
    upsert(spark, path, [("a", D(2024, 1, 1), 1.0), ("b", D(2024, 1, 2), 2.0)])
    before, original = state(spark, path), files.create

    def broken(*_):
        raise OSError("lost on the way")

    monkeypatch.setattr(files, "create", broken)  # rows are written, the commit is not
    with pytest.raises(OSError):
        upsert(spark, path, [("a", D(2024, 1, 1), 9.0)])
    assert state(spark, path) == before and commits.last_commit(spark, path).number == 1
    monkeypatch.setattr(files, "create", original)
    monkeypatch.setattr(files, "delete", lambda *_: False)  # a process that dies cannot clean up either
    monkeypatch.setattr(files, "create", broken)
    with pytest.raises(OSError):
        upsert(spark, path, [("a", D(2024, 1, 1), 9.0)])
    monkeypatch.undo()
    assert state(spark, path) == before and len(list((tmp_path / "silver" / "data").glob("write_id=*"))) == 2
    upsert(spark, path, [("a", D(2024, 1, 1), 5.0), ("c", D(2024, 1, 1), 6.0)])
    after = state(spark, path)
    assert [r[0] for r in after] == ["a", "b", "c"] and commits.last_commit(spark, path).n_rows == 3
    assert commits.vacuum(spark, path) > 0 and state(spark, path) == after
    assert len(list((tmp_path / "silver" / "data").glob("write_id=*"))) == 2  # b is still live in the first write


def test_of_two_commits_with_one_number_one_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "silver")
    upsert(spark, path, [("a", D(2024, 1, 1), 1.0)])
    stale = commits.last_commit(spark, path)
    upsert(spark, path, [("b", D(2024, 1, 1), 2.0)])
    now, latest = state(spark, path), commits.last_commit
    monkeypatch.setattr(commits, "last_commit", lambda *_: stale)
    with pytest.raises(Exception, match="(?i)exist"):
        upsert(spark, path, [("c", D(2024, 1, 1), 3.0)])
    monkeypatch.setattr(commits, "last_commit", latest)
    assert state(spark, path) == now


def test_landing_writes_each_feed_once(spark, tmp_path):
    from shelfline import session

    good = put(tmp_path, "pos.csv", POS_HEADER + "t1,c,p,s,2024-01-05 10:00:00,2,1.5,3.0,true\nt2,c,p,s,not a time,2,1.5,3.0,true\n")
    staged = list(session._STAGED)
    table = str(tmp_path / "pos")
    assert bronze.land(spark, bronze.SOURCES[0], good, table) == 2 and bronze.land(spark, bronze.SOURCES[0], good, table) == 2
    assert session._STAGED == staged and readers.read_table(spark, table).count() == 4
    assert len(list((tmp_path / "pos" / "data").glob("write_id=*"))) == 2


def test_upsert_needs_a_partition_value(spark, tmp_path):
    path = str(tmp_path / "silver")
    upsert(spark, path, [("a", D(2024, 1, 1), 1.0)])
    with pytest.raises(ValueError):
        upsert(spark, path, [("b", None, 1.0)])


def test_sales_joins_move_plain_columns_and_feeds_are_compressed(spark):
    """Texts and amounts of a line are worked out behind the join with its order or part; a landed feed takes fewer bytes than its text."""
    t = Tables(spark, "/root/testdata/sf0.001")
    for df, key in ((t.customer_sales(), "o_orderkey"), (t.category_sales(), "p_partkey")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "concat_ws" in plan.split("Join Inner")[0] and "concat_ws" not in plan.split("Join Inner")[1] and key in plan
    path = plans.land_csv(t, t.lines(), "land-test")
    assert all(n.endswith(".csv.gz") for n in files.names(spark, path) if n.startswith("part-"))
    assert spark.read.option("header", True).csv(path).count() == t.lineitem.count()


def test_appends_by_month_move_plain_columns(spark, monkeypatch):
    """Rows are brought together by month before their texts and amounts are worked out; the tables stay the same, in compact files."""
    laid, paths, layout, append = [], [], writers._layout, writers.append_by_month

    def spy(df, *columns):
        laid.append(df._jdf.queryExecution().optimizedPlan().toString())
        return layout(df, *columns)

    def noted(df, path, *args):
        paths.append(path)
        append(df, path, *args)

    monkeypatch.setattr(writers, "_layout", spy)
    monkeypatch.setattr(writers, "append_by_month", noted)
    t = Tables(spark, "/root/testdata/sf0.001")
    plans.published_pos(t)
    plans.schema_evolution_append(t)
    assert len(laid) == 3 and paths[1] == paths[2]
    assert not any("concat_ws" in p for p in laid)
    sales = plans.landed_pos(t).withColumns({"year": F.year("timestamp"), "month": F.month("timestamp")})
    channel = F.when(F.col("year") >= 1999, F.concat(F.lit("store-"), (F.col("store_id").cast("int") % 4).cast("string")))
    for path, want in ((paths[0], sales), (paths[1], sales.withColumn("channel", channel))):
        table = readers.read_table(spark, path)
        assert sorted(table.columns) == sorted(want.columns) and table.count() == want.count() > 0
        assert table.select(want.columns).exceptAll(want).isEmpty()
        month = next(n for n in files.names(spark, f"{path}/year=1999") if n.startswith("month="))
        assert all(n.endswith(".zstd.parquet") for n in files.names(spark, f"{path}/year=1999/{month}"))
