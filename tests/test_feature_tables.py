"""Feature tables by period, lookups that open few folders, and retrieval over several views against plain loops."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from shelfline.operators import features as ft
from shelfline.plans import features as plans
from shelfline.plans.views import Tables
from shelfline.session import FREEING_SETTING, stage_freed

NOON = dt.datetime(2024, 3, 1, 12)
DEMAND = ["sku_demand_fv:rolling_mean_7d", "sku_demand_fv:lag_1d", "customer_rfm_fv:monetary"]


def history(spark):
    r = random.Random(2)
    demand = [(f"p{k % 5}", NOON + dt.timedelta(hours=r.randint(-900, 900)), float(k), float(-k)) for k in range(300)]
    demand += [("p0", None, 1.0, 1.0), (None, NOON, 2.0, 2.0)]
    rfm = [(f"c{k % 4}", NOON + dt.timedelta(days=r.randint(-60, 60)), float(k)) for k in range(60)]
    zeros = lambda names: [F.lit(0.0).alias(n) for n in names]
    sku = spark.createDataFrame(demand, "product_id string, event_ts timestamp_ntz, rolling_mean_7d double, lag_1d double").select(
        "*", *zeros(["rolling_mean_14d", "rolling_mean_30d", "lag_7d", "momentum_7d"]))
    people = spark.createDataFrame(rfm, "customer_id string, event_ts timestamp_ntz, monetary double").select(
        "*", *zeros(["recency_days", "frequency", "avg_basket_size", "rfm_score"]))
    return demand, rfm, {"sku_demand_fv": sku, "customer_rfm_fv": people}


def newest(rows, key, at, days):
    seen = [x for x in rows if x[0] == key and key is not None and x[1] is not None and at is not None and at - dt.timedelta(days=days) <= x[1] <= at]
    return max(seen, key=lambda x: x[1], default=None)


def test_retrieval_over_views(spark):
    demand, rfm, sources = history(spark)
    r = random.Random(7)
    asked = [(k, f"p{r.randint(0, 6)}", f"c{r.randint(0, 5)}", NOON + dt.timedelta(hours=r.randint(-1000, 1000))) for k in range(200)]
    asked += [(500, "p0", "c0", None), (501, None, None, NOON), (0, *asked[0][1:])]
    frame = spark.createDataFrame(asked, "id int, product_id string, customer_id string, ts timestamp_ntz")
    got = ft.point_in_time_features(frame, sources, "ts", DEMAND).collect()
    assert len(got) == len(asked)
    times = {}
    for key, at, *_ in demand:
        times.setdefault((key, at), 0)
        times[key, at] += 1
    for row in got:
        a, b = newest(demand, row.product_id, row.ts, 1), newest(rfm, row.customer_id, row.ts, 7)
        if a is None or times[a[0], a[1]] == 1:  # rows of one time may give either value
            assert (row.rolling_mean_7d, row.lag_1d) == ((a[2], a[3]) if a else (None, None))
        assert (row.monetary is None) == (b is None) and (b is None or row.monetary in [x[2] for x in rfm if x[:2] == b[:2]])
    assert ft.point_in_time_features(frame.limit(0), sources, "ts", DEMAND).count() == 0


@pytest.mark.parametrize("by", ["day", "week", "month"])
def test_lookup_opens_few_periods(spark, by):
    _, _, sources = history(spark)
    view = ft.VIEWS["sku_demand_fv"]
    table = ft.materialize(view, sources["sku_demand_fv"], by)
    assert table.count() == 301  # the row without a time is in no period
    now = "2024-03-05 00:00:00"
    ids = spark.createDataFrame([(f"p{k}",) for k in range(6)], "product_id string")
    wanted = ["sku_demand_fv:rolling_mean_7d"]
    plain = ft.latest_feature_lookup(ids, sources, now, wanted).collect()
    found = ft.latest_feature_lookup(ids, {"sku_demand_fv": table}, now, wanted)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, plain))
    plan = found._jdf.queryExecution().explainString(found.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(event_period" in plan and "PushedFilters: [IsNotNull(event_ts)" in plan


def test_history_of_an_interval_is_that_part_of_the_whole(spark):
    r = random.Random(9)
    rows = [(f"c{r.randint(0, 9)}", dt.datetime(2024, 1, 1) + dt.timedelta(days=r.randint(0, 300)), float(r.randint(1, 90))) for _ in range(300)]
    sales = spark.createDataFrame([*rows, ("c1", None, 1.0)], "customer_id string, ts timestamp_ntz, total_amount double")
    whole = ft.rfm_history(sales)
    # A week, less than a week between two snapshots, one snapshot day, and days beyond the sales.
    for start, end in (("2024-05-01", "2024-06-13"), ("2024-05-03", "2024-05-08"), ("2024-05-02", "2024-05-02"), ("2025-06-01", "2025-07-01")):
        part = ft.rfm_history(sales, start=start, end=end)
        want = whole.filter(F.to_date("event_ts").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        assert sorted(map(tuple, part.collect())) == sorted(map(tuple, want.collect()))


def test_materialising_reads_and_writes_its_interval(spark, monkeypatch):
    """What is written does not grow with the days outside of the interval."""
    written = {}
    monkeypatch.setattr(ft, "stage_by", lambda rows, label, *columns, order=None: written.setdefault(label, rows))
    tables = Tables(spark, "/root/testdata/sf0.001")
    for name, fn, end in (("all", plans.materialize_all, plans.SNAPSHOT), ("lookup", plans.lookup_materialized, plans.LOOKUP_AT)):
        written.clear()
        fn(tables)
        assert set(written) == {f"view-{v}" for v in (ft.VIEWS if name == "all" else ft.SERVICES["demand"].views)}
        for rows in written.values():
            first, last = rows.agg(F.min(F.to_date("event_ts")), F.max(F.to_date("event_ts"))).first()
            assert plans.days_before(end) <= str(first) <= str(last) <= end


def test_snapshots_equal_single_runs(spark):
    r = random.Random(3)
    rows = [(f"c{r.randint(0, 9)}", dt.datetime(2024, 1, 1) + dt.timedelta(days=r.randint(0, 120)), float(r.randint(1, 90))) for _ in range(300)]
    sales = spark.createDataFrame(rows, "customer_id string, ts timestamp_ntz, total_amount double")
    got = ft.rfm_history(sales, 7)
    for day in ("2024-02-15", "2024-04-04"):
        assert (dt.date.fromisoformat(day) - dt.date(1970, 1, 1)).days % 7 == 0
        one = sorted((tuple(x) for x in got.filter(F.col("event_ts") == F.lit(day).cast("timestamp_ntz")).drop("event_ts").collect()))
        want = sorted(tuple(x) for x in ft.rfm_features(sales, day, bounded=True).collect())
        assert [x[0] for x in one] == [x[0] for x in want] and all(a[1:] == pytest.approx(b[1:]) for a, b in zip(one, want))


@pytest.mark.parametrize("every", [7, 30, 100])
def test_snapshots_before_sales_are_those_of_the_history(spark, every):
    r = random.Random(12)
    rows = [(f"c{r.randint(0, 9)}", dt.datetime(2024, 1, 1, r.choice([0, 0, 13])) + dt.timedelta(days=r.randint(0, 300)), r.choice([None, *range(1, 9)])) for _ in range(300)]
    sales = spark.createDataFrame([*rows, ("c1", None, 1), (None, dt.datetime(2024, 5, 5), 7)], "customer_id string, ts timestamp_ntz, total_amount int")
    snapshot = lambda at: dt.datetime(1970, 1, 1) + dt.timedelta(days=(at - dt.datetime(1970, 1, 1)).days // every * every)
    seen = {(c, snapshot(at)) for c, at, _ in [*rows, (None, dt.datetime(2024, 5, 5), 7)]}
    want = [x for x in map(tuple, ft.rfm_history(sales, every).collect()) if x[:2] in seen]
    got = [tuple(x) for x in ft.rfm_before_sales(sales, every).collect()]
    assert len(want) > 50 or every > 7
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_retrieval_keeps_no_snapshot_that_no_line_sees(spark, monkeypatch):
    """All weekly snapshots of all customers are about seven times the lines; nothing written or looked through may hold them."""
    tables, looked, staged = Tables(spark, "/root/testdata/sf0.001"), {}, []
    stage, find = ft.stage_table, ft.point_in_time_features
    monkeypatch.setattr(ft, "stage_table", lambda df, label: staged.append(label) or stage(df, label))
    monkeypatch.setattr(ft, "point_in_time_features", lambda lines, sources, at: looked.update(sources) or find(lines, sources, at))
    out = plans.point_in_time_features_all(tables)
    lines = tables.lineitem.count()
    assert out.count() == lines and staged == []
    assert all(source.count() <= lines for source in looked.values())


def test_views_of_periods_and_ties(spark):
    """The edge of a period, an age of just the time to live, equal times, and null keys."""
    start = dt.datetime(1970, 1, 1) + dt.timedelta(days=16 * 1000)  # the periods of a time to live of a day
    day, hour = dt.timedelta(days=1), dt.timedelta(hours=1)
    known = [("a", start - hour, 1.0), ("b", start - day, 2.0), ("c", start, 3.0), ("d", start - 2 * day, 4.0), (None, start, 5.0), ("e", start, 6.0), ("e", start, 7.0)]
    zeros = [F.lit(0.0).alias(n) for n in ("rolling_mean_14d", "rolling_mean_30d", "lag_1d", "lag_7d", "momentum_7d")]
    view = spark.createDataFrame(known, "product_id string, event_ts timestamp_ntz, rolling_mean_7d double").select("*", *zeros)
    asked = [("a", start), ("a", start + 22 * hour), ("a", start + 23 * hour), ("a", start + 24 * hour), ("b", start), ("b", start + hour), ("c", start), ("c", start - hour), ("d", start), (None, start), ("e", start), ("f", None)]
    frame = spark.createDataFrame(asked, "product_id string, ts timestamp_ntz")
    got = {(r[0], r[1]): r[2] for r in ft.point_in_time_features(frame, {"sku_demand_fv": view}, "ts", ["sku_demand_fv:rolling_mean_7d"]).collect()}
    assert got.pop(("e", start)) in (6.0, 7.0)
    assert {k for k, v in got.items() if v is not None} == {("a", start), ("a", start + 22 * hour), ("a", start + 23 * hour), ("b", start), ("c", start)}


def test_rounding_scales_before_it_rounds(spark):
    # 67009.3186625 times a million is a last bit below the half.
    got = plans.rounded(spark.range(1).select((F.lit(536074.5493) / 8).alias("a")), {"a": 6})
    assert got.first().a == 67009.318662


def test_retrieval_by_slices_is_that_of_one_pass(spark, rows, monkeypatch):
    _, _, sources = history(spark)
    r = random.Random(5)
    asked = [(k, f"p{r.randint(0, 6)}", f"c{r.randint(0, 5)}", NOON + dt.timedelta(hours=r.randint(-1000, 1000))) for k in range(200)]
    asked += [(500, "p0", "c0", None), (501, None, None, NOON), (502, None, "c1", NOON), asked[0]]
    frame = spark.createDataFrame(asked, "id int, product_id string, customer_id string, ts timestamp_ntz")
    whole = rows(ft.point_in_time_features(frame, sources, "ts", DEMAND))
    monkeypatch.setattr(ft, "SLICE_ROWS", 60)
    assert rows(ft.point_in_time_features(frame, sources, "ts", DEMAND)) == whole and len(whole) == len(asked)
    # Keys of two types may be equal with unequal hashes: one pass.
    monkeypatch.setattr(ft, "_known_by_slices", lambda *_: pytest.fail("slices of keys of two types"))
    number = lambda df: df.withColumn("customer_id", F.substring("customer_id", 2, 2).cast("int"))
    wide = {**sources, "customer_rfm_fv": number(sources["customer_rfm_fv"]).withColumn("customer_id", F.col("customer_id").cast("long"))}
    found = ft.point_in_time_features(number(frame), wide, "ts", DEMAND)
    assert rows(found, "id", "rolling_mean_7d", "lag_1d", "monetary") == sorted((tuple((x[0], *x[4:])) for x in whole), key=repr)


def test_large_retrieval_has_one_slice_on_disk(spark, rows, monkeypatch):
    """No shuffle holds all lines, none is left behind, and what was used is dropped."""
    tables, asked, staged = Tables(spark, "/root/testdata/sf0.001"), [], []
    whole = rows(plans.point_in_time_features_all(tables))
    find, stage = ft.as_known, ft.stage_freed
    monkeypatch.setattr(ft, "SLICE_ROWS", 2500)
    monkeypatch.setattr(ft, "as_known", lambda entities, *rest: asked.append(entities.count()) or find(entities, *rest))
    monkeypatch.setattr(ft, "stage_freed", lambda df, label, *rest: staged.append(stage(df, label, *rest)) or staged[-1])
    out = plans.point_in_time_features_all(tables)
    lines = tables.lineitem.count()
    assert len(asked) == 6 and sum(asked) == 2 * lines and max(asked) < lines / 2
    plan = out._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "Exchange" not in plan and "Window" not in plan
    present = dict.fromkeys(path for _, path in staged if ft.files.exists(spark, path))
    assert [path.rsplit("/", 1)[1].rsplit("-", 1)[0] for path in present] == ["rfm-cells", "known"]
    assert rows(out) == whole


def test_staging_frees_its_shuffles(spark):
    def shuffles():
        kept = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in kept.split("\n") if "/shuffle_" in f}

    before = shuffles()
    one, path = stage_freed(spark.range(1000).repartition(3, "id"), "freed")
    for _ in range(100):  # they go behind the write
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before and spark.conf.get(FREEING_SETTING) == "false"
    both, same = stage_freed(spark.range(1000, 1500), "freed", None, path)
    assert same == path and one.count() + both.count() == 2500
    sliced, _ = stage_freed(spark.range(10).withColumn("part", F.col("id") % 3), "freed", "part")
    assert sliced.filter("part = 1").count() == 3
