"""Customer, SKU and external features, feature views and point-in-time retrieval."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from shelfline import files
from shelfline.functions import calendar as cal
from shelfline.functions.scalars import clv_band, extreme_weather, high_risk_flag
from shelfline.operators.ordered import decimal_sum, newest_per_key, one_row
from shelfline.session import drop_staged, freeing_shuffles, spread, stage_by, stage_freed, stage_table

RFM_LOOKBACK_DAYS = 90
RFM_COLUMNS = ["recency_days", "frequency", "monetary", "avg_basket_size", "rfm_score"]
# Weights of recency, frequency and monetary in the composite score.
RFM_WEIGHTS = {"recency_days": 0.30, "frequency": 0.35, "monetary": 0.35}


def customer_rfm(sales: DataFrame, snapshot: str, bounded: bool = False) -> DataFrame:
    """Recency, frequency, monetary and basket size per customer in the lookback window.

    Without ``bounded`` there is no upper date limit, so sales after the snapshot give a
    negative recency.
    """
    snap = F.lit(snapshot).cast("date")
    day = F.to_date("ts")
    # A plain comparison on the timestamp itself reaches the Parquet scan.
    start = F.date_sub(snap, RFM_LOOKBACK_DAYS).cast("timestamp_ntz")
    window = F.col("ts") >= start
    if bounded:
        window = window & (F.col("ts") < F.date_add(snap, 1).cast("timestamp_ntz"))
    return (
        sales.filter(window)
        .groupBy("customer_id")
        .agg(
            F.datediff(snap, F.max(day)).cast("long").alias("recency_days"),
            F.count("ts").alias("frequency"),
            decimal_sum(F.col("total_amount")).cast("double").alias("monetary"),
        )
        .withColumn("avg_basket_size", F.col("monetary") / F.col("frequency"))
    )


def minmax_score(rfm: DataFrame) -> DataFrame:
    """Add the 1–5 min-max score; the bounds come from one scalar subquery, not a global window."""
    bounds = {f"{side}_{c}": fn(c) for c in RFM_WEIGHTS for side, fn in (("lo", F.min), ("hi", F.max))}
    with_bounds = rfm.withColumn("_b", one_row(rfm, **bounds))

    def scaled(c: str) -> Column:
        lo, hi = F.col(f"_b.lo_{c}"), F.col(f"_b.hi_{c}")
        return (F.col(c) - lo) / (hi - lo + F.lit(1e-9)) * 4 + 1

    r, f, m = scaled("recency_days"), scaled("frequency"), scaled("monetary")
    weights = RFM_WEIGHTS
    score = (6 - r) * weights["recency_days"] + f * weights["frequency"] + m * weights["monetary"]
    return with_bounds.withColumn("rfm_score", score).drop("_b")


def rfm_features(sales: DataFrame, snapshot: str, bounded: bool = False) -> DataFrame:
    return minmax_score(customer_rfm(sales, snapshot, bounded)).select("customer_id", *RFM_COLUMNS)


def _last_rows(key: str, date: str, n: int):
    return Window.partitionBy(key).orderBy(date).rowsBetween(-(n - 1), 0)


def full_window(aggregate: Column, value: str, frame, n: int) -> Column:
    """Null until the frame holds ``n`` values."""
    return F.when(F.count(value).over(frame) >= n, aggregate.over(frame))


def rolling_means(daily: DataFrame, key="product_id", date="date", value="quantity", sizes=(7, 14, 30)) -> DataFrame:
    return daily.withColumns(
        {f"rolling_mean_{n}d": full_window(F.avg(value), value, _last_rows(key, date, n), n) for n in sizes}
    )


def rolling_stds(daily: DataFrame, key="product_id", date="date", value="quantity", sizes=(7, 14)) -> DataFrame:
    return daily.withColumns(
        {f"rolling_std_{n}d": full_window(F.stddev_samp(value), value, _last_rows(key, date, n), n) for n in sizes}
    )


def demand_lags(daily: DataFrame, key="product_id", date="date", value="quantity", lags=(1, 7, 14)) -> DataFrame:
    spec = Window.partitionBy(key).orderBy(date)
    return daily.withColumns({f"lag_{n}d": F.lag(value, n).over(spec) for n in lags})


def momentum(daily: DataFrame, value="quantity") -> DataFrame:
    mean = F.col("rolling_mean_7d")
    return daily.withColumn("momentum_7d", (F.col(value) - mean) / (mean + F.lit(1e-9)))


def demand_features(daily: DataFrame) -> DataFrame:
    """All SKU demand features of daily sales: every window shares one shuffle and one sort."""
    return momentum(demand_lags(rolling_stds(rolling_means(daily))))


def moving_average(daily: DataFrame, keys: Sequence[str], date: str, value: str, n: int = 7) -> DataFrame:
    frame = Window.partitionBy(*keys).orderBy(date).rowsBetween(-(n - 1), 0)
    return daily.withColumn(f"ma{n}", full_window(F.avg(value), value, frame, n))


def date_features(df: DataFrame, holidays: list[str] | None = None, weekend_from_iso: int = 5) -> DataFrame:
    date, known = F.col("date"), cal.holiday_array(holidays)
    out = df.withColumns(cal.calendar_columns(date, weekend_from_iso)).withColumns(
        {
            "days_to_next_holiday": cal.days_to_next_holiday(date, known),
            "days_since_last_holiday": cal.days_since_last_holiday(date, known),
        }
    )
    promo = cal.promotional_period(F.col("days_since_last_holiday"), F.col("days_to_next_holiday"))
    return out.withColumn("is_promotional_period", promo)


def with_extreme_weather(weather: DataFrame) -> DataFrame:
    return weather.withColumn("is_extreme_weather", extreme_weather(F.col("temp_c"), F.col("rain_mm")))


def join_weather(demand: DataFrame, weather: DataFrame) -> DataFrame:
    """Left join on store and day. Readings grow with stores, so the join strategy is left to the optimizer."""
    columns = ["store_id", "date", "temp_c", "rain_mm", "is_extreme_weather"]
    return demand.join(weather.select(columns), ["store_id", "date"], "left")


def join_cpi(demand: DataFrame, cpi: DataFrame, by_year: bool = False) -> DataFrame:
    """Left join on category and month of year.

    A month carries no year, so an index over several years multiplies rows; ``by_year``
    adds the year to the key. Without a category on both sides only the month is added.
    """
    out = demand if "month" in demand.columns else demand.withColumn("month", F.month("date"))
    if "category" not in out.columns or "category" not in cpi.columns:
        return out
    keys = ["category", "month"]
    if by_year:
        out = out if "year" in out.columns else out.withColumn("year", F.year("date"))
        keys.append("year")
    return out.join(cpi.select(*keys, "cpi_index", "cpi_mom_change"), keys, "left")


def join_external(demand: DataFrame, weather: DataFrame, cpi: DataFrame, by_year: bool = False) -> DataFrame:
    return join_cpi(join_weather(demand, weather), cpi, by_year)


def churn_risk_on_demand(rfm: DataFrame) -> DataFrame:
    return rfm.withColumns(
        {
            "high_risk_flag": high_risk_flag(F.col("rfm_score"), F.col("recency_days")),
            "clv_tier": clv_band(F.col("monetary")),
        }
    )


@dataclass(frozen=True)
class FeatureView:
    """Entity keys, time to live and fields of one feature source."""

    name: str
    keys: tuple[str, ...]
    ttl_days: int
    fields: tuple[str, ...]
    time: str = "event_ts"


@dataclass(frozen=True)
class FeatureService:
    name: str
    views: tuple[str, ...]
    on_demand: tuple[str, ...] = field(default=())


# The feature catalogue (view, keys, days to live, fields) and the two named groups.
VIEWS = {
    v.name: v
    for v in (
        FeatureView("customer_rfm_fv", ("customer_id",), 7, tuple(RFM_COLUMNS)),
        FeatureView(
            "sku_demand_fv", ("product_id",), 1,
            ("rolling_mean_7d", "rolling_mean_14d", "rolling_mean_30d", "lag_1d", "lag_7d", "momentum_7d"),
        ),
        FeatureView(
            "sku_date_fv", ("product_id",), 1,
            ("day_of_week", "week_of_year", "is_weekend", "is_promotional_period", "days_to_next_holiday"),
        ),
        FeatureView(
            "sku_external_fv", ("product_id", "store_id"), 1,
            ("temp_c", "rain_mm", "is_extreme_weather", "cpi_index", "cpi_mom_change"),
        ),
    )
}
SERVICES = {
    "demand": FeatureService("demand", ("sku_demand_fv", "sku_date_fv", "sku_external_fv")),
    "churn": FeatureService("churn", ("customer_rfm_fv",), ("high_risk_flag", "clv_tier")),
}
ALL_REFERENCES = [f"{v.name}:{f}" for v in VIEWS.values() for f in v.fields]


def resolve_references(references: Sequence[str]) -> dict[str, list[str]]:
    """Group "view:feature" references by view; unknown names are an error."""
    out: dict[str, list[str]] = {}
    for reference in references:
        name, _, feature = reference.partition(":")
        if name not in VIEWS or feature not in VIEWS[name].fields:
            raise KeyError(reference)
        out.setdefault(name, []).append(feature)
    return out


def service_columns(service: str) -> list[str]:
    chosen = SERVICES[service]
    return [f for v in chosen.views for f in VIEWS[v].fields] + list(chosen.on_demand)


def _snapshot_bounds(rfm: DataFrame) -> DataFrame:
    """Smallest and largest value of each scored column by ``_snap``."""
    return rfm.groupBy("_snap").agg(*[fn(c).alias(f"_{side}_{c}") for c in RFM_WEIGHTS for side, fn in (("lo", F.min), ("hi", F.max))])


def _snapshot_score() -> Column:
    scaled = lambda c: (F.col(c) - F.col(f"_lo_{c}")) / (F.col(f"_hi_{c}") - F.col(f"_lo_{c}") + F.lit(1e-9)) * 4 + 1
    return (6 - scaled("recency_days")) * RFM_WEIGHTS["recency_days"] + scaled("frequency") * RFM_WEIGHTS["frequency"] + scaled("monetary") * RFM_WEIGHTS["monetary"]


def rfm_history(sales: DataFrame, every: int = 7, start=None, end=None) -> DataFrame:
    """RFM features and score of every customer at every snapshot day, one each ``every`` days.

    A sale counts for the snapshots of the next ``RFM_LOOKBACK_DAYS`` days, so one pass over the sales and
    one aggregate give all snapshots. Scores are scaled within a snapshot. Snapshots are the days whose
    number since 1970 is divisible by ``every``. With ``start`` and ``end`` only the snapshots from one
    day to the other are worked out, from the sales they can see.
    """
    day = F.unix_date(F.to_date("ts"))
    first, last = F.ceil(day / every).cast("int"), F.floor((day + RFM_LOOKBACK_DAYS) / every).cast("int")
    seen = F.col("ts").isNotNull()
    if start is not None:
        seen = seen & (F.col("ts") >= F.date_sub(F.lit(start).cast("date"), RFM_LOOKBACK_DAYS).cast("timestamp_ntz"))
        first = F.greatest(first, F.ceil(F.unix_date(F.lit(start).cast("date")) / every).cast("int"))
    if end is not None:
        seen = seen & (F.col("ts") < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz"))
        last = F.least(last, F.floor(F.unix_date(F.lit(end).cast("date")) / every).cast("int"))
    # A sale between two snapshots may meet none of them; a sequence would count downwards there.
    dealt = sales.filter(seen & (first <= last)).select(
        "customer_id", day.alias("_day"), F.col("total_amount").alias("_amount"), F.explode(F.sequence(first, last)).alias("_snap")
    ).withColumn("_snap", F.col("_snap") * every)
    rfm = dealt.groupBy("customer_id", "_snap").agg(
        (F.col("_snap") - F.max("_day")).cast("long").alias("recency_days"), F.count(F.lit(1)).alias("frequency"),
        decimal_sum(F.col("_amount")).cast("double").alias("monetary"),
    ).withColumn("avg_basket_size", F.col("monetary") / F.col("frequency"))
    rfm = stage_table(rfm, "rfm-history")
    at = F.date_from_unix_date("_snap").cast("timestamp_ntz").alias("event_ts")
    return rfm.join(_snapshot_bounds(rfm), "_snap").withColumn("rfm_score", _snapshot_score()).select("customer_id", at, *RFM_COLUMNS)


def rfm_before_sales(sales: DataFrame, every: int = 7) -> DataFrame:
    """The rows of :func:`rfm_history` that a sale of the same customer can see as its newest snapshot.

    Sales are added up by customer and day; each sum enters at its first snapshot and leaves behind its last, so
    running sums over these points give a customer's state, which holds up to the next point. Bounds of a
    snapshot are taken over all customers' states without keeping them: what moves is in proportion to the sales.
    """
    day = F.unix_date(F.to_date("ts"))
    money = F.col("total_amount").cast("decimal(18,4)")
    cells = sales.filter(F.col("ts").isNotNull()).groupBy("customer_id", day.alias("_day")).agg(
        F.count(F.lit(1)).alias("_n"), F.count(money).alias("_known"), F.sum(money).alias("_amount")
    )
    # Both uses read the sums from here, and the shuffles before them go.
    cells, _ = stage_freed(cells, "rfm-cells")
    first, last = F.ceil(F.col("_day") / every).cast("int"), F.floor((F.col("_day") + RFM_LOOKBACK_DAYS) / every).cast("int")
    enters = F.struct(first.alias("_point"), "_n", "_known", "_amount", "_day", F.floor(F.col("_day") / every).cast("int").alias("_asked"))
    nothing = F.lit(None).cast("int")
    leaves = F.struct((last + 1).alias("_point"), (-F.col("_n")).alias("_n"), (-F.col("_known")).alias("_known"), (-F.col("_amount")).alias("_amount"), nothing.alias("_day"), nothing.alias("_asked"))
    # Both uses of the states read one shuffle, of sums and not of points. Merged tasks would sort more than they can hold.
    points = spread(cells, "customer_id").select("customer_id", F.inline(F.array(enters, leaves)))
    order = Window.partitionBy("customer_id").orderBy("_point")

    def state(upto: int) -> Column:
        frame = order.rangeBetween(Window.unboundedPreceding, upto)
        held = F.when(F.sum("_known").over(frame) > 0, F.sum("_amount").over(frame)).cast("double")
        # While any sale is within the days looked back, the last one is.
        return F.struct(F.sum("_n").over(frame).alias("frequency"), held.alias("monetary"), F.max("_day").over(frame).alias("_last"))

    states = points.select("customer_id", "_point", "_asked", F.lead("_point").over(order).alias("_next"), state(0).alias("_at"), state(-1).alias("_before"))
    recency = (F.col("_snap") * every - F.col("_last")).cast("long").alias("recency_days")
    held = states.filter("_at.frequency > 0 AND _next > _point").select(F.explode(F.sequence("_point", F.col("_next") - 1)).alias("_snap"), "_at.*").withColumn("recency_days", recency)
    own = F.when(F.col("_asked") == F.col("_point"), F.col("_at")).otherwise(F.col("_before"))
    asked = states.filter("_asked IS NOT NULL").select("customer_id", F.col("_asked").alias("_snap"), own.alias("_own")).select("customer_id", "_snap", "_own.*")
    asked = asked.filter("frequency > 0").dropDuplicates(["customer_id", "_snap"]).withColumn("recency_days", recency)
    rfm = asked.withColumn("avg_basket_size", F.col("monetary") / F.col("frequency"))
    # One row a snapshot day.
    scored = rfm.join(F.broadcast(_snapshot_bounds(held)), "_snap").withColumn("rfm_score", _snapshot_score())
    return scored.select("customer_id", F.date_from_unix_date(F.col("_snap") * every).cast("timestamp_ntz").alias("event_ts"), *RFM_COLUMNS)


def materialize_latest(view: FeatureView, source: DataFrame, start, end) -> DataFrame:
    """Newest row per entity key with its time inside [start, end]."""
    time = F.col(view.time)
    inside = source.filter((time >= F.lit(start).cast("timestamp_ntz")) & (time <= F.lit(end).cast("timestamp_ntz")))
    tie = F.xxhash64(*view.fields)
    return newest_per_key(inside, view.keys, [time.desc(), tie]).select(*view.keys, view.time, *view.fields)


PERIOD = "event_period"


def materialize(view: FeatureView, source: DataFrame, by: str = "month") -> DataFrame:
    """The view's table in the shared folder: its keys, time, fields and ``event_period``, the first day of the row's period.

    Each period is a folder, in which rows stand by time; ``by`` is "day", "week" or "month": the shortest whose
    rows fill a file.
    """
    time = F.col(view.time)
    rows = source.select(*view.keys, time, *view.fields, F.to_date(F.date_trunc(by, time)).alias(PERIOD)).filter(time.isNotNull())
    return stage_by(rows, f"view-{view.name}", PERIOD, order=view.time)


def view_report(view: FeatureView, table: DataFrame, start, end, now) -> DataFrame:
    """One row: rows and entities of the interval, its first and last time, and the age of the newest row in days."""
    time = F.col(view.time)
    inside = within(table, view, F.lit(start), F.lit(end))
    return inside.agg(
        F.lit(view.name).alias("view"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct(*view.keys).alias("n_entities"),
        F.min(time).alias("first_ts"), F.max(time).alias("last_ts"), F.datediff(F.to_date(F.lit(now)), F.to_date(F.max(time))).alias("age_days"),
    )


def within(table: DataFrame, view: FeatureView, start: Column, end: Column) -> DataFrame:
    """Rows from ``start`` to ``end``; of a materialised table only the folders of their periods are opened.

    A period that holds ``start`` may begin up to 31 days earlier.
    """
    time = F.col(view.time)
    rows = table
    if PERIOD in table.columns:
        rows = rows.filter((F.col(PERIOD) >= F.date_sub(F.to_date(start), 31)) & (F.col(PERIOD) <= F.to_date(end)))
    return rows.filter((time >= start.cast("timestamp_ntz")) & (time <= end.cast("timestamp_ntz")))


def fresh_rows(view: FeatureView, table: DataFrame, now) -> DataFrame:
    """Rows within the view's time to live."""
    at = F.lit(now).cast("timestamp_ntz")
    return within(table, view, at - F.expr(f"INTERVAL {view.ttl_days} DAYS"), at)


def latest_feature_lookup(entities: DataFrame, sources: dict[str, DataFrame], now, references: Sequence[str] = ALL_REFERENCES) -> DataFrame:
    """Per entity row the newest value of every referenced feature, null beyond its time to live."""
    out = entities
    for name, fields in resolve_references(references).items():
        view = VIEWS[name]
        fresh = fresh_rows(view, sources[name], now)
        latest = newest_per_key(fresh, view.keys, [F.col(view.time).desc(), F.xxhash64(*fields)])
        out = out.join(latest.select(*view.keys, *fields), list(view.keys), "left")
    return out


#: A period of retrieval is this many times a view's time to live.
PERIOD_LENGTH = 16


def as_known(entities: DataFrame, sources: dict[str, DataFrame], entity_ts: str, views: Sequence[FeatureView], wanted: dict[str, Sequence[str]]) -> DataFrame:
    """Adds a struct ``_<view>`` per view: the newest row at or before the entity's time, not older than the time to live, else null.

    The views have one time to live, and the keys of the first are among those of all. Entities and view rows stand
    together by the first view's keys and a period of several times to live, in order of time, and each entity
    takes the last row before it: one shuffle for all views, in which views of one source frame and equal keys share
    rows. A view row that the next period can see is in both.
    """
    ttl = views[0].ttl_days
    length = ttl * 86400 * 1_000_000 * PERIOD_LENGTH
    period = lambda time: F.floor(F.unix_micros(F.to_timestamp(time)) / F.lit(length)).cast("long")
    keys = list(dict.fromkeys(k for v in views for k in v.keys))
    at = F.col(entity_ts).cast("timestamp_ntz")
    rest = F.struct(F.lit(True).alias("_asks"), *[c for c in entities.columns if c not in keys])
    rows = entities.select(*keys, at.alias("_at"), period(at).alias("_period"), rest.alias("_entity"))
    shared: dict[tuple, list[FeatureView]] = {}
    for view in views:
        shared.setdefault((id(sources[view.name]), view.keys, view.time), []).append(view)
    for (_, own, at_column), alike in shared.items():
        time = F.col(at_column).cast("timestamp_ntz")
        known = sources[alike[0].name].filter(functools.reduce(Column.__and__, [F.col(c).isNotNull() for c in (at_column, *own)]))
        periods = F.array_distinct(F.array(period(time), period(time + F.expr(f"INTERVAL {ttl} DAYS"))))
        values = [F.struct(*wanted[v.name]).alias(f"_{v.name}") for v in alike]
        rows = rows.unionByName(known.select(*own, time.alias("_at"), F.explode(periods).alias("_period"), *values), allowMissingColumns=True)
    # Times and tie breakers of view rows follow from what has been moved.
    rows = rows.repartition(*views[0].keys, "_period")
    ties = [F.when(F.col(f"_{v.name}").isNotNull(), F.xxhash64(*[f"_{v.name}.{f}" for f in wanted[v.name]])) for v in views]
    dated = {f"_{v.name}": F.when(F.col(f"_{v.name}").isNotNull(), F.struct(F.col("_at").alias("_time"), *[f"_{v.name}.{f}" for f in wanted[v.name]])) for v in views}
    rows = rows.withColumns({"_tie": F.coalesce(*ties), "_asks": F.col("_entity").isNotNull(), **dated})
    for view in views:
        order = Window.partitionBy(*view.keys, "_period").orderBy("_at", "_asks", "_tie").rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn(f"_{view.name}", F.last(f"_{view.name}", ignorenulls=True).over(order))
    found = [F.when(F.col(f"_{v.name}._time") >= F.col("_at") - F.expr(f"INTERVAL {ttl} DAYS"), F.col(f"_{v.name}").dropFields("_time")).alias(f"_{v.name}") for v in views]
    return rows.filter("_asks").select(*[c if c in keys else F.col(f"_entity.{c}") for c in entities.columns], *found)


SLICE = "_slice"
#: Entities of a slice of a large retrieval over several groups of views, and its greatest number of slices.
SLICE_ROWS, MAX_SLICES = 2_000_000, 16


def _same_keys(entities: DataFrame, sources: dict[str, DataFrame], views: Sequence[FeatureView]) -> bool:
    """Whether equal keys have equal hashes: their columns have one plain type on both sides."""
    plain = (T.StringType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DateType())
    return all(entities.schema[k].dataType == sources[v.name].schema[k].dataType and entities.schema[k].dataType in plain for v in views for k in views[0].keys)


def _known_by_slices(
    entities: DataFrame, sources: dict[str, DataFrame], entity_ts: str, groups: Sequence[Sequence[FeatureView]], wanted: dict[str, Sequence[str]], slices: int
) -> DataFrame:
    """As :func:`as_known` for one group after the other, with room on disk for the shuffle of one slice only.

    Entities and the group's sources are staged by slices of the group's keys; a slice goes when what is known of it is staged.
    """
    spark = entities.sparkSession

    def sliced(keys: Sequence[str]) -> Column:
        return F.pmod(F.hash(*keys), F.lit(slices)).alias(SLICE)

    out, at = stage_freed(entities.select("*", sliced(groups[0][0].keys)), "entities", SLICE)
    for i, group in enumerate(groups):
        tables: dict[int, tuple[DataFrame, str]] = {}
        for frame in {id(sources[v.name]): sources[v.name] for v in group}.values():
            alike = [v for v in group if sources[v.name] is frame]
            columns = dict.fromkeys(c for v in alike for c in (*v.keys, v.time, *wanted[v.name]))
            tables[id(frame)] = stage_freed(frame.select(*columns, sliced(group[0].keys)), "sources", SLICE)
        following = groups[i + 1][0].keys if i + 1 < len(groups) else None
        path = None
        for s in range(slices):
            pick = {key: table.filter(F.col(SLICE) == s).drop(SLICE) for key, (table, _) in tables.items()}
            own = {v.name: pick[id(sources[v.name])] for v in group}
            known = as_known(out.filter(F.col(SLICE) == s).drop(SLICE), own, entity_ts, group, wanted)
            if following:
                known = known.select("*", sliced(following))
            found, path = stage_freed(known, "known", SLICE if following else None, path)
            for used in (at, *(p for _, p in tables.values())):
                files.delete(spark, f"{used}/{SLICE}={s}")
        for used in (at, *(p for _, p in tables.values())):
            drop_staged(spark, used)
        out, at = found, path
    return out


def point_in_time_features(
    entities: DataFrame, sources: dict[str, DataFrame], entity_ts: str, references: Sequence[str] = ALL_REFERENCES
) -> DataFrame:
    """Training frame: each entity row with every referenced feature as it was known at the row's time.

    Views of one time to live whose keys contain another's share its shuffle. Rows without a time, or older than
    a view's time to live, get nulls. Several shuffles of many entities are worked out and staged by slices.
    """
    wanted, out = resolve_references(references), entities
    groups: list[list[FeatureView]] = []
    for view in sorted((VIEWS[name] for name in wanted), key=lambda v: (v.ttl_days, len(v.keys))):
        for group in groups:
            if group[0].ttl_days == view.ttl_days and set(group[0].keys) <= set(view.keys):
                group.append(view)
                break
        else:
            groups.append([view])
    # What is found moves with the entities into later shuffles.
    groups.sort(key=lambda g: sum(len(wanted[v.name]) for v in g))
    slices = 1
    if len(groups) > 1 and all(_same_keys(entities, sources, group) for group in groups):
        with freeing_shuffles(entities.sparkSession):
            slices = min(MAX_SLICES, entities.count() // SLICE_ROWS + 1)
    if slices > 1:
        out = _known_by_slices(entities, sources, entity_ts, groups, wanted, slices)
    else:
        for group in groups:
            out = as_known(out, sources, entity_ts, group, wanted)
    return out.select(*entities.columns, *[F.col(f"_{name}.{f}").alias(f) for name, own in wanted.items() for f in own])
