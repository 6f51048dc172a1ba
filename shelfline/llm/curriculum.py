"""Mixing sources to target weights along a time-varying curriculum.

1. Targets: sources share all words by weight; none gets more than ``max_repeats`` times its own
   words, and what one leaves is shared again by the others.
2. Each source is put in a fixed pseudo-random order and read round after round until its target is
   reached, so a document is taken 0 to ``max_repeats`` times.
3. A source's weight follows a schedule over training time t in [0, 1], linear between knots. Its
   integral, scaled to the source's target, is the cumulative demand; the inverse of the demand at
   the words taken so far is the time of a document, and times give positions in training order.

Sizes of all rows are summed; the running sums in a source are taken over slabs (see
``operators.ordered``), so a source with most rows is no bottleneck and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import WORD
from shelfline.operators import ordered
from shelfline.session import stage_table

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
#: Schedules by place in the order of sources, repeating like the weights: knots (time, weight).
SCHEDULES = (
    ((0.0, 0.6), (1.0, 1.4)),
    ((0.0, 1.4), (0.5, 1.0), (1.0, 0.6)),
    ((0.0, 1.0), (1.0, 1.0)),
)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, place, weight, source_size, target) from rows of (source, size).

    Sources are ordered by code point, null last. Water-filling: in the order of cap over weight, all
    sources from the first that fits under the common level on share what the earlier ones leave.
    """
    totals = stage_table(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    placed = ordered.global_rank(totals, [F.col("source").isNull().asc(), F.col("source").asc()], "_rank")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.pmod(F.col("_rank") - 1, F.lit(len(weights))).cast("int")).cast("long")
    w = placed.select("source", (F.col("_rank") - 1).alias("place"), weight.alias("weight"), "source_size", (F.col("source_size") * max_repeats).alias("cap"))
    ratio = F.col("cap").cast("double") / F.col("weight")
    run = ordered.running_totals(w, [ratio.asc(), F.col("place").asc()], {"cap_sum": F.col("cap"), "weight_sum": F.col("weight")})
    all_words = totals.agg(F.sum("source_size")).first()[0] or 0
    all_weight = w.agg(F.sum("weight")).first()[0] or 0
    left = F.lit(all_words) - (F.col("cap_sum") - F.col("cap"))
    share = F.lit(all_weight) - (F.col("weight_sum") - F.col("weight"))
    fits = left * F.col("weight") <= F.col("cap") * share
    # One row: what the first source that fits, and all behind it, share.
    level = run.where(fits).agg(F.min_by(left, F.struct(ratio, "place")), F.min_by(share, F.struct(ratio, "place"))).first()
    left, share = (F.lit(level[0] or 0), F.lit(level[1] or 1))
    first = left * F.col("weight")
    target = F.when(first > F.col("cap") * share, F.col("cap").cast("double")).otherwise(first.cast("double") / share)
    return run.select("source", "place", "weight", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS, schedules: Sequence = SCHEDULES) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken, position) for every row of (doc_id, text, source).

    Each source is read in the order of md5 of its doc_ids. Whole rounds come first; the last round takes
    documents as long as they fit into the target, and the gap is filled with short ones. ``position`` is
    the word offset in training order of the first copy, null when none is taken. Empty texts have
    size 0. Rows of one doc_id are separate documents next to each other. An empty table gives no rows.
    """
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = stage_table(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    targets = stage_table(source_targets(sized, weights, max_repeats), "targets")
    # A null source is a source of its own; joins and keys use a name that no source has.
    name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")).alias("_source")
    run = ordered.running_totals(sized.select("*", name, order.alias("_order")), [F.col("_order"), F.col("doc_id"), F.col("size")], {"_cum": F.col("size")}, keys=["_source"])
    run = run.join(targets.select(name, "source_size", "target", "place"), "_source")
    rounds = F.when(F.col("source_size") > 0, F.least(F.lit(max_repeats), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("long")
    run = stage_table(run.withColumn("copies", rounds).withColumn("_rest", F.col("target") - rounds * F.col("source_size")), "rounds")
    last = (F.col("copies") < max_repeats) & (F.col("size") > 0)
    fits = last & (F.col("_cum") <= F.col("_rest"))
    # What the last round leaves, less than one document, is filled with the shortest that are left.
    filled = run.groupBy("_source").agg((F.max("_rest") - F.coalesce(F.sum(F.when(fits, F.col("size"))), F.lit(0))).alias("_gap"))
    spare = run.where(last & ~fits).join(filled, "_source").where(F.col("size") <= F.col("_gap") * 2).select("_source", "_order", "doc_id", "size", "_cum", "_gap")
    fill = ordered.running_totals(spare, [F.col("size"), F.col("_order"), F.col("doc_id"), F.col("_cum")], {"_fill": F.col("size")}, keys=["_source"])
    fill = fill.where(F.col("_fill") * 2 - F.col("size") <= F.col("_gap") * 2).select("_source", F.col("_cum").alias("_at"), "_order", F.lit(1).alias("_filled"))
    same_place = (F.col("l._source") == F.col("r._source")) & (F.col("l._order") == F.col("r._order")) & (F.col("l._cum") == F.col("r._at")) & (F.col("l.size") > 0)
    taken = run.alias("l").join(fill.alias("r"), same_place, "left").select("l.*", "_filled")
    taken = taken.withColumn("copies", F.col("copies") + F.when(fits | F.col("_filled").isNotNull(), 1).otherwise(0)).withColumn("taken", F.col("copies") * F.col("size"))
    start = F.col("_cum") - F.col("size") / 2
    # Copy k of a document lies one whole round behind copy k - 1.
    copies = taken.where("taken > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    share = (start + F.col("copy") * F.col("source_size")) / F.greatest(F.col("target"), F.lit(1.0))
    timed = copies.select("doc_id", "_source", "_order", "size", "copy", demand_time(F.least(share, F.lit(1.0)), F.col("place"), schedules).alias("_time"))
    placed = ordered.running_totals(timed, [F.col("_time"), F.col("_source"), F.col("_order"), F.col("doc_id"), F.col("size")], {"_end": F.col("size")})
    first = placed.groupBy("_source", "doc_id", "size").agg(F.min(F.col("_end") - F.col("size")).alias("position"))
    same = ["_source", "doc_id", "size"]
    joined = taken.alias("l").join(first.alias("r"), F.expr(" AND ".join(f"l.{c} <=> r.{c}" for c in same)), "left")
    return joined.select("l.doc_id", "l.source", "l.size", "l.source_size", "l.target", "l.copies", "l.taken", F.when(F.col("l.taken") > 0, F.col("r.position")).alias("position"))


def demand_time(share: Column, place: Column, schedules: Sequence = SCHEDULES) -> Column:
    """Inverse of the integrated schedule: the time at which a source has given ``share`` of its words.

    In a segment the weight is linear, its integral quadratic, so the inverse is a closed form.
    """
    result = F.lit(1.0)
    for number, knots in enumerate(schedules):
        result = F.when(F.pmod(place, F.lit(len(schedules))) == number, _invert(share, knots)).otherwise(result)
    return result


def _invert(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    pieces = [(a, wa, b, wb, (b - a) * (wa + wb) / 2) for (a, wa), (b, wb) in zip(knots, knots[1:])]
    total = sum(p[4] for p in pieces)
    inverse, before = F.lit(float(knots[-1][0])), total
    for a, wa, b, wb, area in reversed(pieces):
        before -= area
        inside = share * total - before
        slope = (wb - wa) / (b - a)
        step = inside / wa if slope == 0 else (F.sqrt(F.greatest(F.lit(wa * wa) + inside * (2 * slope), F.lit(0.0))) - wa) / slope
        inverse = F.when(share * total <= before + area, F.lit(float(a)) + F.greatest(step, F.lit(0.0))).otherwise(inverse)
    return inverse


def schedule_weights(schedules: Mapping | Sequence) -> list[float]:
    """Mean weight over time of each schedule: the share it stands for."""
    return [sum((b - a) * (wa + wb) / 2 for (a, wa), (b, wb) in zip(k, k[1:])) for k in schedules]
