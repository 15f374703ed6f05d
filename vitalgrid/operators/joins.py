"""Interval, window and as-of joins: an equality key plus a residual on time.

The key spreads the work; no operator here forms a product of its sides beyond one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.functions.dt import MICROS, ceil_hour, dt_diff, hour_at, hours, micros, times_hours


def _keyed(left: DataFrame, right: DataFrame, on: Sequence[str], cond: Column, how: str) -> DataFrame:
    """Join on equal keys and ``cond`` over the aliases ``l`` and ``r``; the left side's key columns stay."""
    for c in on:
        cond = cond & (F.col(f"l.{c}") == F.col(f"r.{c}"))
    return left.alias("l").join(right.alias("r"), cond, how).drop(*[F.col(f"r.{c}") for c in on])


def _l(c: str) -> Column:
    return F.col(f"l.{c}")


def _r(c: str) -> Column:
    return F.col(f"r.{c}")


def bucket_of(at: Column, hours_wide: int) -> Column:
    """Number of the bucket of ``hours_wide`` hours that a time lies in."""
    return F.floor(micros(at) / (hours_wide * MICROS["HOUR"]))


def interval_join(
    points: DataFrame, intervals: DataFrame, on: Sequence[str], at: str, start: str, end: str, *, closed: str = "both", how: str = "inner", bucket_hours: int | None = 24,
) -> DataFrame:
    """Rows of ``points`` with the intervals their time ``at`` lies in; ``closed``: left, right, both or neither.

    The time's bucket is part of the equality key: an interval stands in each bucket it touches, a point in one, so
    points of one key meet only the intervals of their day and a key with very many rows spreads over its days.
    ``bucket_hours`` None pairs by ``on`` alone, for intervals that are long against what a key holds.
    """
    t = _l(at)
    low = t >= _r(start) if closed in ("left", "both") else t > _r(start)
    high = t <= _r(end) if closed in ("right", "both") else t < _r(end)
    if bucket_hours is None:
        return _keyed(points, intervals, on, low & high, how)
    reached = F.when(F.col(start) <= F.col(end), F.sequence(bucket_of(F.col(start), bucket_hours), bucket_of(F.col(end), bucket_hours)))
    dealt = intervals.withColumn("_bucket", F.explode(reached))
    return _keyed(points.withColumn("_bucket", bucket_of(F.col(at), bucket_hours)), dealt, [*on, "_bucket"], low & high, how).drop("_bucket")


def anchored_join(
    anchors: DataFrame, events: DataFrame, on: Sequence[str], anchor: str, at: str, before: Column, after: Column, *, how: str = "left",
) -> DataFrame:
    """Events within ``[anchor - before, anchor + after]`` of each anchor; anchors without any survive a left join.

    The bounds are columns of the anchors: worked out once an anchor, not for every pair of a key.
    """
    bounded = anchors.withColumns({"_from": F.col(anchor) - before, "_to": F.col(anchor) + after})
    return _keyed(bounded, events, on, (_r(at) >= _l("_from")) & (_r(at) <= _l("_to")), how).drop("_from", "_to")


def containment_join(inner: DataFrame, outer: DataFrame, on: Sequence[str], span: tuple[str, str], bounds: tuple[str, str], *, how: str = "left") -> DataFrame:
    """Segments with the outer intervals that contain them."""
    return _keyed(inner, outer, on, (_l(span[0]) >= _r(bounds[0])) & (_l(span[1]) <= _r(bounds[1])), how)


def overlap_join(a: DataFrame, b: DataFrame, on: Sequence[str], span_a: tuple[str, str], span_b: tuple[str, str], *, how: str = "inner") -> DataFrame:
    """Pairs of intervals that share at least one instant."""
    return _keyed(a, b, on, (_l(span_a[0]) <= _r(span_b[1])) & (_l(span_a[1]) >= _r(span_b[0])), how)


def hour_grid_join(grid: DataFrame, events: DataFrame, on: Sequence[str], grid_end: str, at: str, *, how: str = "left") -> DataFrame:
    """Events in ``(hour start, hour end]`` of a whole-hour grid, as an equality join on the hour's end."""
    dealt = events.withColumn("_hour", ceil_hour(F.col(at)))
    return _keyed(grid, dealt, on, _l(grid_end) == _r("_hour"), how).drop("_hour")


def covered_hours(spans: DataFrame, start: Column, end: Column, at: str, after: int = 0) -> DataFrame:
    """Each span once for every hour from ``start`` to ``end``, both whole hours, and ``after`` more, as ``at``; spans without one are dropped."""
    n = dt_diff(end, start, "HOUR") + after
    each = spans.filter(end >= start).withColumns({"_first": start, "_n": F.explode(F.sequence(F.lit(0).cast("long"), n))})
    return each.withColumn(at, F.col("_first") + times_hours(F.col("_n"))).drop("_first", "_n")


def hour_summary(readings: Sequence[DataFrame], key: str, at: str, end: str, **aggs: Column) -> DataFrame:
    """One row for each ``key`` and hour end that any of ``readings`` falls in, all kinds summarised by one aggregation.

    A table has the time ``at`` or, if it is dealt to hours already, their ``end``; a column that it lacks is null.
    """
    united = None
    for r in readings:
        one = (r if end in r.columns else r.withColumn(end, ceil_hour(F.col(at))).drop(at)).filter(F.col(key).isNotNull())
        united = one if united is None else united.unionByName(one, allowMissingColumns=True)
    return united.repartition(key).groupBy(key, end).agg(*[a.alias(n) for n, a in aggs.items()])


def grid_merge(grid: DataFrame, found: DataFrame, key: str, at: str, values: Sequence[str]) -> DataFrame:
    """``grid`` with ``values`` of the one row of ``found`` at its key and time; null where there is none.

    An ordered merge by ``key``: the grid is partitioned and sorted by key once and every later window over the key finds
    it so.  A grid that was made from rows dealt by ``key`` is not shuffled at all; only ``found`` is.
    """
    both = grid.withColumn("_grid", F.lit(1)).unionByName(found.select(key, at, *values, F.lit(0).alias("_grid")), allowMissingColumns=True)
    own = Window.partitionBy(key).orderBy(at, "_grid")
    same = F.lag(at).over(own) == F.col(at)
    merged = both.select(*grid.columns, "_grid", *[F.when(same, F.lag(v).over(own)).alias(v) for v in values])
    return merged.filter("_grid = 1").drop("_grid")


def trailing_hours(spans: DataFrame, found: DataFrame, key: str, start: str, n: str, at: str, value: str, width: int) -> DataFrame:
    """Each whole hour ``hr`` from 0, which is ``start``, to ``n`` of ``spans``, with ``value`` of the row of ``found`` there and, as ``last_<value>``, the bitwise or of ``width`` hours.

    Sorted are only the rows of ``found`` and the hours at which they leave the trailing frame, one start a span beside
    them; between two of these all hours are alike, so they are made last and in order.
    """
    h = F.col("_h")
    marks = found.select(key, F.explode(F.array(F.struct(bucket_of(F.col(at), 1).alias("h"), F.col(value).alias("v")), F.struct((bucket_of(F.col(at), 1) + width).alias("h"), F.lit(None).cast("long").alias("v")))).alias("_m"))
    marks = marks.select(key, F.col("_m.h").alias("_h"), F.col("_m.v").alias("_v"))
    begins = spans.select(key, bucket_of(F.col(start), 1).alias("_h"), bucket_of(F.col(start), 1).alias("_first"), (bucket_of(F.col(start), 1) + F.col(n)).alias("_last"))
    w = Window.partitionBy(key).orderBy("_h")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    runs = begins.unionByName(marks, allowMissingColumns=True).select(
        key, "_h", F.bit_or("_v").over(w.rangeBetween(0, 0)).alias("_now"), F.bit_or("_v").over(w.rangeBetween(1 - width, 0)).alias(f"last_{value}"), F.lead("_h").over(w).alias("_next"),
        *[F.last(c, ignorenulls=True).over(so_far).alias(c) for c in ("_first", "_last")],
    )
    low, high = F.greatest(h, "_first"), F.least(F.coalesce(F.col("_next") - 1, "_last"), "_last")
    known = F.col("_first").isNotNull() & (low <= high)
    each = runs.filter(known).withColumn("_x", F.explode(F.sequence(low, high)))
    x = F.col("_x")
    return each.select(key, (x - F.col("_first")).alias("hr"), hour_at(x).alias(at), F.when(x == h, F.col("_now")).alias(value), f"last_{value}")


def asof_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_at: str, right_at: str, values: Sequence[str], tolerance: int, *, bucket_hours: int = 24,
) -> DataFrame:
    """``left`` with ``values`` of the latest row of ``right`` at or before it, at most ``tolerance`` hours older.

    An ordered merge: both sides are shuffled once by key and bucket of time and sorted once, and the last row of
    ``right`` is carried along; no pairs are formed.  A row of ``right`` also stands in the next bucket where it is still
    valid there, so a key with very many rows spreads over its buckets.  Of rows at one time the one with the largest
    values counts.  Every row of ``left`` survives.
    """
    wide = max(bucket_hours, tolerance)
    own = bucket_of(F.col(right_at), wide)
    reached = F.explode(F.when(bucket_of(F.col(right_at) + hours(tolerance), wide) > own, F.array(own, own + 1)).otherwise(F.array(own)))
    seen = right.filter(F.col(right_at).isNotNull()).select(*on, reached.alias("_bucket"), F.col(right_at).alias("_at"), F.lit(0).alias("_side"), F.struct(F.col(right_at).alias("at"), *values).alias("_seen"))
    asked = left.withColumns({"_bucket": bucket_of(F.col(left_at), wide), "_at": F.col(left_at), "_side": F.lit(1)})
    merged = asked.unionByName(seen, allowMissingColumns=True)
    before = Window.partitionBy(*on, "_bucket").orderBy("_at", "_side", "_seen").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = merged.withColumn("_last", F.last("_seen", ignorenulls=True).over(before)).filter("_side = 1")
    near = F.col("_last.at") >= F.col(left_at) - hours(tolerance)
    return out.select(*left.columns, *[F.when(near, F.col(f"_last.{v}")).alias(v) for v in values])


def previous_within(df: DataFrame, keys: Sequence[str], at: str, values: Sequence[str], tolerance: Column) -> DataFrame:
    """Adds ``prev_<value>`` of the row before, null if it is not younger than ``tolerance``."""
    w = Window.partitionBy(*keys).orderBy(at)
    near = F.lag(at).over(w) > F.col(at) - tolerance
    return df.withColumns({f"prev_{v}": F.when(near, F.lag(v).over(w)) for v in values})


def anti_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right.select(*on).distinct(), list(on), "left_anti")


def flag_join(left: DataFrame, right: DataFrame, on: Sequence[str], flag: str) -> DataFrame:
    """``left`` with 1 or 0 whether its key is in ``right``."""
    keys = right.select(*on).distinct().withColumn(flag, F.lit(1))
    return left.join(keys, list(on), "left").withColumn(flag, F.coalesce(flag, F.lit(0)))


def full_outer_merge(a: DataFrame, b: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """One value per key from two variants, the first preferred."""
    x = a.select(*on, F.col(value).alias("_a"))
    y = b.select(*on, F.col(value).alias("_b"))
    return x.join(y, list(on), "full").select(*on, F.coalesce("_a", "_b").alias(value))


def cooccurrence(df: DataFrame, entity: str, code: str, first, second) -> DataFrame:
    """Entities that have both codes."""
    return df.filter(F.col(code).isin(first, second)).groupBy(entity).agg(F.count_distinct(code).alias("n")).filter("n = 2").select(entity)
