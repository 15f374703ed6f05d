"""Episodes, segments and grids from time-stamped rows.

All operators are chains of windows over one key, so they share one shuffle and one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.functions.dt import MICROS, ceil_hour, dt_diff, hours, micros, times_hours


def hourly_spine(df: DataFrame, start: str, end: str, keys: Sequence[str], *, lead_hours: int = 24, grid: str = "endtime") -> DataFrame:
    """One row per hour, from ``lead_hours`` before ``start`` to ``end``; ``grid`` falls on whole hours."""
    n = dt_diff(F.col(end), F.col(start), "HOUR")
    out = df.filter(n >= -lead_hours).select(*keys, ceil_hour(F.col(start)).alias("_t"), F.explode(F.sequence(F.lit(-lead_hours).cast("long"), n)).alias("hr"))
    return out.select(*keys, "hr", (F.col("_t") + times_hours(F.col("hr"))).alias(grid))


def day_spine(df: DataFrame, start: str, end: str, keys: Sequence[str]) -> DataFrame:
    """One row per day with its index from the start and from the end; both ends clipped."""
    n = dt_diff(F.col(end), F.col(start), "DAY").cast("int")
    out = df.filter(n >= 0).withColumn("day", F.explode(F.sequence(F.lit(0), n)))
    first = F.date_add(F.col(start).cast("date"), F.col("day")).cast("timestamp_ntz")
    return out.select(
        *keys, "day", (n - F.col("day")).alias("days_left"), F.greatest(first, F.col(start)).alias("day_start"),
        F.least(first + F.expr("INTERVAL '1' DAY"), F.col(end)).alias("day_end"),
    )


def sessionize(
    df: DataFrame, keys: Sequence[str], at: str, *, gap_hours: int, state: str | None = None, order: Sequence[str] = (), number: str = "episode",
) -> DataFrame:
    """Episodes of consecutive rows: a new one after a gap of ``gap_hours`` (boundaries) or a change of ``state``.

    An episode ends at the next row's time, unless a gap follows; then at its own last row.
    """
    w = Window.partitionBy(*keys).orderBy(at, *order)
    before, after = F.lag(at).over(w), F.lead(at).over(w)
    new = before.isNull() | (dt_diff(F.col(at), before, "HOUR") >= gap_hours)
    if state:
        new = new | ~F.lag(state).over(w).eqNullSafe(F.col(state))
    stop = F.when(after.isNull() | (dt_diff(after, F.col(at), "HOUR") >= gap_hours), F.col(at)).otherwise(after)
    marked = df.withColumns({"_new": new.cast("int"), "_stop": stop})
    numbered = marked.withColumn(number, F.sum("_new").over(w))
    aggs = [F.min(at).alias("starttime"), F.max("_stop").alias("endtime")] + ([F.max(state).alias(state)] if state else [])
    return numbered.groupBy(*keys, number).agg(*aggs)


def forward_fill(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, into: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(into, F.last(value, ignorenulls=True).over(w))


def merge_overlaps(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Union of touching or overlapping intervals per key."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    stepped = df.withColumn("_reach", reach)
    stepped = stepped.withColumn("_island", F.sum(F.when(F.col("_reach") >= F.col(start), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return stepped.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def merge_adjacent_equal(df: DataFrame, keys: Sequence[str], start: str, end: str, same: str, total: str) -> DataFrame:
    """Abutting segments of equal ``same`` become one; ``total`` is summed."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    joined = F.lag(end).over(w).eqNullSafe(F.col(start)) & F.lag(same).over(w).eqNullSafe(F.col(same))
    marked = df.withColumn("_new", F.when(joined, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_run", same).agg(F.min(start).alias(start), F.max(end).alias(end), F.sum(total).alias(total)).drop("_run")


def elementary_segments(tables: Sequence[DataFrame], key: str, start: str = "starttime", end: str = "endtime") -> DataFrame:
    """Segments between neighbouring ends of all intervals of a key."""
    cuts = None
    for t in tables:
        for edge in (start, end):
            one = t.select(key, F.col(edge).alias(start))
            cuts = one if cuts is None else cuts.unionByName(one)
    w = Window.partitionBy(key).orderBy(start)
    return cuts.distinct().withColumn(end, F.lead(start).over(w)).filter(F.col(end).isNotNull())


def attach_values(segments: DataFrame, named: dict[str, DataFrame], key: str, value: str, start: str = "starttime", end: str = "endtime") -> DataFrame:
    """Per segment the value of each table's interval that contains it.

    All tables are united, so there is one range join and one pivoting aggregation instead of a join for each.
    Where a table has several such intervals every combination is a row, as with one left join after the other.
    """
    united = None
    for name, t in named.items():
        one = t.select(F.col(key).alias("_k"), F.col(start).alias("_s"), F.col(end).alias("_e"), F.col(value).cast("double").alias("_v"), F.lit(name).alias("_n"))
        united = one if united is None else united.unionByName(one)
    cond = (segments[key] == united["_k"]) & (segments[start] >= united["_s"]) & (segments[end] <= united["_e"])
    wide = segments.join(united, cond, "left").groupBy(key, start, end).agg(
        *[F.collect_list(F.when(F.col("_n") == n, F.struct("_v"))).alias(n) for n in named]
    )
    for n in named:
        wide = wide.withColumn(n, F.explode_outer(n)).withColumn(n, F.col(f"{n}._v"))
    return wide


def ownership_windows(stays: DataFrame, subject: str, stay: str, intime: str, outtime: str, *, pad_hours: int = 12, units: tuple[str, str] = ("SECOND", "SECOND")) -> DataFrame:
    """Window of each stay in which its subject's events are the stay's: up to half the gap to its neighbours, else the pad.

    Half a gap is counted and rounded in ``units``, before and after the stay.
    """
    w = Window.partitionBy(subject).orderBy(intime, stay)
    prev_out, next_in = F.lag(outtime).over(w), F.lead(intime).over(w)

    def half(a: Column, b: Column, unit: str) -> Column:
        return F.make_dt_interval(secs=F.round(dt_diff(b, a, unit) / 2) * (MICROS[unit] // MICROS["SECOND"]))

    near_before = prev_out.isNotNull() & (prev_out > F.col(intime) - hours(2 * pad_hours))
    near_after = next_in.isNotNull() & (next_in < F.col(outtime) + hours(2 * pad_hours))
    return stays.select(
        subject, stay, intime, outtime,
        F.when(near_before, F.col(intime) - half(prev_out, F.col(intime), units[0])).otherwise(F.col(intime) - hours(pad_hours)).alias("data_start"),
        F.when(near_after, F.col(outtime) + half(F.col(outtime), next_in, units[1])).otherwise(F.col(outtime) + hours(pad_hours)).alias("data_end"),
    )


def consolidate_orders(df: DataFrame, keys: Sequence[str], link: str, start: str, end: str) -> DataFrame:
    """Rows of one linked order as one interval."""
    return df.groupBy(*keys, link).agg(F.min(start).alias(start), F.max(end).alias(end))


def to_increments(df: DataFrame, keys: Sequence[str], at: str, value: str, into: str) -> DataFrame:
    """Difference of a running total to the row before; the first row and a falling total keep the value itself."""
    w = Window.partitionBy(*keys).orderBy(at)
    step = F.col(value) - F.lag(value).over(w)
    return df.withColumn(into, F.when(step.isNull() | (step < 0), F.col(value)).otherwise(step))


def since_previous(df: DataFrame, keys: Sequence[str], at: str, unit: str, into: str, first: Column) -> DataFrame:
    """Boundaries of ``unit`` since the row before; ``first`` for the first row of a key."""
    w = Window.partitionBy(*keys).orderBy(at)
    return df.withColumn(into, F.coalesce(dt_diff(F.col(at), F.lag(at).over(w), unit), first))


def trailing_window(keys: Sequence[str], at: str, seconds: int, *, include_now: bool = True):
    """Window of the last ``seconds`` of a key, in exact microseconds."""
    return Window.partitionBy(*keys).orderBy(micros(F.col(at))).rangeBetween(-seconds * 1_000_000, 0 if include_now else -1)


def infusion_episodes(df: DataFrame, keys: Sequence[str], at: str, rate: str, stopped: str) -> DataFrame:
    """Running periods of an infusion from rate readings and stop marks.

    A period begins with a positive rate after nothing, a zero rate or a stop; a null rate keeps the
    last known one; it ends at the first zero rate or stop, else at the last reading.
    """
    w = Window.partitionBy(*keys).orderBy(at)
    to_here = w.rowsBetween(Window.unboundedPreceding, 0)
    filled = df.withColumn("_rate", F.last(rate, ignorenulls=True).over(to_here))
    running = (F.coalesce("_rate", F.lit(0.0)) > 0) & (F.coalesce(F.col(stopped), F.lit(0)) == 0)
    on = filled.withColumn("_on", running.cast("int"))
    on = on.withColumn("_was", F.coalesce(F.lag("_on").over(w), F.lit(0)))
    runs = on.withColumn("_run", F.sum(F.when((F.col("_on") == 1) & (F.col("_was") == 0), 1).otherwise(0)).over(to_here))
    inside = runs.filter((F.col("_on") == 1) | (F.col("_was") == 1))
    return inside.groupBy(*keys, F.col("_run").alias("episode")).agg(
        F.min(at).alias("starttime"), F.max(at).alias("endtime"), F.max("_rate").alias("max_rate")
    )


def slot_episodes(df: DataFrame, keys: Sequence[str], at: str, state: str, gone: str, by: Sequence[str], gap_hours: int) -> DataFrame:
    """``keys``, ``by``, ``starttime`` and ``endtime`` of what numbered slots held.

    A slot's episode ends where its ``state`` changes or is unknown, where the row before was marked ``gone``, and after
    ``gap_hours`` without a row; rows that are not marked 0 only end episodes.
    """
    w = Window.partitionBy(*keys).orderBy(at)
    goes_on = (F.lag(state).over(w) == F.col(state)) & (dt_diff(F.col(at), F.lag(at).over(w), "HOUR") < gap_hours)
    new = F.coalesce(F.lag(gone).over(w) == 1, F.lit(False)) | ~F.coalesce(goes_on, F.lit(False))
    numbered = df.withColumn("_new", new.cast("int")).withColumn("_episode", F.sum("_new").over(w))
    return numbered.filter(F.col(gone) == 0).groupBy(*keys, "_episode", *by).agg(F.min(at).alias("starttime"), F.max(at).alias("endtime")).drop("_episode")
