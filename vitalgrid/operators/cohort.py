"""Cohorts, summary tables and nested sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.operators.joins import anchored_join


def cohort_flags(df: DataFrame, exclusions: dict[str, Column]) -> DataFrame:
    """``df`` with a 0/1 column per exclusion and ``included``."""
    flags = {f"exclusion_{n}": F.coalesce(c, F.lit(False)).cast("int") for n, c in exclusions.items()}
    out = df.withColumns(flags)
    return out.withColumn("included", (F.greatest(*flags, F.lit(0)) == 0).cast("int"))


def funnel(flagged: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows left after each exclusion, in order, counted in one pass."""
    left = F.lit(True)
    aggs = [F.count("*").alias("all")]
    for n in order:
        left = left & (F.col(f"exclusion_{n}") == 0)
        aggs.append(F.count_if(left).alias(n))
    return flagged.agg(*aggs).unpivot([], ["all", *order], "step", "remaining")


def table_one(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """``variable, level, n, mean, sd, missing``: numerics with mean and deviation, categories with counts."""
    nums = df.select(*[F.col(c).cast("double").alias(c) for c in numeric]).unpivot([], list(numeric), "variable", "x")
    a = nums.groupBy("variable").agg(F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev("x").alias("sd"), F.count_if(F.col("x").isNull()).alias("missing"))
    cats = df.select(*[F.col(c).cast("string").alias(c) for c in categorical]).unpivot([], list(categorical), "variable", "level")
    b = cats.groupBy("variable", "level").agg(F.count("*").alias("n"), F.count_if(F.col("level").isNull()).alias("missing"))
    none = F.lit(None)
    return a.withColumn("level", none.cast("string")).unionByName(b.withColumns({"mean": none.cast("double"), "sd": none.cast("double")}))


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts per equal-width bin; 0 and ``bins + 1`` hold what lies outside."""
    return df.filter(F.col(value).isNotNull()).groupBy(F.width_bucket(F.col(value), F.lit(low), F.lit(high), F.lit(bins)).alias("bucket")).agg(F.count("*").alias("freq"))


def auroc(df: DataFrame, target: str, score: str, parts: int = 200) -> DataFrame:
    """Area under the ROC curve; ties count half.

    Scores are counted per distinct value and dealt into ranges between ``parts`` quantiles; running sums go over
    one range each, and over the few sums of the ranges.
    """
    by = df.filter(F.col(score).isNotNull()).groupBy(score).agg(F.sum(F.col(target).cast("double")).alias("p"), F.sum((1 - F.col(target)).cast("double")).alias("n"))
    cuts = by.agg(F.percentile_approx(score, [i / parts for i in range(1, parts)], 10 * parts)).first()[0] or []
    ranges = F.array(*[F.lit(c) for c in sorted(set(cuts))])
    by = by.withColumn("part", F.size(F.filter(ranges, lambda c: c < F.col(score))) if cuts else F.lit(0))
    sums = by.groupBy("part").agg(F.sum("n").alias("_n"))
    ahead = sums.withColumn("ahead", F.coalesce(F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    w = Window.partitionBy("part").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    ranked = by.join(F.broadcast(ahead.select("part", "ahead")), "part").withColumn("below", F.col("ahead") + F.coalesce(F.sum("n").over(w), F.lit(0.0)))
    total = ranked.agg(F.sum(F.col("p") * (F.col("below") + F.col("n") / 2)).alias("u"), F.sum("p").alias("pp"), F.sum("n").alias("nn"))
    return total.select(F.try_divide("u", F.col("pp") * F.col("nn")).alias("auroc"))


def scaled_histogram(df: DataFrame, value: str, low: float, high: float, bins: int, width: int) -> DataFrame:
    """A histogram with each bin's bar of at most ``width`` marks; the largest bin is found over the few bins."""
    bars = histogram(df, value, low, high, bins)
    most = bars.agg(F.max("freq").alias("_most"))
    return bars.join(F.broadcast(most)).withColumn("bar", F.repeat(F.lit("="), F.round(F.col("freq") * width / F.col("_most")).cast("int"))).drop("_most")


def item_counts(events: DataFrame, items: DataFrame, code: str, label: str) -> DataFrame:
    """Rows per item and its label; events are counted per code before they meet the items."""
    return items.select(code, label).join(events.groupBy(code).agg(F.count("*").alias("rows")), code, "left").withColumn("rows", F.coalesce("rows", F.lit(0)))


def labelled_events(items: DataFrame, sources: Sequence[tuple[DataFrame, str]], code: str, label: str, pattern: str) -> DataFrame:
    """Events of all ``sources`` (rows and the name of the time column) whose item's label matches ``pattern``."""
    chosen = F.broadcast(items.filter(F.lower(label).rlike(pattern)).select(code, label))
    out = None
    for df, at in sources:
        one = df.select("subject_id", "hadm_id", F.col(at).alias("charttime"), code).join(chosen, code)
        out = one if out is None else out.unionByName(one)
    return out


def flatten_resources(df: DataFrame, spec: dict) -> DataFrame:
    """Flat rows from nested resources.

    ``spec``: ``for_each`` (an array path, optional), ``where`` (field and value the element must have) and
    ``select`` (name to path; paths under the element begin with ``$``).
    """
    out, each = df, spec.get("for_each")
    if each:
        items = F.col(each)
        for field, value in spec.get("where", {}).items():
            items = F.filter(items, _has(field, value))
        out = out.withColumn("_item", F.explode(items))
    path = lambda p: F.col("_item." + p[2:]) if p.startswith("$.") else F.col(p)
    return out.select(*[path(p).alias(n) for n, p in spec["select"].items()])


def _has(field: str, value):
    return lambda x: x[field] == value


def short_values(metadata: Column, limit: int = 100) -> Column:
    """Map entries whose value is at most ``limit`` characters."""
    return F.map_filter(metadata, lambda k, v: F.length(v) <= limit)


def last_at_anchor(anchors: DataFrame, events: DataFrame, on: str, anchor: str, at: str, label: str, value: str, labels: Sequence[str], before: Column, after: Column, key: str) -> DataFrame:
    """``key`` and a column per label: the last value up to the anchor, or else the last one after it.

    Events count from ``before`` ahead of the anchor to ``after`` behind it.  All labels are taken in one pass: one join
    on ``on`` and the window, one aggregation; of values at one time the largest counts.  A last value that is
    null leaves the place to those after the anchor.
    """
    near = anchored_join(anchors.select(*dict.fromkeys([key, on, anchor])), events.select(on, at, label, value), [on], anchor, at, before, after, how="inner")
    late = F.col(at) > F.col(anchor)
    last = lambda x, phase: F.max(F.when((F.col(label) == x) & phase, F.struct(at, value)))[value]
    return near.groupBy(key).agg(*[F.coalesce(last(x, ~late), last(x, late)).alias(x) for x in labels])


def flag_within(anchors: DataFrame, spans: DataFrame, on: str, anchor: str, start: str, end: str, flags: dict[str, Column], key: str) -> DataFrame:
    """``key`` and 0/1 per flag: whether a span that began before the anchor and had not ended holds it."""
    held = anchors.select(*dict.fromkeys([key, on, anchor])).join(spans, on).filter((F.col(start) < F.col(anchor)) & (F.col(end).isNull() | (F.col(anchor) <= F.col(end))))
    return held.groupBy(key).agg(*[F.max(c.cast("int")).alias(n) for n, c in flags.items()])
