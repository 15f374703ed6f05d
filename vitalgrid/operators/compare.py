"""Validation and comparison of tables, as Spark jobs."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RTOL, ATOL, SECONDS = 1e-3, 1e-6, 1


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("observed")).select(F.lit(name).alias("tbl"), "observed")
        out = one if out is None else out.unionByName(one)
    return out


def expected_row_counts(expected: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """``tbl, expected, observed, status`` for every expected table."""
    both = expected.join(row_counts(tables), "tbl", "left")
    return both.select("tbl", "expected", "observed", F.when(F.col("expected") == F.col("observed"), "PASSED").otherwise("FAILED").alias("status"))


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that are not unique, with their counts."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Number of non-null references of ``child`` without a row in ``parent``."""
    keys = parent.select(F.col(parent_key).alias("_k")).distinct()
    missing = child.filter(F.col(child_key).isNotNull()).join(keys, F.col(child_key) == F.col("_k"), "left_anti")
    return missing.agg(F.count("*").alias("orphans"))


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break each rule (a condition that must hold), counted in one pass."""
    counts = df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()])
    return counts.unpivot([], list(rules), "rule", "broken")


def natural_key(df: DataFrame, anchor: Sequence[str], width: int = 3) -> list[str] | None:
    """Smallest unique set of columns without nulls that holds an ``anchor`` column.

    Candidates of one size are screened together by sketches of their distinct hashes, which does not multiply the rows;
    those that may be unique are counted exactly, one after the other.
    """
    total, *nulls = df.agg(F.count("*"), *[F.count_if(F.col(c).isNull()) for c in df.columns]).first()
    usable = [c for c, n in zip(df.columns, nulls, strict=True) if n == 0]
    for size in range(1, width + 1):
        sets = [s for s in combinations(usable, size) if any(a in s for a in anchor)]
        if not sets:
            continue
        about = df.agg(*[F.approx_count_distinct(F.xxhash64(*s), 0.02).alias(str(i)) for i, s in enumerate(sets)]).first()
        for s, n in zip(sets, about, strict=True):
            if n >= 0.85 * total and duplicates(df, s).isEmpty():
                return list(s)
    return None


def content_hash(df: DataFrame) -> DataFrame:
    """Order-free hash of all rows: the sum of row hashes, so that repeated rows count."""
    cols = sorted(df.columns)
    return df.agg(F.count("*").alias("rows"), F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).alias("hash"))


def logical_class(t: T.DataType) -> str:
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integer"
    if isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "numeric"
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    return t.simpleString()


WIDER = {("integer", "numeric"), ("numeric", "integer"), ("date", "datetime"), ("datetime", "date")}


def schema_differences(left: DataFrame, right: DataFrame) -> list[tuple[str, str, str]]:
    """Columns missing on a side or of incompatible classes: ``(column, left class, right class)``."""
    a = {f.name: logical_class(f.dataType) for f in left.schema}
    b = {f.name: logical_class(f.dataType) for f in right.schema}
    out = []
    for name in sorted(a.keys() | b.keys()):
        x, y = a.get(name, "missing"), b.get(name, "missing")
        if x != y and (x, y) not in WIDER:
            out.append((name, x, y))
    return out


def equal_within(a: Column, b: Column, kind: str) -> Column:
    """Null-safe equality; numbers within tolerance, times within a second."""
    if kind in ("numeric", "integer"):
        close = F.abs(a - b) <= F.greatest(F.lit(ATOL), RTOL * F.greatest(F.abs(a), F.abs(b)))
    elif kind == "datetime":
        close = F.abs(F.unix_micros(a.cast("timestamp")) - F.unix_micros(b.cast("timestamp"))) <= SECONDS * 1_000_000
    else:
        return a.eqNullSafe(b)
    return F.coalesce(close, a.isNull() & b.isNull())


def keyed_diff(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows only on a side, identical rows, rows that differ by nulls or by values, and a count per column."""
    values = [c for c in left.columns if c not in key and c in right.columns]
    kinds = {f.name: logical_class(f.dataType) for f in left.schema}
    a = left.select(*key, F.struct(*values).alias("_a"))
    b = right.select(*key, F.struct(*values).alias("_b"))
    both = a.join(b, list(key), "full")
    present = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    same = {c: equal_within(F.col(f"_a.{c}"), F.col(f"_b.{c}"), kinds[c]) for c in values}
    null_only = {c: F.col(f"_a.{c}").isNull() != F.col(f"_b.{c}").isNull() for c in values}
    every, conflict = F.lit(True), F.lit(False)
    for c in values:
        every = every & same[c]
        conflict = conflict | (~same[c] & ~null_only[c])
    return both.agg(
        F.count_if(F.col("_b").isNull()).alias("only_left"), F.count_if(F.col("_a").isNull()).alias("only_right"),
        F.count_if(present & every).alias("identical"), F.count_if(present & ~every & ~conflict).alias("differing_null_only"),
        F.count_if(present & conflict).alias("differing_conflict"), *[F.count_if(present & ~same[c]).alias(f"differs_{c}") for c in values],
    )


def multiset_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one table beyond those of the other, each as often as it is in excess."""
    a = left.exceptAll(right.select(left.columns)).withColumn("side", F.lit("left"))
    b = right.select(left.columns).exceptAll(left).withColumn("side", F.lit("right"))
    return a.unionByName(b)


def residual_columns(left: DataFrame, right: DataFrame, width: int = 2) -> list[str] | None:
    """Smallest set of columns without which both tables are equal as multisets.

    Sums of row hashes tell in one pass of each table which sets can be it; the first of these is verified.
    """
    drops = [d for size in range(width + 1) for d in combinations(left.columns, size) if size < len(left.columns)]
    kept = [[c for c in left.columns if c not in d] for d in drops]

    def hashes(df: DataFrame) -> list:
        return list(df.agg(F.count("*"), *[F.sum(F.xxhash64(*k).cast("decimal(38,0)")).alias(str(i)) for i, k in enumerate(kept)]).first())

    a, b = hashes(left), hashes(right)
    if a[0] != b[0]:
        return None
    for d, k, x, y in zip(drops, kept, a[1:], b[1:], strict=True):
        if x == y and multiset_diff(left.select(k), right.select(k)).isEmpty():
            return list(d)
    return None


def diff_samples(left: DataFrame, right: DataFrame, key: Sequence[str], n: int = 5) -> DataFrame:
    """Up to ``n`` keys of each class of difference: ``only_left``, ``only_right``, ``null_only`` and ``conflict``.

    Each class is its own bounded sample of the smallest keys, so no class is ranked as a whole.
    """
    values = [c for c in left.columns if c not in key and c in right.columns]
    kinds = {f.name: logical_class(f.dataType) for f in left.schema}
    both = left.select(*key, F.struct(*values).alias("_a")).join(right.select(*key, F.struct(*values).alias("_b")), list(key), "full")
    same = [equal_within(F.col(f"_a.{c}"), F.col(f"_b.{c}"), kinds[c]) for c in values]
    nulls = [F.col(f"_a.{c}").isNull() != F.col(f"_b.{c}").isNull() for c in values]
    every, conflict = F.lit(True), F.lit(False)
    for s, x in zip(same, nulls, strict=True):
        every, conflict = every & s, conflict | (~s & ~x)
    kind = F.when(F.col("_b").isNull(), "only_left").when(F.col("_a").isNull(), "only_right").when(~every & ~conflict, "null_only").when(conflict, "conflict")
    marked = both.select(*key, kind.alias("difference"))
    out = None
    for name in ("only_left", "only_right", "null_only", "conflict"):
        one = marked.filter(F.col("difference") == name).orderBy(*key).limit(n)
        out = one if out is None else out.unionByName(one)
    return out


def rounded_diff(left: DataFrame, right: DataFrame, digits: int = 6) -> DataFrame:
    """``multiset_diff`` of two tables, or of the results of two variants of a query, with numbers rounded first."""

    def plain(df: DataFrame) -> DataFrame:
        return df.select(*[F.round(c, digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.select(left.columns).dtypes])

    return multiset_diff(plain(left), plain(right))


def missing_or_empty(expected: Sequence[str], tables: dict[str, DataFrame]) -> DataFrame:
    """``tbl, status`` of every expected table: present, empty or missing; one row of each is read."""
    spark = next(iter(tables.values())).sparkSession
    status = [(name, "missing" if name not in tables else "empty" if tables[name].isEmpty() else "present") for name in expected]
    return spark.createDataFrame(status, "tbl string, status string")


def all_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per declared-unavailable column the number of values that are there after all."""
    return df.agg(*[F.count(c).alias(c) for c in columns]).unpivot([], list(columns), "column", "present")


def zone_shift_explains(left: Column, right: Column, zone: str) -> Column:
    """Whether ``right`` is ``left`` read as a wall clock of ``zone`` where that hour does not exist."""
    replay = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.convert_timezone(F.lit(zone), F.lit("UTC"), left))
    return (replay == right) & (left != right)


def classify(diff_row: dict) -> str:
    """match, review (nulls only) or mismatch, of the one row of ``keyed_diff``."""
    if diff_row["only_left"] or diff_row["only_right"] or diff_row["differing_conflict"]:
        return "mismatch"
    return "review" if diff_row["differing_null_only"] else "match"


TIERS = (("minor", 0.001), ("moderate", 0.01), ("major", 1.0))


def tier(diff_row: dict, tiers: Sequence[tuple[str, float]] = TIERS) -> str | None:
    """The first tier whose share of all keys the keys that differ stay within; None without any."""
    off = sum(diff_row[c] for c in ("only_left", "only_right", "differing_conflict", "differing_null_only"))
    return next((name for name, most in tiers if off <= most * (off + diff_row["identical"])), tiers[-1][0]) if off else None


def manifest(tables: dict[str, DataFrame], anchor: Sequence[str]) -> DataFrame:
    """Per table its rows, columns, key and hash."""
    out = None
    for name, df in tables.items():
        key = natural_key(df, anchor, 2)
        one = content_hash(df).select(
            F.lit(name).alias("tbl"), "rows", F.lit(len(df.columns)).alias("columns"), F.lit(",".join(key) if key else None).cast("string").alias("key"),
            F.lit("keyed" if key else "multiset").alias("mode"), F.col("hash").cast("string").alias("hash"),
        )
        out = one if out is None else out.unionByName(one)
    return out
