import datetime as dt

import pytest
from pyspark.sql import functions as F

from vitalgrid.functions.dt import ceil_hour, dt_diff, dt_trunc
from vitalgrid.functions.scalar import clean, extract, num, round_int, step_score, strict_greatest, strict_least


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize(("end", "start", "unit", "want"), [
    ("2031-07-09 12:00:00", "2031-07-09 11:59:59", "SECOND", 1), ("2031-07-09 12:00:00", "2031-07-09 11:59:59", "MINUTE", 1), ("2031-07-09 12:00:00", "2031-07-09 11:59:59", "HOUR", 1), ("2031-07-09 12:59:59", "2031-07-09 12:00:00", "MINUTE", 59),
    ("2032-03-01 00:00:00", "2032-02-28 23:59:00", "DAY", 2), ("2031-03-01 00:00:00", "2031-02-28 23:59:00", "DAY", 1), ("2032-02-29 08:00:00", "2031-02-28 09:00:00", "YEAR", 1), ("2032-02-29 08:00:00", "2031-02-28 09:00:00", "MONTH", 12),
    ("2031-01-01 00:00:00", "2030-12-31 23:59:59", "YEAR", 1), ("2030-12-31 23:59:59", "2031-01-01 00:00:00", "YEAR", -1), ("2030-11-30 00:00:00", "2031-02-01 00:00:00", "MONTH", -3), ("1969-12-31 23:30:00", "1970-01-01 00:10:00", "HOUR", -1),
    ("1969-12-31 23:59:59", "1969-12-31 22:00:00", "HOUR", 1), ("2031-07-09 12:00:00", "2031-07-12 11:00:00", "DAY", -3),
])
def test_boundaries_are_counted(spark, end, start, unit, want):
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    assert one(spark, dt_diff(at(end), at(start), unit), a=1) == want


def test_wall_clock_has_no_zone(spark):
    t = F.lit("2153-03-11 02:30:15").cast("timestamp_ntz")
    df = spark.range(1).select(dt_trunc(t, "HOUR").alias("h"), ceil_hour(t).alias("c"))
    assert [x for _, x in df.dtypes] == ["timestamp_ntz"] * 2
    assert df.first() == (dt.datetime(2153, 3, 11, 2), dt.datetime(2153, 3, 11, 3))


def test_rounding_and_nulls(spark):
    c = F.col
    assert one(spark, round_int(c("v")), v=2.5) == 3 and one(spark, round_int(c("v")), v=-2.5) == -3
    assert one(spark, num(c("v"), 2), v=1.005) == 1.01
    assert one(spark, strict_greatest(c("v"), F.lit(None), F.lit(3.0)), v=1.0) is None
    assert one(spark, strict_least(c("v"), F.lit(3.0)), v=1.0) == 1.0
    assert one(spark, extract(c("v"), "b(.)"), v="abcd") == "c" and one(spark, extract(c("v"), "z(.)"), v="abcd") is None
    assert one(spark, clean(c("v"), 0, 10), v=10.0) is None and one(spark, clean(c("v"), 0, 10, high_open=False), v=10.0) == 10.0
    assert one(spark, step_score([(c("v") > 5, 2), (c("v") > 1, 1)], 0, c("v").isNull()), v=3) == 1


def test_step_score_of_null(spark):
    df = spark.createDataFrame([(None,), (7,)], "v int")
    got = df.select(step_score([(F.col("v") > 5, 2)], 0, F.col("v").isNull()).alias("x")).collect()
    assert [r.x for r in got] == [None, 2]
