"""Conditional-aggregate pivots from declared columns.

A declared column names its codes, plausible ranges and unit factors once; the Spark aggregate and
the SQL text of the oracle are both made from it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Part:
    """Readings of ``codes`` inside a range, as ``(value + add) * times / over``."""

    codes: tuple[int, ...]
    above: float | None = None  # exclusive
    least: float | None = None  # inclusive
    below: float | None = None  # exclusive
    most: float | None = None  # inclusive
    add: float = 0.0
    times: float = 1.0
    over: float = 1.0
    text: str | None = None  # only readings of this text, which count as ``const``
    const: float | None = None


@dataclass(frozen=True)
class Item:
    name: str
    parts: tuple[Part, ...]
    agg: str = "max"
    field: str = "valuenum"
    digits: int | None = None


def item(name: str, *codes: int, agg: str = "max", field: str = "valuenum", digits: int | None = None, **bounds) -> Item:
    return Item(name, (Part(tuple(codes), **bounds),), agg, field, digits)


BOUNDS = (("above", ">"), ("least", ">="), ("below", "<"), ("most", "<="))


def _value(p: Part, field: str) -> Column:
    if p.const is not None:
        return F.lit(p.const)
    v = F.col(field)
    if p.add:
        v = v + p.add
    if p.times != 1.0:
        v = v * p.times
    return v / p.over if p.over != 1.0 else v


def _cond(p: Part, field: str) -> Column:
    v = F.col(field)
    cond = F.col("itemid").isin(list(p.codes))
    tests = {">": v.__gt__, ">=": v.__ge__, "<": v.__lt__, "<=": v.__le__}
    for name, op in BOUNDS:
        if (bound := getattr(p, name)) is not None:
            cond = cond & tests[op](F.lit(bound))
    return cond & (F.col("value") == p.text) if p.text is not None else cond


def column(it: Item) -> Column:
    first, *rest = it.parts
    chain = F.when(_cond(first, it.field), _value(first, it.field))
    for p in rest:
        chain = chain.when(_cond(p, it.field), _value(p, it.field))
    out = {"max": F.max, "min": F.min, "avg": F.avg, "sum": F.sum}[it.agg](chain)
    if it.digits is not None:
        out = F.round(out.cast("decimal(38,9)"), it.digits).cast("double")
    return out.alias(it.name)


def column_sql(it: Item) -> str:
    cases = []
    for p in it.parts:
        cond = [f"itemid IN ({', '.join(map(str, p.codes))})"]
        cond += [f"{it.field} {op} {getattr(p, name)}" for name, op in BOUNDS if getattr(p, name) is not None]
        if p.text is not None:
            cond.append(f"value = '{p.text}'")
        v = it.field if not p.add else f"({it.field} + CAST({p.add} AS DOUBLE))"
        v = v if p.times == 1.0 else f"{v} * CAST({p.times} AS DOUBLE)"
        v = v if p.over == 1.0 else f"{v} / CAST({p.over} AS DOUBLE)"
        v = v if p.const is None else f"CAST({p.const} AS DOUBLE)"
        cases.append(f"WHEN {' AND '.join(cond)} THEN {v}")
    out = f"{it.agg}(CASE {' '.join(cases)} END)"
    if it.digits is not None:
        out = f"CAST(round(CAST({out} AS DECIMAL(38,9)), {it.digits}) AS DOUBLE)"
    return f"{out} AS {it.name}"


def codes_of(items: Sequence[Item]) -> list[int]:
    return sorted({c for it in items for p in it.parts for c in p.codes})


def pivot(events: DataFrame, keys: Sequence[str], carry: Sequence[str], items: Sequence[Item], where: Column | None = None) -> DataFrame:
    """One row per ``keys``: the largest of each ``carry`` column and the declared items.

    Only the declared codes are read; the list reaches the scan as a pushed filter.
    """
    rows = events.filter(F.col("itemid").isin(codes_of(items)))
    if where is not None:
        rows = rows.filter(where)
    return rows.groupBy(*keys).agg(*[F.max(c).alias(c) for c in carry], *[column(it) for it in items])


def pivot_sql(table: str, keys: Sequence[str], carry: Sequence[str], items: Sequence[Item], where: str = "TRUE") -> str:
    cols = [*keys, *[f"max({c}) AS {c}" for c in carry], *[column_sql(it) for it in items]]
    return (
        f"SELECT {', '.join(cols)} FROM {table} WHERE itemid IN ({', '.join(map(str, codes_of(items)))}) AND ({where}) "
        f"GROUP BY {', '.join(keys)}"
    )


def summary(df: DataFrame, keys: Sequence[str], columns: dict[str, str], stats: Sequence[str] = ("min", "max")) -> DataFrame:
    """One row per key with ``<name>_<stat>`` of each column."""
    f = {"min": F.min, "max": F.max, "mean": F.avg}
    return df.groupBy(*keys).agg(*[f[s](c).alias(f"{n}_{s}") for c, n in columns.items() for s in stats])


def summary_sql(columns: dict[str, str], stats: Sequence[str] = ("min", "max")) -> str:
    f = {"min": "min", "max": "max", "mean": "avg"}
    return ", ".join(f"{f[s]}({c}) AS {n}_{s}" for c, n in columns.items() for s in stats)
