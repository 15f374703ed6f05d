"""Scalar semantics that differ between engines, stated once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def num(x: Column, digits: int) -> Column:
    """Round half up in decimal(38, 9), as a double."""
    return F.round(x.cast("decimal(38,9)"), digits).cast("double")


def round_int(x: Column) -> Column:
    """Nearest integer, halves away from zero (a plain cast would cut off)."""
    return F.round(x).cast("long")


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """First match, or null where there is none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def strict_greatest(*columns: Column) -> Column:
    """Greatest value, null if any is null."""
    return F.when(_any_null(columns), None).otherwise(F.greatest(*columns))


def strict_least(*columns: Column) -> Column:
    return F.when(_any_null(columns), None).otherwise(F.least(*columns))


def _any_null(columns: Sequence[Column]) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | c.isNull()
    return out


def contains_any(text: Column, terms: Sequence[str]) -> Column:
    """Case-blind substring test for any of ``terms``, as one pattern."""
    import re

    return F.lower(text).rlike("|".join(re.escape(t.lower()) for t in terms))


def clean(value: Column, low: float | None = None, high: float | None = None, *, low_open=True, high_open=True, scale: float = 1.0, offset: float = 0.0) -> Column:
    """``(value + offset) * scale`` within plausible bounds, null outside."""
    ok = F.lit(True)
    if low is not None:
        ok = ok & ((value > low) if low_open else (value >= low))
    if high is not None:
        ok = ok & ((value < high) if high_open else (value <= high))
    out = value if offset == 0.0 else value + offset
    return F.when(ok, out if scale == 1.0 else out * scale)


def step_score(cases: Sequence[tuple[Column, int]], otherwise: int | None = 0, null_if: Column | None = None) -> Column:
    """Points of the first condition that holds; null where ``null_if``."""
    first, *rest = cases
    out = F.when(null_if, F.lit(None)) if null_if is not None else F.when(first[0], F.lit(first[1]))
    for cond, points in rest if null_if is None else cases:
        out = out.when(cond, F.lit(points))
    return out.otherwise(F.lit(otherwise)).cast("int")


def pack_points(points: Sequence[str], top: int = 4, first: int = 0) -> Column:
    """Points from 0 to ``top`` of several parts in one number: ``p`` low bits of a part's ``top`` + 1 are set, the last if known.

    The bitwise or of such numbers holds the largest points of each part, so one aggregate serves all parts.
    ``first`` is the place of the first part given; a number holds as many as fit 63 bits.
    """
    out = F.lit(0).cast("long")
    for i, p in enumerate(points, first):
        bits = F.call_function("shiftleft", F.lit(1).cast("long"), F.col(p)) - 1 + (1 << top)
        out = out.bitwiseOR(F.coalesce(F.shiftleft(bits, i * (top + 1)), F.lit(0).cast("long")))
    return out


def unpack_points(packed: Column, part: int, top: int = 4) -> Column:
    """Points of a part from ``pack_points``, null if unknown."""
    bits = F.shiftright(packed, part * (top + 1)).bitwiseAND(F.lit((1 << top + 1) - 1))
    return F.when(bits > 0, F.bit_count(bits) - 1).cast("int")


def logistic(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))
