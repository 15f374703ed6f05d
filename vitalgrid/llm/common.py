"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import re
import string
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ASCII white space: space and the five controls from tab to carriage return.
WS_CHARS = " \t\n\x0b\x0c\r"
WS = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one only where none is set and one machine runs everything."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="vitalgrid-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_scopes: list[list[str]] = []


def materialize(df: DataFrame, *, outer: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends there, for all executors.

    Inside ``scratch`` the folder goes when the block ends, with ``outer`` when the block around it does.
    """
    path = f"{shared_dir(df.sparkSession)}/vitalgrid-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if len(_scopes) > outer:
        _scopes[-1 - outer].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What ``materialize`` writes inside the block is deleted at its end."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def give_back() -> None:
    """Free memory of this process goes back to the machine; Python workers wait for further tasks with what they hold."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def released(run):
    """``run`` for ``mapInArrow``, after which the worker gives its memory back."""

    def inner(batches):
        yield from run(batches)
        give_back()

    return inner


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for what runs inside the block; long texts make batches of many rows large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


BROADCAST_BYTES = 32_000_000


def small_side(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (already materialised) marked for broadcast if all its values take at most ``max_bytes``.

    Beyond the bound it is returned unmarked, and Spark shuffles the join.
    """

    def width(f: T.StructField) -> Column:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return 16 + F.coalesce(F.octet_length(f.name), F.lit(0))
        if isinstance(f.dataType, T.ArrayType):
            return 16 + 8 * F.greatest(F.coalesce(F.size(f.name), F.lit(0)), F.lit(0))
        return F.lit(8)

    row = sum((width(f) for f in df.schema), F.lit(16))
    return F.broadcast(df) if (df.agg(F.sum(row)).first()[0] or 0) <= max_bytes else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns, none of which ``df`` has."""
    held = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in held:
            name = "_" + name
        held.add(name.lower())
        out.append(name)
    return out


def words_of(text: Column) -> Column:
    """Array of the maximal runs without ASCII white space; null and blank texts give an empty array."""
    parts = F.split(F.coalesce(text, F.lit("")), WS)
    edge = (F.get(parts, 0) == "") | (F.element_at(parts, -1) == "")
    return F.when(edge, F.array_remove(parts, "")).otherwise(parts)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def shingle_hash(words: Column, i: Column, k: int) -> Column:
    """64-bit hash of the ``k`` words from position ``i`` (from 0)."""
    return F.xxhash64(*[F.get(words, i + j) for j in range(k)])


def lower_but_ascii(text: Column) -> Column:
    """``text`` in lower case, of which no ASCII letter was anything but one before.

    Two letters of other scripts have ASCII ones in their lower case (the Kelvin sign and the dotted I); they stay.
    """
    odd = text.contains("\u212a") | text.contains("\u0130")
    return F.when(odd, F.translate(text, string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.lower(text))


def alnum_words(text: Column, lower=F.lower) -> Column:
    """Array of lower-cased words of ASCII letters, digits and all non-ASCII characters."""
    parts = F.split(lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    edge = (F.get(parts, 0) == "") | (F.element_at(parts, -1) == "")
    return F.when(edge, F.array_remove(parts, "")).otherwise(parts)


def exploded_shingles(df: DataFrame, words: str, k: int) -> DataFrame:
    """``df`` with one row per position ``pos`` of a ``k``-word shingle."""
    return df.filter(F.size(words) >= k).withColumn("pos", F.explode(F.sequence(F.lit(0), F.size(words) - k)))


def shingle_text(words: Column, i: Column, k: int) -> Column:
    return F.concat_ws(" ", *[F.get(words, i + j) for j in range(k)])
