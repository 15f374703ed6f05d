"""Resampling towards a target by the importance of hashed n-grams.

Two passes of Arrow kernels over batches: texts are lower-cased, split and flattened, words become dictionary
indices, and shifted indices form pairs and triples that never leave their text.  Each distinct word, pair and
triple of a batch is hashed once: the checksum of a joined text follows from those of its parts, so no n-gram is
ever spelt out.  The first pass adds up buckets of all documents and of the target, a table of fixed size; the
second takes each feature's gain and sums it per document.  A sampling score adds Gumbel noise that is drawn from
the document's id; ranks come from ranges of scores whose sizes are counted, so no task ever sees all of them.

Defined results: a null or empty text has no features and weight 0; a null id draws its noise from the empty id and
comes last among equal scores; repeated rows are documents of their own with equal scores and neighbouring ranks; an
empty target leaves every bucket's ``t`` at 0; with no documents there are no rows; further columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.arrow_words import slices, words
from vitalgrid.llm.common import fresh, materialize

BUCKETS = 10_000


@cache
def _one_byte() -> np.ndarray:
    """What a zero byte behind a text makes of each bit of its checksum."""
    out = np.empty(32, np.uint32)
    for bit in range(32):
        c = 1 << bit
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        out[bit] = c
    return out


def _applied(bits: np.ndarray, c: np.ndarray) -> np.ndarray:
    out = np.zeros(len(c), np.uint32)
    for bit in range(32):
        out ^= np.where((c >> np.uint32(bit)) & np.uint32(1), bits[bit], np.uint32(0))
    return out


@cache
def _power(exponent: int) -> np.ndarray:
    """The same for ``2 ** exponent`` zero bytes."""
    half = _one_byte() if exponent == 0 else _power(exponent - 1)
    return half if exponent == 0 else _applied(half, half)


@cache
def _byte_table(exponent: int) -> np.ndarray:
    """That step as four tables of 256, one for each byte of the checksum."""
    low = np.arange(256, dtype=np.uint32)
    return np.stack([_applied(_power(exponent), low << np.uint32(8 * i)) for i in range(4)])


def moved(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The checksum of each text followed by ``length`` further bytes, but for those bytes' own part."""
    crc = crc.copy()
    for exponent in range(int(length.max(initial=0)).bit_length()):
        at = np.flatnonzero((length >> exponent) & 1)
        if len(at):
            c, table = crc[at], _byte_table(exponent)
            crc[at] = table[0][c & 255] ^ table[1][(c >> 8) & 255] ^ table[2][(c >> 16) & 255] ^ table[3][c >> 24]
    return crc


SPACE = np.uint32(zlib.crc32(b" "))


def features(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words of each text; and per length of n-gram each place's text and bucket."""
    row, flat = words(texts)
    n_words = np.bincount(row, minlength=len(texts))
    coded = flat.dictionary_encode()
    names = coded.dictionary.cast(pa.binary()).to_pylist()
    crc = np.fromiter(map(zlib.crc32, names), np.uint32, len(names))
    length = np.fromiter(map(len, names), np.int64, len(names))
    word = coded.indices.to_numpy().astype(np.int64)
    out = [(row, (crc % buckets)[word])]
    gram, gram_crc = word, crc
    for n in (2, 3):
        if len(row) < n:
            break
        inside = row[n - 1 :] == row[: len(row) - n + 1]
        key = gram[: len(row) - n + 1] * len(names) + word[n - 1 :]
        shifted = pa.array(key).dictionary_encode()
        distinct = shifted.dictionary.to_numpy()
        first, last = np.divmod(distinct, len(names))
        gram_crc = moved(gram_crc[first], np.ones(len(first), np.int64)) ^ SPACE
        gram_crc = moved(gram_crc, length[last]) ^ crc[last]
        gram = shifted.indices.to_numpy().astype(np.int64)
        at = row[: len(row) - n + 1]
        out.append((at[inside], (gram_crc % buckets)[gram[inside]]))
    return n_words, out


def bucket_counts(texts: DataFrame, text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket; a row per bucket and task goes through the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                for _, bucket in features(part.column(0), buckets)[1]:
                    total += np.bincount(bucket, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    rows = texts.select(F.col(text)).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    out[[r.bucket for r in rows]] = [r.n for r in rows]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of smoothed bucket shares, rounded down."""
    buckets = len(source)
    ratio = (target + 1.0) * (float(source.sum()) + buckets) / ((source + 1.0) * (float(target.sum()) + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                n_words, grams = features(part.column(1), len(gain))
                n, weight = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
                for row, bucket in grams:
                    if len(row):  # rows ascend, so each text is one segment
                        own = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                        weight[row[own]] += np.add.reduceat(gain[bucket], own)
                        n[row[own]] += np.diff(np.r_[own, len(row)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n_words), pa.array(n), pa.array(weight)], names=["id", "n_words", "n_features", "weight"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """Noise in thousandths from the first 32 bits of the hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with its place ``rank`` from 1 in ``order``: ranges are sorted apart and begin where the ones before end."""
    at, place = fresh(df, "_at", "_place")
    ordered = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(place, F.monotonically_increasing_id()))
    part = F.shiftright(F.col(place), 33)
    sizes = {r.part: r.n for r in ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}  # a row a range
    start, begins = 0, {}
    for p in sorted(sizes):
        begins[p] = start
        start += sizes[p]
    if not begins:
        return ordered.withColumn("rank", F.col(place)).drop(place)
    starts = df.sparkSession.createDataFrame(list(begins.items()), f"{at} long, rank long")
    inside = F.col(place) - F.shiftleft(part, 33)
    return ordered.join(F.broadcast(starts), part == F.col(at)).withColumn("rank", F.col("rank") + inside + 1).drop(at, place)


def resample(docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", percent: int = 5, min_words: int = 20, seed: int = 42, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` for every row; ``rank`` is null but for ``percent`` of those of at least ``min_words`` words."""
    gain = gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    scored = weigh(docs, gain, doc_id=doc_id, text=text).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    # the row's number, fixed by writing it, spreads rows that are equal in all else over the ranges
    scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()))
    eligible = F.col("n_words") >= min_words
    n = scored.filter(eligible).count()
    ranked = numbered(scored.filter(eligible), F.desc("score"), F.asc_nulls_last("id"), F.asc("row"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= percent * n // 100, F.col("rank")))
    rest = scored.filter(~eligible).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(F.col("id").alias(doc_id), "n_features", "weight", "score", "rank")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
