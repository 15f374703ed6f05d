"""License scans by diagonal voting.

Every word gram of every document is hashed and joined with the gram positions of the licence
templates (a fixed list, broadcast; its size is that of the parameter): grams of ``K`` words for texts
and notices, of two words for the base phrases, which are no longer.  Hits vote for ``document position
- template position``: an undisturbed copy puts all its votes on one diagonal, an edited one on
neighbouring diagonals, which are merged.  Spans are verified on the words themselves: grams are
compared as text, a base phrase needs its whole diagonal, and a notice needs ``min_share`` of its words
inside such grams, in a span not much longer than itself.  Of notices that overlap, the one with most
words there stays, so that a licence is not also taken for its relatives.

Defined results: null text is empty (0 words, no labels, score 0); repeated rows (same id and text)
get the same result each; a null id is kept; further columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalgrid.llm.common import alnum_words, exploded_shingles, let, lower_but_ascii, shingle_hash, shingle_text
from vitalgrid.llm.license_texts import NOTICES

K = 4

#: Fixed phrases and their labels.
PHRASES = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)


def _grams(spark: SparkSession, listed: list[tuple], k: int) -> DataFrame:
    templates = spark.createDataFrame(listed, "tid int, label string, body string, base boolean").withColumn("w", F.split("body", " "))
    return exploded_shingles(templates, "w", k).select(
        "tid", "label", "base", F.size("w").alias("t_words"), F.lit(k).alias("k"), F.col("pos").alias("tpos"),
        shingle_text(F.col("w"), F.col("pos"), k).alias("gram"), shingle_hash(F.col("w"), F.col("pos"), k).alias("h"),
    )


def _hits(placed: DataFrame, grams: DataFrame, gram: Column) -> DataFrame:
    """Grams of the templates among ``doc, body, pos, h``: hashes meet first, then the words of ``gram``."""
    met = placed.join(F.broadcast(grams.withColumnRenamed("gram", "_gram")), "h")
    met = met.filter(F.array_contains(F.array("_gram"), gram))  # an equality would become a key, made for every place
    return met.select("doc", "body", "tid", "label", "base", "t_words", "k", "tpos", (F.col("pos") - F.col("tpos")).alias("diagonal"))


def scan_licenses(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    phrases=PHRASES,
    notices=NOTICES,
    min_share: float = 0.6,
    diagonal_gap: int = 3,
) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` for every row."""
    spark = docs.sparkSession
    plain = lambda t: " ".join(re.findall("[0-9a-z]+", t.lower()))
    listed = [(i, label, plain(t), i < len(phrases)) for i, (label, t) in enumerate([*phrases, *notices])]

    def words() -> Column:
        return alnum_words(F.col(text), lower_but_ascii)

    key = (F.col(doc_id).alias("doc"), F.xxhash64(text).alias("body"))
    starts = sorted({w for _, t in phrases for w in t.split()[:-1]})

    def pairs(w: Column) -> Column:
        """Two-word grams that may begin a base phrase; ``w`` is split once, not anew for each place."""
        at = F.filter(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.get(w, i).isin(starts) & (i + 1 < F.size(w)))
        return F.transform(at, lambda i: F.struct(i.alias("pos"), F.get(w, i).alias("a"), F.get(w, i + 1).alias("b")))

    # a text without the last word of any phrase has no base phrase
    last = "|".join(sorted({re.escape(t.split()[-1]) for _, t in phrases}))
    short = docs.filter(lower_but_ascii(F.col(text)).rlike(last)).select(*key, F.explode(let(words(), pairs)).alias("x")).select("doc", "body", "x.*").withColumn("h", F.xxhash64("a", "b"))
    # most texts share no gram with any notice; the others are read place by place
    notices_of = _grams(spark, listed[len(phrases) :], K)
    known = F.lit([r.h for r in notices_of.select("h").distinct().collect()]).cast("array<bigint>")  # as many as the parameter has
    hashes = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - 1), lambda i: shingle_hash(w, i, K))
    some = docs.filter(F.arrays_overlap(let(words(), hashes), known))
    long = exploded_shingles(some.select(*key, words().alias("w")), "w", K).withColumn("h", shingle_hash(F.col("w"), F.col("pos"), K))
    hits = _hits(short, _grams(spark, listed[: len(phrases)], 2), F.concat_ws(" ", "a", "b"))
    hits = hits.unionByName(_hits(long, notices_of, shingle_text(F.col("w"), F.col("pos"), K)))
    diagonals = hits.groupBy("doc", "body", "tid", "label", "base", "t_words", "k", "diagonal").agg(F.collect_set("tpos").alias("votes"))
    order = Window.partitionBy("doc", "body", "tid").orderBy("diagonal")
    gap = F.when(F.col("base"), 0).otherwise(diagonal_gap)  # a base phrase stands undisturbed
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > gap, F.lit(True))
    merged = (
        diagonals.withColumn("island", F.sum(F.when(far, 1).otherwise(0)).over(order))
        .withColumn("vote", F.explode(F.flatten(F.transform("votes", lambda v: F.sequence(v, v + F.col("k") - 1)))))
        .groupBy("doc", "body", "tid", "label", "base", "t_words", "k", "island")
        .agg(
            F.count_distinct("vote").alias("n"),
            F.min(F.col("diagonal") + F.col("vote")).alias("start"),
            F.max(F.col("diagonal") + F.col("vote") + 1).alias("stop"),
        )
        .withColumn("share", F.col("n") / F.col("t_words"))
    )
    near = (F.col("share") >= min_share) & (F.col("stop") - F.col("start") <= 1.5 * F.col("t_words"))
    passed = merged.filter(F.when(F.col("base"), F.col("n") == F.col("t_words")).otherwise(near))
    spans = F.collect_list(F.struct("label", "base", "start", "stop", "n", "share"))
    rank = lambda x: F.struct(x["n"], x["share"])
    apart = lambda x, y: y["base"] | (y["start"] >= x["stop"]) | (x["start"] >= y["stop"]) | (rank(y) <= rank(x))
    own = F.filter("s", lambda x: x["base"] | F.forall("s", lambda y: apart(x, y)))
    of = lambda field, some: F.transform(F.filter("s", some), lambda x: x[field])
    listed_labels = lambda some: F.array_join(F.array_sort(F.array_distinct(of("label", some))), ",")
    base, any_ = lambda x: x["base"], lambda x: F.lit(True)
    found = passed.groupBy("doc", "body").agg(spans.alias("s")).withColumn("s", own).select(
        "doc", "body", F.size(of("start", base)).alias("n_base"), F.array_min(of("start", base)).cast("long").alias("first_word"), F.array_max(of("start", base)).cast("long").alias("last_word"),
        listed_labels(base).alias("base_labels"), listed_labels(any_).alias("labels"), F.least(F.array_max(of("share", any_)), F.lit(1.0)).alias("score"),
    )
    found = found.withColumnsRenamed({"doc": "_doc", "body": "_body"})
    every = docs.select(
        F.col(doc_id), F.xxhash64(text).alias("_text_hash"), F.size(words()).cast("long").alias("n_words")
    )
    out = every.join(found, every[doc_id].eqNullSafe(found["_doc"]) & (F.col("_text_hash") == F.col("_body")), "left")
    return out.select(
        doc_id, "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
