"""Quality rules with cross-document line frequency (DataFrame functions only).

Lines are normalised (lower case, white space collapsed) and hashed.  For each host the operator
counts the distinct documents that hold a line; a line above the host's limit is removed, and a
document that loses most of its word characters that way is rejected as depleted.

Equal texts are one document for this count, and a line repeated in one text counts once.  Otherwise
every member of a large group of copies would be emptied by the others and the content would be lost
rather than deduplicated.

Defined results: null or empty text has no words and fails the base rules; a null host is a host of
its own; repeated rows (same id and text) get the same result, one row each; an empty table gives an
empty result; further columns pass through ``apply_rules`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.common import BROADCAST_BYTES, WS, fresh, let, materialize, shingle_hash, small_side, words_of

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5


def _repeat_words(words: Column) -> Column:
    """Words that lie in a five-word window found twice or more in the text."""

    def covered(starts: Column) -> Column:
        gaps = F.transform(starts, lambda p, k: F.least(F.lit(WINDOW), F.get(starts, k + 1) - p))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def from_sorted(s: Column) -> Column:
        twice = F.filter(
            s,
            lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)),
        )
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    def from_hashes(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(placed, from_sorted))

    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: shingle_hash(words, i, WINDOW)
    )
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(let(hashes, from_hashes))


def with_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the per-document counts and ``base_failed``."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    w, x, row = fresh(docs, "_words", "_lines", "_row")
    out = docs.withColumn(w, words_of(F.col(text))).withColumn(x, lines)
    out = out.withColumns({
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": _repeat_words(F.col(w)).cast("long"),
        # never negative; a later filter on the verdict cannot be pushed below this column, where it would
        # split the text anew for every word
        row: F.monotonically_increasing_id(),
    }).drop(w, x)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.withColumn("base_failed", failed & (F.col(row) >= 0)).drop(row)


def _line_rows(docs: DataFrame, doc_id: str, text: str, host: str) -> DataFrame:
    """One row per non-blank line: keys of document, text, host and line."""
    norm = F.transform(
        F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "\n", -1),
        lambda x: F.btrim(F.regexp_replace(x, WS, " ")),
    )
    keyed = docs.select(
        F.col(doc_id).alias("doc"), F.xxhash64(text).alias("body"), F.xxhash64(host).alias("host"), norm.alias("l")
    ).filter(F.size("l") > 0)
    hashed = keyed.select(
        "doc", "body", "host",
        F.transform("l", lambda x: F.struct(F.xxhash64(x).alias("h"), F.length(x).alias("n"))).alias("l"),
    )
    rows = hashed.select("doc", "body", "host", F.posexplode("l").alias("pos", "x")).filter("x.n > 0")
    return rows.select("doc", "body", "host", F.col("x.h").alias("line"), "pos", F.col("x.n").alias("chars"))


def removed_lines(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    min_docs: int = 20,
    host_share: float = 0.02,
    long_line: int = 40,
) -> DataFrame:
    """Documents that hold lines above their host's limit.

    A line of ``long_line`` characters or more has the limit ``min_docs`` on every host.  Shorter ones recur
    by chance: theirs is ``host_share`` of the host's distinct texts, but at least ``min_docs`` and at most
    ``min_docs * (long_line / length) ** 2``, whatever the host's size.  Returns ``doc, body`` (hash of the
    text), ``removed`` (positions of those lines) and ``removed_chars``.
    """
    rows = _line_rows(docs, doc_id, text, host)
    distinct = rows.groupBy("line", "host", "body").agg(F.max("chars").alias("chars"))
    per_line = (
        distinct.groupBy("line", "host").agg(F.count("*").alias("n_docs"), F.max("chars").alias("chars"))
        .filter(F.col("n_docs") > min_docs)
    )
    texts = docs.select(F.xxhash64(host).alias("host"), F.xxhash64(text).alias("body")).distinct()
    hosts = texts.groupBy("host").agg((F.count("*") * host_share).alias("share"))
    limit = F.least("share", min_docs * F.pow(F.greatest(F.lit(1.0), long_line / F.col("chars")), 2))
    above = per_line.join(hosts, "host").filter(F.col("n_docs") > limit).select("line", "host")
    hit = rows.join(above, ["line", "host"]).groupBy("doc", "body", "pos").agg(F.max("chars").alias("chars"))
    return hit.groupBy("doc", "body").agg(
        F.collect_set("pos").alias("removed"), F.sum("chars").alias("removed_chars")
    )


def apply_rules(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    min_docs: int = 20,
    host_share: float = 0.02,
    max_removed: float = 0.7,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` with base counts, ``n_removed_lines``, ``clean_text`` and ``kept``.

    A document is kept if it passes the base rules, loses at most ``max_removed`` of its word
    characters and has a word left.  The table of affected documents is written once; it is broadcast only up to
    ``broadcast_bytes`` and joined by a shuffle beyond that.  Columns of ``docs`` named like one of the
    results are replaced.
    """
    base = with_base(docs, text)
    doc, body, gone_lines, gone_chars = fresh(base, "_doc", "_body", "_removed", "_removed_chars")
    gone = removed_lines(docs, doc_id=doc_id, text=text, host=host, min_docs=min_docs, host_share=host_share)
    gone = materialize(gone.toDF(doc, body, gone_lines, gone_chars))
    joined = base.join(
        small_side(gone, broadcast_bytes),
        base[doc_id].eqNullSafe(gone[doc]) & (F.xxhash64(base[text]) == gone[body]),
        "left",
    )
    t = F.col(text)
    cut = F.array_join(
        F.filter(F.split(t, "\n", -1), lambda x, i: ~F.array_contains(F.col(gone_lines), i)), "\n"
    )
    # word characters that are left; nothing is removed from most documents
    left = F.when(F.col(gone_lines).isNull(), F.col("word_chars")).otherwise(F.length(F.array_join(words_of(cut), "")))
    enough = (left > 0) & (left >= (1 - max_removed) * F.col("word_chars"))
    return joined.withColumns({
        "n_removed_lines": F.coalesce(F.size(gone_lines), F.lit(0)).cast("long"),
        "clean_text": F.when(F.col(gone_lines).isNull(), t).otherwise(cut),
        "kept": ~F.col("base_failed") & enough,
    }).drop(doc, body, gone_lines, gone_chars)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return apply_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.greatest("n_removed_lines", F.lit(0)).alias("n_removed_lines"),
    )
