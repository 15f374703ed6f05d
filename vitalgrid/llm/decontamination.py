"""Benchmark decontamination by size-partitioned MinHash containment search (DataFrame functions only).

Test items are partitioned by size (powers of two of their shingle count).  In each partition every
item keeps its ``sketch`` smallest shingle hashes, and the partition's cutoff is the largest hash any
of its items kept; the shingles of a document below that cutoff are the document's MinHash sketch at
the partition's rate, so a long document has a long sketch and a short item inside it is still met.
The share of an item's sketch found in a document estimates containment.  Pairs well below the
threshold are left out, all others are verified by exact shingle containment on the words.

Items whose count is at most ``sketch`` keep all their hashes.  A larger item of true containment 0.8
is missed only if fewer than a quarter of its sketch occurs in the document (about 1e-8 for 16).

Defined results: null or empty texts contain nothing; items with fewer than five words have no
shingle and match nothing; repeated rows (same id and text) are one document here; a null id is
matched like any other; further columns are not read; with an empty table there are no pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalgrid.llm.common import BROADCAST_BYTES, alnum_words, exploded_shingles, materialize, shingle_hash, shingle_text, small_side


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    k: int = 5,
    threshold: float = 0.8,
    sketch: int = 16,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Pairs ``doc_id, body, item_id, n_item_shingles, n_found, containment`` at or above ``threshold``.

    ``body`` is the hash of the document's text.
    """
    listed = items.select(F.col(item_id).alias("item"), alnum_words(F.col(item_text)).alias("w"))
    shingles = materialize(
        exploded_shingles(listed, "w", k).select(
            "item", shingle_hash(F.col("w"), F.col("pos"), k).alias("h"), shingle_text(F.col("w"), F.col("pos"), k).alias("s")
        ).distinct()
    )
    sizes = shingles.groupBy("item").agg(F.count("*").alias("n_item"))
    ranked = (
        shingles.join(sizes, "item")
        .withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy("h", "s")))
        .filter(F.col("rank") <= sketch)
        .withColumn("part", F.floor(F.log2("n_item")))
    )
    cutoff = ranked.groupBy("part").agg(F.max("h").alias("cutoff"))
    kept = materialize(ranked.join(cutoff, "part").select("part", "cutoff", "item", "h", "n_item"))
    top = kept.agg(F.max("cutoff")).first()[0]

    keyed = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("body"), alnum_words(F.col(text)).alias("w"))
    drawn = exploded_shingles(keyed, "w", k).select("doc", "body", shingle_hash(F.col("w"), F.col("pos"), k).alias("h"))
    drawn = drawn.filter(F.col("h") <= F.lit(top if top is not None else 0))
    met = drawn.join(small_side(kept, broadcast_bytes), "h").filter(F.col("h") <= F.col("cutoff"))
    pairs = (
        met.groupBy("doc", "body", "item", "n_item", "h").agg(F.lit(1).alias("one"))
        .groupBy("doc", "body", "item", "n_item").agg(F.count("*").alias("n"))
        .filter(F.col("n") >= F.lit(0.25) * F.least("n_item", F.lit(sketch)))
        .select("doc", "body", "item", "n_item")
    )
    pairs = materialize(pairs)

    # exact containment of the surviving pairs, on the words of those documents only
    wanted = small_side(materialize(pairs.select("doc", "body").distinct()), broadcast_bytes)
    again = keyed.alias("k").join(
        wanted.alias("p"), F.col("k.doc").eqNullSafe(F.col("p.doc")) & (F.col("k.body") == F.col("p.body")), "left_semi"
    )
    words = exploded_shingles(again, "w", k).select("doc", "body", shingle_text(F.col("w"), F.col("pos"), k).alias("s"))
    exact = (
        words.join(small_side(shingles.select("item", "s"), broadcast_bytes), "s")
        .groupBy("doc", "body", "item", "s").agg(F.lit(1).alias("one"))
        .groupBy("doc", "body", "item").agg(F.count("*").alias("n_found"))
    )
    found = exact.alias("e").join(
        pairs.alias("p"),
        F.col("e.doc").eqNullSafe(F.col("p.doc")) & (F.col("e.body") == F.col("p.body")) & F.col("e.item").eqNullSafe(F.col("p.item")),
    )
    return found.select(
        F.col("e.doc").alias(doc_id), F.col("e.body").alias("body"), F.col("e.item").alias(item_id),
        F.col("p.n_item").alias("n_item_shingles"), "n_found", (F.col("n_found") / F.col("p.n_item")).alias("containment"),
    ).filter(F.col("containment") >= threshold)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("body")


OP4_SQL = r"""
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), x -> x <> '') AS w
  FROM documents
), iw AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), x -> x <> '') AS w
  FROM benchmark
), ds AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(list_transform(range(1, len(w) - 3), i -> array_to_string(w[i:i+4], ' '))) AS s FROM dw WHERE len(w) >= 5)
), its AS (
  SELECT DISTINCT item_id, s FROM (
    SELECT item_id, unnest(list_transform(range(1, len(w) - 3), i -> array_to_string(w[i:i+4], ' '))) AS s FROM iw WHERE len(w) >= 5)
), n AS (SELECT item_id, count(*) AS n_item_shingles FROM its GROUP BY 1)
SELECT ds.doc_id, its.item_id, n.n_item_shingles, count(*) AS n_found, count(*) / n.n_item_shingles AS containment
FROM ds JOIN its USING (s) JOIN n ON n.item_id = its.item_id
GROUP BY 1, 2, 3 HAVING count(*) / n.n_item_shingles >= 0.8
"""
