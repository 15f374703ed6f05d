"""Corpus preparation in five stages, each the operator of its name over all the stage before kept."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.common import fresh, materialize, scratch, small_side
from vitalgrid.llm.decontamination import contaminated
from vitalgrid.llm.jaccard_join import jaccard_members
from vitalgrid.llm.mixing import mix_to_targets
from vitalgrid.llm.pii import DEMO_KEY, pseudonymize
from vitalgrid.llm.quality_rules import apply_rules


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go (null and empty texts among them); lines above their host's limit go from those that stay."""
    kept = apply_rules(docs).filter("kept")
    return kept.withColumns({"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}).select(docs.columns)


def _same_row(docs: DataFrame, side: DataFrame, doc: str, body: str):
    """Equal id (null like any other) and equal text."""
    return docs["doc_id"].eqNullSafe(side[doc]) & (F.xxhash64(docs["text"]) == side[body])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group (five-word shingles, similarity 0.8) stays: that of the smallest id, then text hash.

    Null ids come last and are ids like any other; equal rows are copies of each other; texts without words stay.
    """
    doc, body = fresh(docs, "_doc", "_body")
    found = jaccard_members(docs, k=5, percent=80).filter("n_shingles > 0")
    pairs = materialize(found.groupBy("root", "doc_id", "body").agg(F.count("*").alias("rows")))
    member = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("body"))
    first = pairs.groupBy("root").agg(F.min(member).alias("first"), F.sum("rows").alias("all")).filter("all > 1")
    first = small_side(materialize(first.withColumnRenamed("root", "_root")))
    spare = pairs.join(first, F.col("root") == F.col("_root"))
    spare = spare.withColumn("goes", member != F.col("first")).filter("goes or rows > 1")
    spare = materialize(spare.select(F.col("doc_id").alias(doc), F.col("body").alias(body), "goes"))
    kept = docs.join(marked := small_side(spare), _same_row(docs, marked, doc, body), "left_anti")
    again = spare.filter("not goes").drop("goes")
    if not again.isEmpty():  # equal rows of one id and text, of which one stays
        again = small_side(again)
        once = docs.join(again, _same_row(docs, again, doc, body)).select(*docs.columns, body).dropDuplicates(["doc_id", body])
        kept = kept.unionByName(once.select(docs.columns))
    return kept.select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go; those without words stay, and so do all if there are no items."""
    doc, body = fresh(docs, "_doc", "_body")
    leaks = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaks = small_side(materialize(leaks.select(F.col("doc_id").alias(doc), F.col("body").alias(body)).distinct()))
    return docs.join(leaks, _same_row(docs, leaks, doc, body), "left_anti")


#: True lets runs without a secret use the public key; a real run sets the secret, and this to False to be sure of it.
DEMONSTRATION = True


def pii_key(spark: SparkSession) -> str:
    """The secret of the pseudonyms: ``spark.vitalgrid.pii.secret`` of the session, a name that Spark redacts."""
    if (key := spark.conf.get("spark.vitalgrid.pii.secret", None)) is not None:
        return key
    if not DEMONSTRATION:
        raise RuntimeError("spark.vitalgrid.pii.secret must be set")
    warnings.warn("spark.vitalgrid.pii.secret is not set: the pseudonyms are made with the public demonstration key", stacklevel=2)
    return DEMO_KEY


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by pseudonyms; every row stays, null texts as they are."""
    return pseudonymize(docs, pii_key(spark)).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its rate in the mixture; null and empty texts have no tokens and a rate like any other."""
    return mix_to_targets(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", pii),
    ("mixing to target weights", mixing),
]

#: SQL cannot express the fitted stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage writes besides its result is deleted with it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        with scratch(spark):
            docs = materialize(stage(spark, docs, sf_dir), outer=True)
    return STAGES[-1][1](spark, docs, sf_dir)
