"""Quality by nearest-neighbour voting over latent-semantic vectors.

A bounded sample of labelled documents (``max_labelled``, the smallest hashes of their ids) gives the
term weights, the latent space (truncated singular value decomposition of its weighted term matrix)
and the labelled vectors; these three arrays are of fixed size and broadcast.  Every document of the
table is projected and compared with all labelled vectors in blocks of exact cosine products; its
``neighbours`` nearest vote with ``similarity ** sharpness``.

Terms are pairs of byte classes and shape terms of the text alone; id, language and source are not
read.  Defined results: null text is empty and is scored like any other; without labelled rows every
score is 0.5; labels that are null are not used, of several label rows of one id the largest counts, and
of several texts of one id one is learned from; of neighbours equally near the one of the smaller place in
the sample votes, and a tie of the votes (0.5) predicts 1; repeated rows get repeated results; further
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.features import as_texts, pair_counts


def id_crc(doc_id: str) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def labelled_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, columns: list[str], limit: int) -> DataFrame:
    """``doc_id, text`` and label columns of at most ``limit`` labelled ids, chosen by a hash of the id.

    One row each: of several texts of an id that of the smallest hash, of several label rows the largest.
    """
    pick = F.max(F.struct(*columns)).alias("_pick")
    chosen = (
        labels.filter(F.col(doc_id).isNotNull()).dropna(subset=columns).groupBy(F.col(doc_id).alias("_id")).agg(pick)
        .orderBy(F.xxhash64("_id"), "_id").limit(limit)
    )
    held = docs.select(F.col(doc_id).alias("_doc"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    first = held.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).groupBy("_id").agg(
        F.min(F.struct(F.xxhash64("_text"), "_text")).alias("_first"), F.first("_pick").alias("_pick")
    )
    return first.select(F.col("_id").alias(doc_id), F.col("_first._text").alias(text), *[F.col(f"_pick.{c}").alias(c) for c in columns])


class Neighbours:
    """Latent space and labelled vectors."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, dim: int, seed: int = 0):
        n = len(counts)
        self.labels = labels.astype(np.float32)
        self.idf = (np.log(1 / ((counts > 0).mean(axis=0) + 1 / n)) + 0.1).astype(np.float32)
        terms = self._weighted(counts)
        dim = min(dim, n)
        rng = np.random.default_rng(seed)
        q = rng.standard_normal((terms.shape[1], dim + 16)).astype(np.float32)
        for _ in range(4):
            q, _ = np.linalg.qr(terms.T @ (terms @ q))
        _, _, vt = np.linalg.svd(terms @ q, full_matrices=False)
        self.axes = (q @ vt.T)[:, :dim].astype(np.float32)
        self.vectors = self.project(counts)

    def _weighted(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.idf
        return x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-9)

    def project(self, counts: np.ndarray) -> np.ndarray:
        z = self._weighted(counts) @ self.axes
        return z / (np.linalg.norm(z, axis=1, keepdims=True) + 1e-9)

    @staticmethod
    def nearest(cosine: np.ndarray, k: int) -> np.ndarray:
        """Columns of the ``k`` largest cosines of each row; of equal ones those that come first."""
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        least = np.take_along_axis(cosine, near, axis=1).min(axis=1, keepdims=True)
        for i in np.flatnonzero((cosine >= least).sum(axis=1) > k):
            near[i] = np.argsort(-cosine[i], kind="stable")[:k]
        return near

    def vote(self, counts: np.ndarray, neighbours: int, sharpness: float) -> np.ndarray:
        cosine = self.project(counts) @ self.vectors.T
        k = min(neighbours, cosine.shape[1])
        near = self.nearest(cosine, k)
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 1e-6) ** sharpness
        return (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_labelled: int = 3000,
    dim: int = 64,
    neighbours: int = 15,
    sharpness: float = 8.0,
    block: int = 500,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row.

    Only labels of ids whose crc32 mod 3 is not 1 are learned from.
    """
    train = labels.filter(id_crc(doc_id) % 3 != 1)
    sample = labelled_sample(docs, train, doc_id, text, [label], max_labelled).select(F.col(text).alias("text"), F.col(label).cast("double").alias("y"), F.col(doc_id).cast("string").cast("binary").alias("id"))

    def count(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                x = pair_counts(as_texts(part.column(0)).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(2), pa.array([np.flatnonzero(r).astype(np.int32).tobytes() for r in x], pa.binary()), pa.array([r[r > 0].tobytes() for r in x], pa.binary()), part.column(1)],
                    names=["id", "term", "n", "y"],
                )

    rows = sample.mapInArrow(count, "id binary, term binary, n binary, y double").toArrow().sort_by([("id", "ascending")])
    width = pair_counts([""]).shape[1]
    model = None
    if rows.num_rows:
        x = np.zeros((rows.num_rows, width), np.float32)
        for r, term, n in zip(x, rows["term"], rows["n"], strict=True):
            r[np.frombuffer(term.as_buffer(), np.int32)] = np.frombuffer(n.as_buffer(), np.float32)
        model = Neighbours(x, rows["y"].to_numpy(), dim)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                got = np.full(part.num_rows, 0.5)
                if model is not None:
                    got = model.vote(pair_counts(as_texts(part.column(2)).to_pylist()), neighbours, sharpness).astype(np.float64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(got)], names=[doc_id, "held_out", "score"])

    id_type = docs.schema[doc_id].dataType.simpleString()
    scored = docs.select(F.col(doc_id), (id_crc(doc_id) % 3 == 1).alias("held_out"), F.col(text)).mapInArrow(
        score, f"`{doc_id}` {id_type}, held_out boolean, score double"
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
