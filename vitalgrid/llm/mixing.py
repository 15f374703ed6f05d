"""Soft-membership mixing of a corpus to target domain weights.

A softmax classifier learned from a bounded labelled sample (``max_labelled``) gives each document a
posterior over domains.  Document rates ``r >= 0`` (expected copies) are then fitted by projected
gradient least squares so that the expected domain totals ``sum r * tokens * posterior`` match the
targets: with ``g`` the gap of the totals, weighted by the inverse second moments of the documents whose rate is
above 0, one step is ``r <- max(0, r - posterior . g)``.  That metric makes the step the whole way as long as no further
document reaches 0, so a few steps suffice.  A step needs only the few totals from the cluster; rates
are a fold over the steps so far, and are written out every few steps.

Domains are the four combinations of the labels quality and toxic.  Defined results: null and empty
texts have no tokens, the prior's posterior and a rate like any other; an empty table gives an empty
result; without labelled rows all posteriors are equal; repeated rows count each; of one id one text and
one row of labels is learned from; further columns are not read.
"""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.common import materialize, released, scratch
from vitalgrid.llm.features import as_texts, pair_counts, word_counts
from vitalgrid.llm.quality_classifier import labelled_sample

DOMAINS = ("junk", "junk_toxic", "clean", "toxic")  # 2 * quality + toxic
TARGETS = {"clean": 0.9, "toxic": 0.02, "junk": 0.07, "junk_toxic": 0.01}
WORD_TERMS = 1 << 20


def _sparse(texts: pa.Array) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Pair counts, and per text its hashed words with counts, and its number of words."""
    pairs = pair_counts(texts.to_pylist())
    doc, term, n, size = word_counts(texts, WORD_TERMS)
    cut = np.searchsorted(doc, np.arange(1, len(size)))
    return pairs, np.split(term, cut), np.split(n, cut), size


class Softmax:
    """Domain posteriors from byte-class pairs and the most telling words."""

    def __init__(self, pairs: np.ndarray, terms: list[np.ndarray], labels: np.ndarray, words: int = 1500, ridge: float = 1e-4, steps: int = 150):
        n, k = len(labels), len(DOMAINS)
        share = np.bincount(labels, minlength=k) / n
        flat, row = np.concatenate(terms), np.repeat(np.arange(n), [len(t) for t in terms])
        known, at = np.unique(flat, return_inverse=True)
        seen = np.zeros((len(known), k))
        np.add.at(seen, (at, labels[row]), 1)
        total = seen.sum(axis=1, keepdims=True)
        chi = ((seen - total * share) ** 2 / (total * share + 0.5)).sum(axis=1) * (total[:, 0] >= 5)
        self.words = np.sort(known[np.argsort(-chi, kind="stable")[:words]])
        self.scale = 1 / (np.sqrt((np.log1p(pairs) ** 2).mean(axis=0)) + 1.0).astype(np.float32)
        x = self.rows(pairs, terms)
        y = np.eye(k, dtype=np.float32)[labels]
        weight = momentum = np.zeros((x.shape[1], k), np.float32)
        prior = np.log(share + 1e-3).astype(np.float32)
        weight[-1] = prior
        lip = 0.5 * float(np.linalg.norm(x.T @ (x @ (np.ones(x.shape[1], np.float32) / x.shape[1] ** 0.5)))) / n + ridge
        lip = max(lip, 0.5 * float((x**2).sum(axis=1).max()) / 4)
        for t in range(steps):
            p = self._soft(x @ momentum)
            new = momentum - (x.T @ (p - y) / n + ridge * momentum) / lip
            momentum, weight = new + t / (t + 3) * (new - weight), new
        self.weight = weight

    @staticmethod
    def _soft(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def rows(self, pairs: np.ndarray, terms: list[np.ndarray]) -> np.ndarray:
        held = np.zeros((len(pairs), len(self.words)), np.float32)
        for r, t in zip(held, terms, strict=True):
            if len(self.words) and len(t):
                at = np.minimum(np.searchsorted(self.words, t), len(self.words) - 1)
                r[at[self.words[at] == t]] = 1
        x = np.log1p(pairs) * self.scale
        x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-9
        return np.concatenate([4 * x, held, np.ones((len(pairs), 1), np.float32)], axis=1)

    def posteriors(self, pairs: np.ndarray, terms: list[np.ndarray]) -> np.ndarray:
        return self._soft(self.rows(pairs, terms) @ self.weight)


def domain_posteriors(
    docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", max_labelled: int = 3000, block: int = 400
) -> DataFrame:
    """``doc_id, n_tokens, p`` (array in the order of ``DOMAINS``) for every row."""
    sample = labelled_sample(docs, labels, doc_id, text, ["quality", "toxic"], max_labelled).select(
        F.col(text).alias("text"), (2 * F.col("quality") + F.col("toxic")).cast("long").alias("y"), F.col(doc_id).cast("string").cast("binary").alias("id")
    )

    def count(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                pairs, terms, _, _ = _sparse(as_texts(part.column(0)))
                cells = [np.flatnonzero(r).astype(np.int32) for r in pairs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c.tobytes() for c in cells], pa.binary()), pa.array([r[c].tobytes() for r, c in zip(pairs, cells, strict=True)], pa.binary()),
                     pa.array([t.astype(np.int64).tobytes() for t in terms], pa.binary()), part.column(1), part.column(2)],
                    names=["cell", "n", "term", "y", "id"],
                )

    got = sample.mapInArrow(released(count), "cell binary, n binary, term binary, y long, id binary").toArrow().sort_by([("id", "ascending")])
    model = None
    if got.num_rows:
        pairs = np.zeros((got.num_rows, pair_counts([""]).shape[1]), np.float32)
        for r, c, n in zip(pairs, got["cell"], got["n"], strict=True):
            r[np.frombuffer(c.as_buffer(), np.int32)] = np.frombuffer(n.as_buffer(), np.float32)
        model = Softmax(pairs, [np.frombuffer(t.as_buffer(), np.int64) for t in got["term"]], got["y"].to_numpy())
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                pairs, terms, _, size = _sparse(as_texts(part.column(1)))
                p = model.posteriors(pairs, terms) if model is not None else np.full((len(size), len(DOMAINS)), 1 / len(DOMAINS))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(size.astype(np.int64)), pa.array(p.astype(np.float64).tolist(), pa.list_(pa.float64()))], names=[doc_id, "n_tokens", "p"]
                )

    id_type = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, text).mapInArrow(released(score), f"`{doc_id}` {id_type}, n_tokens long, p array<double>")


def fit_rates(
    members: DataFrame,
    targets: list[float],
    *,
    tokens: str = "n_tokens",
    posterior: str = "p",
    budget: float = 1.0,
    tolerance: float = 1e-3,
    floor: float = 1e-3,
    max_steps: int = 100,
    keep_every: int = 6,
) -> DataFrame:
    """``members`` with ``rate`` and ``worst_gap``; ``targets`` are domain shares of ``budget`` times the corpus's tokens.

    ``worst_gap`` is the same in all rows: how far the worst domain's total is from its target, in shares of that
    target (of ``floor`` of the budget for smaller targets and those of 0).  Steps go on until it is at most
    ``tolerance``; a step that leads away is halved.  Where no step leads nearer, the targets are out of reach (or
    further than ``max_steps`` steps), which gives the nearest rates, a warning and a ``worst_gap`` above ``tolerance``.
    """
    k = len(targets)
    share = np.array(targets, float) / sum(targets)
    p = [F.get(posterior, i) for i in range(k)]
    n = F.col(tokens).cast("double")
    total = members.agg(F.sum(n)).first()[0] or 0.0
    current = materialize(members.withColumn("rate", F.lit(1.0)))
    if not total:
        return current.withColumn("worst_gap", F.lit(0.0))
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    steps: list[list[float]] = []  # since ``current`` was written

    def rate(steps: list[list[float]]) -> Column:
        if not steps:
            return F.col("rate")
        slope = lambda g: sum((p[i] * F.get(g, i) for i in range(1, k)), p[0] * F.get(g, 0))
        history = F.array(*[F.array(*[F.lit(float(x)) for x in g]) for g in steps])
        return F.aggregate(history, F.col("rate"), lambda r, g: F.greatest(F.lit(0.0), r - slope(g)))

    def measure() -> tuple[np.ndarray, float, np.ndarray]:
        """The gaps of the domains' totals, the worst one, and the inverse moments of the documents that can move both ways."""
        r = F.col("_r")
        free = [F.sum(F.when(r > 0, n * p[i] * p[j])) for i, j in upper]
        row = np.array([x or 0.0 for x in current.withColumn("_r", rate(steps)).agg(*[F.sum(r * n * x) for x in p], *free).first()], float) / total
        gap, hold = row[:k] - budget * share, np.zeros((k, k))
        for (i, j), x in zip(upper, row[k:], strict=True):
            hold[i, j] = hold[j, i] = x
        metric = np.linalg.pinv(hold + 1e-6 * np.trace(hold) * np.eye(k))
        return gap / (budget * np.maximum(share, floor)), float(np.abs(gap / (budget * np.maximum(share, floor))).max()), metric @ gap

    best, halved = np.inf, 0
    for _ in range(max_steps):
        gaps, far, step = measure()
        size = float(gaps @ gaps)
        if far <= tolerance or (size < best and size > best * (1 - 1e-6)):
            break
        if size >= best:
            if (halved := halved + 1) > 20:
                break
            steps[-1] = [x / 2 for x in steps[-1]]
            continue
        best, halved = size, 0
        if len(steps) >= keep_every:
            current = materialize(current.withColumn("rate", rate(steps)))
            steps.clear()
        steps.append(step.tolist())
    else:
        _, far, _ = measure()
    if far > tolerance:
        warnings.warn(f"targets not met: the worst domain is off by {far:.2%}", stacklevel=2)
    return current.withColumns({"rate": rate(steps), "worst_gap": F.lit(far)})


def mix_to_targets(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens``, a posterior column per domain, ``rate`` and ``worst_gap`` for every row."""
    with scratch(docs.sparkSession):
        members = materialize(domain_posteriors(docs, labels, doc_id=doc_id, text=text))
        fitted = materialize(fit_rates(members, [targets[d] for d in DOMAINS]), outer=True)
    return fitted.select(doc_id, "n_tokens", *[F.get("p", i).alias(f"p_{d}") for i, d in enumerate(DOMAINS)], "rate", "worst_gap")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_to_targets(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
