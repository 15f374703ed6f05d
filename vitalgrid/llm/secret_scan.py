"""Secret scans that weigh each candidate by how many owners hold it.

One pass over the texts finds candidates: the three base patterns, strings with an issuer's fixed prefix, key
blocks, and long mixed strings of high entropy.  Only their places and hashes leave the pass.  The corpus then decides
between look-alikes: hashes are counted by distinct repositories and owners (one row for each owner and hash
meets another, so a string that half of all documents copy costs no more than its owners).  What many owners hold
is an example, copied from documentation or templates; what one owner holds, in however many of that
owner's documents, is owner-specific and likely live.

Base spans are reported whatever their verdict.  Of the candidates that the method adds, those that only few owners hold
are reported, and only where no base span overlaps them: a hash in the base has its verdict there.

Defined results: a null or empty text has no spans; a null owner or repository counts as one owner or
repository of its own; repeated rows are reported each, and being of one repository they do not make a secret common;
a null id is kept; no documents give no rows; further columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.arrow_words import slices
from vitalgrid.llm.common import materialize, small_side

#: Fixed base patterns: kind, pattern, group that holds the value, least length of it.
BASE = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
#: Patterns of the method itself: strings with an issuer's prefix, key blocks, long mixed strings.
ADDED = (
    ("issued", r"(?:gh[pousr]_|github_pat_|xox[abprs]-|sk-|sk_live_|rk_live_|glpat-|AIza|npm_|SG\.)[A-Za-z0-9_.-]{16,}", 0),
    ("block", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----", 0),
    ("random", r"[A-Za-z0-9+/_=-]{24,}", 0),
)
KINDS = tuple(k for k, *_ in (*BASE, *ADDED))
#: A text without a match of this has no candidate. Runs of the base patterns are written with their least lengths.
SCREEN = r"(?i:password|passwd|secret|token|api_?key)|AKIA[A-Z0-9]{12}|[0-9a-f]{32}|[A-Za-z0-9+/_=-]{24}|(?:gh[pousr]_|xox[abprs]-|sk-|sk_live_|rk_live_|glpat-|AIza|npm_|SG\.)[A-Za-z0-9_.-]{16}|PRIVATE KEY-----"

_BASE = {
    "assign": re.compile(BASE[0][1], re.ASCII | re.IGNORECASE),
    "access": re.compile(BASE[1][1]),
    "hex": re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}"),  # whole runs that are long enough
}
_ADDED = {k: re.compile(p) for k, p, _ in ADDED}


def entropy(value: str) -> float:
    """Bits a character."""
    n = np.unique(np.frombuffer(value.encode(), np.uint8), return_counts=True)[1] / len(value.encode())
    return float(-(n * np.log2(n)).sum())


def _mixed(value: str, least_bits: float) -> bool:
    """Letters of both cases and digits, as random strings have and words, numbers and paths do not."""
    return bool(re.search("[a-z]", value) and re.search("[A-Z]", value) and re.search("[0-9]", value)) and value.count("/") <= 2 and entropy(value) >= least_bits


def _joined(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of what ``spans`` cover, as spans that do not touch."""
    starts, ends = [], []
    for s, e in sorted(spans):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def candidates(text: str, least_bits: float = 4.0) -> list[tuple[str, int, int, str]]:
    """``kind, start, end, value`` of base matches and of the method's candidates that touch none of them."""
    out = []
    for kind, _, group, least in BASE:
        out += [(kind, m.start(), m.end(), m[group]) for m in _BASE[kind].finditer(text) if len(m[group]) >= least]
    for kind, pattern in _ADDED.items():
        starts, ends = _joined([(s, e) for _, s, e, _ in out])
        for m in pattern.finditer(text):
            s, e = m.span()
            i = bisect_right(ends, s)  # the first span that ends after s
            if (i == len(starts) or e <= starts[i]) and (kind != "random" or _mixed(m[0], least_bits)):
                out.append((kind, s, e, m[0]))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def find_candidates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least_bits: float = 4.0) -> DataFrame:
    """``doc_id, repository, owner, spans`` for every row of ``doc_id, repository, owner, text``."""
    kind_of = docs.schema[doc_id].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("hash", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 3):
                texts = part.column(3)
                found: list[list] = [[] for _ in range(part.num_rows)]
                for i in np.flatnonzero(pc.fill_null(pc.match_substring_regex(texts, SCREEN), False).to_numpy(zero_copy_only=False)).tolist():
                    found[i] = [{"kind": k, "start": s, "end": e, "hash": xxhash.xxh3_128_digest(v)} for k, s, e, v in candidates(texts[i].as_py(), least_bits)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(found, pa.list_(span))], names=[doc_id, "repository", "owner", "spans"])

    return docs.select(doc_id, "repository", "owner", text).mapInArrow(run, f"`{doc_id}` {kind_of}, repository long, owner long, spans array<struct<kind: string, start: int, end: int, hash: binary>>")


def ownership(found: DataFrame) -> DataFrame:
    """``hash, repositories, owners``: how many distinct ones hold each candidate."""
    held = found.select("owner", "repository", F.explode("spans.hash").alias("hash")).distinct()
    by_owner = held.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    return by_owner.groupBy("hash").agg(F.sum("repositories").alias("repositories"), F.count("*").alias("owners"))


def scan_secrets(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", owner: str = "source", repository: str | None = None, many_owners: int = 3, few_owners: int = 1, least_bits: float = 4.0) -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end, hash, repositories, owners, verdict) for every row, by start and kind.

    Verdicts: ``example`` from ``many_owners`` owners on, ``live`` up to ``few_owners``, ``unsure`` between. Spans of the
    method's own kinds are kept where they are live. Without a ``repository`` column a document's distinct text is one.
    """
    repository_of = F.xxhash64(F.lit(1), F.col(repository)) if repository else F.xxhash64(F.col(text))
    rows = docs.select(F.col(doc_id), repository_of.alias("repository"), F.xxhash64(F.lit(1), F.col(owner)).alias("owner"), F.col(text))
    found = materialize(find_candidates(rows, doc_id=doc_id, text=text, least_bits=least_bits).withColumn("row", F.monotonically_increasing_id()))
    counted = materialize(ownership(found).filter((F.col("owners") > few_owners) | (F.col("repositories") > 1)))
    spans = found.filter(F.size("spans") > 0).select("row", F.explode("spans").alias("s")).select("row", "s.*")
    once = F.coalesce("repositories", F.lit(1)).alias("repositories"), F.coalesce("owners", F.lit(1)).alias("owners")  # what is not listed stands in one
    judged = spans.join(small_side(counted), "hash", "left").select("row", "kind", "start", "end", "hash", *once)
    verdict = F.when(F.col("owners") >= many_owners, "example").when(F.col("owners") <= few_owners, "live").otherwise("unsure")
    judged = judged.withColumn("verdict", verdict).filter(F.col("kind").isin([k for k, *_ in BASE]) | (F.col("verdict") == "live"))
    place = F.array_position(F.lit(list(KINDS)), F.col("kind"))
    kept = judged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", place.alias("place"), "kind", "end", "hash", "repositories", "owners", "verdict"))).alias("judged"))
    out = found.select(doc_id, "row").join(kept, "row", "left")
    own = F.transform(F.coalesce("judged", F.array()), lambda x: F.struct(*[x[c].alias(c) for c in ("kind", "start", "end", "hash", "repositories", "owners", "verdict")]))
    return out.select(doc_id, own.alias("spans"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("spans", lambda x: x["kind"].isin([k for k, *_ in BASE]))
    of = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    judged = lambda verdict: F.size(F.filter("spans", lambda x: x["verdict"] == verdict)).cast("long").alias(f"n_{verdict}")
    return found.select("doc_id", *[of(k) for k, *_ in BASE], F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"), judged("live"), judged("example"))
