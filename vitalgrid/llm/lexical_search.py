"""Ranked lexical search by Block-Max MaxScore over segments.

``index_segments`` turns runs of documents into segments, one row each: document ids and sizes, and per
term its postings in blocks of ``BLOCK``, each packed by itself.  A block also carries the pairs (occurrences,
document size) that no other pair of the block beats in both; they bound every score in the block once the
corpus totals are known, without unpacking it.

``search_segments`` runs every item over every segment.  The bounds of whole lists part an item's terms:
the lists with the smallest bounds whose sum stays below the tenth score so far cannot make a result alone,
so only documents of the other, essential lists are candidates.  What a candidate can still gain is then
bounded by the maxima of the blocks it falls in, and blocks are unpacked only for candidates that may
still reach the results.  Heaps are carried from segment to segment of a task and merged at the end.

The items' terms meet the corpus' document frequencies in a join, and items are dealt into blocks of
bounded size, each of which is run over all segments.  Nothing grows with the corpus outside Spark's
tables: a segment covers about ``segment_bytes`` of text, a heap holds ``k`` documents an item.

Defined results: a null or empty text has no terms, is no document of the totals and is never found; a null
id is kept and comes last among equal scores; repeated rows are documents of their own (they tie); items are
distinct pairs of id and text, so a repeated item is answered once and an item without terms not at all;
no documents or no items give no rows; further columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalgrid.llm.arrow_words import slices, words
from vitalgrid.llm.common import BROADCAST_BYTES, alnum_words, materialize, small_side
from vitalgrid.llm.packing import from_planes, planes

BLOCK = 128


def _skyline(block: np.ndarray, tf: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block, occurrences and size of the pairs that none of their block beats with more occurrences and a smaller size."""
    order = np.lexsort((size, -tf, block))
    block, tf, size = block[order], tf[order], size[order]
    wide = int(size.max(initial=0)) + 1
    least = np.minimum.accumulate(size - block * wide)  # falls with each new block, so no block sees the one before
    best = np.r_[True, (size - block * wide)[1:] < least[:-1]][: len(size)]
    return block[best], tf[best], size[best]


def _pack(doc: np.ndarray, tf: np.ndarray, first: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Postings of blocks that start at ``first``: gaps and occurrences in as few bytes a number as the block needs."""
    stop = np.r_[first[1:], len(doc)]
    gap = np.diff(doc, prepend=0)
    gap[first] = 0
    kinds = (np.uint8, np.uint16, np.uint32)
    width = lambda x: np.searchsorted([1 << 8, 1 << 16], np.maximum.reduceat(x, first), side="right")
    out, ends, at = [], [], 0
    for a, b, g, t in zip(first.tolist(), stop.tolist(), width(gap).tolist(), width(tf).tolist()):
        raw = bytes((g, t)) + gap[a:b].astype(kinds[g]).tobytes() + tf[a:b].astype(kinds[t]).tobytes()
        out.append(raw)
        ends.append(at := at + len(raw))
    return b"".join(out), np.array(ends, np.int64)


def _segment(ids: list, sizes: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, names: list[str]) -> dict:
    """One row of the index from postings sorted by term and document."""
    own, start, df = np.unique(term, return_index=True, return_counts=True)
    place = np.arange(len(doc)) - np.repeat(start, df)
    first = np.flatnonzero(place % BLOCK == 0)
    block = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(doc)]))
    data, ends = _pack(doc, tf, first) if len(doc) else (b"", np.zeros(0, np.int64))
    sky_block, sky_tf, sky_size = _skyline(block, tf, sizes[doc])
    last = np.r_[first[1:], len(doc)][: len(first)] - 1
    return {
        "ids": ids, "sizes": planes(sizes), "terms": [names[i] for i in own.tolist()], "df": df.tolist(), "first": planes(doc[first]), "last": planes(doc[last]), "ends": planes(ends),
        "sky": planes(np.bincount(sky_block, minlength=len(first))), "sky_tf": planes(sky_tf), "sky_size": planes(sky_size), "postings": data, "n_docs": len(ids), "n_terms": int(sizes.sum()),
    }


INDEX_COLUMNS = "sizes binary, terms array<string>, df array<bigint>, first binary, last binary, ends binary, sky binary, sky_tf binary, sky_size binary, postings binary, n_docs long, n_terms long"


def index_segments(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", vocabulary: list[str] | None = None, segment_bytes: int = 16 << 20) -> DataFrame:
    """Segments of ``docs``; ``vocabulary`` leaves out the postings of all other terms (sizes and totals count them)."""
    spark = docs.sparkSession
    known = None if vocabulary is None else spark.sparkContext.broadcast(vocabulary)
    kind = docs.schema[doc_id].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = None if known is None else pa.array(known.value, pa.string())
        names: dict[str, int] = {}
        ids: list = []
        parts: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, parts, held, names
            sizes, doc, term, tf = (np.concatenate([p[i] for p in parts]) for i in range(4))
            order = np.lexsort((doc, term))
            row = _segment(ids, sizes, doc[order], term[order], tf[order], listed.to_pylist() if listed is not None else list(names))
            out = pa.RecordBatch.from_pylist([row], schema=shape)
            ids, parts, held, names = [], [], 0, {}
            return out

        for batch in batches:
            shape = pa.schema([("ids", pa.list_(batch.schema.field(0).type)), ("sizes", pa.binary()), ("terms", pa.list_(pa.string())), ("df", pa.list_(pa.int64())), *((n, pa.binary()) for n in ("first", "last", "ends", "sky", "sky_tf", "sky_size", "postings")), ("n_docs", pa.int64()), ("n_terms", pa.int64())])
            for part in slices(batch, 1):
                row, flat = words(part.column(1))
                size = np.bincount(row, minlength=part.num_rows)
                with_terms = np.flatnonzero(size)
                if not len(with_terms):
                    continue
                place = np.cumsum(size > 0) - 1 + len(ids)
                if listed is not None:
                    code = pc.index_in(flat, value_set=listed)
                    there = pc.is_valid(code)
                    row, code = row[there.to_numpy(zero_copy_only=False)], code.filter(there).to_numpy().astype(np.int64)
                else:
                    coded = flat.dictionary_encode()
                    code = np.array([names.setdefault(w, len(names)) for w in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()]
                key, tf = np.unique(row * np.int64(1 << 32) + code, return_counts=True)
                parts.append((size[with_terms], place[key >> 32], key & 0xFFFFFFFF, tf))
                ids += part.column(0).take(pa.array(with_terms)).to_pylist()
                held += part.column(1).nbytes
                if held >= segment_bytes:
                    yield flush()
        if parts:
            yield flush()

    return docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).mapInArrow(build, f"ids array<{kind}>, {INDEX_COLUMNS}")


class Segment:
    """A segment as arrays, with bounds under the totals of the corpus."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        sizes = from_planes(row["sizes"], np.int64)
        if int(sizes.max()) * 75 * n_docs < 1 << 63:
            self.m = 25 + (75 * sizes * n_docs) // n_terms
        else:
            self.m = np.array([25 + 75 * n * n_docs // n_terms for n in sizes.tolist()], np.int64)
        self.first, self.last, self.ends = (from_planes(row[c], np.int64) for c in ("first", "last", "ends"))
        self.postings = row["postings"]
        n_blocks = [-(-n // BLOCK) for n in row["df"]]
        upto = np.cumsum([0, *n_blocks]).tolist()
        self.blocks = {t: (a, b) for t, a, b in zip(row["terms"], upto, upto[1:])}
        sky, tf, size = (from_planes(row[c], np.int64) for c in ("sky", "sky_tf", "sky_size"))
        self.most = np.zeros(0, np.int64)
        if len(sky):
            m = 25 + np.array([75 * n * n_docs // n_terms for n in size.tolist()], np.int64)
            self.most = np.maximum.reduceat(impact(tf, m), np.cumsum(np.r_[0, sky[:-1]]))
        self.cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def unpack(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a block and what the term gives them, before its weight."""
        if (found := self.cache.get(block)) is None:
            raw = self.postings[int(self.ends[block - 1]) if block else 0 : int(self.ends[block])]
            gap, occur = (1, 2, 4)[raw[0]], (1, 2, 4)[raw[1]]
            n = (len(raw) - 2) // (gap + occur)
            doc = np.cumsum(np.frombuffer(raw, f"u{gap}", n, 2), dtype=np.int64) + self.first[block]
            tf = np.frombuffer(raw, f"u{occur}", n, 2 + n * gap).astype(np.int64)
            found = self.cache[block] = doc, impact(tf, self.m[doc])
        return found

    def unpack_all(self, blocks: list[int]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.unpack(b) for b in blocks]
        return (found[0] if len(found) == 1 else (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])))


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def best_of(seg: Segment, terms: list[tuple[str, int]], floor: int, k: int, window: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of documents that may belong to the ``k`` best, none below ``floor``."""
    lists = []
    for term, weight in terms:
        if weight > 0 and (span := seg.blocks.get(term)):
            lists.append((weight * int(seg.most[span[0] : span[1]].max()), weight, *span))
    lists.sort()
    below = np.cumsum([0, *(x[0] for x in lists)])  # what the first i lists can give together
    places, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    width = 256
    lo = 0
    while lo < len(seg.m) and below[-1] >= max(floor, 1):
        hi, width = min(lo + width, len(seg.m)), window
        n_lower = int(np.searchsorted(below[1:], floor, side="left"))  # lists that cannot reach the floor together
        own = np.zeros(hi - lo, np.int64)
        for _, weight, a, b in lists[n_lower:]:
            x, y = a + np.searchsorted(seg.last[a:b], lo), a + np.searchsorted(seg.first[a:b], hi)
            if x < y:
                doc, gain = seg.unpack_all(range(x, y))
                s, e = np.searchsorted(doc, (lo, hi))
                own[doc[s:e] - lo] += weight * gain[s:e]
        at = np.flatnonzero(own)
        own, at = own[at], at + lo
        left = own + below[n_lower] >= floor
        own, at = own[left], at[left]
        if n_lower and len(at):
            block = np.empty((n_lower, len(at)), np.int64)
            more = np.zeros((n_lower, len(at)), np.int64)
            for i, (_, weight, a, b) in enumerate(lists[:n_lower]):
                block[i] = a + np.searchsorted(seg.last[a:b], at)
                inside = np.flatnonzero(block[i] < b)
                inside = inside[seg.first[block[i, inside]] <= at[inside]]
                more[i, inside] = weight * seg.most[block[i, inside]]
            rest = more.sum(0)
            for i in range(n_lower - 1, -1, -1):
                left = own + rest >= floor
                if not left.all():
                    own, at, rest, block, more = own[left], at[left], rest[left], block[:, left], more[:, left]
                if not len(at):
                    break
                rest -= more[i]
                ask = np.flatnonzero(more[i])
                if len(ask):
                    doc, gain = seg.unpack_all(np.unique(block[i, ask]).tolist())
                    found = np.minimum(np.searchsorted(doc, at[ask]), len(doc) - 1)
                    own[ask] += np.where(doc[found] == at[ask], lists[i][1] * gain[found], 0)
        left = own >= max(floor, 1)
        places, scores = np.r_[places, at[left]], np.r_[scores, own[left]]
        if len(scores) >= k:
            floor = max(floor, int(np.partition(scores, -k)[-k]))
            left = scores >= floor  # all that tie stay, as their ids decide
            places, scores = places[left], scores[left]
        lo = hi
    return places, scores


def _terms(text: Column) -> Column:
    """Words of ASCII letters, digits and all non-ASCII characters, of which only A-Z go to lower case."""
    return alnum_words(text, lambda t: F.translate(t, string.ascii_uppercase, string.ascii_lowercase))


def _weighted_items(items: DataFrame, segments: DataFrame, item_id: str, text: str, n_docs: int, block_bytes: int) -> tuple[DataFrame, int]:
    """Items with their terms and weights, dealt into blocks, one row a block; and how many blocks."""
    once = items.select(F.col(item_id).alias("item"), F.col(text).alias("text")).distinct()
    terms = once.select("item", F.xxhash64("text").alias("body"), F.explode(_terms(F.col("text"))).alias("term"))
    asked = terms.groupBy("item", "body", "term").agg(F.count("*").alias("q"))
    df = segments.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.df").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0)))
    weighed = asked.join(df, "term").withColumn("w", F.col("q") * weight).groupBy("item", "body").agg(F.collect_list(F.struct("term", "w")).alias("terms"))
    weighed = materialize(weighed)
    held = weighed.agg(F.sum(F.aggregate("terms", F.lit(0), lambda s, x: s + 24 + F.octet_length(x["term"])))).first()[0] or 0
    n = max(1, -(-int(held) // block_bytes))
    blocks = weighed.groupBy(F.pmod(F.xxhash64("item", "body"), F.lit(n)).cast("int").alias("block")).agg(F.collect_list(F.struct("item", "body", "terms")).alias("items"))
    return blocks, n


def search_segments(segments: DataFrame, items: DataFrame, *, item_id: str = "item_id", text: str = "text", k: int = 10, block_bytes: int = 1 << 20) -> DataFrame:
    """``item, body, rank, doc_id, score``: the ``k`` best documents of each item; ``segments`` is a written table."""
    totals = segments.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = totals[0] or 0, totals[1] or 0
    blocks, n_blocks = _weighted_items(items, segments, item_id, text, n_docs, block_bytes)
    blocks = materialize(blocks)
    id_kind, item_kind = segments.schema["ids"].dataType.elementType.simpleString(), items.schema[item_id].dataType.simpleString()
    asked = segments.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).join(small_side(blocks), "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, list] = {}  # (block, place of the item) -> item, body, [(score, null, id)]
        parsed: dict[int, list] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                number = row["block"].as_py()
                if number not in parsed:
                    parsed.clear()  # one block at a time is held
                    parsed[number] = [(x["item"], x["body"], [(t["term"], t["w"]) for t in x["terms"]]) for x in row["items"].as_py()]
                seg = Segment({c: v.as_py() for c, v in row.items() if c not in ("ids", "items", "block")}, n_docs, n_terms)
                ids = row["ids"].values
                for item, body, terms in parsed[number]:
                    _, _, heap = best.setdefault((item, body), (item, body, []))
                    places, scores = best_of(seg, terms, heap[-1][0] if len(heap) == k else 0, k)
                    if len(places):
                        found = [(s, x is None, x) for s, x in zip(scores.tolist(), ids.take(pa.array(places)).to_pylist())]
                        heap[:] = sorted([*heap, *found], key=lambda x: (-x[0], x[1], x[2] if not x[1] else 0))[:k]
        rows = [(item, body, x[2], x[0]) for item, body, heap in best.values() for x in heap]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (batch.schema.field("items").type.value_type.field("item").type, pa.int64(), batch.schema.field("ids").type.value_type, pa.int64()))], names=["item", "body", "doc_id", "score"])

    heaps = asked.mapInArrow(run, f"item {item_kind}, body long, doc_id {id_kind}, score long")
    order = Window.partitionBy("item", "body").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return heaps.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item", "body", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", k: int = 10, segment_bytes: int = 16 << 20, vocabulary_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``rank, doc_id, score`` of the ``k`` best documents of each item under its id.

    Only the items' terms are indexed while their list takes at most ``vocabulary_bytes``, else all terms are.
    """
    terms = items.select(F.explode(_terms(F.col(text))).alias("term")).distinct()
    terms = materialize(terms)
    held = terms.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    vocabulary = sorted(r.term for r in terms.collect()) if held <= vocabulary_bytes else None
    segments = materialize(index_segments(docs, doc_id=doc_id, text=text, vocabulary=vocabulary, segment_bytes=segment_bytes))
    found = search_segments(segments, items, item_id=item_id, text=text, k=k)
    return found.select(F.col("item").alias(item_id), "rank", F.col("doc_id").alias(doc_id), "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP11_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
words AS (SELECT r, unnest(w) AS term FROM docs),
tf AS (SELECT r, term, count(*) AS tf FROM words GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
total AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM docs WHERE len(w) > 0),
sized AS (SELECT r, doc_id, 25 + (75 * CAST(len(w) AS BIGINT) * n) // l AS m FROM docs, total WHERE len(w) > 0),
items AS (SELECT DISTINCT item_id, text FROM benchmark),
asked AS (SELECT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM items),
q AS (SELECT item_id, text, term, count(*) AS q FROM asked GROUP BY ALL),
scored AS (
  SELECT q.item_id, q.text, s.r, s.doc_id, CAST(sum(q.q * CAST(floor(1000 * ln((2.0 * t.n + 2.0)::DOUBLE / (2.0 * df.df + 1.0)::DOUBLE)) AS BIGINT) * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * s.m))) AS BIGINT) AS score
  FROM q JOIN df USING (term) JOIN tf USING (term) JOIN sized s USING (r), total t GROUP BY ALL),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
