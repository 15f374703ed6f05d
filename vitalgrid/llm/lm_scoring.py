"""Language-model scores from a weighted backoff automaton whose counts never leave the cluster.

The corpus is dealt into blocks of bounded text.  Each block sends its distinct n-gram hashes with
its own training counts to hash buckets; a bucket adds the counts of all blocks and answers each
block with the totals of exactly the n-grams that block asked for.  A block then holds the part of
the model that its documents can touch, whatever the size of the whole model:

* states are the histories seen in training: word pairs, single words (and the text's start), and
  the root without history;
* an arc ``history -> word`` carries ``(c(history word) + m p(word | shorter)) / (c(history) + m)``, and
  the root's arcs ``p(word)``, the additive estimate that the base score uses;
* the failure arc of a history carries ``m / (c(history) + m)`` and leads to the history without its
  first word: from a pair to its second word, from there to the root.

For each history the weights sum to one over words, end and one unseen word.  One left-to-right
traversal carries the state and adds log10 probabilities; all texts of a block take their steps side
by side, and a long text is cut into stretches, each of which starts in the state that the two words
before it lead to.

A row is what one block asks of one bucket, a few microseconds of work each; there are at most as many
rows as n-grams.  Words are compared by 64-bit hashes, pairs and triples by ``NGRAM_BITS`` bits: with M distinct
n-grams in training, one that training lacks is taken for a seen one with a chance of M / 2 ** 46, which is 1.4e-6 at a
hundred million (about a gigabyte of text), 1.4e-5 at a billion and 1.4 % at 1e12.  A larger corpus wants more
bits, at 3 bytes more for each n-gram that moves.  ``base_score`` and ``n_known`` rest on words alone.

Defined results: null text is empty and scores its end only; a null id is in training (its hash is
taken of the empty text); repeated rows are repeated documents, in the counts as well; an empty
table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.common import give_back, materialize
from vitalgrid.llm.packing import from_narrow, from_slim, narrow, slim

NGRAM_BITS = 46
STRETCH = 256  # places of a text that are read one after the other
END = np.uint64(xxhash.xxh3_64_intdigest(b"", seed=1))
START = np.uint64(xxhash.xxh3_64_intdigest(b"", seed=2))


def tokenize(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Word ids of all texts, the number of words of each, and the distinct words."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    parent = pc.list_parent_indices(lists).to_numpy()
    flat = lists.flatten()
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    coded = flat.filter(pa.array(full)).dictionary_encode()
    size = np.bincount(parent[full], minlength=len(texts))
    return coded.indices.to_numpy().astype(np.int64), size, [w.encode() for w in coded.dictionary.to_pylist()]


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (a >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Grams:
    """Distinct n-grams of one length in a block: sorted hashes and own counts, and the way back to their numbers."""

    def __init__(self, hashes: np.ndarray, own: np.ndarray, bits: int):
        short = hashes >> np.uint64(64 - bits)
        self.bits, self.order = bits, np.argsort(short)
        self.hash, self.own = short[self.order], own[self.order]

    def total(self, answered: np.ndarray) -> np.ndarray:
        if len(answered) != len(self.order):
            raise RuntimeError("a block was dealt differently in the two passes")
        out = np.empty(len(answered), np.uint64)
        out[self.order] = answered
        return out


class Block:
    """The n-grams of a block of texts and where they stand."""

    def __init__(self, texts: pa.Array, train: np.ndarray):
        words, self.size, names = tokenize(texts)
        n = len(names)
        self.start = n + 1
        self.width = np.int64(n + 2)
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in names] + [END, START], np.uint64)
        # every document: start (history only), its words, end
        stop = np.cumsum(self.size + 1) - 1
        self.first = stop - self.size
        total = int(self.size.sum()) + len(self.size)
        self.token = np.full(total, n, np.int64)
        inside = np.ones(total, bool)
        inside[stop] = False
        self.token[inside] = words
        self.history = np.empty(total, np.int64)
        self.history[1:] = self.token[:-1]
        self.history[self.first] = self.start
        trained = np.repeat(train, self.size + 1)

        own = np.bincount(self.token[trained], minlength=self.width).astype(np.uint64)
        own[self.start] = np.count_nonzero(train)
        self.words = Grams(hashes, own, 64)

        self.pair_key, self.pair_of = np.unique(self.history * self.width + self.token, return_inverse=True)
        own = np.bincount(self.pair_of[trained], minlength=len(self.pair_key)).astype(np.uint64)
        pair_hash = _joined(hashes[self.pair_key // self.width], hashes[self.pair_key % self.width])
        self.pairs = Grams(pair_hash, own, NGRAM_BITS)

        # a text's first place has no pair before it
        later = np.ones(total, bool)
        later[self.first] = False
        later = np.flatnonzero(later)
        key, which = np.unique(self.pair_of[later - 1] * self.width + self.token[later], return_inverse=True)
        place = np.empty(len(key), np.int64)
        place[which] = np.arange(len(which))
        self.triple_before, self.triple_last = key // self.width, self.pair_of[later[place]]
        self.triple_of = np.full(total, -1, np.int64)
        self.triple_of[later] = which
        own = np.bincount(which[trained[later]], minlength=len(key)).astype(np.uint64)
        self.triples = Grams(_joined(pair_hash[self.triple_before], hashes[key % self.width]), own, NGRAM_BITS)


def bucket_bases(bits: int, buckets: int) -> np.ndarray:
    """The first hash of each bucket, an equal range of hashes."""
    return np.array([-(-(i << bits) // buckets) for i in range(buckets)], np.uint64)


KINDS = {"word": 64, "pair": NGRAM_BITS, "triple": NGRAM_BITS}
ASKED = "bucket int, block int, " + ", ".join(f"{k} binary, {k}_width int, {k}_own binary" for k in KINDS)
ANSWERED = "block int, bucket int, " + ", ".join(f"{k} binary" for k in KINDS)


def _edges(hashes: np.ndarray, bases: np.ndarray) -> np.ndarray:
    return np.r_[np.searchsorted(hashes, bases), len(hashes)]


def _ask(buckets: int):
    def run(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        b = Block(block.column("text").combine_chunks(), block.column("train").to_numpy().astype(bool))
        columns, filled = {}, np.zeros(buckets, bool)
        for kind, grams in zip(KINDS, (b.words, b.pairs, b.triples)):
            bases = bucket_bases(grams.bits, buckets)
            edges = _edges(grams.hash, bases)
            filled |= edges[1:] > edges[:-1]
            width, columns[kind] = narrow(grams.hash, edges, bases)
            columns[f"{kind}_width"] = [width] * buckets
            columns[f"{kind}_own"] = slim(grams.own, edges)
        kept = np.flatnonzero(filled).tolist()
        name = block.column("block")[0].as_py()
        out = {"bucket": pa.array(kept, pa.int32()), "block": pa.array([name] * len(kept), pa.int32())}
        for c, values in columns.items():
            out[c] = pa.array([values[i] for i in kept], pa.int32() if c.endswith("_width") else pa.binary())
        return pa.table(out)

    return run


def _asked(rows: pa.Table, kind: str, buckets: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Hashes and own counts of each row."""
    base = int(bucket_bases(KINDS[kind], buckets)[rows.column("bucket")[0].as_py()])
    hashes = [from_narrow(x, w, base) for x, w in zip(rows.column(kind).to_pylist(), rows.column(f"{kind}_width").to_pylist(), strict=True)]
    own = [from_slim(x, len(h)) for x, h in zip(rows.column(f"{kind}_own").to_pylist(), hashes, strict=True)]
    return hashes, own


def _totals(hashes: list[np.ndarray], own: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Totals of the distinct hashes, and the number among these of every hash in turn."""
    _, which = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.zeros(int(which.max(initial=-1)) + 1, np.uint64)
    np.add.at(total, which, np.concatenate(own))
    return total, which


def _answer(buckets: int):
    def run(asked: pa.Table) -> pa.Table:
        out = {"block": asked.column("block"), "bucket": asked.column("bucket")}
        for kind in KINDS:
            hashes, own = _asked(asked, kind, buckets)
            total, which = _totals(hashes, own)
            out[kind] = pa.array(slim(total[which], np.cumsum([0, *map(len, hashes)])), pa.binary())
        return pa.table(out)

    return run


def _count(buckets: int):
    """Training tokens of a bucket and how many of its words (and the end) have any."""

    def run(asked: pa.Table) -> pa.Table:
        hashes, own = _asked(asked, "word", buckets)
        total, _ = _totals(hashes, [np.where(h == START, np.uint64(0), c) for h, c in zip(hashes, own, strict=True)])
        return pa.table({"n": pa.array([int(total.sum())], pa.int64()), "v": pa.array([int(np.count_nonzero(total))], pa.int64())})

    return run


class Automaton:
    """The part of the model that a block can touch.

    State 0 is the root, ``1 + w`` the history of word ``w``, ``1 + width + p`` that of pair ``p``.
    """

    def __init__(self, block: Block, word: np.ndarray, pair: np.ndarray, triple: np.ndarray, n: int, v: int, weight: float):
        self.block, self.width = block, int(block.width)
        p_word = (word + 0.5) / (n + 0.5 * (v + 1))
        before, last = block.pair_key // block.width, block.pair_key % block.width
        p_pair = (pair + weight * p_word[last]) / (word[before] + weight)
        p_triple = (triple + weight * p_pair[block.triple_last]) / (pair[block.triple_before] + weight)
        self.log_word, self.log_pair, self.log_triple = np.log10(p_word), np.log10(p_pair), np.log10(p_triple)
        self.word_seen, self.pair_seen, self.triple_seen = word > 0, pair > 0, triple > 0
        self.fail = np.concatenate([[0.0], np.log10(weight / (word + weight)), np.log10(weight / (pair + weight))])
        self.below = np.concatenate([np.zeros(1 + self.width, np.int64), 1 + last])

    def state_before(self, at: np.ndarray) -> np.ndarray:
        """The longest history before each place that training has seen."""
        b = self.block
        word = np.where(self.word_seen[b.history[at]], 1 + b.history[at], 0)
        pair = b.pair_of[np.maximum(at - 1, 0)]
        return np.where((b.triple_of[at] >= 0) & self.pair_seen[pair], 1 + self.width + pair, word)

    def step(self, state: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log10 weight of reading the token at each place, and the state after it."""
        b = self.block
        token, pair, triple = b.token[at], b.pair_of[at], b.triple_of[at]
        in_pair = state > self.width
        arc = in_pair & (triple >= 0) & self.triple_seen[triple] if len(self.triple_seen) else np.zeros(len(at), bool)
        gain = np.zeros(len(at))
        gain[arc] = self.log_triple[triple[arc]]
        fails = in_pair & ~arc
        gain[fails] += self.fail[state[fails]]
        state = np.where(fails, self.below[state], state)
        in_word = (state > 0) & ~arc
        other = in_word & self.pair_seen[pair]
        gain[other] += self.log_pair[pair[other]]
        fails = in_word & ~other
        gain[fails] += self.fail[state[fails]]
        root = ~(arc | other)
        gain[root] += self.log_word[token[root]]
        after = np.where(self.pair_seen[pair], 1 + self.width + pair, np.where(self.word_seen[token], 1 + token, 0))
        return gain, after

    def scores(self) -> np.ndarray:
        """Log10 probability of each text."""
        b = self.block
        size = b.size + 1
        pieces = -(-size // STRETCH)
        text = np.repeat(np.arange(len(size)), pieces)
        rank = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = b.first[text] + rank * STRETCH
        length = np.minimum(size[text] - rank * STRETCH, STRETCH)
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        state, total = self.state_before(first), np.zeros(len(first))
        for t in range(int(length.max(initial=0))):
            active = int(np.searchsorted(-length, -t, side="left"))
            gain, state[:active] = self.step(state[:active], first[:active] + t)
            total[:active] += gain
        return np.bincount(text[order], weights=total, minlength=len(size))


def _score(weight: float, id_type: pa.DataType):
    out = pa.schema([("id", id_type), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        if not block.num_rows:
            return out.empty_table()
        block = block.combine_chunks()
        train = block.column("train").to_numpy().astype(bool)
        b = Block(block.column("text").combine_chunks(), train)
        answers = answers.sort_by("bucket")
        n, v, buckets = (answers.column(c)[0].as_py() for c in ("n", "v", "buckets"))
        totals = []
        for kind, grams in zip(KINDS, (b.words, b.pairs, b.triples)):
            size = np.diff(_edges(grams.hash, bucket_bases(grams.bits, buckets)))[answers.column("bucket").to_numpy()]
            totals.append(grams.total(np.concatenate([from_slim(x, k) for x, k in zip(answers.column(kind).to_pylist(), size.tolist(), strict=True)])))
        model = Automaton(b, *totals, n, v, weight)
        base = np.add.reduceat(model.log_word[b.token], b.first)
        known = np.add.reduceat(model.word_seen[b.token].astype(np.int64), b.first)
        return pa.table(
            [block.column("id"), pa.array(~train), pa.array(b.size + 1), pa.array(known), pa.array([n] * len(known), pa.int64()), pa.array(base), pa.array(model.scores())],
            schema=out,
        )

    return run


def _given_back(run):
    """``run`` for one group, after which the worker gives its memory back."""

    def inner(rows: pa.Table) -> pa.Table:
        out = run(rows)
        give_back()
        return out

    return inner


def _given_back2(run):
    def inner(rows: pa.Table, others: pa.Table) -> pa.Table:
        out = run(rows, others)
        give_back()
        return out

    return inner


def lm_scores(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    weight: float = 2.0,
    block_chars: int = 8_000_000,
    bucket_chars: int = 4_000_000,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Documents with ``crc32(id as text) mod 5 <> 1`` train the model.  ``weight`` is m above.
    ``block_chars`` and ``bucket_chars`` bound what one task holds; the numbers of blocks and buckets
    follow from the corpus size.  Rows are dealt by the hash of id and text, which any task that runs again
    repeats, whatever order its rows come in.  Where one document is repeated so often that its rows fill a block,
    rows are written once and dealt by their place in what was written.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    repeated = docs.groupBy(F.col(doc_id).alias("id"), F.xxhash64(text).alias("body")).agg(F.count("*").alias("rows"), F.sum(16 + F.coalesce(F.length(text), F.lit(0))).alias("chars"))
    chars, fills = repeated.agg(F.sum(F.col("chars") - 16 * F.col("rows")), F.max(F.when(F.col("rows") > 1, F.col("chars")))).first()
    chars = chars or 0
    blocks, buckets = 1 + chars // block_chars, 1 + chars // bucket_chars
    id_type = docs.schema[doc_id].dataType
    crc = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    own = F.xxhash64(doc_id, text)
    if (fills or 0) > block_chars // 2:
        docs, own = materialize(docs.select(doc_id, text)), F.xxhash64(F.monotonically_increasing_id())
    dealt = docs.select(
        F.pmod(own, F.lit(blocks)).cast("int").alias("block"),
        F.col(doc_id).alias("id"),
        (crc % 5 != 1).alias("train"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    by_block = dealt.groupBy("block")
    asked = by_block.applyInArrow(_given_back(_ask(buckets)), ASKED).groupBy("bucket")
    sizes = asked.applyInArrow(_given_back(_count(buckets)), "n long, v long").agg(F.sum("n").alias("n"), F.sum("v").alias("v"), F.lit(buckets).alias("buckets"))
    answers = asked.applyInArrow(_given_back(_answer(buckets)), ANSWERED).crossJoin(F.broadcast(sizes))  # one row
    scored = by_block.cogroup(answers.groupBy("block")).applyInArrow(
        _given_back2(_score(weight, to_arrow_type(id_type))),
        f"id {id_type.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
    return scored.withColumnRenamed("id", doc_id)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
