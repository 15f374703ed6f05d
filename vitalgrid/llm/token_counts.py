"""Token counts of a public word-end BPE vocabulary by rank-synchronous array merging.

Pre-tokens of a batch are held as one flat symbol array with sequence numbers.  Each round looks up
the rank of every adjacent pair, takes the lowest rank of each sequence, and merges all its
occurrences in all sequences at once; what survives is the token count.  Counts of distinct words
are kept between batches in a table of bounded size, so a common word is merged once per task.

Defined results: null text counts as empty (0 bytes, 0 tokens); repeated rows give repeated results;
texts of any length are counted whole; further columns are not read.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Pre-token pattern of the vocabulary file, with white space spelt out.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\p{L}\p{N}]+"
NONE = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte value in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + rest.index(b)) for b in range(256)]


class RankMerger:
    """Vocabulary as arrays: pair keys in order, their ranks and products."""

    def __init__(self, path: str, memo_words: int = 300_000):
        spec = json.loads(open(path, encoding="utf-8").read())
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.size = np.int64(len(vocab) + len(spec["added_tokens"]) + 1)
        names = byte_symbols()
        self.inner = np.array([vocab[c] for c in names], np.int64)
        self.last = np.array([vocab[c + end] for c in names], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        key = np.array([vocab[a] for a, _ in merges], np.int64) * self.size + np.array([vocab[b] for _, b in merges], np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.rank = key[order], order.astype(np.int64)
        self.product = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"]))
        self.marks = tuple({t["content"][:2] for t in spec["added_tokens"]})
        self.pattern = regex.compile(PATTERN)
        self.memo: dict[str, int] = {}
        self.memo_words = memo_words

    def merged_sizes(self, pretokens: Sequence[bytes]) -> np.ndarray:
        """Symbols left of each pre-token after all merges."""
        n = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
        raw = np.frombuffer(b"".join(pretokens), np.uint8)
        sym = self.inner[raw]
        ends = np.cumsum(n) - 1
        sym[ends] = self.last[raw[ends]]
        seq = np.repeat(np.arange(len(n)), n)
        out = np.ones(len(n), np.int64)
        while len(sym):
            pair = np.full(len(sym), -1, np.int64)
            pair[:-1] = np.where(seq[:-1] == seq[1:], sym[:-1] * self.size + sym[1:], -1)
            at = np.minimum(np.searchsorted(self.key, pair), len(self.key) - 1)
            rank = np.where(self.key[at] == pair, self.rank[at], NONE)
            first = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            lowest = np.minimum.reduceat(rank, first)
            length = np.diff(np.r_[first, len(seq)])
            done = lowest == NONE
            out[seq[first[done]]] = length[done]
            best = np.repeat(lowest, length)
            keep = best != NONE
            hit = keep & (rank == best)
            # of overlapping occurrences (a a a) every second one of a run counts, from the left
            prev = np.r_[False, hit[:-1]]
            idx = np.arange(len(hit))
            run_start = np.maximum.accumulate(np.where(hit & ~prev, idx, 0))
            hit &= (idx - run_start) % 2 == 0
            sym[hit] = self.product[rank[hit]]
            keep &= ~np.r_[False, hit[:-1]]
            sym, seq = sym[keep], seq[keep]
        return out

    def _pretokens(self, word: str) -> tuple[list[str], int]:
        """Pre-tokens of a word without ASCII white space, and the special strings in it."""
        if word.isascii() and not any(m in word for m in self.marks):
            return self.pattern.findall(word.lower()), 0
        parts = self.special.split(word)
        found: list[str] = []
        for part in parts:
            part = unicodedata.normalize("NFC", part).replace("\u03a3", "\u03c3").lower()
            found += self.pattern.findall(part)
        return found, len(parts) - 1

    def word_sizes(self, words: list[str]) -> np.ndarray:
        memo = self.memo
        if len(memo) > self.memo_words:
            memo.clear()
        new = [w for w in words if w not in memo]
        if new:
            flat: dict[str, int] = {}
            index: list[int] = []
            count, extra = [], []
            for w in new:
                pre, special = self._pretokens(w)
                index += [flat.setdefault(p, len(flat)) for p in pre]
                count.append(len(pre))
                extra.append(special)
            sizes = self.merged_sizes([p.encode("utf-8", "surrogatepass") for p in flat]) if flat else np.zeros(0, np.int64)
            total = np.r_[0, np.cumsum(sizes[np.array(index, np.int64)])]
            upto = np.cumsum(count)
            own = total[upto] - total[upto - np.array(count)] + np.array(extra)
            memo.update(zip(new, own.tolist(), strict=True))
        return np.fromiter((memo[w] for w in words), np.int64, len(words))

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        lists = pc.ascii_split_whitespace(texts)
        parent = pc.list_parent_indices(lists).to_numpy()
        coded = lists.flatten().dictionary_encode()
        sizes = self.word_sizes(coded.dictionary.to_pylist())
        return np.bincount(parent, weights=sizes[coded.indices.to_numpy()], minlength=len(texts)).astype(np.int64)


def count_tokens(
    docs: DataFrame,
    vocabulary: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    rows_at_once: int = 1000,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` for every row; ``vocabulary`` is the path of a word-end BPE file on each node."""
    whole = F.coalesce(F.col(text), F.lit(""))
    parts = docs.select(F.col(doc_id), F.octet_length(whole).cast("long").alias("n_bytes"), whole.alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = RankMerger(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(at, rows_at_once)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(merger.count(part.column(2)))],
                    names=[doc_id, "n_bytes", "n_tokens"],
                )

    id_type = docs.schema[doc_id].dataType.simpleString()
    return parts.mapInArrow(run, f"`{doc_id}` {id_type}, n_bytes long, n_tokens long")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counted = count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)
