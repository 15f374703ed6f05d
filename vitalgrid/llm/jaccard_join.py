"""N-gram Jaccard self-join over a count-vector R-tree.

A document is the set of its distinct four-word shingle hashes; equal sets form one class.  Two
classes link at ``100 * intersection >= percent * union``.

* Shingles are hashed into groups and the group counts of a class are a point.  Points are packed
  into an R-tree (leaves of points close in size, inner nodes with the coordinate-wise maxima of
  their children).  The overlap of two sets is at most the sum of the coordinate minima, so a node
  whose maxima cannot reach the overlap that the smallest size below it needs is not entered.
  Surviving pairs are verified on the sets.
* Most classes are settled before any key is made.  Of a class of ``n`` shingles of which ``u`` stand in
  no other class, every other one holds at most ``n - u``, so with ``100 * (n - u) < percent * n`` it
  links with none.  A fixed share of all hashes is enough to count by, as the shingles of that share
  alone give a smaller ``u``; chance collisions of their shortened hashes make it smaller still.  Only
  what this leaves goes on.
* Trees are small and local to a *cell*.  A linked pair differs in at most ``D`` shingles, so of
  ``D + 1 + e`` hash groups at least ``1 + e`` hold the very same shingles in both: classes that
  agree on no group cannot link.  Each class posts one key per group, for its own size interval and
  for the next larger one.  Classes connected by shared keys form a cell, so every linked pair lies
  in one cell.
* Groups that hold nothing, or only shingles that many documents have, are *weak*: they would glue
  pages together that merely share a passage.  A class with at most ``e`` weak groups does not post
  them, since one of its ``1 + e`` equal groups is another.  Which shingles are common is read from a
  table of ``2 ** BUCKET_BITS`` counters over all documents; it decides how much work is done, never
  which links are found.
* Within a cell, classes and tree nodes of one component already are not compared again, so a group
  of copies costs about one comparison each and no pair list is ever made.  A cell above
  ``cell_rows`` classes or ``CELL_BYTES`` is dealt into chunks twice, by two hashes; what is then
  still outside the cell's largest component meets every chunk.

Defined results: null, empty and blank texts have no shingles and are linked with nothing; texts
under four words are one shingle; repeated rows are documents with equal sets; a null id never
becomes a component's id while another member has one; further columns are not read.  Hashes are 64
bits, so sets are compared up to hash collisions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.arrow_words import slices
from vitalgrid.llm.common import BROADCAST_BYTES, give_back, materialize, released, scratch, small_batches, small_side
from vitalgrid.llm.components import connected_components
from vitalgrid.llm.lm_scoring import tokenize
from vitalgrid.llm.packing import from_planes, planes

M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
GROUPS = 64  # coordinates of a point
FAN = 32  # children of a tree node
CELL_BYTES = 64_000_000  # of the sets that one task holds at once
BUCKET_BITS = 24  # counters of shingles: two megabytes of marks
COUNTED = 2_000_000  # shingles that are counted together
KEY_BITS = 48  # keys only gather candidates, so a shortened key costs at most a few needless comparisons
SCREENED = 2_000_000  # shingles that are posted together to see which stand alone
SPARE_BITS = 5  # by which their shortened hashes exceed their number: one in 32 meets another by chance, at most
MARK_BITS = 28  # of a table of marked rows, at most: 32 megabytes
POSTED_CLASSES = 8000  # classes that post together, at most
POSTED_KEYS = 700_000  # and about how many keys


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * M3
    x = (x ^ (x >> np.uint64(29))) * M1
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    ids, size, names = tokenize(texts)
    own = np.array([xxhash.xxh3_64_intdigest(w) for w in names], np.uint64)[ids] if len(names) else np.zeros(0, np.uint64)
    rolled = np.zeros(len(own), np.uint64)
    for j in range(min(k, len(own))):
        rolled[: len(own) - j] = mix(rolled[: len(own) - j] * M2 + own[j:])
    stop = np.cumsum(size)
    for a, b in zip((stop - size).tolist(), stop.tolist(), strict=True):
        if b - a >= k:
            yield np.unique(rolled[a : b - k + 1])
        elif b > a:
            h = np.full(1, b - a, np.uint64)
            for x in own[a:b]:
                h = mix(h * M2 + x)
            yield h
        else:
            yield np.zeros(0, np.uint64)


def class_of(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def bucket_of(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


class Intervals:
    """Size intervals ``low .. low * 100 / percent``; a linked pair lies in one or two neighbouring ones."""

    def __init__(self, percent: int):
        self.percent, self.top = percent, [0]

    def of(self, n: int) -> int:
        while self.top[-1] < n:
            self.top.append((self.top[-1] + 1) * 100 // self.percent)
        return int(np.searchsorted(self.top, n))

    def groups(self, k: int) -> tuple[int, int]:
        """Groups of interval ``k`` and how many of them may be weak."""
        while len(self.top) <= k:
            self.top.append((self.top[-1] + 1) * 100 // self.percent)
        most = 2 * self.top[k] * (100 - self.percent) // (100 + self.percent)
        spare = 2 + most // 2 if most else 0
        return most + 1 + spare, spare

    def keys(self, s: np.ndarray, common: np.ndarray | None = None) -> np.ndarray:
        """Keys of a set for its own interval and the next larger one; ``common`` marks shingles of many documents."""
        own = self.of(len(s))
        mixed = mix(s ^ M2)
        rare = np.ones(len(s), bool) if common is None else ~common
        out = []
        for k in (own, own + 1):
            n, spare = self.groups(k)
            group = (s >> np.uint64(5)) % np.uint64(n)
            order = np.argsort(group, kind="stable")
            group = group[order]
            first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            held = group[first]
            key = mix(np.add.reduceat(mixed[order], first) + mix(held * M1 + np.uint64(k)))
            strong = np.logical_or.reduceat(rare[order], first)
            if n - np.count_nonzero(strong) <= spare:
                key = key[strong]
            elif n - len(held) > spare:
                empty = np.setdiff1d(np.arange(n, dtype=np.uint64), held)
                out.append(mix(mix(empty * M1 + np.uint64(k)) ^ M3))
            out.append(key)
        return np.concatenate(out).view(np.int64)


# one row per document, and rows of shingle counts


def _summary(k: int, parts: int, id_type: pa.DataType):
    out = pa.schema([("doc", id_type), ("body", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()), ("part", pa.int32()), ("bucket", pa.binary()), ("count", pa.binary())])
    width = (1 << BUCKET_BITS) // parts

    def counts(held: list[np.ndarray]) -> pa.RecordBatch:
        bucket, count = np.unique(np.concatenate(held), return_counts=True)
        edge = np.searchsorted(bucket, np.arange(parts + 1) * width)
        rows = []
        for p in range(parts):
            x = bucket[edge[p] : edge[p + 1]]
            if len(x):
                step = np.diff(x, prepend=p * width).astype(np.uint32)
                rows.append({"part": p, "bucket": planes(step), "count": planes(count[edge[p] : edge[p + 1]].astype(np.uint32))})
        return pa.RecordBatch.from_pylist(rows, out)

    def run(batches):
        seen, held, size = set(), [], 0
        for batch in batches:
            for part in slices(batch, 1):
                sets = []
                for s in shingle_sets(part.column(1), k):
                    sets.append((len(s), c := class_of(s)))
                    if len(s) and c not in seen:
                        seen.add(c)
                        held.append(bucket_of(s))
                        size += len(s)
                none = [pa.nulls(part.num_rows, t) for t in (pa.int32(), pa.binary(), pa.binary())]
                n, cls = (pa.array([x[i] for x in sets], pa.int64()) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), n, cls, *none], schema=out)
                if size >= COUNTED:
                    yield counts(held)
                    held, size = [], 0
        if held:
            yield counts(held)

    return run


def _marks(parts: int, least: int):
    """Of each range of counters, which ones reach ``least``, as packed bits."""
    width = (1 << BUCKET_BITS) // parts

    def run(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, bucket, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total = totals.setdefault(part, np.zeros(width, np.uint64))
                total[np.cumsum(from_planes(bucket, np.uint32), dtype=np.int64)] += from_planes(count, np.uint32)
        bits = [np.packbits(t >= least, bitorder="little").tobytes() for t in totals.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array(bits, pa.binary())], names=["part", "bits"])

    return run


def common_shingles(base: DataFrame, parts: int, common_docs: int) -> bytes:
    """A bit for each counter: whether at least ``common_docs`` documents, and four times the mean, fall on it.

    The table is of fixed size, so what reaches the driver does not grow with the corpus.
    """
    total = base.agg(F.sum("n")).first()[0] or 0
    least = max(common_docs, 4 * total >> BUCKET_BITS)
    rows = base.filter("part IS NOT NULL").select("part", "bucket", "count").repartition("part")
    width = (1 << BUCKET_BITS) // parts // 8
    out = bytearray(width * parts)
    for part, bits in rows.mapInArrow(released(_marks(parts, least)), "part int, bits binary").collect():
        out[part * width : (part + 1) * width] = bits
    return bytes(out)


# rows marked in a table of bits, by the first bits of their hash


class Marked:
    """Whether a row's mark is set; a few that were never marked share another's bit."""

    def __init__(self, table: np.ndarray, bits: int):
        self.table, self.bits = table, bits

    def __getitem__(self, rows: np.ndarray) -> np.ndarray:
        at = rows.view(np.uint64) >> np.uint64(64 - self.bits)
        return (self.table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def of(self, part: pa.RecordBatch, column: int) -> pa.RecordBatch:
        return part.filter(pa.array(self[part.column(column).to_numpy()]))


def _packed(width: int):
    """Of each range of a table, its bits."""

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            part, at = (c.to_numpy() for c in batch.columns)
            for p in np.unique(part).tolist():
                held.setdefault(p, np.zeros(width, bool))[at[part == p]] = True
        bits = [np.packbits(t, bitorder="little").tobytes() for t in held.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(bits, pa.binary())], names=["part", "bits"])

    return run


def marked_rows(rows: DataFrame, spare: int):
    """Broadcast table and its bits for ``Marked``: those of the column ``row`` of ``rows`` (already materialised)."""
    n, part_bits = rows.count(), 8
    bits = min(MARK_BITS, max(part_bits + 3, n.bit_length() + spare))
    low = bits - part_bits
    at = F.shiftrightunsigned("row", 64 - bits)
    held = rows.select(F.shiftright(at, low).alias("part"), at.bitwiseAND((1 << low) - 1).alias("at")).repartition("part")
    width = 1 << low >> 3
    out = bytearray(width << part_bits)
    for part, packed in held.mapInArrow(released(_packed(1 << low)), "part long, bits binary").collect():
        out[part * width : (part + 1) * width] = packed
    return rows.sparkSession.sparkContext.broadcast(bytes(out)), bits


def _marked(marks) -> Marked:
    return Marked(np.frombuffer(marks[0].value, np.uint8), marks[1])


def _only(marks, column: int):
    """The rows whose hash in ``column`` is marked."""

    def run(batches):
        held = _marked(marks)
        for batch in batches:
            yield held.of(batch, column)

    return run


# classes with so many shingles of their own that they link with none

SCREEN = "part int, block long, n int, hashes binary, at binary, rows binary, sizes binary"
LONE = "block long, lone binary, rows binary, sizes binary"


def screen_share(percent: int) -> int:
    """Of 256 hashes, how many are counted by: well above what a class needs of its own to be settled."""
    return min(256, max(16, 256 * 5 * (100 - percent) // 200))


def _screen(k: int, percent: int, parts: int, bits: int, firsts):
    """Shortened hashes of the shingles that are counted by, packed per range, and whose they are (column 0: text, 1: row).

    A hash that several classes of a block have is posted once, as nobody's (rank ``n``).  A row of its own names
    the block's rows and their numbers of shingles.
    """
    share = np.uint64(screen_share(percent))

    def rows(held: list[np.ndarray], names: list[int], sizes: list[int]) -> pa.RecordBatch:
        n, name = len(names), np.array(names, np.int64).tobytes()
        block = xxhash.xxh3_64_intdigest(name) - (1 << 63)
        x = np.concatenate(held) >> np.uint64(64 - bits)
        order = np.argsort(x, kind="stable")
        x, at = x[order], np.repeat(np.arange(n, dtype=np.uint32), [len(h) for h in held])[order]
        first = _starts(x)
        at = np.where(np.diff(np.r_[first, len(x)]) > 1, np.uint32(n), at[first])
        x = x[first]
        edges = np.searchsorted(x, np.array([(i << bits) // parts for i in range(parts)], np.uint64)).tolist() + [len(x)]
        out = [{"part": block % parts, "block": block, "n": 0, "rows": name, "sizes": planes(np.array(sizes, np.uint32))}]
        for p, (a, b) in enumerate(zip(edges, edges[1:])):
            if b > a:
                out.append({"part": p, "block": block, "n": n, "hashes": planes(np.diff(x[a:b], prepend=np.uint64(0))), "at": planes(at[a:b])})
        types = {"part": pa.int32(), "block": pa.int64(), "n": pa.int32()}
        return pa.RecordBatch.from_pylist(out, pa.schema([(c, types.get(c, pa.binary())) for c in ("part", "block", "n", "hashes", "at", "rows", "sizes")]))

    def run(batches):
        first = _marked(firsts)
        seen, held, names, sizes, size = set(), [], [], [], 0
        for batch in batches:
            for part in slices(first.of(batch, 1), 0):
                for s, row in zip(shingle_sets(part.column(0), k), part.column(1).to_pylist(), strict=True):
                    if len(s) and (c := class_of(s)) not in seen:
                        seen.add(c)
                        held.append(s[s & np.uint64(255) < share])
                        names.append(row)
                        sizes.append(len(s))
                        size += len(held[-1]) + 20  # a short text takes room as well
                        if size >= SCREENED:
                            yield rows(held, names, sizes)
                            held, names, sizes, size = [], [], [], 0
        if names:
            yield rows(held, names, sizes)

    return run


def _lone(part: pa.Table) -> pa.Table:
    """Of each block, how many hashes of this range each of its rows has for itself."""
    hashes, at, blocks, out = [np.zeros(0, np.uint64)], [], [], []
    columns = (part.column(c).to_pylist() for c in ("block", "n", "hashes", "at", "rows", "sizes"))
    for block, n, x, own, rows, sizes in zip(*columns, strict=True):
        if n == 0:
            out.append({"block": block, "rows": rows, "sizes": sizes})
            continue
        hashes.append(np.cumsum(from_planes(x, np.uint64), dtype=np.uint64))
        at.append(from_planes(own, np.uint32))
        blocks.append((block, n))
    x = np.concatenate(hashes)
    order = np.argsort(x, kind="stable")
    differs = np.r_[True, x[order[1:]] != x[order[:-1]], True]
    alone = np.zeros(len(x), bool)
    alone[order] = (differs[:-1] & differs[1:])[: len(x)]
    start = 0
    for (block, n), own in zip(blocks, at, strict=True):
        count = np.bincount(own[alone[start : start + len(own)]], minlength=n + 1)[:n]
        out.append({"block": block, "lone": planes(count.astype(np.uint32))})
        start += len(own)
    return pa.Table.from_pylist(out, pa.schema([("block", pa.int64()), ("lone", pa.binary()), ("rows", pa.binary()), ("sizes", pa.binary())]))


def _open(percent: int):
    """The rows of a block that may link, and their numbers of shingles."""

    def run(part: pa.Table) -> pa.Table:
        rows, sizes, lone = (part.column(c).to_pylist() for c in ("rows", "sizes", "lone"))
        named = next((i for i, x in enumerate(rows) if x is not None), None)
        if named is None:  # of another attempt of a task
            return pa.table({"row": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        row, n = np.frombuffer(rows[named], np.int64), from_planes(sizes[named], np.uint32).astype(np.int64)
        own = np.zeros(len(n), np.int64)
        for x in lone:
            if x is not None:
                own += from_planes(x, np.uint32)
        held = 100 * (n - own) >= percent * n
        return pa.table({"row": pa.array(row[held], pa.int64()), "n": pa.array(n[held], pa.int64())})

    return run


def _giving_back(run):
    """``run`` for ``applyInArrow``, after which the worker gives its memory back."""

    def inner(part: pa.Table) -> pa.Table:
        out = run(part)
        give_back()
        return out

    return inner


def open_classes(texts: DataFrame, classes: DataFrame, shingles: int, k: int, percent: int, part_shingles: int) -> DataFrame:
    """``row, n`` of the classes that may link with another.

    ``texts``: ``text, row`` of all documents; ``classes``: ``row`` of one document of each class, ``shingles`` in all.
    """
    counted = shingles * screen_share(percent) // 256
    parts, bits = 1 + counted // part_shingles, min(56, counted.bit_length() + SPARE_BITS)
    posted = texts.mapInArrow(released(_screen(k, percent, parts, bits, marked_rows(classes, 4))), SCREEN)
    lone = posted.groupBy("part").applyInArrow(_giving_back(_lone), LONE)
    return lone.groupBy("block").applyInArrow(_giving_back(_open(percent)), "row long, n long")


# candidates: classes connected by shared keys


def least_members(member: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` members the least one it is connected with; group ``i`` of ``member`` begins at ``first[i]``."""
    label = np.arange(n)
    if not len(first):
        return label
    group = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(member)]))
    while True:
        low = np.minimum.reduceat(label[member], first)
        new = label.copy()
        np.minimum.at(new, member, low[group])
        new = np.minimum(new, new[new])
        if np.array_equal(new, label):
            return label
        label = new


def _starts(sorted_keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]][: len(sorted_keys)])


POSTED = "part int, n int, keys binary, at binary, classes binary"


def _postings(k: int, percent: int, parts: int, marks=None, kept=None):
    """Keys, packed per key range: sorted differences and places in a class list (column 0: text, 1: row, if ``kept`` marks some).

    Classes of a batch that share keys are connected on the spot: each key is posted once, for the least class
    connected with it, and the others' links to that class go in rows of their own (``n`` 0).
    """

    def rows(keys: list[np.ndarray], names: list[int]) -> pa.RecordBatch:
        key = np.concatenate(keys).view(np.uint64) >> np.uint64(64 - KEY_BITS)
        cls, rank = np.unique(np.array(names, np.int64), return_inverse=True)
        own = np.repeat(rank, [len(x) for x in keys])
        order = np.argsort(key, kind="stable")
        key, own = key[order], own[order]
        first = _starts(key)
        least = least_members(own, first, len(cls))
        key, own = key[first], least[own[first]]
        moved = np.flatnonzero(least != np.arange(len(cls)))
        edges = np.searchsorted(key, np.array([(i << KEY_BITS) // parts for i in range(parts + 1)], np.uint64))
        out = []
        for p in range(parts):
            x, at = key[edges[p] : edges[p + 1]], own[edges[p] : edges[p + 1]]
            if len(x):
                here, at = np.unique(at, return_inverse=True)
                out.append({"part": p, "n": len(x), "keys": planes(np.diff(x, prepend=np.uint64(0))), "at": planes(at.astype(np.uint32)), "classes": cls[here].tobytes()})
        if len(moved):
            links = np.stack([cls[moved], cls[least[moved]]])
            out.append({"part": int(links[0, 0] % parts), "n": 0, "keys": b"", "at": b"", "classes": links.tobytes()})
        types = {"part": pa.int32(), "n": pa.int32()}
        return pa.RecordBatch.from_pylist(out, pa.schema([(c, types.get(c, pa.binary())) for c in ("part", "n", "keys", "at", "classes")]))

    def run(batches):
        bits = np.zeros(1 << BUCKET_BITS >> 3, np.uint8) if marks is None else np.frombuffer(marks.value, np.uint8)
        only = _marked(kept) if kept else None
        intervals, seen, keys, names, size = Intervals(percent), set(), [], [], 0
        for batch in batches:
            for part in slices(only.of(batch, 1) if only else batch, 0):
                for s in shingle_sets(part.column(0), k):
                    if len(s) and (c := class_of(s)) not in seen:
                        seen.add(c)
                        bucket = bucket_of(s)
                        keys.append(intervals.keys(s, (bits[bucket >> 3] >> (bucket & 7)) & 1 == 1))
                        names.append(c)
                        size += len(keys[-1])
                        if len(names) == POSTED_CLASSES or size >= POSTED_KEYS:
                            yield rows(keys, names)
                            keys, names, size = [], [], 0
        if names:
            yield rows(keys, names)

    return run


def _meet(part: pa.Table) -> pa.Table:
    """A star for every set of classes that the keys of this range connect: an edge from each to the least."""
    keys, cls, links = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros((2, 0), np.int64)]
    for n, x, at, classes in zip(*(part.column(c).to_pylist() for c in ("n", "keys", "at", "classes")), strict=True):
        if n == 0:
            links.append(np.frombuffer(classes, np.int64).reshape(2, -1))
            continue
        keys.append(np.cumsum(from_planes(x, np.uint64), dtype=np.uint64))
        cls.append(np.frombuffer(classes, np.int64)[from_planes(at, np.uint32)])
    key, name, link = np.concatenate(keys), np.concatenate(cls), np.concatenate(links, axis=1)
    order = np.argsort(key, kind="stable")
    key, name = key[order], name[order]
    first = _starts(key)
    shared = np.repeat(np.diff(np.r_[first, len(key)]) > 1, np.diff(np.r_[first, len(key)]))
    first = _starts(key[shared])
    names, member = np.unique(np.concatenate([name[shared], link.T.ravel()]), return_inverse=True)
    n_keyed = np.count_nonzero(shared)
    least = least_members(member, np.r_[first, n_keyed + 2 * np.arange(link.shape[1])], len(names))
    moved = np.flatnonzero(least != np.arange(len(names)))
    return pa.table({"a": pa.array(names[moved], pa.int64()), "b": pa.array(names[least[moved]], pa.int64())})


# verification: the R-tree of a cell


class CountTree:
    """Packed R-tree over the group counts of sets, all held in one cell; places are in order of size."""

    def __init__(self, sets: Sequence[np.ndarray], percent: int):
        self.percent = percent
        n = np.array([len(s) for s in sets])
        counts = np.zeros((len(sets), GROUPS), np.int32)
        for row, s in zip(counts, sets, strict=True):
            row += np.bincount((s % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS).astype(np.int32)
        self.order = np.lexsort((counts.argmax(axis=1), n))
        self.sets = [sets[i] for i in self.order]
        # levels from the leaves up: maxima of the coordinates and the smallest size
        high, small = counts[self.order], n[self.order]
        self.levels = [(high, small)]
        while len(high) > FAN:
            first = np.arange(0, len(high), FAN)
            high, small = np.maximum.reduceat(high, first), np.minimum.reduceat(small, first)
            self.levels.append((high, small))
        self.one = [np.zeros(len(small), bool) for _, small in self.levels]

    def settle(self, label: np.ndarray) -> None:
        """Note which nodes lie in one component as a whole."""
        low = high = label
        for level in range(1, len(self.levels)):
            first = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)
            self.one[level] = low == high

    def near(self, q: int, label: np.ndarray | None = None, after: int = 0) -> np.ndarray:
        """Places from ``after`` on, in other components than ``q`` if these are given, whose bound allows a link with ``q``."""
        point, n = self.levels[0][0][q], int(self.levels[0][1][q])
        at = np.arange(len(self.levels[-1][1]))
        for level in range(len(self.levels) - 1, -1, -1):
            high, small = self.levels[level]
            size = FAN**level
            at = at[(at + 1) * size > after]
            if label is not None:
                whole = self.one[level][at] if level else True
                at = at[~(whole & (label[at * size] == label[q]))]
            bound = np.minimum(high[at], point).sum(axis=1)
            at = at[bound * (100 + self.percent) >= self.percent * (n + small[at])]
            if level:
                at = (at[:, None] * FAN + np.arange(FAN)).ravel()
                at = at[at < len(self.levels[level - 1][1])]
        return at

    def linked(self, i: int, j: int) -> bool:
        a, b = self.sets[i], self.sets[j]
        if len(a) > len(b):
            a, b = b, a
        at = np.minimum(np.searchsorted(b, a), len(b) - 1)
        both = int(np.count_nonzero(b[at] == a))
        return 100 * both >= self.percent * (len(a) + len(b) - both)


def cell_links(sets: Sequence[np.ndarray], percent: int, label: np.ndarray | None = None, probe: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join all sets of the cell that any links join.

    ``label``: components known so far; ``probe``: the sets of which each is compared with all others (else all).
    """
    tree = CountTree(sets, percent)
    _, label = np.unique(np.arange(len(sets)) if label is None else label, return_inverse=True)
    label = label[tree.order]
    left = label.max(initial=-1) + 1
    links = []
    whole = probe is None or bool(probe.all())
    for step, q in enumerate(range(len(sets)) if whole else np.flatnonzero(probe[tree.order]).tolist()):
        if left == 1:
            break
        if step % 256 == 0 or step == 1:
            tree.settle(label)
        for j in tree.near(q, label, q + 1 if whole else 0).tolist():
            if label[j] != label[q] and tree.linked(q, j):
                links.append((int(tree.order[q]), int(tree.order[j])))
                label[label == label[j]] = label[q]
                left -= 1
    return links


SETS = "cell long, i int, j int, cls long, label long, probe boolean, items binary"


def _sets(k: int):
    """Sets of the texts in column 3; the first three columns are those of ``SETS``."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, 4):
                items = pa.array([s.tobytes() for s in shingle_sets(part.column(4), k)], pa.binary())
                cls = part.column(3)
                yield pa.RecordBatch.from_arrays([*part.columns[:4], cls, pa.array([True] * part.num_rows), items], names=["cell", "i", "j", "cls", "label", "probe", "items"])

    return run


def _cells(percent: int):
    """Links within each run of rows of equal ``cell, i, j``; equal classes stand side by side and count once."""

    def links_of(rows: list[tuple]) -> list[tuple[int, int]]:
        names, labels, probe, items = zip(*rows, strict=True)
        found = cell_links([np.frombuffer(x, np.uint64) for x in items], percent, np.array(labels, np.int64), np.array(probe, bool))
        return [(names[i], names[j]) for i, j in found]

    def run(batches):
        cell, rows = None, []

        def batch_of(out: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            out = []
            columns = [batch.column(i).to_pylist() for i in range(7)]
            for *key, cls, label, probe, items in zip(*columns, strict=True):
                if key != cell:
                    out += links_of(rows) if len(rows) > 1 else []
                    cell, rows = key, []
                if not rows or rows[-1][0] != cls:
                    rows.append((cls, label, probe, items))
                elif probe:
                    rows[-1] = (cls, label, True, items)
            yield batch_of(out)
        yield batch_of(links_of(rows) if len(rows) > 1 else [])

    return run


def _dealt_links(rows: DataFrame, percent: int) -> DataFrame:
    cell = ("cell", "i", "j")
    return rows.repartition(*cell).sortWithinPartitions(*cell, "cls").mapInArrow(released(_cells(percent)), "a long, b long")


def _chunk(seed: int, chunks: str = "chunks"):
    return F.pmod(F.xxhash64("cls", F.lit(seed)), F.greatest(chunks, F.lit(1))).cast("int")


def _large_links(large: DataFrame, cells: DataFrame, percent: int, cell_rows: int) -> DataFrame:
    """Links of cells of several chunks: ``large`` holds their sets, ``cells`` their ``cell, chunks``.

    Two dealings join all dense groups; then every class outside the largest component of its cell meets all
    classes of the cell, chunk by chunk.
    """

    def labelled(links: DataFrame) -> DataFrame:
        known = connected_components(links).select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        joined = large.join(known, F.col("cls") == F.col("_node"), "left")
        return joined.withColumn("label", F.coalesce("_root", "cls")).drop("_node", "_root").join(cells, "cell")

    columns = ["cell", "i", "j", "cls", "label", "probe", "items"]
    first = materialize(_dealt_links(large.join(cells, "cell").withColumns({"i": _chunk(1), "j": _chunk(1)}).select(columns), percent))
    again = labelled(first).withColumns({"i": _chunk(2), "j": _chunk(2)})
    links = materialize(first.unionByName(_dealt_links(again.select(columns), percent)))

    known = materialize(labelled(links))
    sizes = known.groupBy("cell", "label").agg(F.count("*").alias("rows"))
    main = sizes.groupBy("cell").agg(F.max_by("label", F.struct("rows", "label")).alias("main"))
    apart = known.join(main, "cell").withColumn("probe", F.col("label") != F.col("main"))
    rest = apart.filter("probe")
    parts = rest.groupBy("cell").agg(
        F.ceil(F.greatest(F.count("*") / cell_rows, F.sum(F.length("items")) / CELL_BYTES)).cast("int").alias("parts")
    )
    ranks = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = apart.join(parts, "cell").withColumn("probe", F.lit(False)).withColumns({"j": _chunk(1), "i": ranks("parts")})
    asking = rest.join(parts, "cell").withColumns({"i": _chunk(3, "parts"), "j": ranks("chunks")})
    met = _dealt_links(held.select(columns).unionByName(asking.select(columns)), percent)
    return links.unionByName(met)


def jaccard_members(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    k: int = 4,
    percent: int = 85,
    cell_rows: int = 20_000,
    part_shingles: int = 2_000_000,
    common_docs: int = 32,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``doc_id, body, n_shingles, root, component_id`` for every row of ``docs``.

    ``body`` is the hash of the text and ``root`` names the component whatever the ids of its members are.
    ``part_shingles`` bounds the shingles whose keys meet in one task, ``common_docs`` is the number of
    documents from which a shingle may count as common.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    id_type = docs.schema[doc_id].dataType
    whole = F.coalesce(F.col(text), F.lit("")).alias("text")
    body = F.xxhash64(text).alias("body")
    count_parts = 256
    rows = docs.select(F.col(doc_id).alias("doc"), whole, body).mapInArrow(
        released(_summary(k, count_parts, to_arrow_type(id_type))), f"doc {id_type.simpleString()}, body long, n long, cls long, part int, bucket binary, count binary"
    )
    with scratch(spark), small_batches(spark):
        written = materialize(rows, outer=True)
        base = written.filter("part IS NULL").select("doc", "body", "n", "cls")
        marks = spark.sparkContext.broadcast(common_shingles(written, count_parts, common_docs))
        shingles = base.agg(F.sum("n")).first()[0] or 0
        first = F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "body")).alias("first")
        classes = base.filter("n > 0").groupBy("cls").agg(first, F.first("n").alias("n")).select("cls", "first.doc", "first.body", "n")
        classes = materialize(classes.withColumn("row", F.xxhash64("doc", "body")))

        texts = docs.select(whole, F.xxhash64(F.col(doc_id), body).alias("row"))
        opened = materialize(open_classes(texts, classes, shingles, k, percent, part_shingles))
        kept = marked_rows(opened, 8)
        parts = 1 + (opened.agg(F.sum("n")).first()[0] or 0) // part_shingles
        posted = texts.mapInArrow(released(_postings(k, percent, parts, marks, kept)), POSTED)
        cells = connected_components(posted.groupBy("part").applyInArrow(_giving_back(_meet), "a long, b long"))
        wanted = materialize(classes.join(cells, F.col("cls") == F.col("node")).select("cls", "doc", "body", "n", F.col("root").alias("cell")))
        sizes = wanted.groupBy("cell").agg(F.ceil(F.greatest(F.count("*") / cell_rows, F.sum("n") * 8 / CELL_BYTES)).cast("int").alias("chunks"))
        large = materialize(sizes.filter("chunks > 1"))

        def sets_of(classes: DataFrame) -> DataFrame:
            named = materialize(classes.select("cell", "cls", F.col("doc").alias("_doc"), F.col("body").alias("_body")))
            own = docs.select(F.col(doc_id).alias("doc"), body, whole)
            if (side := small_side(named, broadcast_bytes)) is named:  # both sides are shuffled: only texts that may be met
                own = own.withColumn("row", F.xxhash64("doc", "body")).mapInArrow(_only(kept, 3), f"doc {id_type.simpleString()}, body long, text string, row long")
            same = own["doc"].eqNullSafe(named["_doc"]) & (own["body"] == named["_body"])
            held = own.join(side, same)
            return held.select("cell", F.lit(0).alias("i"), F.lit(0).alias("j"), "cls", "text").mapInArrow(released(_sets(k)), SETS)

        links = _dealt_links(sets_of(wanted.join(large, "cell", "left_anti")), percent)
        if not large.isEmpty():
            sets = materialize(sets_of(wanted.join(large, "cell", "left_semi")).dropDuplicates(["cls"]))
            links = links.unionByName(_large_links(sets, large, percent, cell_rows))
        linked = materialize(connected_components(links), outer=True)

    rooted = base.join(linked, base["cls"] == linked["node"], "left").select(
        "doc", "body", "n", F.coalesce("root", "cls").alias("root")
    )
    names = rooted.filter("n > 0").groupBy("root").agg(F.min("doc").alias("component"))
    return (
        rooted.join(names.withColumnRenamed("root", "_root"), F.col("root") == F.col("_root"), "left")
        .select(
            F.col("doc").alias(doc_id), "body", F.col("n").alias("n_shingles"), "root",
            F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc")).alias("component_id"),
        )
    )


def jaccard_components(docs: DataFrame, *, doc_id: str = "doc_id", **options) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``; options as of ``jaccard_members``."""
    return jaccard_members(docs, doc_id=doc_id, **options).select(doc_id, "n_shingles", "component_id")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
