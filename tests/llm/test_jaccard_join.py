import random

import numpy as np

from vitalgrid.llm.jaccard_join import CountTree, Intervals, cell_links, jaccard_components


def brute(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set()))
    comp = list(range(len(rows)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                comp[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        if sets[i] and d is not None:
            best[find(i)] = min(best.get(find(i), d), d)
    return sorted(((d, len(sets[i]), best.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def corpus(seed=1):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    texts = [None, "", "  \n", "one", "one", "One Two", "one two three", "a b c d", "A b c\x0bd", "a b c d e"]
    for n in (8, 12, 20, 30, 45, 80, 200, 700):
        for _ in range(6):
            w = [rng.choice(vocab) for _ in range(n)]
            texts.append(" ".join(w))
            for edits in (0, 1, 1, 2, 3, n // 40, n // 25):
                v = list(w)
                for _ in range(edits):
                    at = rng.randrange(len(v))
                    v[at : at + 1] = rng.choice([[], [rng.choice(vocab)], [rng.choice(vocab), "x"]])
                texts.append(" ".join(v))
    # a chain in which neighbours link and the ends do not
    w = [f"c{i}" for i in range(120)]
    for i in range(12):
        texts.append(" ".join(w[i * 2 : 90 + i * 2]))
    rng.shuffle(texts)
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    return rows + [(None, "null id text with words"), (7, "null id text with words"), (0, rows[0][1])]


def got(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, cls int, bucket int")
    return sorted((tuple(r) for r in jaccard_components(df, **kw).collect()), key=str)


def test_equals_brute_force(spark):
    rows = corpus()
    assert got(spark, rows) == brute(rows)


def test_chunked_cells_and_no_broadcast(spark):
    rows = corpus(2)
    assert got(spark, rows, cell_rows=3, broadcast_bytes=0, part_shingles=3_000, common_docs=2) == brute(rows)


def test_empty_table(spark):
    assert got(spark, []) == []


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(3)
    iv = Intervals(85)
    for _ in range(400):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        drop = int(rng.integers(0, max(1, n // 10) + 1))
        b = np.unique(np.r_[rng.permutation(a)[: len(a) - drop], rng.integers(0, 2**63, int(rng.integers(0, n // 10 + 1))).astype(np.uint64)])
        if len(b) and CountTree([a, b], 85).linked(0, 1):
            assert np.intersect1d(iv.keys(a), iv.keys(b)).size


def test_tree_loses_no_link():
    rng = np.random.default_rng(4)
    seed = np.unique(rng.integers(0, 2**63, 150).astype(np.uint64))
    sets = [np.unique(np.r_[rng.permutation(seed)[: rng.integers(120, 150)], rng.integers(0, 2**63, 8).astype(np.uint64)]) for _ in range(200)]
    tree = CountTree(sets, 85)
    for i in range(0, 200, 7):
        near = set(tree.near(i).tolist())
        assert all(j in near for j in range(200) if tree.linked(i, j))


def test_slices_of_few_words():
    import pyarrow as pa

    from vitalgrid.llm.jaccard_join import shingle_sets

    for k in (4, 5):
        for n in (0, 1, 2, 3):
            (own,) = shingle_sets(pa.array([" ".join("abc"[:n])]), k)
            assert len(own) == min(n, 1)


def test_a_key_is_posted_once_a_batch():
    import pyarrow as pa

    from vitalgrid.llm.jaccard_join import _meet, _postings, class_of, shingle_sets
    from vitalgrid.llm.packing import from_planes

    words = [f"w{i}" for i in range(200)]
    texts = pa.array([" ".join([*words[:i], "edit", *words[i + 1 :]]) for i in range(100)])
    (posted,) = _postings(4, 85, 1)([pa.record_batch([texts], names=["text"])])
    rows = posted.to_pylist()
    keys = np.concatenate([np.cumsum(from_planes(r["keys"], np.uint64), dtype=np.uint64) for r in rows if r["n"]])
    assert len(np.unique(keys)) == len(keys)
    pairs = [p for r in rows for p in zip(*(c.to_pylist() for c in _meet(pa.Table.from_pylist([r], schema=posted.schema)).columns))]
    near = {class_of(s): {class_of(s)} for s in shingle_sets(texts, 4)}
    for a, b in pairs:
        both = near[a] | near[b]
        for c in both:
            near[c] = both
    assert len(near[a]) == 100  # all still meet


def test_linked_sets_share_a_key_whatever_is_common():
    rng = np.random.default_rng(5)
    for percent in (80, 85, 100):
        iv = Intervals(percent)
        for _ in range(400):
            n = int(rng.integers(1, 300))
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            b = np.unique(np.r_[rng.permutation(a)[: len(a) - int(rng.integers(0, n // 8 + 1))], rng.integers(0, 2**63, int(rng.integers(0, n // 8 + 1))).astype(np.uint64)])
            if not len(b) or not CountTree([a, b], percent).linked(0, 1):
                continue
            # a passage at the front, all, none, or any shingles are common
            cut = np.uint64([0, 2**61, 2**62, 2**62 + 2**61, 2**64 - 1][rng.integers(0, 5)])
            odd = np.uint64(rng.integers(1, 5))
            common = lambda s: (s < cut) & (s % odd == 0)
            assert np.intersect1d(iv.keys(a, common(a)), iv.keys(b, common(b))).size


def test_a_shared_passage_does_not_glue_pages():
    rng = np.random.default_rng(6)
    passage = rng.integers(0, 2**63, 60).astype(np.uint64)
    iv, seen = Intervals(80), {}
    for i in range(300):
        s = np.unique(np.r_[passage, rng.integers(0, 2**63, 140).astype(np.uint64)])
        for key in iv.keys(s, np.isin(s, passage)).tolist():
            seen.setdefault(key, set()).add(i)
    assert sum(len(x) > 1 for x in seen.values()) < 20  # without marks almost every page shares such a key


def test_cells_with_known_components():
    rng = np.random.default_rng(7)
    seed = [np.unique(rng.integers(0, 2**63, 150).astype(np.uint64)) for _ in range(3)]
    sets = [np.unique(np.r_[rng.permutation(seed[i % 3])[:145], rng.integers(0, 2**63, 3).astype(np.uint64)]) for i in range(300)]
    def parts(links, label):
        label = np.array(label)
        for i, j in links:
            label[label == label[i]] = label[j]
        return {frozenset(np.flatnonzero(label == x).tolist()) for x in set(label.tolist())}

    want = {frozenset(range(i, 300, 3)) for i in range(3)}
    alone = np.arange(300)
    assert parts(cell_links(sets, 85), alone) == want
    known = np.where(np.arange(300) % 6 < 3, np.arange(300) % 3, alone + 10)
    few = cell_links(sets, 85, known, np.arange(300) % 6 >= 3)
    assert parts(few, known) == want and len(few) == 150


def test_components_of_random_graphs(spark):
    from vitalgrid.llm.components import connected_components

    rng = random.Random(8)
    for n, m in ((1, 0), (300, 150), (300, 320), (2000, 1999)):
        name = rng.sample(range(-(2**60), 2**60), n)
        edges = [(name[rng.randrange(n)], name[rng.randrange(n)]) for _ in range(m)] if n < 2000 else [(name[i], name[i + 1]) for i in range(n - 1)]
        label = {x: x for e in edges for x in e}
        for a, b in edges:
            low, high = sorted((label[a], label[b]))
            for x, y in label.items():
                if y == high:
                    label[x] = low
        got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
        assert {r.node: r.root for r in got} == {a: r for a, r in label.items() if any(a in e and e[0] != e[1] for e in edges)}


def test_no_folder_is_left_inside_a_block(spark):
    from pathlib import Path

    from vitalgrid.llm.common import scratch, shared_dir

    folder = Path(shared_dir(spark).removeprefix("file://"))
    before = set(folder.iterdir()) if folder.exists() else set()
    with scratch(spark):
        assert len(got(spark, corpus(3))) > 400
    assert set(folder.iterdir()) == before


def test_a_very_long_text_and_one_key_of_many(spark):
    long = " ".join(f"x{i}" for i in range(60_000))
    rows = [(1, long), (2, long + " end"), (3, long[: len(long) // 2])]
    base = [f"b{i}" for i in range(30)]
    rows += [(100 + i, " ".join([*base[:-1], f"e{i}"])) for i in range(3000)]
    by = {r[0]: r[2] for r in got(spark, rows)}
    assert (by[1], by[2], by[3]) == (1, 1, 3) and {by[100 + i] for i in range(3000)} == {100}


def still_open(texts, percent, parts, bits, tasks=3):
    """Places of the texts that the screen leaves, and the bytes it posts."""
    from types import SimpleNamespace

    import pyarrow as pa
    import pyarrow.compute as pc

    from vitalgrid.llm.jaccard_join import _lone, _open, _screen

    every = (SimpleNamespace(value=b"\xff" * 256), 11)
    posted = []
    for t in range(tasks):
        at = range(t, len(texts), tasks)
        posted += _screen(4, percent, parts, bits, every)([pa.record_batch([pa.array([texts[i] for i in at], pa.string()), pa.array(at, pa.int64())], names=["text", "row"])])
    posted = pa.Table.from_batches(posted)
    groups = lambda x, c: [x.filter(pc.equal(x[c], v)) for v in pc.unique(x[c])]
    lone = pa.concat_tables([_lone(x) for x in groups(posted, "part")])
    rows = [r for x in groups(lone, "block") for r in _open(percent)(x)["row"].to_pylist()]
    assert len(rows) == len(set(rows))
    return set(rows), sum(len(x or b"") for c in ("hashes", "at", "rows", "sizes") for x in posted[c].to_pylist())


def test_the_screen_loses_no_link(monkeypatch):
    import pyarrow as pa

    from vitalgrid.llm import jaccard_join
    from vitalgrid.llm.jaccard_join import class_of, shingle_sets

    monkeypatch.setattr(jaccard_join, "SCREENED", 900)
    first = {class_of(s): (t, set(s.tolist())) for _, t in corpus(10) for s in shingle_sets(pa.array([t], pa.string()), 4) if len(s)}
    texts, sets = zip(*first.values(), strict=True)
    for percent in (50, 80, 85, 100):
        near = {x for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) for x in (i, j)}
        for parts, bits in ((1, 40), (7, 14), (50, 20)):
            assert near <= still_open(texts, percent, parts, bits)[0]


def test_few_bytes_are_posted_however_many_ranges():
    import pyarrow as pa

    from vitalgrid.llm.jaccard_join import _postings

    rng = random.Random(11)
    pages = [[f"w{rng.randrange(5000)}" for _ in range(300)] for _ in range(1500)]
    texts = [" ".join(p) for p in pages] + [" ".join([*p[:100], "edit", *p[101:]]) for p in pages[:30]]
    for parts in (2, 200):
        left, size = still_open(texts, 85, parts, 26, 1)
        assert set(range(30)) | set(range(1500, 1530)) <= left and len(left) < 80
        keys = _postings(4, 85, parts)([pa.record_batch([pa.array([texts[i] for i in left])], names=["text"])])
        size += sum(len(x) for b in keys for c in ("keys", "at", "classes") for x in b.column(c).to_pylist())
        assert size < 2.2 * 297 * len(texts)  # keys of all pages take 3.1 and 6.2 bytes a shingle


def test_fresh_pages_and_their_copies_make_no_keys(spark, monkeypatch):
    from vitalgrid.llm import jaccard_join

    rng, seen, screen = random.Random(12), [], jaccard_join.open_classes

    def counted(*args):
        seen.append((out := jaccard_join.materialize(screen(*args))).count())
        return out

    monkeypatch.setattr(jaccard_join, "open_classes", counted)
    pages = [" ".join(f"w{rng.randrange(3000)}" for _ in range(80)) for _ in range(80)]
    rows = [(i + 1000 * copy, p) for copy in range(4) for i, p in enumerate(pages)] + [(5000, pages[3] + " end"), (None, pages[4] + " end")]
    assert got(spark, rows, part_shingles=900) == brute(rows)
    assert 4 <= seen[0] < 30


def test_the_pipelines_stage_makes_keys_of_few_pages(spark, monkeypatch):
    import corpus_pipeline
    from vitalgrid.llm import jaccard_join

    rng, seen, screen = random.Random(13), [], jaccard_join.open_classes

    def counted(*args):
        seen.append((out := jaccard_join.materialize(screen(*args))).count())
        return out

    monkeypatch.setattr(jaccard_join, "open_classes", counted)
    pages = [" ".join(f"w{rng.randrange(3000)}" for _ in range(80)) for _ in range(60)]
    rows = [(i + 1000 * copy, p) for copy in range(3) for i, p in enumerate(pages)] + [(5000, pages[3] + " end"), (5001, "")]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted(r.doc_id for r in kept) == [*range(60), 5001]
    assert 2 <= seen[0] < 20
