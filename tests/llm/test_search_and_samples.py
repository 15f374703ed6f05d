"""Ranked search, importance resampling and secret scans against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from vitalgrid.llm import importance_resampling as ir
from vitalgrid.llm import lexical_search as ls
from vitalgrid.llm import secret_scan as sc

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, source string, rank string, item string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "y") for i, t, s in rows], DOCS)


def odd_texts(seed, n=300):
    r = random.Random(seed)
    vocabulary = ["a", "B", "İs", "KelvinK", "wörd", "x1", "Zed", "é", "漢字"] + [f"w{i}" for i in range(40)]
    out = [(i, " ".join(r.choices(vocabulary, k=r.choice([0, 1, 2, 3, 19, 20, 60])) + ["--"] * r.choice([0, 1])), f"s{i % 7}") for i in range(n)]
    out += [(n + 1, None, None), (n + 2, "", "s0"), (None, "w1 w2 w3 " * 9, "s1"), (5, out[5][1], "s5"), (n + 3, "w1 w2 zed-w3," * 20_000, "s2")]
    return out


def brute_search(rows, items, k=10):
    held = [(i, Counter(words(t))) for i, t, _ in rows if words(t)]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    out = set()
    for item, text in {(i, t) for i, t in items}:
        asked = Counter(words(text))
        found = []
        for i, c in held:
            m = 25 + (75 * sum(c.values()) * n) // total
            score = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m)) for w, q in asked.items() if w in c)
            found.append((-score, i is None, i or 0, i))
        out |= {(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(found)[:k]) if x[0] < 0}
    return out


@pytest.mark.parametrize("vocabulary_bytes", [1 << 20, 0])
def test_search_equals_brute_force(spark, vocabulary_bytes):
    rows = odd_texts(3)
    items = [(1, "w1 w2 W1 é"), (2, "zed"), (3, "absent words"), (4, None), (5, ""), (6, " ".join(f"w{i}" for i in range(40))), (1, "w1 w2 W1 é"), (7, "漢字 kelvinK İs"), (None, "w7")]
    docs = docs_of(spark, rows).repartition(3)
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    found = ls.search(docs, asked, segment_bytes=1500, vocabulary_bytes=vocabulary_bytes)
    got = [tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect()]
    assert len(got) == len(set(got)) and set(got) == brute_search(rows, items)


def test_search_in_blocks_of_items_and_of_nothing(spark):
    rows = odd_texts(4, 60)
    items = [(i, f"w{i % 40} w{(i * 7) % 40} a") for i in range(50)]
    segments = ls.materialize(ls.index_segments(docs_of(spark, rows), segment_bytes=1 << 12))
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = ls.search_segments(segments, asked, k=3, block_bytes=200)
    assert {(r["item"], r["rank"], r.doc_id, r.score) for r in found.collect()} == brute_search(rows, items, 3)
    assert ls.search(docs_of(spark, []), asked).count() == 0
    assert ls.search(docs_of(spark, rows), asked.limit(0)).count() == 0


def test_block_maxima_leave_blocks_packed(spark):
    """A term that all documents hold is unpacked only where the rare term leaves candidates."""
    r = random.Random(1)
    rows = [(i, "common " * r.randint(1, 3) + ("rare " if i % 900 == 7 else "") + "other " * 5, "s") for i in range(6000)]
    row = ls.index_segments(docs_of(spark, rows).coalesce(1)).collect()
    assert len(row) == 1
    seg = ls.Segment(row[0].asDict(), row[0].n_docs, row[0].n_terms)
    places, scores = ls.best_of(seg, [("rare", 6000), ("common", 3)], 0, 3)
    assert len(places) >= 3 and len(seg.cache) < len(seg.first) / 2
    assert all(seg.most[b] == seg.unpack(b)[1].max() for b in range(len(seg.first)))  # the bounds are met


def test_long_postings_of_all_widths():
    tf = np.array([1, 2, 70_000, 1, 300], np.int64)
    doc = np.array([0, 5, 300, 70_000, 9_000_000], np.int64)
    first = np.array([0, 3])
    data, ends = ls._pack(doc, tf, first)
    seg = ls.Segment.__new__(ls.Segment)
    seg.first, seg.ends, seg.postings, seg.cache, seg.m = doc[first], ends, data, {}, np.full(9_000_001, 25)
    for b, (x, y) in enumerate([(0, 3), (3, 5)]):
        got = seg.unpack(b)
        assert got[0].tolist() == doc[x:y].tolist() and got[1].tolist() == ls.impact(tf[x:y], seg.m[:1]).tolist()


def brute_resample(rows, target, percent=5, least=20):
    def grams(text):
        w = words(text)
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    made = [(i, *grams(t)) for i, t, _ in rows]
    s, t = Counter(b for *_, g in made for b in g), Counter(b for x in target for b in grams(x)[1])
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000)))) for b in range(10_000)]
    out = []
    for i, n, g in made:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in g)
        out.append([i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    eligible = sorted((x for x in out if x[5] >= least), key=lambda x: (-x[3], x[0] is None, x[0]))
    for rank, x in enumerate(eligible[: percent * len(eligible) // 100]):
        x[4] = rank + 1
    return Counter(tuple(x[:5]) for x in out)


@pytest.mark.parametrize("percent", [5, 100])
def test_resampling_equals_brute_force(spark, percent):
    rows = odd_texts(5)
    target = ["w1 w2 w3 w4", None, "", "é 漢字 zed " * 30, "w1 w2 w3 w4"]
    found = ir.resample(docs_of(spark, rows).repartition(5), spark.createDataFrame([(t,) for t in target], "text string"), percent=percent)
    assert Counter(tuple(r) for r in found.select("doc_id", "n_features", "weight", "score", "rank").collect()) == brute_resample(rows, target, percent)


def test_resampling_of_nothing(spark):
    none = spark.createDataFrame([], "text string")
    assert ir.resample(docs_of(spark, []), none).count() == 0
    got = ir.resample(docs_of(spark, [(1, "a b", "s")]), none).collect()
    assert [(r.doc_id, r.n_features, r["rank"]) for r in got] == [(1, 3, None)]


def test_checksums_of_joined_texts():
    r = random.Random(2)
    a = [bytes(r.randrange(256) for _ in range(r.choice([0, 1, 5, 300]))) for _ in range(50)]
    b = [bytes(r.randrange(256) for _ in range(r.choice([0, 1, 8, 70_001]))) for _ in range(50)]
    crc = lambda xs: np.array([zlib.crc32(x) for x in xs], np.uint32)
    joined = ir.moved(crc(a), np.array([len(x) for x in b])) ^ crc(b)
    assert joined.tolist() == [zlib.crc32(x + y) for x, y in zip(a, b)]


def test_ranks_of_equal_rows_are_all_there(spark):
    df = spark.range(1000).selectExpr("id % 3 AS score", "id AS row").repartition(7)
    got = ir.numbered(df, ir.F.desc("score"), ir.F.asc("row")).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 1001))
    assert [r.score for r in sorted(got, key=lambda r: r["rank"])] == sorted((r.score for r in got), reverse=True)


def brute_base(text):
    found = [("assign", *m.span()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 8]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda x: (x[1], ("assign", "access", "hex").index(x[0])))


def test_base_candidates_equal_brute_force():
    r = random.Random(6)
    pieces = ["password", "PASSWD", "Token", "ſecret", "toKen", "api_key", "apikey", "=", ": ", " ", "'", '"', "AKIA", "AKIAQWERTY", "0123456789abcdef", "deadbeef" * 4, "abc", "A1b2C3d4", "é", "\n", "漢", "=="]
    for _ in range(4000):
        text = "".join(r.choices(pieces, k=r.randint(1, 14)))
        got = [x for x in sc.candidates(text) if x[0] in ("assign", "access", "hex")]
        assert [x[:3] for x in got] == brute_base(text), text
        if sc.candidates(text):
            assert pa.compute.match_substring_regex(pa.array([text]), sc.SCREEN)[0].as_py(), text


LIVE, COPIED = "ghp_" + "Ab3dEf6hIj9lMn2pQr5t", "aB3xY9kLmN0pQrS7tUvWz1Q4"


def test_ownership_parts_examples_from_live(spark):
    rows = [(i, f"see {COPIED} there {i}", f"s{i % 5}") for i in range(20)] + [(30 + i, f"my {LIVE} {i}", "s1") for i in range(4)]
    rows += [(50, "token = 'examplevalue1' a", "s1"), (51, "token = 'examplevalue1' b", "s2"), (52, "token = 'examplevalue1' c", "s3"), (53, "token = onlyhere99", "s3"), (None, None, None), (54, "", "s1"), (55, f"{LIVE} é {LIVE}", None), (54, "", "s1")]
    found = {}
    for r in sc.scan_secrets(docs_of(spark, rows).repartition(4), few_owners=2).collect():
        found.setdefault(r.doc_id, []).append([(s.kind, s.start, s.end, s.verdict, s.owners, s.repositories) for s in r.spans])
    assert len([x for v in found.values() for x in v]) == len(rows)
    assert all(found[i] == [[]] for i in range(20))  # held by five owners
    assert found[30] == [[("issued", 3, 27, "live", 2, 5)]]
    assert found[50] == [[("assign", 0, 22, "example", 3, 3)]] and found[53] == [[("assign", 0, 18, "live", 1, 1)]]
    assert found[54] == [[], []] and found[None] == [[]]
    assert [x[:4] for x in found[55][0]] == [("issued", 0, 24, "live"), ("issued", 27, 51, "live")]
    assert sc.scan_secrets(docs_of(spark, [])).count() == 0


def test_very_long_text_of_secrets(spark):
    text = "x" + " deadbeefdeadbeefdeadbeefdeadbeef" * 20_000 + f" {LIVE}"
    got = sc.scan_secrets(docs_of(spark, [(1, text, "s")])).collect()[0].spans
    assert len(got) == 20_001 and got[-1].kind == "issued"


def test_queries_on_tables(spark, sf_dir):
    found = sc.op13_secret_scan(spark, sf_dir).collect()
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    assert len(found) == len(text)
    for r in found:
        base = brute_base(text[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x[0] == k for x in base) for k in ("assign", "access", "hex"))
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
        assert {f"{k}:{s}:{e}" for k, s, e in base} <= set(r.spans.split(","))
    rows = [(i, t, None) for i, t in text.items()]
    target = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    drawn = ir.op12_importance_resampling(spark, sf_dir)
    assert Counter(tuple(r) for r in drawn.select("doc_id", "n_features", "weight", "score", "rank").collect()) == brute_resample(rows, target)
