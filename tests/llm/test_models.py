"""Language model, classifier, mixing and pipeline."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalgrid.llm.lm_scoring import lm_scores
from vitalgrid.llm.mixing import DOMAINS, fit_rates, mix_to_targets, op8_mixing
from vitalgrid.llm.quality_classifier import quality_scores

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, m):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    tokens = [[*WORD.findall(lower(t)), "\n"] for _, t in rows]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in rows]
    uni, hist, pair, triple = Counter(), Counter(), Counter(), Counter()
    for ws, h in zip(tokens, held):
        if not h:
            uni.update(ws)
            seq = ["\t", *ws]
            hist.update(seq[:-1])
            pair.update(zip(seq, ws))
            triple.update(zip(seq, ws, ws[1:]))
    n, v = sum(uni.values()), len(uni)
    p = lambda w: (uni[w] + 0.5) / (n + 0.5 * (v + 1))
    p2 = lambda a, b: (pair[a, b] + m * p(b)) / (hist[a] + m)
    p3 = lambda a, b, c: (triple[a, b, c] + m * p2(b, c)) / (pair[a, b] + m)
    out = []
    for (d, _), ws, h in zip(rows, tokens, held):
        seq = ["\t", *ws]
        score = math.log10(p2(*seq[:2])) + sum(math.log10(p3(*x)) for x in zip(seq, ws, ws[1:]))
        out.append((d, h, len(ws), sum(uni[w] > 0 for w in ws), n, round(sum(math.log10(p(w)) for w in ws), 6), round(score, 6)))
    return sorted(out, key=str)


def test_language_model_equals_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows = docs + [(None, "The the"), (5000, None), (5001, ""), (5002, " \x0b\x0c"), (7, docs[7][1]), (5003, "a b A B É é x\x1cy")]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, block int, id int")
    for chars in (6_000_000, 40_000):  # one block, and many blocks and buckets
        got = lm_scores(df, weight=2.0, block_chars=chars, bucket_chars=chars).collect()
        assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got), key=str) == brute(rows, 2.0)
    assert lm_scores(df.filter("false")).count() == 0


def test_language_model_of_shuffled_long_and_repeated_rows(spark):
    words = [f"w{(i * i) % 97}" for i in range(60_000)]
    rows = [(i, " ".join(words[i : i + 30])) for i in range(80)] + [(900, " ".join(words))] + [(3, "again and again")] * 300 + [(4, None)] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for chars in (400_000, 4_000):  # all rows in few blocks; one document's repeats fill several
        got = lm_scores(df, weight=2.0, block_chars=chars, bucket_chars=chars).collect()
        assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), round(r.score, 4)) for r in got), key=str) == sorted([(*x[:5], round(x[5], 4), round(x[6], 4)) for x in brute(rows, 2.0)], key=str)


def test_quality_is_learned(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    extra = spark.createDataFrame([(10**9, None), (10**9 + 1, "")], "doc_id long, text string")
    scored = quality_scores(docs.select("doc_id", "text").unionByName(extra), labels).cache()
    assert scored.count() == docs.count() + 2
    assert scored.filter("score < 0 OR score > 1 OR predicted <> CAST(score >= 0.5 AS INT)").count() == 0
    held = scored.filter("held_out").join(labels, "doc_id").groupBy("quality", "predicted").count().collect()
    right = sum(r["count"] for r in held if r.quality == r.predicted)
    assert right / sum(r["count"] for r in held) > 0.95
    none = quality_scores(docs, labels.filter("false"))
    assert {r.score for r in none.select("score").distinct().collect()} == {0.5}
    assert quality_scores(docs.filter("false"), labels).count() == 0


def test_very_long_texts_are_scored_and_mixed(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    text = "one two three\n" * 150_000
    long = spark.createDataFrame([(10**9, text), (10**9, text), (10**9 + 1, "x" * 1_000_000)], "doc_id long, text string")
    both = docs.unionByName(long)
    scored = [r for r in quality_scores(both, labels).collect() if r.doc_id >= 10**9]
    assert len(scored) == 3 and all(0 <= r.score <= 1 for r in scored) and len({r.score for r in scored if r.doc_id == 10**9}) == 1
    mixed = [r for r in mix_to_targets(both, labels).collect() if r.doc_id >= 10**9]
    assert sorted(r.n_tokens for r in mixed) == [1, 450_000, 450_000] and all(r.rate >= 0 for r in mixed)


def test_votes_equal_brute_force(spark):
    from vitalgrid.llm.quality_classifier import Neighbours

    rng = np.random.default_rng(2)
    counts = rng.integers(0, 5, (60, 40)).astype(np.float32)
    counts[30:40] = counts[:10]  # ties
    labels = rng.integers(0, 2, 60)
    model = Neighbours(counts, labels, 20)
    got = model.vote(counts, 7, 8.0)
    cosine = model.project(counts) @ model.vectors.T
    for i in range(60):
        near = sorted(range(60), key=lambda j: (-cosine[i, j], j))[:7]
        weight = [max(float(cosine[i, j]), 1e-6) ** 8 for j in near]
        assert abs(got[i] - sum(w * labels[j] for w, j in zip(weight, near)) / sum(weight)) < 1e-4


def test_one_row_of_each_labelled_id_is_learned_from(spark):
    from vitalgrid.llm.quality_classifier import labelled_sample

    docs = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (2, None), (3, "c"), (None, "d")] * 50, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0, 1), (1, 1, 0), (2, None, 1), (2, 0, 0), (3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: (r.text in "ab", r.quality, r.toxic) for r in labelled_sample(docs, labels, "doc_id", "text", ["quality", "toxic"], 10).collect()}
    assert got == {1: (True, 1, 0), 2: (True, 0, 0)}
    assert labelled_sample(docs, labels, "doc_id", "text", ["toxic"], 1).count() == 1
    twice = docs.withColumn("score", F.lit("x"))
    scored = quality_scores(twice, labels, label="toxic").collect()
    assert len(scored) == 300 and len({(r.doc_id, r.score) for r in scored if r.doc_id == 3}) == 1


def test_rates_equal_projected_gradient(spark):
    rng = np.random.default_rng(3)
    p, n = rng.dirichlet([0.5, 0.5, 0.5], 80), rng.integers(0, 90, 80).astype(float)
    n[:5] = 0
    df = spark.createDataFrame([(i, int(k), [float(x) for x in q]) for i, (k, q) in enumerate(zip(n, p))], "doc_id long, n_tokens long, p array<double>")
    for target in ([0.6, 0.3, 0.1], [0.2, 0.3, 0.5], [0.1, 0.2, 0.7]):
        rows = sorted(fit_rates(df, target, keep_every=3).collect(), key=lambda r: r.doc_id)
        share, total, r = np.array(target) / sum(target), n.sum(), np.ones(80)
        far = lambda r: (p * (r * n)[:, None]).sum(axis=0) / total - share
        sizes = lambda r: far(r) / np.maximum(share, 1e-3)
        for _ in range(100):
            if np.abs(sizes(r)).max() <= 1e-3:
                break
            hold = (p * (n * (r > 0))[:, None]).T @ p / total
            step, size = p @ (np.linalg.pinv(hold + 1e-6 * np.trace(hold) * np.eye(3)) @ far(r)), (sizes(r) ** 2).sum()
            for _ in range(20):
                if (sizes(np.maximum(0, r - step)) ** 2).sum() >= size:
                    step = step / 2
            r = np.maximum(0, r - step)
        assert np.allclose([x.rate for x in rows], r, atol=1e-9) and abs(rows[0].worst_gap - np.abs(sizes(r)).max()) < 1e-9
        assert len({x.worst_gap for x in rows}) == 1 and rows[0].worst_gap <= 1e-3


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_targets_of_the_query_are_met(spark, sf):
    import os
    import warnings

    if not os.path.isdir(f"/root/testdata/{sf}"):
        pytest.skip("no such table here")
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        got = op8_mixing(spark, f"/root/testdata/{sf}").agg(F.max("worst_gap"), F.min("rate"), F.count("*")).first()
    assert got[0] <= 1e-3 and got[1] >= 0 and got[2] > 0


def test_targets_out_of_reach_are_reported(spark):
    df = spark.createDataFrame([(i, 10, [0.5, 0.5]) for i in range(4)], "doc_id long, n_tokens long, p array<double>")
    with pytest.warns(UserWarning, match="not met"):
        rows = fit_rates(df, [0.9, 0.1]).collect()
    assert all(r.worst_gap > 1 and r.rate >= 0 for r in rows)


def test_rates_meet_targets(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.3, 0.3, 0.3, 0.1], 500)
    n = rng.integers(0, 500, 500)
    df = spark.createDataFrame([(i, int(k), [float(x) for x in q]) for i, (k, q) in enumerate(zip(n, p))], "doc_id long, n_tokens long, p array<double>")
    target = [0.4, 0.3, 0.2, 0.1]
    got = fit_rates(df, target).collect()
    r = np.array([x.rate for x in got])
    assert (r >= 0).all()
    share = (np.array([x.p for x in got]) * (r * np.array([x.n_tokens for x in got]))[:, None]).sum(axis=0) / n.sum()
    assert np.abs(share / target - 1).max() < 0.01
    assert fit_rates(df.filter("false"), target).count() == 0


def test_mixing_reads_every_document(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    extra = docs.limit(2).withColumns({"doc_id": F.col("doc_id") + 10**9, "text": F.lit(None).cast("string")})
    got = mix_to_targets(docs.unionByName(extra).withColumn("p", F.lit(1)), labels).collect()
    assert len(got) == docs.count() + 2 and all(x.rate >= 0 for x in got)
    assert all(abs(sum(x[f"p_{d}"] for d in DOMAINS) - 1) < 1e-6 for x in got)
    assert {x.n_tokens for x in got if x.doc_id >= 10**9} == {0}
    assert mix_to_targets(docs.filter("false"), labels).count() == 0
    assert {round(x.p_clean, 9) for x in mix_to_targets(docs, labels.filter("false")).collect()} == {0.25}


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.count()
    for name, stage in c.STAGES[:-1]:
        out = c.materialize(stage(spark, docs, sf_dir))
        assert out.columns == docs.columns and 0 < out.count() <= docs.count(), name
        docs = out
    final = c.STAGES[-1][1](spark, docs, sf_dir)
    assert final.count() == docs.count() < rows


def odd_documents(spark):
    """Nulls in every column, empty texts, repeated rows and columns whose names the stages use."""
    page = " ".join(f"word{i} is here" for i in range(30))
    rows = [(1, page, None, None, None), (1, page, None, None, None), (None, page + " end", "en", "s", 5), (None, None, None, None, None), (2, "", "en", "s", 0), (3, "other " + " ".join(f"x{i}" for i in range(50)), "en", None, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(7) for c in ("_doc", "_body", "_root", "root", "goes", "rows", "_words", "_found", "_new", "_removed", "p", "block", "cls", "n")})


def test_stages_take_odd_rows(spark, sf_dir):
    import corpus_pipeline as c

    docs = odd_documents(spark)
    want = {"quality rules": 4, "n-gram Jaccard join": 4, "benchmark decontamination": 6, "PII": 6}
    for name, stage in c.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.count() == want[name], name
        assert {r._doc for r in out.select("_doc").collect()} == {7}
        assert stage(spark, docs.filter("false"), sf_dir).count() == 0, name
    assert c.STAGES[-1][1](spark, docs, sf_dir).count() == 6


def test_pipeline_equals_brute_force(spark, tmp_path):
    """All stages over a small folder, against plain Python; what they write besides the result is deleted."""
    import random
    from pathlib import Path

    import corpus_pipeline as c
    from vitalgrid.llm.common import shared_dir

    rng = random.Random(4)
    fresh = lambda n: [f"v{rng.randrange(3000)}" for _ in range(n)]
    item = fresh(12)
    base = fresh(80)
    texts = [fresh(60) for _ in range(12)] + [fresh(4), ["same"] * 40, base, base, [*base[:40], "edit", *base[41:]], [*fresh(300), *item, *fresh(200)], [*fresh(30), *item[:6], *fresh(30)]]
    texts = [" ".join(t) for t in texts] + ["card 4111 1111 1111 1111 12/27 " + " ".join(fresh(30)), None, ""]
    spark.createDataFrame([(i, t, "en", f"host{i % 3}", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(item)), (2, "x y")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, i % 2, int(i % 4 == 3)) for i in range(12)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    def shingles(t):
        w = t.split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    def repeated(t):
        w = t.split()
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        return len({j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(i, i + 5)})

    kept = [i for i, t in enumerate(texts) if t and len(t.split()) >= 10 and 100 * repeated(t) <= 20 * len(t.split())]
    one = [i for i in kept if not any(j < i and 100 * len(shingles(texts[i]) & shingles(texts[j])) >= 80 * len(shingles(texts[i]) | shingles(texts[j])) for j in kept)]
    clean = [i for i in one if len(shingles(texts[i]) & shingles(" ".join(item))) < 0.8 * len(shingles(" ".join(item)))]
    assert len(texts) > len(kept) > len(one) > len(clean)
    folder = Path(shared_dir(spark).removeprefix("file://"))
    before = set(folder.iterdir()) if folder.exists() else set()
    spark.conf.set("spark.vitalgrid.pii.secret", "of this test")
    got = {r.doc_id: r for r in c.run(spark, str(tmp_path)).collect()}
    spark.conf.unset("spark.vitalgrid.pii.secret")
    assert sorted(got) == clean
    for i, r in got.items():
        assert r.n_tokens == len(texts[i].split()) and r.rate >= 0
    assert len(set(folder.iterdir()) - before) < 20  # the fourth stage's documents and what the fit of the rates still reads


def test_near_duplicates_equal_brute_force(spark):
    import corpus_pipeline as c

    page = lambda n, size=60: [f"p{n}w{k}" for k in range(size)]
    edited = lambda n, at: " ".join([*page(n)[:at], "edit", *page(n)[at + 1 :]])
    rows = [(None, " ".join(page(i))) for i in range(8)]  # null ids without copies
    rows += [(5, " ".join(page(20 + i))) for i in range(3)]  # different texts of one id
    rows += [(None, edited(1, 2)), (None, edited(1, 58)), (None, edited(2, 3)), (7, edited(2, 57))]
    rows += [(9, edited(20, 1)), (3, edited(21, 1)), (4, " ".join(page(40))), (4, " ".join(page(40)))]
    rows += [(None, " ".join(page(50)))] * 3 + [(11, " ".join(page(60))), (12, " ".join(page(60))), (13, None), (13, None), (None, "")]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in ((t or "").split() for _, t in rows)]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    df = spark.createDataFrame([(d, t, f"s{i}") for i, (d, t) in enumerate(rows)], "doc_id long, text string, source string")
    stays = [int(r.source[1:]) for r in c.near_duplicates(spark, df, "").collect()]
    assert sorted(group[i] for i in stays) == sorted(set(group))  # one row of each group
    for i in stays:
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        assert rows[i][0] == min(ids, default=None)


def test_the_key_is_the_sessions(spark):
    import pytest

    import corpus_pipeline as c

    docs = spark.createDataFrame([(1, "host 10.0.0.1", 1)], "doc_id long, text string, n_chars long")
    with pytest.warns(UserWarning, match="demonstration key"):
        public = c.pii(spark, docs, "").first().text
    spark.conf.set("spark.vitalgrid.pii.secret", "another")
    assert c.pii(spark, docs, "").first().text not in (public, "host 10.0.0.1")
    spark.conf.unset("spark.vitalgrid.pii.secret")
