"""License scan and decontamination against brute force."""

import random
import re

from vitalgrid.llm.decontamination import contaminated
from vitalgrid.llm.license_scan import PHRASES, scan_licenses
from vitalgrid.llm.license_texts import BSD_CONDITIONS, BSD_WARRANTY, GNU_NOTICE, MIT_GRANT, MIT_NOTICE, MIT_WARRANTY

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def places(ws):
    out = []
    for label, phrase in PHRASES:
        p = phrase.split()
        out += [(i, label) for i in range(len(ws) - len(p) + 1) if ws[i : i + len(p)] == p]
    return out


def test_licenses_equal_brute_force(spark):
    mit = " ".join(words(MIT_GRANT)[:21])
    edited = mit.replace("free of charge", "without any charge").replace("copy of this", "copy of that")
    texts = [
        None, "", "MIT License", "mit-license. MIT\nLICENSE and Apache License; GNU General Public License v3 general public license", "general public", "mit", "x " * 50 + mit, edited + " y" * 40,
        "Permission is granted.", "apache license apache license", "la mit licenses", "the mit license mit license", "a" * 100_000 + " mit license",
        MIT_GRANT + MIT_NOTICE + MIT_WARRANTY, "intro " * 30 + BSD_CONDITIONS.replace("disclaimer", "notice") + BSD_WARRANTY,
        GNU_NOTICE.format(program="program", name="General Public License", version="3"), "\u212a mit l\u0130cense mit licen\u017fe", "of the use of this software and of the " * 40,
    ]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(3, texts[3], "again"), (None, "mit license", "x")]
    got = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, labels string")).collect()
    assert len(got) == len(rows)
    for r in got:
        t = "mit license" if r.doc_id is None else texts[r.doc_id]
        found = places(words(t))
        assert (r.n_words, r.n_base) == (len(words(t)), len(found))
        assert (r.first_word, r.last_word) == ((min(found)[0], max(found)[0]) if found else (None, None))
        assert r.base_labels == ",".join(sorted({b for _, b in found}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    by = {r.doc_id: r for r in got}
    assert by[6].labels == "mit" and by[6].n_base == 0 and by[6].score == 1.0
    assert by[7].labels == "mit" and 0.6 <= by[7].score < 1
    assert (by[13].labels, by[13].score) == ("mit", 1.0)
    assert by[14].labels == "bsd" and 0.6 <= by[14].score < 1
    assert by[15].labels == by[15].base_labels == "gpl" and by[16].n_words == 5 and by[17].labels == ""
    assert by[8].labels == "" and by[8].score == 0.0


def test_licenses_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in scan_licenses(docs).collect():
        found = places(words(text[r.doc_id]))
        assert (r.n_words, r.n_base) == (len(words(text[r.doc_id])), len(found))
    assert scan_licenses(docs.filter("false")).count() == 0


def test_contamination_equals_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"v{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(n))) for i, n in enumerate([3, 5, 8, 12, 20, 30, 45, 70, 120])] + [(20, None), (21, ""), (22, "same words in both items here"), (23, "same words in both items here")]
    docs = [(0, None), (1, ""), (2, "v1 v2"), (3, "same words in both items here"), (3, "same words in both items here"), (None, items[4][1])]
    for n, (i, t) in enumerate(items[:9]):
        pad = lambda k: [rng.choice(vocab) for _ in range(k)]
        w = t.split()
        docs.append((100 + n, " ".join(pad(3000) + w + pad(2000))))
        docs.append((200 + n, " ".join(pad(50) + w[: max(1, int(len(w) * 0.7))] + pad(50))))
        v = list(w)
        v[len(v) // 2] = "changed"
        docs.append((300 + n, ". ".join(pad(40)) + "\n" + ", ".join(v).upper() + " " + " ".join(pad(400))))

    def sh(t):
        ws = words(t)
        return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)}

    want = set()
    sets = [(i, sh(q)) for i, q in items]
    for d, t in docs:
        own = sh(t)
        want |= {(d, i, len(s), len(s & own)) for i, s in sets if s and len(s & own) / len(s) >= 0.8}
    a = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    for limit in (1_000_000, 0):
        got = contaminated(a, b, broadcast_bytes=limit).collect()
        assert {(r.doc_id, r.item_id, r.n_item_shingles, r.n_found) for r in got} == want and len(got) == len(want)
    assert contaminated(a.filter("false"), b).count() == 0 and contaminated(a, b.filter("false")).count() == 0


def test_an_item_inside_a_very_long_text(spark):
    item = "an item of eight words that stands alone"
    long = " ".join(f"w{i}" for i in range(100_000)) + " " + item + " " + " ".join(f"v{i}" for i in range(100_000))
    a = spark.createDataFrame([(1, long), (2, long.replace(" alone", " here"))], "doc_id long, text string")
    b = spark.createDataFrame([(9, item)], "item_id long, text string")
    assert [(r.doc_id, r.item_id, r.n_found) for r in contaminated(a, b).collect()] == [(1, 9, 4)]
