import re

from pyspark.sql import functions as F

from vitalgrid.llm.quality_rules import apply_rules, removed_lines, with_base

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    words = WORD.findall(t)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in t.split("\n") if WORD.search(x)]
    dup = len(lines) - len(set(lines))
    n = len(words)
    return n, sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(covered), n < 10 or 100 * len(covered) > 20 * n


TEXTS = [
    None, "", "   \n\t", "a", "one two three four five six seven eight nine ten", " a\x0bb\x0cc\rd  e\n", "a b c d e " * 8, "x y z\nx y z\n\nx y z \nq #$%&|<>*",
    "a a a a a a a", "été naïve \U0001f600 x y " * 3, "p q r s t u v w x y z " + " ".join(f"w{i}" for i in range(200)) + " p q r s t u", "l\n" * 50, "\x1c\x1d a", "1 2 3 4 5 6 1 2 3 4 5",
]


def test_base_equals_brute_force(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    for r in with_base(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(TEXTS[r.doc_id]), repr(TEXTS[r.doc_id])[:50]


def test_base_equals_brute_force_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").filter("length(text) < 3000")
    for r in with_base(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(r.text)


def corpus():
    rows = []
    for i in range(60):
        body = "\n".join(f"line {i} number {j} " + " ".join(f"w{i}x{j}y{k}" for k in range(12)) for j in range(4))
        rows.append((i, body + "\nShare this  PAGE now with friends", "a"))
    rows += [(100 + i, "Share this page now with friends\n" + f"tiny {i} b c d e f g h i j", "a") for i in range(5)]
    copy = "\n".join(f"copied line {j} " + " ".join(f"c{j}{k}" for k in range(15)) for j in range(6))
    rows += [(200 + i, copy, "a") for i in range(50)]
    rows += [(300, "Share this page now with friends\n" + "other host text here with enough words to stay in", "b"), (301, None, None), (301, None, None)]
    return rows


def test_lines_above_the_limit_go_and_copies_stay(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, source string").withColumn("removed", F.lit("clash"))
    out = {}
    for r in apply_rules(df, min_docs=20, max_removed=0.5).collect():
        out.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, out.values())) == len(corpus())
    for i in range(60):
        assert out[i][0].kept and out[i][0].n_removed_lines == 1 and "PAGE" not in out[i][0].clean_text
    for i in range(100, 105):
        assert out[i][0].n_removed_lines == 1 and not out[i][0].kept  # depleted
    for i in range(200, 250):
        assert out[i][0].kept and out[i][0].n_removed_lines == 0  # copies of one page are one document
    assert out[300][0].kept and out[300][0].n_removed_lines == 0  # another host
    assert len(out[301]) == 2 and not out[301][0].kept
    assert set(df.columns) <= set(out[0][0].asDict())


def test_shuffled_join_and_empty_table(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, source string")
    a = sorted(map(str, apply_rules(df).collect()))
    assert a == sorted(map(str, apply_rules(df, broadcast_bytes=0).collect()))
    empty = df.filter("false")
    assert apply_rules(empty).count() == 0 and removed_lines(empty).count() == 0


def line_corpus():
    """Documents of one host: fixed lines side by side, blank-line paragraphs, a line repeated in one document, copies."""
    rows = []
    for i in range(30):
        own = [f"own text {i} {j} " + " ".join(f"v{i}x{j}y{k}" for k in range(12)) for j in range(3)]
        lines = ["Header one of the whole site", "Header two of the whole site", "Header three of the whole site", *own]
        lines += ["", "Subscribe to our weekly letter right now", "", "footer one of the whole site", "footer  two of the whole site"]
        rows.append((None if i % 7 == 0 else i // 2, "\n".join(lines), "a"))
    alone = "\n".join(f"between {k} words\nthe refrain of one single document" for k in range(30))
    copy = "\n".join(f"copied line {j} of one page " + " ".join(f"c{j}{k}" for k in range(9)) for j in range(5))
    rows += [(1000, alone, "a"), *[(1001 + i, copy, "a") for i in range(40)]]
    return rows + [(2000, "header two of the whole site\n" + alone.replace("between", "b"), "b")]


def test_lines_are_counted_by_document(spark):
    rows = line_corpus()
    norm = lambda x: " ".join(WORD.findall(x.lower()))
    texts = {}
    for _, t, h in rows:
        for x in t.split("\n"):
            texts.setdefault((h, norm(x)), set()).add(t)
    want = []
    for d, t, h in rows:
        lines = t.split("\n")
        gone = [j for j, x in enumerate(lines) if norm(x) and len(texts[h, norm(x)]) > 20]
        want.append((d, "\n".join(x for j, x in enumerate(lines) if j not in gone), len(gone)))
    assert {n for _, _, n in want} == {0, 6}
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [(r.doc_id, r.clean_text, r.n_removed_lines) for r in apply_rules(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_limit_of_long_lines_does_not_grow_with_the_host(spark):
    long, short = "A passage of the terms of use that many pages of this site repeat word by word", "read on"
    rows = [(i, f"one {i} page with its own words a b c d e f g\n" + (f"{long}\n{short}\n" if i < 30 else "") + f"end {i}", "a") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in apply_rules(df).collect()}
    assert all(got[i].n_removed_lines == (i < 30) and long not in got[i].clean_text for i in range(3000))
    assert all(short in got[i].clean_text for i in range(30))  # short lines recur by chance


def test_helper_names_and_a_very_long_text(spark):
    names = ["_words", "_lines", "_row", "_doc", "_body", "_removed", "_removed_chars", "removed", "host", "l"]
    long = "\n".join(f"line{i} a{i} b{i} c{i} d{i}" for i in range(30_000))
    df = spark.createDataFrame([(1, long, "a"), (1, long, "a"), (2, "short", None)], "doc_id long, text string, source string").withColumns({c: F.lit(c) for c in names})
    rows = apply_rules(df).collect()
    assert len(rows) == 3 and all(r[c] == c for r in rows for c in names)
    assert {(r.n_words, r.kept) for r in rows} == {(150_000, True), (1, False)}


def test_emptied_documents_are_rejected(spark):
    """The share that is removed is one of word characters, whatever blanks stand around them."""
    line = "these twelve words stand on one line that all of the pages share"
    other = "and here are ten more words that only this page has no {}"
    rows = [(i, line + " " * 500 + f"\n  \n{' ' * i}", "h") for i in range(30)] + [(100 + i, f"{line}\n{other.format(i)}", "h") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in apply_rules(docs).collect()}
    assert not any(got[i].kept or got[i].clean_text.strip() for i in range(30))
    assert all(got[100 + i].kept and got[100 + i].clean_text == other.format(i) for i in range(3))
    assert not any(r.kept for r in apply_rules(docs, max_removed=1.0).collect() if r.doc_id < 30)
