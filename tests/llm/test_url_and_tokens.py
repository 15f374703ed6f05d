import re

import numpy as np
import pytest

from vitalgrid.llm.token_counts import RankMerger, count_tokens
from vitalgrid.llm.url_filters import GLOBS, RULES, Glob, Rule, ShiftAnd, filter_urls


def test_shift_and_equals_regex():
    rng = np.random.default_rng(0)
    letters = np.array(list("ab.*?"))
    patterns = ["".join(rng.choice(letters, rng.integers(1, 12))) for _ in range(40)]
    texts = ["".join(rng.choice(list("ab."), rng.integers(0, 12))) for _ in range(300)] + [""]
    got = ShiftAnd([p.encode() for p in patterns]).match([t.encode() for t in texts])
    for k, p in enumerate(patterns):
        rx = re.compile("".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in p))
        assert got[:, k].tolist() == [bool(rx.fullmatch(t)) for t in texts], p


#: The rules as the contract of the query words them.
CONTRACT = "allow org/, block example.org/es/, block example.org/en/1, allow com/fr/, block com/de/"


def test_rules_are_those_of_the_contract():
    assert [f"{r.verdict} {r.name}" for r in RULES] == CONTRACT.split(", ")


def test_filter_urls(spark):
    urls = [
        "http://a.example.org/es/5", "http://EXAMPLE.org/en/17?x", "http://example.org/en/2", "http://a.org", "https://x.com/fr/1#t",
        "https://x.com/de/", "http://xcom/de/", "http://spam-farm.example.net/a", "http://b.net/x.org/", None, "nothing", "http:///a", "http://b.net/a://c.org/",
    ]
    rows = [(i, u, "n") for i, u in enumerate(urls)] + [(0, urls[0], "again")]
    got = filter_urls(spark.createDataFrame(rows, "page_id long, url string, verdict string")).collect()
    assert len(got) == len(rows)
    by = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert by[0] == ("a.example.org", "/es/5", "example.org/es/", "block")
    assert by[1] == ("example.org", "/en/17", "example.org/en/1", "block")
    assert by[2][2:] == ("org/", "allow")
    assert by[3] == ("a.org", "", None, "allow")
    assert by[4][2:] == ("com/fr/", "allow")
    assert by[5][2:] == ("com/de/", "block")
    assert by[6][2:] == (None, "allow")
    assert by[7][2:] == (None, "block")
    assert by[8][2:] == (None, "allow")
    assert by[9] == by[10] == ("", "", None, "block")
    assert by[11] == ("", "/a", None, "block")
    assert by[12][:2] == ("b.net", "/a://c.org/")
    empty = filter_urls(spark.createDataFrame([], "page_id long, url string"))
    assert empty.count() == 0
    assert isinstance(RULES[0], Rule) and isinstance(GLOBS[0], Glob)


TEXTS = [
    "", None, "  ", "Hello world's  end", "<|endoftext|>a<|startoftext|> b<|endoftext", "caf\u0065\u0301 \u00c5ngstr\u00f6m \u0130 \u03a3\u03a3",
    "a\u00a0b\u2003c\x1cd\x85e", "aaaaaaaaa aaaaaa bbbb", "x" * 5000 + " " + "ab" * 3000, "12345 \u0663\u0664", "don't we'll 'S 'ReX", "\U0001f600\U0001f600 \u4e2d\u6587",
    "a\x00b \ufeff c\u200bd",
]


@pytest.fixture(scope="module")
def vocabulary():
    public = pytest.importorskip("public_tokenizers")
    return public.path("word_bpe_49k.json")


def test_counts_equal_the_library(spark, vocabulary):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary)
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_tokens int")
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in count_tokens(docs, vocabulary).collect()}
    for i, t in enumerate(TEXTS):
        want = len(library.encode(t or "", add_special_tokens=False).ids)
        assert got[i] == (len((t or "").encode()), want), repr(t)[:60]


def test_no_rows_and_repeated_rows(spark, vocabulary):
    docs = spark.createDataFrame([(1, "some words"), (1, "some words"), (None, "some words")], "doc_id long, text string")
    assert len({r.n_tokens for r in count_tokens(docs, vocabulary).collect()}) == 1 and count_tokens(docs, vocabulary).count() == 3
    assert count_tokens(docs.filter("false"), vocabulary).count() == 0


def test_a_very_long_url(spark):
    urls = ["http://example.org/es/" + "a/" * 20_000 + "x.exe", "http://" + "b" * 20_000 + ".com/de/", "x" * 20_000]
    got = {r.page_id: (len(r.host), len(r.path), r.rule, r.verdict) for r in filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()}
    assert got == {0: (11, 40_009, "example.org/es/", "block"), 1: (20_004, 4, "com/de/", "block"), 2: (0, 0, None, "block")}


def test_counts_equal_the_library_on_documents(spark, vocabulary, sf_dir):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in count_tokens(docs, vocabulary).collect()}
    rows = docs.select("doc_id", "text").collect()
    want = {r.doc_id: len(e.ids) for r, e in zip(rows, library.encode_batch([r.text for r in rows], add_special_tokens=False), strict=True)}
    assert got == want


def test_merging_in_small_memory(vocabulary):
    merger = RankMerger(vocabulary, memo_words=2)
    words = ["hello", "world", "hello", "again", "worlds"]
    assert merger.word_sizes(words).tolist() == RankMerger(vocabulary).word_sizes(words).tolist()
