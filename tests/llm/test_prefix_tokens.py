import random

import numpy as np
import pytest
import sentencepiece

import public_tokenizers
from ember.llm.catalog import QUERIES
from ember.llm import textkit as K
from ember.llm.prefix_tokens import MARK, PrefixBpe, count_tokens, prefix_table
from tests.conftest import MEDIUM

PATH = public_tokenizers.path("piece_bpe_32k.model")
SP = sentencepiece.SentencePieceProcessor(model_file=PATH)
SCHEMA = "doc_id long, text string"


def fuzz(n, seed):
    rnd = random.Random(seed)
    alphabet = list(" \t\n   abcdeéèßñü.,'-<>/|0123456789▁") + ["日", "本", "　", "🙂", "鿿", "‍", "s", "the", " in", "ing "]
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(40))) for _ in range(n)]


def test_whole_table_equals_the_library(spark):
    rows = QUERIES["op6_prefix_tokens"](spark, MEDIUM).collect()
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        n = len(SP.encode(texts[r["doc_id"]]))
        assert (r["n_tokens"], r["over_limit"], r["n_bytes"]) == (n, n > 4096, len(texts[r["doc_id"]].encode()))
        if n > 4096:
            assert len(SP.encode(texts[r["doc_id"]][:r["cut_chars"]])) <= 4096
        else:
            assert r["cut_chars"] == len(texts[r["doc_id"]])


def test_every_prefix_equals_the_library(spark):
    texts = fuzz(150, 1) + ["</s> <s> <unk> [INST] <0x41>", "   leading", "trailing   ", "a▁b", "naïve café" * 3]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    for r in prefix_table(df, PATH).collect():
        t = texts[r["doc_id"]]
        assert r["prefix_tokens"] == [len(SP.encode(t[:i])) for i in range(1, len(t) + 1)], t


def test_totals_on_random_unicode(spark):
    rnd = random.Random(9)
    texts = fuzz(1500, 2) + ["".join(chr(rnd.choice([rnd.randrange(32, 0x250), rnd.randrange(0x250, 0xD7FF)]))
                                     for _ in range(30)) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    got = {r["doc_id"]: r["n_tokens"] for r in count_tokens(df, PATH).collect()}
    assert [got[i] for i in range(len(texts))] == [len(x) for x in SP.encode(texts)]


@pytest.mark.parametrize("limit", [1, 3, 7])
def test_cut_is_the_longest_fitting_prefix(spark, limit):
    texts = fuzz(120, 3)
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    for r in count_tokens(df, PATH, limit=limit).collect():
        t = texts[r["doc_id"]]
        fits = [i for i in range(len(t) + 1) if len(SP.encode(t[:i])) <= limit]
        assert r["cut_chars"] == max(fits), t


def test_edges(spark):
    long = "unbroken" * 20_000
    rows = [(1, None), (2, ""), (None, "x y"), (2, ""), (3, " "), (4, long), (5, "word " * 30_000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n_tokens", "'z' AS n_bytes")
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in count_tokens(df, PATH).collect())
    assert got == sorted((i or 0, len((t or "").encode()), len(SP.encode(t or ""))) for i, t in rows)
    assert count_tokens(spark.createDataFrame([], SCHEMA), PATH).collect() == []


def test_prefixes_of_one_segment():
    bpe = PrefixBpe(PATH)
    for s in ["▁the", "▁▁▁internationalization", "▁x日本鿿y"]:
        assert bpe.prefixes(s) == [len(SP.encode(s[1:i].replace(MARK, " "))) if i > 1 else 1 for i in range(1, len(s) + 1)]


def test_many_segments_equal_each_alone():
    bpe = PrefixBpe(PATH)
    words = ["▁" + t.replace(" ", MARK) for t in fuzz(2000, 5)] + ["▁the", "x", "鿿", "🙂", "▁▁▁", "internationalization"]
    chars = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    assert bpe.many(chars, np.array([len(w) for w in words])).tolist() == [c for w in words for c in bpe.prefixes(w)]
    assert bpe.many(chars[:0], np.zeros(0, np.int64)).tolist() == []


def test_cache_finds_what_was_added_and_grows_by_merging_few_runs():
    rnd = np.random.default_rng(4)
    keys = rnd.permutation(np.unique(rnd.integers(0, 1 << 63, 30_000).astype(np.uint64)))
    cache, grown = K.SpanCache(limit=len(keys)), K.Grown(np.int64, [7])
    at = 0
    while at < len(keys):
        n = int(rnd.integers(0, 400))
        part = keys[at:at + n]
        assert (cache.find(part) == -1).all()
        cache.add(part, np.arange(at, at + len(part)))
        grown.append(np.arange(len(part)))
        at += n
    assert cache.full() and len(cache.runs) <= 16
    assert cache.find(keys).tolist() == list(range(len(keys)))
    assert grown.size == len(keys) + 1 and grown.view()[0] == 7
