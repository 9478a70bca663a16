import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from ember.llm import periodic_runs as R
from ember.llm.catalog import QUERIES
from tests.conftest import SMALL
from tests.llm import brute


def slow_runs(w, min_length=6, exponent=4):
    found = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, exponent * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def slow_collapse(w, runs):
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def words_with_repeats(rng):
    k = rng.choice([1, 2, 2, 3, 5, 20])
    w = [rng.randrange(k) for _ in range(rng.randrange(120))]
    for _ in range(rng.randrange(4)):
        p = rng.randrange(1, 9)
        block = ([rng.randrange(k + 1) for _ in range(p)] * rng.randrange(2, 8))
        block = block[:len(block) - rng.randrange(p)]
        if rng.random() < .3:
            block = block + [99] + block + [98] + block
        at = rng.randrange(len(w) + 1)
        w[at:at] = block
    return w


def test_random_documents_against_the_definition():
    rng = random.Random(5)
    for _ in range(500):
        docs = [words_with_repeats(rng) for _ in range(rng.randrange(1, 6))]
        length, exponent = rng.choice([6, 6, 1, 3, 9]), rng.choice([4, 4, 5])
        bounds = np.r_[0, np.cumsum([len(d) for d in docs])].astype(np.int64)
        got = R.find_runs(np.array(sum(docs, []), np.int64), bounds, length, exponent)
        want = [(s + b, e + b, q) for b, d in zip(bounds, docs) for s, e, q in slow_runs(d, length, exponent)]
        assert [tuple(r) for r in got.tolist()] == want


def test_rules_spell_equal_words_at_all_places():
    ids = np.array(words_with_repeats(random.Random(1)) * 3, np.int64)
    rules = R.re_pair(ids, np.array([0, len(ids)]), 2)
    for r in range(len(rules.lo)):
        body = ids[rules.lo[r]:rules.hi[r]]
        for p in rules.places[rules.first[r]:rules.first[r + 1]]:
            assert (ids[p:p + len(body)] == body).all()
    assert (rules.lo[-1], rules.hi[-1]) == (0, len(ids))


@pytest.mark.parametrize("w", [[0] * 200_000, list(range(500)) * 200, [0, 1] * 50_000 + [2] + [0, 1] * 50_000],
                         ids=["one word", "long period", "two stretches"])
def test_long_repeats_stay_cheap(w):
    got = R.find_runs(np.array(w, np.int64), np.array([0, len(w)]))
    if w[:3] == [0, 1, 0]:
        assert got.tolist() == [[0, 100_000, 2], [100_001, 200_001, 2]]
    else:
        assert got.tolist() == [[0, len(w), 1 if w[1] == 0 else 500]]


def test_defined_cases(spark):
    rows = [(1, "a b a b a b a b", "x"), (1, "a b a b a b a b", "x"), (None, "z z\tz\nz z z end", "x"), (2, None, "x"),
            (3, "", "x"), (4, " \n ", "x"), (5, "a a a a a", "x"), (6, "é é é é é é  é", "x"), (7, "q " * 50_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = sorted((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"])
                 for r in R.periodic_runs(docs).collect())
    assert got == [(0, 7, [(0, 6, 1)], "z end"), (1, 8, [(0, 8, 2)], "a b"), (1, 8, [(0, 8, 2)], "a b"), (2, 0, [], ""),
                   (3, 0, [], ""), (4, 0, [], ""), (5, 5, [], "a a a a a"), (6, 7, [(0, 6, 1)], "é  é"),
                   (7, 50_000, [(0, 50_000, 1)], "q")]
    assert R.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        R.periodic_runs(docs, min_exponent=2)


def test_query_against_the_definition(spark):
    got = {r["doc_id"]: r for r in QUERIES["op11_periodic_runs"](spark, SMALL).collect()}
    some = 0
    for d in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect():
        w = brute.words(d["text"])
        h, n = zlib.crc32(str(d["doc_id"]).encode()), len(w)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = slow_runs(w)
        listed = [(s, e - s, q) for s, e, q in runs]
        s, m, q = max(listed, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
        digest = hashlib.sha256("".join("%d,%d,%d\n" % r for r in listed).encode()).hexdigest()
        r = got[d["doc_id"]]
        assert tuple(r[1:6]) == (len(runs), s, m, q, 1000 * m // q if runs else None)
        assert r["runs_sha256"] == digest
        assert r["collapsed_sha256"] == hashlib.sha256(slow_collapse(w, runs).encode()).hexdigest()
        some += len(runs)
    assert some > 20
