import math
import unicodedata
import zlib
from collections import Counter, defaultdict

import pytest

from ember.llm.catalog import QUERIES
from ember.llm.langid import EVIDENCE, MAX_GRAM, fit, identify
from tests.conftest import MEDIUM

SCHEMA = "doc_id long, text string, lang string"


def letter_words(text):
    return "".join(c if unicodedata.category(c)[0] == "L" else " " for c in (text or "").lower()).split()


def brute(rows):
    """The same model in plain Python, without bounds."""
    counts = [defaultdict(Counter) for _ in range(MAX_GRAM + 1)]
    langs = set()
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, _, _ in rows}
    for i, t, lang in rows:
        if not held[i] and lang is not None and t is not None:
            langs.add(lang)
            for w in letter_words(t):
                counts[0][w][lang] += 1
                p = f"^{w}$"
                for n in range(1, MAX_GRAM + 1):
                    for j in range(len(p) - n + 1):
                        counts[n][p[j:j + n]][lang] += 1
    langs = sorted(langs)
    total = [{x: sum(c[x] for c in table.values()) for x in langs} for table in counts]
    log = lambda n, g, x: math.log(counts[n][g][x] + 0.5) - math.log(total[n][x] + 0.5 * len(counts[n]) + 1)

    def word(w, x):
        if w in counts[0]:
            return log(0, w, x)
        p = f"^{w}$"
        for n in range(MAX_GRAM, 0, -1):
            known = [g for g in (p[j:j + n] for j in range(len(p) - n + 1)) if g in counts[n]]
            if known:
                return sum(log(n, g, x) for g in known) / len(known)
        return 0.0

    out = {}
    for i, t, _ in rows:
        w = letter_words(t)
        if not w or not langs:
            out[i] = (held[i], "und", 0.0)
            continue
        mean = [sum(word(v, x) for v in w) / len(w) for x in langs]
        odds = [math.exp((m - max(mean)) * min(len(w), EVIDENCE)) for m in mean]
        out[i] = (held[i], langs[mean.index(max(mean))], max(odds) / sum(odds))
    return out


def test_matches_the_plain_model(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text", "lang")
            .filter("n_chars < 1500").collect()]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r[0]: r for r in identify(df, fit(df, docs_per_lang=10**6)).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    for i, (held, lang, score) in want.items():
        assert (got[i]["held_out"], got[i]["lang_pred"]) == (held, lang)
        assert got[i]["score"] == pytest.approx(score, abs=1e-6)


def test_held_out_accuracy(spark):
    truth = {r[0]: r[1] for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op3_language_id"](spark, MEDIUM).collect()
    assert len(rows) == len(truth) and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 100
    right = sum(r["lang_pred"] == truth[r["doc_id"]] for r in held)
    assert right >= 0.97 * len(held)


def test_labels_of_held_out_rows_are_not_learned(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    free = [i for i in range(400) if i not in ids]
    rows = [(i, "alpha beta gamma", "xx") for i in ids] + [(i, "alpha beta gamma", "yy") for i in free[:20]]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r["lang_pred"] for r in identify(df, fit(df)).collect()} == {"yy"}


def test_edges(spark):
    rows = [(1, "the cat and the dog", "en"), (3, "le chat et le chien", "fr"), (4, None, "en"), (5, "", "fr"), (6, "123 !?", "en"),
            (None, "the dog", "en"), (7, "the dog", None), (8, "日本", "ja"), (9, "the " * 50_000, None), (9, "the " * 50_000, None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS score", "'q' AS held_out", "2 AS key")
    got = [tuple(r) for r in identify(df, fit(df)).select("doc_id", "lang_pred", "score").collect()]
    assert len(got) == len(rows)
    by = {i: (p, s) for i, p, s in got}
    assert by[4] == by[5] == by[6] == ("und", 0.0)
    assert by[7][0] == by[9][0] == by[None][0] == "en" and by[3][0] == "fr"
    none = spark.createDataFrame([(1, "a b", None)], SCHEMA)
    assert [tuple(r) for r in identify(none, fit(none)).select("lang_pred", "score").collect()] == [("und", 0.0)]
    empty = spark.createDataFrame([], SCHEMA)
    assert identify(empty, fit(empty)).collect() == []
