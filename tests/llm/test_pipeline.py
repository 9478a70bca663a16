import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from tests.conftest import SMALL
from tests.llm import brute
from tests.llm.test_mixing import targets
from tests.llm.test_setsketch import brute_by_size

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def staged_rows(spark, docs, upto):
    for _, stage in P.STAGES[:upto]:
        docs = stage(spark, docs, None)
        assert docs.columns == P.COLUMNS
    return docs


def brute_stages(rows):
    """Texts by id after the language, near-duplicate and repeat stages."""
    kept = {i: t for i, t, *_ in rows if t is not None and re.search(r"[^\W\d_]", t)}
    first = {i for i, _, c in brute_by_size(list(kept.items()), P.SHINGLE, P.PERCENT) if i == c}
    kept = {i: t for i, t in kept.items() if i in first}
    out = {}
    least = {}
    for i in sorted(kept):
        w = brute.words(kept[i])
        for s in range(len(w) - P.WINDOW + 1):
            least.setdefault(tuple(w[s:s + P.WINDOW]), i)
    for i, t in kept.items():
        w, gone = brute.words(t), set()
        for s in range(len(w) - P.WINDOW + 1):
            if least[tuple(w[s:s + P.WINDOW])] < i:
                gone.update(range(s, s + P.WINDOW))
        if not gone:
            out[i] = t
        elif len(gone) < len(w):
            out[i] = " ".join(x for p, x in enumerate(w) if p not in gone)
    return out


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = brute_stages(rows)
    three = staged_rows(spark, docs, 3).cache()
    assert {r["doc_id"]: r["text"] for r in three.collect()} == want
    mixed = P.mix(spark, three, None).collect()
    source = {r["doc_id"]: r["source"] for r in three.collect()}
    size = {i: len(brute.words(t)) for i, t in want.items()}
    sizes, got = Counter(), Counter()
    for i in want:
        sizes[source[i]] += size[i]
    count = Counter(r["doc_id"] for r in mixed)
    assert all(r["text"] == want[r["doc_id"]] for r in mixed) and max(count.values()) <= 2
    for i, n in count.items():
        got[source[i]] += n * size[i]
    aim = targets(sizes)
    for s in sizes:
        assert abs(got[s] - aim[s]) <= max(size[i] for i in want if source[i] == s) / 2 + 1


def test_run_packs_what_the_stages_keep(spark):
    tok = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))
    rows = P.run(spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = brute_stages([tuple(r) for r in docs.select("doc_id", "text").collect()])
    tokens = defaultdict(int)
    for r in rows:
        assert r["doc_id"] in want and 0 < r["length"] <= 2048
        tokens[r["doc_id"]] += r["length"]
    for i, n in tokens.items():
        one = len(tok.encode(want[i], add_special_tokens=False).ids) + 1
        assert n in (one, 2 * one)


EDGE = [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "12 34", None, None, 5), (None, "some words here", None, "b", 1),
        (4, "some words here", "en", "b", 1), (5, "y " * 40_000, "en", None, 2), (6, "plain text", "en", "c", 3),
        (6, "plain text", "en", "c", 3)]


@pytest.mark.parametrize("rows", [EDGE, [], EDGE[:3]])
def test_every_stage_takes_odd_rows(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS size", "'x' AS kept", "2 AS home")
    kept = staged_rows(spark, docs, 4)
    assert {r["doc_id"] for r in kept.collect()} <= {r[0] for r in rows}
    P.pack(spark, kept, None).collect()
    for _, stage in P.STAGES:
        stage(spark, docs, None).collect()


def test_repeated_passages_are_cut_once(spark):
    passage = " ".join(f"p{i}" for i in range(55))
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(300)) + " " + passage, "en", "a", 1) for i in range(6)]
    out = {r["doc_id"]: r["text"] for r in P.cut_repeats(spark, spark.createDataFrame(rows, SCHEMA), None).collect()}
    assert out[0] == rows[0][1] and all(passage not in out[i] and out[i].startswith(f"w{i}x0") for i in range(1, 6))


def test_near_copies_leave_one(spark):
    base = [f"w{j}" for j in range(200)]
    rows = [(i, " ".join(base[:i] + ["zz"] + base[i:]), "en", "a", 1) for i in range(1, 6)] + [
        (9, " ".join(f"q{j}" for j in range(200)), "en", "a", 1)]
    out = P.near_dedup(spark, spark.createDataFrame(rows, SCHEMA), None).collect()
    assert sorted(r["doc_id"] for r in out) == [1, 9]


def test_language_stage_keeps_every_text_with_letters(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = P.language(spark, docs, None)
    assert out.exceptAll(docs).count() == 0
    assert docs.exceptAll(out).filter("text rlike '\\\\p{L}'").count() == 0


def rows_like(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows], SCHEMA)


def text_of(word, n=60):
    return " ".join(f"{word}{j}" for j in range(n))


def test_rows_that_share_an_id_keep_their_own_texts(spark):
    a, q = text_of("a"), text_of("q")
    docs = rows_like(spark, [(1, a, "s"), (2, a + " tail", "s"), (2, q, "s"), (None, a + " end", "s"), (None, q, "s")])
    out = P.cut_repeats(spark, docs, None).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out) == sorted(
        [(0, a + " end"), (0, q), (1, a), (2, "tail"), (2, q)])


def test_near_dedup_keeps_one_row_of_every_text(spark):
    x, y = text_of("x"), text_of("y")
    docs = rows_like(spark, [(3, x, "s"), (5, x, "s"), (5, y, "s"), (7, y, "s"), (7, y, "s"), (None, x, "s"), (None, x, "t")])
    out = P.near_dedup(spark, docs, None).collect()
    assert sorted((r["doc_id"] or 0, r["text"][0], r["source"]) for r in out) == [
        (0, "x", "s"), (0, "x", "t"), (3, "x", "s"), (5, "y", "s")]


def test_mix_meets_its_targets_where_ids_are_shared(spark):
    rows = [(1, text_of(f"b{i}", 40 + i), "b") for i in range(12)] + [(2, "same words", "c")] * 2500 + [
        (None, text_of(f"c{i}", 30), "c") for i in range(5)] + [(i, text_of(f"a{i}"), "a") for i in range(40)]
    out = P.mix(spark, rows_like(spark, rows), None).collect()
    size, got = Counter(), Counter()
    for _, t, s in rows:
        size[s] += len(brute.words(t))
    for r in out:
        got[r["source"]] += len(brute.words(r["text"]))
    aim = targets(size)
    for s in size:
        assert abs(got[s] - aim[s]) <= max(len(brute.words(t)) for _, t, x in rows if x == s) / 2 + 1
    many = Counter(r["text"] for r in out)
    assert all(n <= 2 * Counter(t for _, t, _ in rows)[t] for t, n in many.items())


def test_language_predicts_every_text_once(spark):
    docs = spark.createDataFrame([(i, "some words here", "en" if i % 2 else None, "a", 15) for i in range(20)], SCHEMA)
    out = P.language(spark, docs, None)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("ArrowEvalPython", plan)) == 1
    assert {r["lang"] for r in out.collect()} == {"en"} and out.count() == 20
