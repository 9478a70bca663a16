import math

import numpy as np
import pytest

from ember.llm.bitsliced import top_k_products
from ember.llm.catalog import QUERIES
from ember.llm.kmeans_tree import Tree, calibrate, fixed_order_products, nearest
from tests.conftest import MEDIUM

SCHEMA = "vec_id long, embedding array<double>"
BENCH = "/root/testdata/sf0.1"


def good(v, zero=True):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))


def brute(rows, k, quantise, zero=True):
    rows = [(i, v) for i, v in rows if i is not None and good(v, zero)]
    out = {}
    for qi, q in rows:
        if qi % 20:
            continue
        scored = []
        for i, v in rows:
            if i != qi:
                if quantise:
                    s = sum(math.floor(64 * a) * math.floor(64 * b) for a, b in zip(q, v))
                else:
                    s = float(np.dot(q, v))
                scored.append((-s, i))
        out[qi] = [(r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return out


def grouped(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def table(spark, d):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding").collect()]


def test_top_k_whole_table(spark):
    assert grouped(QUERIES["op2_bit_sliced"](spark, MEDIUM).collect()) == brute(table(spark, MEDIUM), 20, True)


def test_top_k_over_many_blocks_with_ties(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.integers(-3, 4, 5) / 64]) for i in range(700)]
    rows += [(1000 + i, rows[0][1]) for i in range(90)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert grouped(top_k_products(df, block_rows=100, query_bytes=200).collect()) == brute(rows, 20, True)


EDGES = [(0, [0.5, 0.25]), (20, None), (40, [1.0, None]), (60, [float("nan"), 1.0]), (80, [float("inf"), 0.0]), (1, [0.0, 0.0]),
         (2, [-1.5, 2.0]), (None, [1.0, 1.0]), (3, [1e5, -1e5]), (100, [0.0, 0.0])]


def test_top_k_edges(spark):
    df = spark.createDataFrame(EDGES, SCHEMA).selectExpr("*", "1 AS q", "'b' AS block")
    assert grouped(top_k_products(df).collect()) == brute(EDGES, 20, True)
    assert top_k_products(spark.createDataFrame([], SCHEMA)).collect() == []
    assert top_k_products(spark.createDataFrame([(0, [1.0])], SCHEMA)).collect() == []
    twice = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (5, [1.0, 1.0]), (5, [1.0, 1.0])]
    got = grouped(top_k_products(spark.createDataFrame(twice, SCHEMA)).collect())
    assert got == {0: [(1, 5, 4096), (2, 5, 4096)]}


def recall(got, want):
    hit = sum(len({i for _, i, _ in got.get(q, [])} & {i for _, i, _ in rows}) for q, rows in want.items())
    return hit / sum(map(len, want.values()))


def check_neighbours(got, rows, want):
    vec = {i: np.array(v, float) for i, v in rows if good(v)}
    assert set(got) == set(want)
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, len(want[q]) + 1))
        assert all(a[2] > b[2] or a[2] == b[2] and a[1] < b[1] for a, b in zip(found, found[1:]))
        for _, i, s in found:
            assert i != q and s == pytest.approx(float(vec[q] @ vec[i]), abs=1e-12)


def test_neighbours_recall_on_the_benchmark_table(spark):
    rows = table(spark, BENCH)
    x = np.array([v for _, v in rows], float)
    ids = np.array([i for i, _ in rows])
    want = {}
    for j in np.flatnonzero(ids % 20 == 0):
        s = x @ x[j]
        s[j] = -np.inf
        best = np.lexsort((ids, -s))[:20]
        want[int(ids[j])] = [(r + 1, int(ids[b]), float(s[b])) for r, b in enumerate(best)]
    got = grouped(QUERIES["op7_kmeans_tree"](spark, BENCH).collect())
    check_neighbours(got, rows, want)
    assert recall(got, want) >= 0.9


def test_neighbours_with_a_small_sample_and_a_hot_leaf(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(12, 8))
    x = np.concatenate([centre[i % 12] + 0.2 * rng.normal(size=8) for i in range(2400)]).reshape(-1, 8)
    x = np.concatenate([x, np.repeat(x[:1], 900, axis=0)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    got = grouped(nearest(spark.createDataFrame(rows, SCHEMA), sample_rows=600, block_rows=200, query_rows=50).collect())
    want = brute(rows, 20, False)
    # Copies tie, so a result counts when its score reaches the true last place.
    hit = sum(s >= want[q][-1][2] - 1e-9 for q in want for _, _, s in got[q])
    assert hit >= 0.9 * sum(map(len, want.values()))


def test_the_walk_is_selective_and_calibration_holds():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(10, 24))[rng.integers(10, size=6000)] * 0.6 + rng.normal(size=(6000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree = Tree(x[500:3000])
    leaf = tree.assign(x)
    count, total = np.bincount(leaf, minlength=tree.leaves), np.zeros((tree.leaves, 24))
    np.add.at(total, leaf, x)
    tree.describe(count, total, np.bincount(leaf, weights=(x * x).sum(axis=1), minlength=tree.leaves))
    assert np.allclose(tree.means[0], x.mean(axis=0))
    score = x[:500] @ x.T
    score[np.arange(500), np.arange(500)] = -np.inf
    near = leaf[np.argsort(-score, axis=1)[:, :20]]
    promise, home = tree.promise(x[:500]), tree.assign(x[:500])
    visits = calibrate(tree, x[:250], np.repeat(np.arange(250), 20), near[:250].ravel(), 0.95)
    walked = [list(tree.walk(promise[i], home[i])) for i in range(500)]
    assert all(sorted(w) == list(range(tree.leaves)) for w in walked[:5])
    assert np.mean([np.isin(near[i], walked[i][:visits]).mean() for i in range(250, 500)]) >= 0.93
    assert np.mean([count[walked[i][:visits]].sum() for i in range(500)]) < 0.5 * len(x)
    assert calibrate(tree, x[:5], np.arange(5), near[:5, 0], 1.0) == tree.leaves


def test_neighbours_edges(spark):
    rows = EDGES + [(120, [0.1, 0.2, 0.3])]
    got = grouped(nearest(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS leaf", "'g' AS group")).collect())
    # A shorter vector is read as if zeros followed.
    same = [(i, v + [0.0] * (3 - len(v))) for i, v in rows if good(v, False) and i is not None]
    want = brute(same, 20, False, False)
    assert {q: [i for _, i, _ in r] for q, r in got.items()} == {q: [i for _, i, _ in r] for q, r in want.items()}
    assert nearest(spark.createDataFrame([], SCHEMA)).collect() == []
    assert nearest(spark.createDataFrame([(0, [0.0])], SCHEMA)).collect() == []
    assert nearest(spark.createDataFrame([(0, [1.0])], SCHEMA)).collect() == []


def test_equal_vectors_score_alike_in_any_company():
    rng = np.random.default_rng(8)
    for dims in (3, 17, 64):
        v, q = rng.normal(size=dims), rng.normal(size=dims)
        scores = {float(s) for rows in (1, 2, 7, 64, 200) for s in fixed_order_products(q, np.tile(v, (rows, 1)))}
        assert len(scores) == 1


def test_ties_of_equal_vectors_go_to_the_smaller_id(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(30, 64))
    rows = [(i, base[int(rng.integers(30))].tolist()) for i in range(900)] + [(2000, [1.0, 2.0]), (2020, [0.0, 0.0, 3.0])]
    out = grouped(nearest(spark.createDataFrame(rows, SCHEMA), k=20, recall=1.0, block_rows=100, query_rows=7).collect())
    full = np.zeros((len(rows), 64))
    for r, (_, v) in enumerate(rows):
        full[r, :len(v)] = v
    ids = np.array([i for i, _ in rows])
    assert set(out) == {i for i, _ in rows if i % 20 == 0}
    for query, found in out.items():
        s = fixed_order_products(full[ids == query][0], full)
        order = [r for r in np.lexsort((ids, -s)) if ids[r] != query][:20]
        assert [(i, x) for _, i, x in found] == [(int(ids[r]), float(s[r])) for r in order]
