import random

import numpy as np
import pytest

from ember.llm.catalog import QUERIES
from ember.llm.mixing import fit_budget, mix_sources
from tests.conftest import MEDIUM
from tests.llm import brute


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > cap * sizes[s]}
        if not over:
            out.update({s: level * w[s] for s in open_})
            break
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def check(spark, rows, near=1.0):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mix_sources(df).collect()
    size, want, got, count = {}, [], {}, {}
    for i, t, s in rows:
        size[s] = size.get(s, 0) + len(brute.words(t))
        want.append((i, s, len(brute.words(t))))
    aim = targets(size)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted([(r["doc_id"], r["source"], r["size"]) for r in out], key=key) == sorted(want, key=key)
    for r in out:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(aim[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        got[r["source"]] = got.get(r["source"], 0) + r["taken"]
        count.setdefault(r["source"], []).append(r["copies"])
    for s in got:
        assert abs(got[s] - aim[s]) <= near, s
        assert max(count[s]) - min(c for c in count[s]) <= 1
    return out


def test_whole_table_meets_its_targets(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text", "source").collect()]
    check(spark, rows)
    a, b = (sorted(QUERIES["op4_mixing"](spark, MEDIUM).collect()) for _ in range(2))
    assert a == b


def test_one_length_holds_most_rows(spark):
    rows = [(i, "a b c d e", "hot") for i in range(9000)] + [(10_000 + i, "x " * (i % 7 + 1), f"s{i % 5}") for i in range(3000)]
    check(spark, rows, near=3.0)


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "one two", None), (3, "one two", None), (None, "w " * 30_000, "b"),
            (4, "x y z", "c"), (5, None, "empty")]
    out = check(spark, rows, near=15_000.0)
    assert {r["doc_id"]: r["target"] for r in out if r["source"] == "empty"} == {5: 0.0}
    assert mix_sources(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []
    extra = spark.createDataFrame([(1, "a b", "s", 3, "t")], "doc_id long, text string, source string, size int, n string")
    assert mix_sources(extra).select("size", "taken").collect() == [(2, 2)]


def test_budget_fit_is_exact_when_a_subset_exists():
    rnd = random.Random(3)
    for _ in range(200):
        lengths = np.array(rnd.sample(range(1, 60), rnd.randrange(1, 9)))
        counts = np.array([rnd.randrange(1, 6) for _ in lengths])
        budget = rnd.randrange(0, int((lengths * counts).sum()) + 1)
        take = fit_budget(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        sums = {0}
        for size, n in zip(lengths.tolist(), counts.tolist()):
            sums = {s + k * size for s in sums for k in range(n + 1)}
        best = min(abs(s - budget) for s in sums)
        # The proportional start is kept, so the exact optimum is not always reachable.
        assert abs(int((take * lengths).sum()) - budget) <= best + int(lengths.max())
    many = np.arange(1, 400)
    assert int((fit_budget(many, np.full(399, 50), 1_234_567) * many).sum()) == 1_234_567
