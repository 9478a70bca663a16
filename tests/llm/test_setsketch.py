import random

import numpy as np
import pytest

from ember.llm import setsketch
from ember.llm.catalog import QUERIES
from ember.llm.components import connected_components
from ember.llm.setsketch import ShingleSets, band_size, estimate_jaccard, near_duplicates, solve
from tests.conftest import MEDIUM
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def run(spark, rows, k=3, percent=85, **kw):
    out = near_duplicates(spark.createDataFrame(rows, SCHEMA), shingle=k, percent=percent, **kw).collect()
    assert len(out) == len(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out if r["doc_id"] is not None)
    return out


def check(spark, rows, k=3, percent=85, **kw):
    out = run(spark, rows, k, percent, **kw)
    assert sorted(tuple(r)[:3] for r in out) == sorted(brute.near_duplicates(rows, k, percent))
    return out


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r)[:3] for r in QUERIES["op5_setsketch"](spark, MEDIUM).collect())
    # Every pair at the threshold shares a shingle; the brute force skips shingles of many documents.
    assert got == sorted(brute_by_size(rows, 3, 85))


def brute_by_size(rows, k, percent):
    """Exact components with a size filter and prefix positions in a fixed shingle order."""
    sets = {i: brute.shingles(t, k) for i, t in rows}
    freq = {}
    for s in sets.values():
        for x in s:
            freq[x] = freq.get(x, 0) + 1
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where, seen = {}, set()
    for i, s in sets.items():
        order = sorted(s, key=lambda x: (freq[x], x))
        for x in order[:len(s) - -(-percent * len(s) // 100) + 1]:
            for o in where.get(x, ()):
                seen.add((o, i))
            where.setdefault(x, []).append(i)
    for a, b in seen:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return [(i, len(sets[i]), find(i)) for i in sets]


def mutated(rnd, words, n):
    out = list(words)
    for _ in range(n):
        out[rnd.randrange(len(out))] = f"n{rnd.getrandbits(30)}"
    return out


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_random_families(spark, k, percent):
    rnd = random.Random(k)
    rows = []
    for _ in range(40):
        base = [f"w{rnd.randrange(4000)}" for _ in range(rnd.choice([1, 2, 3, 5, 9, 30, 120, 400]))]
        for _ in range(rnd.randrange(1, 8)):
            rows.append((len(rows), " ".join(mutated(rnd, base, rnd.randrange(0, 1 + len(base) // 25)))))
    rnd.shuffle(rows)
    check(spark, rows, k, percent)


def test_chains_and_blocks(spark):
    """A family larger than a block whose ends are linked only through the middle."""
    rnd = random.Random(1)
    words, rows = [f"c{i}" for i in range(150)], []
    for i in range(300):
        rows.append((i, " ".join(words)))
        words[(i * 7) % 150] = f"x{i}"
    rows += [(1000 + i, " ".join(mutated(rnd, rows[5][1].split(), 5))) for i in range(120)]
    rnd.shuffle(rows)
    out = check(spark, rows, 3, 85, block=40)
    assert sum(r["kept"] for r in out) < len(rows) / 2


def test_edges(spark):
    long = "v " * 3 + " ".join(f"u{i}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, long), (5, long.upper()), (6, "a"), (7, "A"), (8, "a b"), (9, "É b c"),
            (10, "é b c"), (11, "x y z w")]
    out = {r["doc_id"]: r for r in check(spark, rows)}
    assert out[5]["component_id"] == 4 and out[7]["component_id"] == 6 and out[10]["component_id"] == 10
    extra = spark.createDataFrame([(5, "a b c", 1, "r"), (5, "a b c", 1, "r"), (None, "a b c", 1, "r"), (4, "A b c", 1, "")],
                                  "doc_id long, text string, size int, component string")
    got = near_duplicates(extra, shingle=3, percent=85).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in got) == [
        (0, 0, True), (4, 4, True), (5, 4, False), (5, 4, False)]
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sketches_merge_and_estimate():
    rnd = random.Random(2)
    for share in (0.5, 0.8, 0.9):
        n = 1500
        a = [f"w{rnd.getrandbits(40)}" for _ in range(n)]
        keep = round(n * 2 * share / (1 + share))
        b = a[:keep] + [f"w{rnd.getrandbits(40)}" for _ in range(n - keep)]
        both = keep / (2 * n - keep)
        sk = ShingleSets([" ".join(a).encode(), " ".join(b).encode(), " ".join(a + b).encode()], 1)
        reg = sk.registers()
        assert (np.maximum(reg[0], reg[1]) == reg[2]).all()
        e = estimate_jaccard(np.array([(reg[0] > reg[1]).sum()]), np.array([(reg[0] < reg[1]).sum()]),
                             sk.sizes[:1].astype(float), sk.sizes[1:2].astype(float))[0]
        assert abs(e - both) < 0.1


def test_band_size_keeps_the_miss_rate():
    for t in (0.8, 0.85, 0.95):
        r = band_size(t)
        assert (1 - t ** r) ** (setsketch.REGISTERS // r) <= setsketch.MISS
    assert band_size(0.95) > band_size(0.8)


def test_solve_compares_across_sides_only():
    texts = [b"a b c d e", b"a b c d e f", b"a b c d e"]
    ids = np.array([1, 2, 3])
    none = solve(ids, ids, np.array([1, 1, 1]), texts, 1, 80)
    some = solve(ids, ids, np.array([1, 2, 2]), texts, 1, 80)
    assert none == [] and sorted(some) == [(1, 2), (1, 3)]


def test_components_of_random_graphs(spark):
    rnd = random.Random(8)
    for n, m in ((60, 50), (200, 210)):
        links = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)] + [(500 + i, 501 + i) for i in range(60)]
        want = {}
        for u, v in links:
            want.setdefault(u, u)
            want.setdefault(v, v)
        changed = True
        while changed:
            changed = False
            for u, v in links:
                low = min(want[u], want[v])
                if want[u] != low or want[v] != low:
                    want[u] = want[v] = low
                    changed = True
        loops = {u for u, v in links if u == v} - {x for u, v in links if u != v for x in (u, v)}
        got = {r[0]: r[1] for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
        assert got == {k: v for k, v in want.items() if k not in loops}


def test_an_id_on_several_texts_is_one_node(spark):
    x, y, z = (" ".join(f"{c}{j}" for j in range(50)) for c in "xyz")
    rows = [(3, x), (5, x), (5, y), (7, y), (9, z), (9, y + " more"), (11, z), (12, None), (12, "other"), (None, x)]
    out = near_duplicates(spark.createDataFrame(rows, SCHEMA), shingle=3, percent=85).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in out) == [
        (0, None), (3, 3), (5, 3), (5, 3), (7, 3), (9, 3), (9, 3), (11, 3), (12, 12), (12, 12)]
