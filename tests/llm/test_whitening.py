import math

import numpy as np
import pytest

from ember.llm import whitening as W
from ember.llm.catalog import QUERIES
from tests.conftest import SMALL

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, components=8, scale=1024, offset=100_000):
    """(n, deviation by row, eigenvalues, trace, whitened up to sign) with whole numbers up to the covariance."""
    dims = max(len(v) for v in rows)
    x = np.array([[math.floor(scale * c) + offset for c in [*v, *[0.0] * (dims - len(v))]] for v in rows], object)
    z = len(x) * x - x.sum(axis=0)
    cov = np.array([[int(c) / len(x) ** 3 for c in line] for line in z.T @ z])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return len(x), [int((r * r).sum()) for r in z], values, np.trace(cov), np.array(z / len(x), float) @ axes / np.sqrt(values)


def test_query_against_whole_number_arithmetic(spark):
    table = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    rows = [(i, v) for i, v in table if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, deviation, values, trace, whitened = plain([v for _, v in rows])
    got = {(r["vec_id"], r["component"]): r for r in QUERIES["op13_whitening"](spark, SMALL).collect()}
    assert len(got) == 8 * n
    for k in range(8):
        mine = np.array([got[i, k + 1]["whitened"] for i, _ in rows])
        assert min(abs(mine - whitened[:, k]).max(), abs(mine + whitened[:, k]).max()) < 1e-9
        assert abs(got[rows[0][0], k + 1]["explained"] / (values[k] / trace) - 1) < 1e-10
    assert [got[i, 1]["deviation"] for i, _ in rows] == deviation
    assert {r["n"] for r in got.values()} == {n} and max(r["identity_error"] for r in got.values()) < 1e-9


def test_bit_sliced_products_are_exact(spark):
    rng = np.random.default_rng(4)
    vecs = (rng.normal(size=(700, 5)) * [1, 1e-6, 1e3, 1e9, 0]).tolist() + [[1.0, 2.0], [], [0.5] * 7]
    rows = spark.createDataFrame(list(enumerate(vecs)), SCHEMA).repartition(3)
    n, deviation, values, trace, _ = plain(vecs, 3)
    model = W.fit(W.finite_vectors(rows, 1024), 1024, 100_000, 3)
    assert model.n == n == 703 and len(model.sums) == 7
    assert np.allclose(model.values, values, rtol=1e-12) and np.allclose(model.explained, values / trace, rtol=1e-12)
    got = {r["vec_id"]: r["deviation"] for r in W.whiten(rows, components=1).collect()}
    assert got == {i: d if d < 1 << 63 else None for i, d in enumerate(deviation)}
    assert None in got.values()


def test_bit_planes_spell_the_values():
    x = np.random.default_rng(1).integers(0, 1000, (130, 3))
    bits = np.array([10, 10, 10])
    planes = np.unpackbits(W.bit_planes(x, bits).view(np.uint8), axis=1, bitorder="little")[:, :130]
    for d in range(3):
        assert (sum(planes[10 * d + b].astype(int) << b for b in range(10)) == x[:, d]).all()


def test_defined_cases(spark):
    bad = [(9, None), (10, [1.0, None]), (11, [float("nan"), 1.0]), (12, [float("inf"), 0.0]), (13, [1e300, 0.0])]
    good = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 2.0]), (2, [2.0])]
    table = spark.createDataFrame([(*r, "x") for r in bad + good], SCHEMA + ", whitened string")
    got = W.whiten(table, components=5).collect()
    assert len(got) == 2 * len(good) and sorted({r["vec_id"] or 0 for r in got}) == [0, 1, 2]
    n, deviation, _, _, _ = plain([v for _, v in good], 2)
    assert sorted(r["deviation"] for r in got if r["component"] == 1) == sorted(deviation)
    flat = W.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).collect()
    assert len(flat) == 4 and all(r["whitened"] is None and r["identity_error"] is None and r["deviation"] == 0 for r in flat)
    line = W.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0])], SCHEMA)).collect()
    assert sorted(abs(r["whitened"]) for r in line if r["component"] == 1) == pytest.approx([1, 1])
    assert all(r["whitened"] is None for r in line if r["component"] == 2)
    assert W.whiten(table.limit(0)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, [])], SCHEMA)).count() == 0
