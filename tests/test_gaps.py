"""Missing frame numbers and camera order over range partitions."""

import random

import pytest

from ember.operators.packets import camera_positions
from ember.operators.quality import frame_gaps


def slow_gaps(rows, first, last):
    out = []
    for c in {c for c, f in rows if f is not None}:
        seen = sorted({f for x, f in rows if x == c and f is not None and (first is None or f >= first) and (last is None or f <= last)})
        if not seen:
            continue
        ends = ([first - 1] if first is not None else []) + seen + ([last + 1] if last is not None else [])
        out += [(c, a + 1, b - 1, b - a - 1) for a, b in zip(ends, ends[1:]) if b - a > 1]
    return sorted(out, key=repr)


@pytest.mark.parametrize("first,last", [(None, None), (0, None), (None, 99), (0, 99)])
def test_gaps_against_the_definition(spark, first, last):
    rng = random.Random(3)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", None]), rng.choice([None, *range(-5, 120)])) for _ in range(300)]
    rows += [("whole", f) for f in range(100)] + [("one", 7)] * 3 + [("far", 10**12), ("far", 5)]
    df = spark.createDataFrame(rows, "cam string, n long").repartition(7)
    got = frame_gaps(df, "cam", "n", first=first, last=last).collect()
    assert sorted(map(tuple, got), key=repr) == slow_gaps(rows, first, last)


def test_no_frames_no_gaps(spark):
    assert frame_gaps(spark.createDataFrame([], "camera_id string, frame_number long"), first=0, last=9).count() == 0


def test_a_hot_camera_is_cut_over_ranges(spark):
    df = spark.range(0, 40_000, 1, 4).selectExpr("'hot' AS camera_id", "id * 2 AS frame_number")
    got = frame_gaps(df)
    assert got.count() == 39_999 and got.agg({"length": "max"}).first()[0] == 1


def test_positions(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot"] * 5 + ["a", None]), rng.randrange(50), i) for i in range(400)]
    got = camera_positions(spark.createDataFrame(rows, "camera_id string, frame_number long, x long").repartition(5)).collect()
    assert sorted((r["x"] for r in got)) == list(range(400))
    for c in ("hot", "a", None):
        mine = sorted((r["position"], r["frame_number"]) for r in got if r["camera_id"] == c)
        assert [p for p, _ in mine] == list(range(len(mine)))
        assert [f for _, f in mine] == sorted(f for _, f in mine)
