"""Tables kept by merging: replays, folding, bounded reads, and the answers built on them."""

import random

from pyspark.sql import functions as F

from ember.merge_table import MergeTable
from ember.operators import maintained as M
from ember.operators import ratings as R
from ember.session import shared_dir
from ember.storage import folders
from ember.streaming.frames import LatestFrames


def sums(spark, **options):
    return MergeTable(spark, shared_dir(spark, "merge"), "k string, v long",
                      lambda rows: rows.groupBy("k").agg(F.sum("v").alias("v")), **options)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v long")


def test_inputs_count_once_and_reads_stay_small(spark):
    t = sums(spark, least_rows=4)
    want = {}
    for i in range(9):
        rows = [("a", i), ("b", 1), (None, 2), (f"c{i % 2}", 5)]
        for k, v in rows:
            want[k] = want.get(k, 0) + v
        assert t.add(f"in-{i}", frame(spark, rows))
        assert not t.add(f"in-{i}", frame(spark, rows)) and not t.add("in-0", frame(spark, rows))
        assert t._parts().count() <= len(want) + max(4, 0.5 * len(want))
    assert {r["k"]: r["v"] for r in t.read().collect()} == want
    assert t.vacuum() > 0 and t.vacuum() == 0
    assert {r["k"]: r["v"] for r in t.read().collect()} == want
    again = MergeTable(spark, t.root, t.schema, t.merge)
    assert again.knows("in-0") and not again.knows("in-9")
    assert again.read().count() == len(want)


def test_a_lost_input_leaves_the_table_as_it_was(spark):
    t = sums(spark)
    t.add("one", frame(spark, [("a", 1)]))
    boom = F.udf(lambda v: 1 // 0, "long")
    try:
        t.add("two", frame(spark, [("a", 1)]).withColumn("v", boom("v")))
    except Exception as e:
        assert "ZeroDivision" in str(e)
    assert t.read().collect()[0]["v"] == 1 and not t.knows("two")
    assert t.add("two", frame(spark, [("a", 4)])) and t.read().collect()[0]["v"] == 5
    t.vacuum()
    assert len(folders(f"{t.root}/delta")) == 2


def test_empty_table_and_empty_inputs(spark):
    t = sums(spark)
    assert t.read().count() == 0
    t.add("none", frame(spark, []))
    t.fold()
    assert t.read().count() == 0 and t.knows("none")


def test_maintained_means_equal_the_full_answers(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, *range(9)]), rng.choice([None, *range(6)]), rng.choice([None, 1.0, 2.5, 4.0])) for _ in range(400)]
    ratings = spark.createDataFrame(rows, "user_id long, movie_id long, rating double")
    movies = spark.createDataFrame([(i, f"g{i % 2} h{i}") for i in range(6)], "movie_id long, title string")
    users = spark.createDataFrame([(i, i % 3) for i in range(9)], "user_id long, occ_id long")
    jobs = spark.createDataFrame([(i, f"job{i}") for i in range(3)], "occ_id long, occupation string")
    kept = M.MaintainedRatings(spark, shared_dir(spark, "kept"))
    for i in range(3):
        part = spark.createDataFrame(rows[i::3], ratings.schema)
        assert kept.add(f"file-{i}", part) and not kept.add(f"file-{i}", part)
    got = [kept.movie_stats(movies), kept.genre_stats(movies), kept.occupation_stats(users, jobs)]
    want = [R.movie_stats(ratings, movies), R.genre_stats(ratings, movies), R.occupation_stats(ratings, users, jobs)]
    for g, w in zip(got, want):
        assert g.columns == w.columns
        assert sorted(map(repr, g.collect())) == sorted(map(repr, w.collect()))


def test_distinct_ids_count_nulls_and_odd_ids(spark):
    kept = M.DistinctIds(spark, shared_dir(spark, "ids"))
    ids = [None, None, 0, 1, 1, 32767, 32768, 32769, -1, -40000, 2**40, 2**40]
    rows = spark.createDataFrame([(i, 5) for i in ids], "a long, b long")
    kept.add("one", rows, {"a": "a", "b": "b"})
    kept.add("two", spark.createDataFrame([(7, None), (1, 5)], "a long, b long"), {"a": "a", "b": "b"})
    kept.add("two", rows, {"a": "a"})
    assert {r["entity"]: r["n"] for r in kept.counts().collect()} == {"a": len({*ids, 7}), "b": 2}
    assert kept.one_row({"x": "a", "y": "none"}).first().asDict() == {"x": 10, "y": 0}


def test_counters_of_batches(spark):
    c = M.RunningCounters(spark, shared_dir(spark, "counters"), (1, 2.5))
    rows = [("cam", 1000, 0.5), ("cam", 3000, 2.0), ("dog", 500, 9.0)]
    batch = spark.createDataFrame(rows, "camera_id string, timestamp_ms long, value double")
    for i in (0, 0, 1):
        c.add_batch(batch, i, stage="camera_id", value="value")
    assert {r["camera_id"]: (r["frames"], r["fps"]) for r in c.throughput().collect()} == {"cam": (4, 2.0), "dog": (2, None)}
    assert {tuple(r) for r in c.histogram.read().collect()} == {("cam", 2, 4, 4), ("dog", 0, 0, 2)}
    assert [tuple(r) for r in c.silent(4000, 2000).collect()] == [("dog", 500, 3500)]


def test_latest_frames_take_the_last_write(spark):
    latest = LatestFrames(spark, shared_dir(spark, "latest"), least_rows=2)

    def frames(*rows):
        return spark.createDataFrame([(c, f"{c}_{n}.png", n, t, "ok", 1, 1, 4, bytes([v] * 4)) for c, n, t, v in rows],
                                     "camera_id string, filename string, frame_number int, timestamp_ms long, status string, "
                                     "height int, width int, nChannels int, data binary")

    latest.store(frames(("a", 1, 10, 1), ("a", 1, 12, 2), ("a", 2, 10, 3)), 0)
    latest.store(frames(("a", 1, 11, 4), ("b", 1, 5, 5)), 1)
    latest.store(frames(("a", 2, 10, 6)), 2)
    latest.store(frames(("a", 1, 99, 7)), 1)                   # batch 1 again: passed over
    assert {r["filename"]: r["data"][0] for r in latest.read().collect()} == {"a_1.png": 2, "a_2.png": 6, "b_1.png": 5}
    assert latest.table._parts().count() <= 3 + 2
