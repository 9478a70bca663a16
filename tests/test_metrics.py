"""Metric operators (A19-A21, W11) on hand-made rows."""

import datetime as dt

from ember.operators import metrics as M


def test_throughput_single_frame_is_null_not_error(spark):  # A19
    rows = [("a", dt.datetime(2024, 1, 1, 0, 0, 0)), ("a", dt.datetime(2024, 1, 1, 0, 0, 2)),
            ("b", dt.datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "cam string, ts timestamp_ntz")
    got = {r["camera_id"]: (r["frames"], r["fps"]) for r in M.throughput_by(df, "cam", "ts").collect()}
    assert got == {"a": (2, 1.0), "b": (1, None)}


def test_latency_summary_and_total(spark):  # A20
    rows = [(1, "decode", 1.005), (1, "remove", 2.0), (2, "decode", 3.0), (2, "remove", 4.5)]
    df = spark.createDataFrame(rows, "frame long, stage string, ms double")
    s = {r["stage"]: (r["min_ms"], r["max_ms"], r["avg_ms"]) for r in M.latency_summary(df, "stage", "ms").collect()}
    assert s["remove"] == (2.0, 4.5, 3.25)
    assert M.total_latency(df, "frame", "ms").first()["avg_total_ms"] == round((3.005 + 7.5) / 2, 4)


def test_histogram_bounds_and_names(spark):  # W11
    df = spark.createDataFrame([("s", v) for v in (0.5, 1.0, 2.5, 7.0, 100.0)], "stage string, ms double")
    r = M.latency_histogram(df, "stage", "ms", (1, 2.5, 10)).first()
    assert (r["le_1"], r["le_2_5"], r["le_10"], r["le_inf"]) == (2, 3, 4, 5)


def test_message_volume_rates(spark):  # A21
    df = spark.createDataFrame([("x" * 1048576,), ("é" * 524288,)], "payload string")
    r = M.message_volume(df, "payload", seconds=2.0).first()
    assert (r["total_messages"], r["total_mb"], r["mb_per_sec"], r["msgs_per_sec"]) == (2, 2.0, 1.0, 1.0)


def test_batch_counts_only_ok_rows(spark):  # A18
    df = spark.createDataFrame([(0, "ok"), (0, "undecodable"), (1, "ok"), (1, "ok")], "batch_id long, status string")
    assert {r[0]: r[1] for r in M.batch_counts(df).collect()} == {0: 1, 1: 2}
