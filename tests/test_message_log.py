"""The message log and its stream reader: offsets, row cap, start position, restart."""

from collections import Counter

import pytest

from ember.session import shared_dir
from ember.sources import message_log as L
from ember.sources.testdata import table
from ember.streaming import drain, run_stream
from tests.conftest import SMALL


def messages(spark, lo, hi):
    return spark.range(lo, hi, 1, 3).selectExpr(
        "cast(id as string) AS key", "if(id % 7 = 0, null, concat('v', id)) AS value", "cast(if(id % 3 = 0, 0, id % 4) as int) AS partition")


class Reader:
    """A stream over a log that keeps what each batch held."""

    def __init__(self, spark, **options):
        self.spark, self.options = spark, options
        self.root, self.checkpoint = shared_dir(spark, "log"), shared_dir(spark, "log-checkpoint")
        self.batches, self.fail_at = {}, None

    def append(self, lo, hi):
        return L.append_messages(messages(self.spark, lo, hi), self.root)

    def run(self):
        def on_batch(df, i):
            if i == self.fail_at:
                raise ValueError("lost")
            self.batches[i] = [tuple(r) for r in df.collect()]

        drain(run_stream(L.message_log_source(self.spark, self.root, **self.options), on_batch, self.checkpoint, trigger="0 seconds"))
        return [len(v) for _, v in sorted(self.batches.items()) if v]

    def rows(self):
        return [r for _, v in sorted(self.batches.items()) for r in v]


def test_offsets_and_row_cap_over_restarts(spark):
    r = Reader(spark, starting_offsets="earliest", max_rows_per_trigger=30, rows_per_task=7)
    ends = r.append(0, 100)
    assert sum(ends.values()) == 100 and r.run() == [30, 30, 30, 10]
    r.append(100, 150)
    r.append(150, 152)
    assert r.run() == [30, 30, 30, 10, 30, 22]
    assert r.run() == [30, 30, 30, 10, 30, 22]
    want = [tuple(x) for x in messages(spark, 0, 152).collect()]
    assert sorted(map(repr, want)) == sorted(repr(x[:3]) for x in r.rows())
    seen = Counter((p, o) for _, _, p, o in r.rows())
    assert max(seen.values()) == 1 and set(seen) == {(int(p), o) for p, n in L.end_offsets(r.root).items() for o in range(n)}


def test_a_failed_batch_is_read_again_and_nothing_else(spark):
    r = Reader(spark, starting_offsets="earliest", max_rows_per_trigger=40)
    r.append(0, 100)
    r.fail_at = 1
    with pytest.raises(Exception, match="lost"):
        r.run()
    r.fail_at = None
    r.append(100, 110)
    assert r.run() == [40, 40, 30]
    assert len({(p, o) for _, _, p, o in r.rows()}) == 110


def test_latest_skips_what_was_there_and_new_partitions_are_read_whole(spark):
    r = Reader(spark)
    r.append(0, 50)
    assert r.run() == []
    L.append_messages(messages(spark, 50, 60).selectExpr("key", "value", "partition + 10 AS partition"), r.root)
    r.append(60, 70)
    r.run()
    assert sorted(int(x[0]) for x in r.rows()) == list(range(50, 70))


def test_empty_appends_and_an_empty_log(spark):
    r = Reader(spark, starting_offsets="earliest")
    assert r.run() == []
    assert r.append(5, 5) == {}
    assert r.append(0, 3) != {} and r.append(3, 3) == L.end_offsets(r.root)
    assert r.run() == [3]


def test_admission_shares_the_cap():
    ends = {"0": 100, "1": 5, "2": 40}
    assert L.admitted({}, ends, None) == ends
    got = L.admitted({}, ends, 60)
    assert sum(got.values()) == 60 and got["1"] == 5 and abs(got["0"] - got["2"]) <= 1
    assert L.admitted({"0": 95, "1": 5, "2": 0}, ends, 60) == ends
    assert L.admitted({"0": 100, "1": 5}, ends, 10) == {"0": 100, "1": 5, "2": 10}
    assert sum(L.admitted({}, ends, 2).values()) == 2


def test_a_hot_partition_is_many_tasks(spark):
    events = table(spark, SMALL, "events")
    root = shared_dir(spark, "log")
    ends = L.append_messages(events.selectExpr("event_type AS key", "props AS value", "0 AS partition"), root)
    reader = L.MessageLogReader({"path": root, "startingOffsets": "earliest", "rowsPerTask": "100"})
    parts = reader.partitions({}, reader.latestOffset())
    assert len(parts) == 10 and sum(p.rows for p in parts) == ends["0"] == 1000
    assert [sum(b.num_rows for b in reader.read(p)) for p in parts] == [100] * 10
    assert reader.partitions({"0": 950}, {"0": 1000})[0].offset == 950


def test_wrong_options_are_refused():
    for bad in ({"startingOffsets": "first"}, {"maxRowsPerTrigger": "-1"}):
        with pytest.raises(ValueError):
            L.MessageLogReader({"path": "/tmp/x", **bad})
