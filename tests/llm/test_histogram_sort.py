import time
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from ember.llm import histogram_sort as H
from ember.llm.catalog import QUERIES
from ember.llm.histogram_sort import shard_by_bytes
from tests.conftest import MEDIUM


def by_shard(rows):
    out = defaultdict(list)
    for r in rows:
        out[r["shard"]].append(r)
    for members in out.values():
        assert sorted(r["slot"] for r in members) == list(range(len(members)))
    return out


def test_whole_table(spark):
    rows = QUERIES["op9_histogram_sort"](spark, MEDIUM).collect()
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()}
    assert {r["doc_id"] for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
        assert r["law"] == "bytes" and r["grown_shard"] is None
    shards = by_shard(rows)
    assert set(shards) == set(range(24))
    total, largest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    for members in shards.values():
        assert abs(sum(r["size"] for r in members) - total / 24) <= largest


def test_hot_group_of_copies_is_cut_only_where_needed(spark):
    rows = [(i, "hot text " * 20) for i in range(3000)] + [(10_000 + i, f"cold text {i} " * 12) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    shards = by_shard(shard_by_bytes(df, 8, unit_rows=300).collect())
    sizes = [sum(r["size"] for r in m) for m in shards.values()]
    assert max(sizes) - min(sizes) <= 0.01 * max(sizes) + 200
    assert sum(any(r["text"].startswith("hot") for r in m) for m in shards.values()) <= 4


def test_small_copies_stay_together(spark):
    rows = [(10 * g + k, f"text of group {g} " * 15) for g in range(2000) for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen = defaultdict(set)
    for r in shard_by_bytes(df, 4, tolerance=0.01).collect():
        seen[r["text"]].add(r["shard"])
    assert all(len(s) == 1 for s in seen.values())


def test_edges(spark):
    rows = [(1, None), (None, "x"), (2, ""), (2, ""), (None, None), (3, "y" * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"slot": F.lit("clash"), "size": F.lit("clash")})
    out = shard_by_bytes(df, 3).collect()
    assert len(out) == 6 and sorted(r["size"] for r in out) == [8, 8, 8, 8, 9, 50_008]
    by_shard(out)
    assert shard_by_bytes(spark.createDataFrame([], "doc_id long, text string"), 3).collect() == []
    assert [r["slot"] for r in shard_by_bytes(df.limit(1), 24).collect()] == [0]


def test_many_splitters_take_seconds_on_the_driver(monkeypatch):
    """Counting is stood in for by arrays, so only the rounds' own work is timed."""
    rnd = np.random.default_rng(9)
    keys = np.sort(rnd.integers(1, H._TOP, 1_000_000))
    keys[300_000:600_000] = keys[300_000]                     # a third of all rows share a key
    below = np.r_[0, np.cumsum(rnd.integers(8, 4000, len(keys)))]

    class Keys:
        def agg(self, *_):
            return self

        def first(self):
            return len(keys), int(below[-1])

    def histogram(_, probes):
        at = np.searchsorted(keys, probes, side="left")
        return at, below[at]

    monkeypatch.setattr(H, "_histogram", histogram)
    began = time.process_time()
    cuts, rows = H.find_splitters(Keys(), 50_000, 0.2)
    assert time.process_time() - began < 60
    assert len(cuts) == 49_999 and cuts == sorted(cuts) and rows == sorted(rows)
    want = below[-1] * np.arange(1, 50_000) / 50_000
    off = np.abs(below[np.array(rows)] - want)
    assert (off[(np.array(rows) < 299_900) | (np.array(rows) > 600_100)] <= 4000 + 0.2 * below[-1] / 50_000).all()
