"""Operator 9: shards of near-equal bytes by histogram sort.

Every document has a 63-bit key: 32 bits of its text's hash, then 31 bits of
its id's hash.  Documents in key order are cut at splitters so that every
shard gets the same bytes; equal texts are neighbours and stay in one shard
unless a cut inside their group is needed to keep the sizes equal.

Splitters come from rounds of exact counting: each open splitter has a key
bracket, probes divide it evenly, every partition counts the rows and bytes
between neighbouring probes, and the sums narrow the bracket.  A splitter is
done when a probe is within ``tolerance`` of its target (probes on text
boundaries come first because brackets shrink from the high bits down) or
when its bracket holds one row.  Only keys and sizes are staged and counted;
the documents move once, to their unit.  A round's driver work is linear in
the open splitters and their probes.

Shards are divided into *units* of about ``unit_rows`` rows by the same
splitters, so ranking rows inside a shard never needs a whole shard in one
task; exact row counts of the last histogram give each unit's first slot.

Defined cases: null text has no bytes (size 8); null ids hash like any value;
identical rows share a key and so a shard; an empty table gives no rows; an
input column named like a result column is replaced.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ember.llm.staging import staged
from ember.session import ship_package

OVERHEAD = 8
_TOP = (1 << 63) - 1
_MAX_PROBES = 1 << 16


def _measured(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.shiftleft(F.xxhash64(text).bitwiseAND(0xFFFFFFFF), 31).bitwiseOR(
        F.xxhash64(F.col("doc_id").cast("long"), F.lit(9)).bitwiseAND(0x7FFFFFFF))
    return docs.withColumns({"size": (F.octet_length(text) + OVERHEAD).cast("long"),
                             "text_crc32": F.crc32(text.cast("binary")), "_key": key})


def _histogram(keys: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact (rows, bytes) with a key below each probe."""
    n = len(probes) + 1

    def count(batches):
        rows, size = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for b in batches:
            at = np.searchsorted(probes, b.column("_key").to_numpy(), side="right")
            rows += np.bincount(at, minlength=n)
            np.add.at(size, at, b.column("size").to_numpy())
        hit = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(rows[hit]), pa.array(size[hit])],
                                         names=["at", "n_rows", "n_bytes"])

    sums = keys.mapInArrow(count, "at long, n_rows long, n_bytes long").groupBy("at").agg(
        F.sum("n_rows").alias("r"), F.sum("n_bytes").alias("b")).collect()   # one row a probe interval at most
    rows, size = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for at, r, b in sums:
        rows[at], size[at] = r, b
    return np.cumsum(rows)[:-1], np.cumsum(size)[:-1]


def find_splitters(keys: DataFrame, parts: int, tolerance: float) -> tuple[list[int], list[int]]:
    """Keys that cut ``keys(_key, size)`` into ``parts`` of equal bytes, and the rows below each cut."""
    n_rows, total = keys.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    if not n_rows:
        return [_TOP] * (parts - 1), [0] * (parts - 1)
    target = [total * i / parts for i in range(1, parts)]
    slack = tolerance * total / parts
    # Per splitter: bracket (low key, high key), rows and bytes below each end.
    low = [(0, 0, 0)] * (parts - 1)
    high = [(_TOP, n_rows, total)] * (parts - 1)
    done: dict[int, tuple[int, int]] = {}
    while len(done) < parts - 1:
        open_ = [i for i in range(parts - 1) if i not in done]
        each = max(3, min(63, _MAX_PROBES // len(open_)))
        probes = set()
        # Brackets shared by several splitters get their probes together.
        for (lo, hi), sharing in Counter((low[i][0], high[i][0]) for i in open_).items():
            share = each * sharing
            probes.update(lo + (hi - lo) * j // (share + 1) for j in range(1, share + 1))
        at = np.array(sorted(p for p in probes if 0 < p < _TOP), np.int64)
        rows, size = _histogram(keys, at) if len(at) else (np.zeros(0), np.zeros(0))
        nearest = np.searchsorted(size, [target[i] for i in open_]).tolist()
        for i, right in zip(open_, nearest):
            for j in (right - 1, right):
                if 0 <= j < len(at) and low[i][0] < at[j] < high[i][0]:
                    point = (int(at[j]), int(rows[j]), int(size[j]))
                    if point[2] <= target[i]:
                        low[i] = max(low[i], point)
                    else:
                        high[i] = min(high[i], point)
            best = min(low[i], high[i], key=lambda x: abs(x[2] - target[i]))
            if abs(best[2] - target[i]) <= slack or high[i][1] - low[i][1] <= 1 or high[i][0] - low[i][0] <= 1:
                done[i] = (best[0], best[1])
    return [done[i][0] for i in range(parts - 1)], [done[i][1] for i in range(parts - 1)]


def shard_by_bytes(docs: DataFrame, n_shards: int = 24, *, tolerance: float = 0.001,
                   unit_rows: int = 1 << 20) -> DataFrame:
    """``docs`` with size, text_crc32, shard (from 0) and slot (gapless from 0 in its shard)."""
    ship_package(docs.sparkSession)
    measured = _measured(docs)
    keys = staged(measured.select("_key", "size"), "shard-keys")
    units = max(1, -(-keys.count() // (n_shards * unit_rows)))
    cuts, below = find_splitters(keys, n_shards * units, tolerance)
    cut_keys, first = np.array(cuts, np.int64), np.array([0, *below], np.int64)

    @F.pandas_udf("unit int, base long")
    def placed(key: pd.Series) -> pd.DataFrame:
        unit = np.searchsorted(cut_keys, key.to_numpy(), side="right")
        # First slot of the unit inside its shard.
        base = first[unit] - first[unit // units * units]
        return pd.DataFrame({"unit": unit.astype(np.int32), "base": base})

    order = Window.partitionBy("_at.unit").orderBy("_key", "doc_id")
    return (measured.withColumn("_at", placed("_key"))
            .withColumn("slot", (F.col("_at.base") + F.row_number().over(order) - 1).cast("long"))
            .withColumn("shard", F.expr(f"cast(_at.unit div {units} as int)"))
            .drop("_key", "_at"))
