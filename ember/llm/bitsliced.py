"""Operator 2: exact top-k inner products with a bit-sliced index.

Index.  Rows are dealt into blocks of about ``block_rows``.  In a block every
attribute (quantised component, shifted to start at 0) is a set of slices:
bitmaps over the block's rows, one for each binary digit.

Search.  A query's score over all rows of a block is a sum of slices: digit s
of the weight times digit b of the attribute adds a slice at weight s + b; a
negative weight adds the complement.  Bitmaps of one weight are summed three
at a time by carry-save adders (sum = a^b^c, carry = majority), which leaves
one slice for every digit of the score.  The top rows are then selected from
the most significant slice downward: rows that surely belong, and rows still
tied; when the last slice is reached the ties are resolved exactly by id.
No row's score is formed on its own except for the k selected.

Queries meet blocks in a grid of (row block, query block) cells: the packed
index and query blocks are joined on the cell, so work spreads over cells and
memory is one block and one query at a time.  A query block holds up to
``query_bytes``: the index is copied once for each block of queries, not more
often than memory asks for, and only a small table's queries are dealt finer,
to give every core a cell.  Each cell returns at most k rows
a query, and a window ranks them.

Defined cases: vectors that are null or hold null or non-finite components,
and rows with null ids, take no part; shorter vectors count as padded with 0;
rows sharing a query's id are its own; repeated query rows are answered once
for each different vector; an empty table gives no rows.  Scores are 64-bit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ember.llm import vectors as V
from ember.session import ship_package

SCALE = 64


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and floor(scale * x) of every component."""
    return V.usable(vectors).select("vec_id", F.transform("vec", lambda x: F.floor(x * scale).cast("long")).alias("q"))


def _matrix(table: pa.Table) -> np.ndarray:
    lists = table.column("q").combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    out = np.zeros((table.num_rows, int(size.max(initial=0))), np.int64)
    flat = lists.flatten().to_numpy()
    at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(np.arange(len(size)), size), at] = flat
    return out


def _slice_block(table: pa.Table) -> pa.Table:
    """Pack a block: ids in order, each attribute's least value and its slices."""
    table = table.sort_by("vec_id")
    x = _matrix(table)
    n, dims = x.shape
    low = x.min(axis=0)
    x = x - low
    widths = [int(v).bit_length() for v in x.max(axis=0)]
    words = -(-n // 64)
    slices = np.zeros((sum(widths), words * 64), bool)
    at = 0
    for d in range(dims):
        for b in range(widths[d]):
            slices[at, :n] = (x[:, d] >> b) & 1
            at += 1
    packed = np.packbits(slices, axis=1, bitorder="little")
    return pa.table({"block": table.column("block").slice(0, 1), "n": pa.array([n], pa.int64()),
                     "ids": pa.array([table.column("vec_id").to_numpy().tobytes()], pa.binary()),
                     "low": pa.array([low.tobytes()], pa.binary()),
                     "widths": pa.array([np.array(widths, np.int64).tobytes()], pa.binary()),
                     "slices": pa.array([packed.tobytes()], pa.binary())})


def _pack_queries(table: pa.Table) -> pa.Table:
    x = _matrix(table)
    return pa.table({"q_block": table.column("q_block").slice(0, 1), "dims": pa.array([x.shape[1]], pa.int64()),
                     "q_ids": pa.array([table.column("vec_id").to_numpy().tobytes()], pa.binary()),
                     "weights": pa.array([x.tobytes()], pa.binary())})


def _add_slices(columns: dict[int, list[np.ndarray]], words: int) -> list[np.ndarray]:
    """Carry-save addition of bitmaps by weight; one bitmap for every digit of the sums."""
    out, weight = [], 0
    while columns:
        stack = columns.pop(weight, [])
        while True:
            stack = np.vstack(stack) if stack else np.zeros((0, words), np.uint64)
            if len(stack) <= 1:
                break
            up = columns.setdefault(weight + 1, [])
            if len(stack) == 2:
                up.append(stack[:1] & stack[1:])
                stack = [stack[:1] ^ stack[1:]]
                continue
            k = len(stack) // 3
            a, b, c = stack[:k], stack[k:2 * k], stack[2 * k:3 * k]
            half = a ^ b
            up.append((a & b) | (half & c))
            stack = [half ^ c, stack[3 * k:]]
        out.append(stack[0] if len(stack) else np.zeros(words, np.uint64))
        weight += 1
    return out


def _score_slices(slices: np.ndarray, start: np.ndarray, widths: np.ndarray, weights: np.ndarray, every: np.ndarray):
    """Slices of the weighted sum of all attributes, and the constant to add to the digits' value."""
    columns: dict[int, list[np.ndarray]] = {}
    constant = 0
    flipped = slices ^ every
    for d in np.flatnonzero((weights != 0) & (widths > 0)).tolist():
        w, width = int(weights[d]), int(widths[d])
        rows = slices[start[d]:start[d] + width]
        if w < 0:
            # -w * x = w' * (2^width - 1 - x) - w' * (2^width - 1) with w' = -w.
            constant -= -w * ((1 << width) - 1)
            rows, w = flipped[start[d]:start[d] + width], -w
        s = 0
        while w:
            if w & 1:
                for b in range(width):
                    columns.setdefault(s + b, []).append(rows[b:b + 1])
            w >>= 1
            s += 1
    return _add_slices(columns, slices.shape[1]), constant


def _rows_of(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def top_rows(score: list[np.ndarray], allowed: np.ndarray, k: int) -> np.ndarray:
    """The k rows with the largest sliced score among ``allowed``; the first rows among ties."""
    sure, tied = np.zeros_like(allowed), allowed.copy()
    for digit in reversed(score):
        more = sure | (tied & digit)
        n = int(np.bitwise_count(more).sum())
        if n > k:
            tied = tied & digit
        else:
            sure, tied = more, tied & ~digit
            if n == k:
                return _rows_of(sure)
    first = _rows_of(tied)[:k - int(np.bitwise_count(sure).sum())]
    return np.concatenate([_rows_of(sure), first])


def _search(k: int):
    def run(batches):
        for batch in batches:
            for cell in batch.to_pylist():
                n = cell["n"]
                words = -(-n // 64)
                ids = np.frombuffer(cell["ids"], np.int64)
                low, widths = np.frombuffer(cell["low"], np.int64), np.frombuffer(cell["widths"], np.int64)
                start = np.cumsum(widths) - widths
                slices = np.frombuffer(cell["slices"], np.uint64).reshape(-1, words)
                every = np.frombuffer(np.packbits(np.arange(words * 64) < n, bitorder="little").tobytes(), np.uint64)
                q_ids = np.frombuffer(cell["q_ids"], np.int64)
                weights = np.frombuffer(cell["weights"], np.int64).reshape(len(q_ids), cell["dims"])
                dims = max(len(low), cell["dims"])
                low, widths, start = (np.pad(x, (0, dims - len(x))) for x in (low, widths, start))
                weights = np.pad(weights, ((0, 0), (0, dims - cell["dims"])))
                found = [], [], [], []
                for row in range(len(q_ids)):
                    digits, constant = _score_slices(slices, start, widths, weights[row], every)
                    own = np.zeros(words * 64, bool)
                    own[np.searchsorted(ids, q_ids[row]):np.searchsorted(ids, q_ids[row], side="right")] = True
                    allowed = every & ~np.packbits(own, bitorder="little").view(np.uint64)
                    rows = top_rows(digits, allowed, k)
                    score = np.zeros(len(rows), np.int64)
                    for s, digit in enumerate(digits):
                        score += ((digit[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << s
                    found[0].append(np.full(len(rows), q_ids[row]))
                    found[1].append(np.full(len(rows), cell["q_block"] << 32 | row))
                    found[2].append(ids[rows])
                    found[3].append(score + constant + int((weights[row] * low).sum()))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(f).astype(np.int64)) for f in found],
                                                 names=["query_id", "query_row", "vec_id", "score"])

    return run


def bit_sliced_index(rows: DataFrame, block_rows: int) -> DataFrame:
    """One packed row for each block of ``rows(vec_id, q)``."""
    blocks = max(1, -(-rows.count() // block_rows))
    return rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "q"), F.lit(blocks))).groupBy("block").applyInArrow(
        _slice_block, "block long, n long, ids binary, low binary, widths binary, slices binary")


def top_k_products(vectors: DataFrame, *, k: int = 20, block_rows: int = 1 << 16, query_bytes: int = 1 << 23) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of every query row (id divisible by 20)."""
    ship_package(vectors.sparkSession)
    rows = quantised(vectors)
    index = V.kept(bit_sliced_index(rows, block_rows), "bit-sliced-index")
    queries = rows.filter(V.is_query()).dropDuplicates(["vec_id", "q"])
    blocks, dims = index.agg(F.max("block"), F.max(F.octet_length("low"))).first()
    blocks, n = (blocks or 0) + 1, queries.count()
    cells = 2 * vectors.sparkSession.sparkContext.defaultParallelism
    q_blocks = max(1, -(-n * (dims or 0) // query_bytes), min(-(-cells // blocks), n))
    packed = V.kept(queries.withColumn("q_block", F.pmod(F.xxhash64("vec_id", "q", F.lit(1)), F.lit(q_blocks)))
                    .groupBy("q_block").applyInArrow(_pack_queries, "q_block long, dims long, q_ids binary, weights binary"),
                    "query-blocks")
    # Every packed block meets every query block: the stated queries against all rows, in blocks.
    left = index.withColumn("q_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long"))))
    right = packed.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    cells = left.hint("shuffle_hash").join(right, ["block", "q_block"])
    found = cells.mapInArrow(_search(k), "query_id long, query_row long, vec_id long, score long")
    return V.best_of(found, k)
