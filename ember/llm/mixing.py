"""Operator 4: mixing sources to target weights by subset-sum budget fitting.

Size is the number of words.  Sources in code-point order (null last) get
the weights in turn; together they share ``share`` times all words, no source
more than ``cap`` times its own, the excess going to the others by weight.

A source's target is whole passes over its documents plus a rest.  The rest
is fitted exactly where possible: documents are counted by length, every
length first gives its proportional count, the remaining budget is reduced
with longest-first steps and closed by a bounded-knapsack dynamic programme
over lengths (a bitset of reachable sums).  The plan says how many documents
of each (source, length) are taken once more; a seeded hash order of the ids
says which, so reruns agree.

Memory follows the number of distinct lengths, never the number of rows.
Ranking inside one (source, length) is done in slices of ``slice_rows`` rows
with prefix counts, so a length shared by a third of all rows is no hot task.

Defined cases: null text has size 0; a source without words has target 0;
null ids take part and rank as their hash; identical rows are
interchangeable; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ember.llm.staging import staged
from ember.llm.textkit import WORD_PATTERN
from ember.session import ship_package

DP_BUDGET = 1 << 14


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """source, source_size, target from ``sizes(source, size, n)``; one row a source.

    Sources sorted by cap over weight: the capped ones are a prefix, and the
    others share what is left by weight.
    """
    s = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source")))
    s = s.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                                       ((rank - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = (Window.orderBy(F.col("limit") / F.col("w"), F.col("source").isNull(), F.col("source"))
              .rowsBetween(Window.unboundedPreceding, -1))
    s = (s.withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
         .withColumn("all_w", F.sum("w").over(everything))
         .withColumn("level", (F.col("budget") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
                     / (F.col("all_w") - F.coalesce(F.sum("w").over(before), F.lit(0.0)))))
    capped = F.col("limit") <= F.col("level") * F.col("w")
    s = s.withColumn("capped", capped)
    free_w = F.sum(F.when(~F.col("capped"), F.col("w"))).over(everything)
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("limit"))).over(everything), F.lit(0.0))
    return s.withColumn("target", F.when(F.col("capped"), F.col("limit")).otherwise(left * F.col("w") / free_w)) \
        .select("source", "source_size", "target")


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: float) -> np.ndarray:
    """How many documents of each length to take so that their words come nearest to ``budget``.

    ``lengths`` are distinct and positive; at most ``counts`` of each are taken.
    """
    total = int((lengths * counts).sum())
    take = np.zeros(len(lengths), np.int64)
    if total == 0 or budget <= 0:
        return take
    if budget >= total:
        return counts.astype(np.int64)
    take = np.floor(counts * (budget / total)).astype(np.int64)
    left = int(round(budget)) - int((take * lengths).sum())
    order = np.argsort(-lengths, kind="stable")
    for i in order:
        if left <= DP_BUDGET:
            break
        more = min(int(counts[i] - take[i]), left // int(lengths[i]), 1)
        take[i] += more
        left -= more * int(lengths[i])
    left -= _knapsack(lengths, counts, take, min(left, DP_BUDGET))
    # A last document may overshoot by less than what is missing.
    free = np.flatnonzero(take < counts)
    if left > 0 and len(free):
        i = free[np.argmin(np.abs(lengths[free] - left))]
        if lengths[i] < 2 * left:
            take[i] += 1
    return take


def _knapsack(lengths: np.ndarray, counts: np.ndarray, take: np.ndarray, budget: int) -> int:
    """Add to ``take`` the bounded choice with the largest sum not over ``budget``; return that sum."""
    if budget <= 0:
        return 0
    mask = (1 << (budget + 1)) - 1
    reach, steps = 1, []
    for i in range(len(lengths)):
        size = int(lengths[i])
        room = min(int(counts[i] - take[i]), budget // size) if size <= budget else 0
        part = 1
        while room > 0:                      # powers of two make any count up to room
            n = min(part, room)
            steps.append((i, n, reach))
            reach |= (reach << (size * n)) & mask
            room -= n
            part *= 2
        if reach >> budget & 1:
            break
    best = at = reach.bit_length() - 1
    for i, n, before in reversed(steps):
        if not before >> at & 1:
            at -= int(lengths[i]) * n
            take[i] += n
    return best


def _fit_source(cap: int):
    def run(table: pa.Table) -> pa.Table:
        size = table.column("size").to_numpy()
        n = table.column("n").to_numpy()
        target, words = table.column("target")[0].as_py(), table.column("source_size")[0].as_py()
        passes = min(int(target // words), cap) if words else 0
        extra = np.zeros(len(size), np.int64)
        some = size > 0
        if passes < cap:
            extra[some] = fit_budget(size[some], n[some], target - passes * words)
        return table.select(["source", "size", "n", "source_size", "target"]) \
            .append_column("passes", pa.array([passes] * len(size), pa.int32())) \
            .append_column("extra", pa.array(extra, pa.int64()))

    return run


def mix_sources(docs: DataFrame, *, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5,
                cap: int = 2, seed: int = 11, slice_rows: int = 256) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for every row of ``docs(doc_id, text, source)``."""
    ship_package(docs.sparkSession)
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    sized = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                               F.col("source").cast("string").alias("source"), size.alias("size")), "mix-sizes")
    hist = sized.groupBy("source", "size").agg(F.count("*").alias("n"))
    targets = source_targets(hist, weights, share, cap)
    known = hist.alias("h").join(targets.alias("t"), F.expr("h.source <=> t.source")).select(
        "h.source", "h.size", "h.n", "t.source_size", "t.target")
    plan = staged(known.groupBy("source").applyInArrow(
        _fit_source(cap), "source string, size long, n long, source_size long, target double, passes int, extra long"),
        "mix-plan")

    pick = F.xxhash64(F.lit(seed), "doc_id")
    rows = (sized.alias("d").join(plan.alias("p"), F.expr("d.source <=> p.source AND d.size = p.size"))
            .select("d.doc_id", "d.source", "d.size", "p.source_size", "p.target", "p.passes", "p.extra",
                    pick.alias("pick"), F.ceil(F.col("p.n") / slice_rows).alias("slices"))
            .withColumn("slice", F.pmod(F.shiftright("pick", 8), F.col("slices"))))
    # How many of each slice are taken: what the slices before it leave of ``extra``.
    earlier = Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    quota = (rows.filter("slices > 1").groupBy("source", "size", "slice").agg(F.count("*").alias("m"))
             .withColumn("before", F.coalesce(F.sum("m").over(earlier), F.lit(0)))
             .select("source", "size", "slice", "before"))
    rank = F.row_number().over(Window.partitionBy("source", "size", "slice").orderBy("pick", "doc_id"))
    ranked = rows.withColumn("rank", rank)
    placed = ranked.alias("r").join(
        quota.alias("q"), F.expr("r.source <=> q.source AND r.size = q.size AND r.slice = q.slice"), "left")
    chosen = F.col("rank") + F.coalesce(F.col("before"), F.lit(0)) <= F.col("extra")
    return placed.select(
        "r.doc_id", "r.source", "r.size", "r.source_size", "r.target",
        (F.col("r.passes") + F.when(chosen, 1).otherwise(0)).cast("int").alias("copies")) \
        .withColumn("taken", F.col("size") * F.col("copies"))
