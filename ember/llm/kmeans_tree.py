"""Operator 7: approximate nearest neighbours with a hierarchical k-means tree.

Fit.  The tree is fitted on a sample of about ``sample_rows`` vectors (a
documented bound): a node's vectors are split into ``BRANCH`` clusters until
``LEAF`` are left.  It is therefore bounded whatever the table.

Index.  Every vector goes down the tree to a leaf.  Each leaf's count, mean
and spread are then taken over all vectors indexed in it and added up to the
root.  Leaves are laid out in tree order in groups of about ``block_rows``
vectors, and a group with more is cut into blocks by the id's hash, so a hot
leaf is many blocks.

Search.  A query walks the tree best bin first: a priority queue holds the
nodes met so far by what a good row of theirs may score (the query's product
with the node's mean plus ``REACH`` times the spread in one direction), the
best is opened next after the query's own leaf, and leaves are collected until both the calibrated number
of visits and at least ``k + 1`` indexed vectors are reached.  Queries meet
the blocks of the groups they visit; in a block, only vectors of visited
leaves are scored, exactly and in double precision.

Calibrate.  ``CALIBRATION`` sampled vectors, kept from the fit, are asked of
the whole index by brute force (one pass that returns k rows for each); the
number of leaf visits is widened until the walk finds ``recall`` of those.

Defined cases: vectors that are null, zero, or hold null or non-finite
components, and rows with null ids, take no part; shorter vectors count as
padded with 0; other columns are ignored; rows sharing a query's id are its own; repeated query rows are
answered once for each different vector; an empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ember.llm import vectors as V
from ember.session import ship_package

BRANCH = 8
LEAF = 8
ROUNDS = 8
REACH = 3.0
CALIBRATION = 256


class Tree:
    """Centroids of a hierarchical k-means tree; leaves are numbered in tree order."""

    def __init__(self, points: np.ndarray, seed: int = 7):
        self.children: list[list[int]] = []
        self.centers: list[np.ndarray] = []
        self.leaf: list[int] = []
        self.leaves = 0
        self._grow(points, np.random.default_rng(seed))

    def _grow(self, points: np.ndarray, rng) -> int:
        node = len(self.children)
        self.children.append([])
        self.centers.append(np.zeros((0, points.shape[1])))
        self.leaf.append(-1)
        groups = _split(points, rng) if len(points) > LEAF else []
        if len(groups) < 2:
            self.leaf[node], self.leaves = self.leaves, self.leaves + 1
            return node
        self.centers[node] = np.stack([g.mean(axis=0) for g in groups])
        self.children[node] = [self._grow(g, rng) for g in groups]
        return node

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every vector: the nearest centroid at each level."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            c = self.centers[node]
            near = (x[rows] @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1)
            todo += [(child, rows[near == i]) for i, child in enumerate(self.children[node])]
        return out

    def describe(self, count: np.ndarray, total: np.ndarray, square: np.ndarray) -> None:
        """Take every leaf's count, vector sum and sum of squared norms; inner nodes get those of their leaves."""
        dims = total.shape[1]
        n, sums, squares = np.zeros(len(self.children)), np.zeros((len(self.children), dims)), np.zeros(len(self.children))
        for node in range(len(self.children) - 1, -1, -1):              # children follow their parent
            at = self.leaf[node]
            if at >= 0:
                n[node], sums[node], squares[node] = count[at], total[at], square[at]
            else:
                below = self.children[node]
                n[node], sums[node], squares[node] = n[below].sum(), sums[below].sum(axis=0), squares[below].sum()
        some = np.maximum(n, 1)
        self.means = sums / some[:, None]
        self.spread = np.sqrt(np.maximum(squares / some - (self.means ** 2).sum(axis=1), 0) / dims)
        self.filled = n > 0

    def promise(self, q: np.ndarray) -> np.ndarray:
        """One row a query, one column a node: what a good row of the node may score; empty nodes promise nothing."""
        size = np.sqrt((q * q).sum(axis=1))
        return np.where(self.filled, q @ self.means.T + REACH * size[:, None] * self.spread, -np.inf)

    def walk(self, promise: np.ndarray, home: int):
        """The query's own leaf ``home``, where its copies lie, then the others in best-bin-first order of its ``promise``."""
        yield home
        key = (-promise).tolist()
        heap = [(0.0, 0)]
        while heap:
            _, node = heapq.heappop(heap)
            if self.leaf[node] >= 0:
                if self.leaf[node] != home:
                    yield self.leaf[node]
                continue
            for child in self.children[node]:
                heapq.heappush(heap, (key[child], child))


def _split(points: np.ndarray, rng) -> list[np.ndarray]:
    centers = points[rng.choice(len(points), min(BRANCH, len(points)), replace=False)]
    for _ in range(ROUNDS):
        at = (points @ centers.T - 0.5 * (centers * centers).sum(axis=1)).argmax(axis=1)
        centers = np.stack([points[at == i].mean(axis=0) if (at == i).any() else centers[i] for i in range(len(centers))])
    at = (points @ centers.T - 0.5 * (centers * centers).sum(axis=1)).argmax(axis=1)
    return [points[at == i] for i in range(len(centers)) if (at == i).any()]


def calibrate(tree: Tree, asked: np.ndarray, who: np.ndarray, leaf: np.ndarray, recall: float) -> int:
    """Fewest leaf visits that meet ``recall`` of the rows (query ``who``, in ``leaf``) nearest to the queries ``asked``; 1 asks for all."""
    if recall >= 1:
        return tree.leaves
    promise, home = tree.promise(asked), tree.assign(asked)
    hits = np.zeros(tree.leaves + 1)
    for i in np.unique(who):
        place = np.empty(tree.leaves, np.int64)
        place[list(tree.walk(promise[i], home[i]))] = np.arange(tree.leaves)
        np.add.at(hits, place[leaf[who == i]] + 1, 1)
    return max(1, int(np.searchsorted(np.cumsum(hits), recall * len(who))))


def _vectors(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(len(column), -1)


def _assigned(shared):
    def run(batches):
        tree = shared.value[0]
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("vec"), pa.array(tree.assign(_vectors(batch.column("vec"))))],
                    names=["vec_id", "vec", "leaf"])

    return run


def _leaf_parts(leaves: int, dims: int):
    """Count, vector sum and sum of squared norms of a task's rows in every leaf."""

    def run(batches):
        n, total, square = np.zeros(leaves, np.int64), np.zeros((leaves, dims)), np.zeros(leaves)
        for batch in batches:
            if batch.num_rows:
                x, leaf = _vectors(batch.column("vec")), batch.column("leaf").to_numpy()
                order = np.argsort(leaf, kind="stable")
                which, first = np.unique(leaf[order], return_index=True)
                n[which] += np.diff(np.r_[first, len(leaf)])
                total[which] += np.add.reduceat(x[order], first, axis=0)
                square[which] += np.add.reduceat((x * x).sum(axis=1)[order], first)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(n[some]), pa.array(list(total[some]), pa.list_(pa.float64())), pa.array(square[some])],
            names=["leaf", "n", "total", "square"])

    return run


def _leaf_sum(table: pa.Table) -> pa.Table:
    return pa.table({"leaf": table.column("leaf").slice(0, 1), "n": pa.array([table.column("n").to_numpy().sum()], pa.int64()),
                     "total": pa.array([_vectors(table.column("total")).sum(axis=0)], pa.list_(pa.float64())),
                     "square": pa.array([table.column("square").to_numpy().sum()], pa.float64())})


def _true_nearest(ids: np.ndarray, asked: np.ndarray, k: int):
    """The k rows of a task with the largest products for each of the calibrating queries."""

    def run(batches):
        score, rows, leaves = (np.zeros((len(ids), 0), t) for t in (float, np.int64, np.int64))
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column("vec_id").to_numpy()
            new = np.where(own == ids[:, None], -np.inf, asked @ _vectors(batch.column("vec")).T)
            score = np.hstack([score, new])
            rows = np.hstack([rows, np.broadcast_to(own, new.shape)])
            leaves = np.hstack([leaves, np.broadcast_to(batch.column("leaf").to_numpy(), new.shape)])
            if score.shape[1] > k:
                best = np.argpartition(-score, k - 1, axis=1)[:, :k]
                score, rows, leaves = (np.take_along_axis(x, best, axis=1) for x in (score, rows, leaves))
        who, at = np.nonzero(score > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(rows[who, at]), pa.array(leaves[who, at]), pa.array(score[who, at])],
                                         names=["who", "vec_id", "leaf", "score"])

    return run


def _packed(table: pa.Table) -> pa.Table:
    table = table.sort_by([("leaf", "ascending"), ("vec_id", "ascending")])
    return pa.table({"block": table.column("block").slice(0, 1), "group": table.column("group").slice(0, 1),
                     "ids": pa.array([table.column("vec_id").to_numpy().tobytes()], pa.binary()),
                     "leaves": pa.array([table.column("leaf").to_numpy().tobytes()], pa.binary()),
                     "matrix": pa.array([_vectors(table.column("vec")).tobytes()], pa.binary())})


def _visits(shared, k: int):
    """For every query, the groups it visits and the leaves in them."""

    def run(batches):
        tree, visits, sizes, group_of = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                rows, groups, leaves = [], [], []
                x = _vectors(part.column("vec"))
                for i, (promise, home) in enumerate(zip(tree.promise(x), tree.assign(x).tolist())):
                    seen, rows_seen = [], 0
                    for leaf in tree.walk(promise, home):
                        if len(seen) >= visits and rows_seen > k:
                            break
                        seen.append(leaf)
                        rows_seen += int(sizes[leaf])
                    seen = np.sort(np.array(seen))
                    for g in np.unique(group_of[seen]):
                        rows.append(i)
                        groups.append(int(g))
                        leaves.append(seen[group_of[seen] == g].astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(pa.array(rows, pa.int64())), part.column("row").take(pa.array(rows, pa.int64())),
                     pa.array(groups, pa.int64()), pa.array(leaves, pa.binary()),
                     part.column("vec").take(pa.array(rows, pa.int64()))], names=["query_id", "query_row", "group", "visited", "vec"])

    return run


def _pack_visits(table: pa.Table) -> pa.Table:
    seen = table.column("visited").to_pylist()
    return pa.table({"group": table.column("group").slice(0, 1),
                     "q_ids": pa.array([table.column("query_id").to_numpy().tobytes()], pa.binary()),
                     "q_rows": pa.array([table.column("query_row").to_numpy().tobytes()], pa.binary()),
                     "q_matrix": pa.array([_vectors(table.column("vec")).tobytes()], pa.binary()),
                     "visited": pa.array([b"".join(seen)], pa.binary()),
                     "n_visited": pa.array([np.array([len(s) // 4 for s in seen], np.int64).tobytes()], pa.binary())})


def fixed_order_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products added up component by component: equal vectors get equal scores in any company."""
    total = np.zeros(len(x))
    for d in range(len(q)):
        total += q[d] * x[:, d]
    return total


def _score(k: int, dims: int):
    def run(batches):
        for batch in batches:
            for cell in batch.to_pylist():
                ids, leaves = np.frombuffer(cell["ids"], np.int64), np.frombuffer(cell["leaves"], np.int64)
                x = np.frombuffer(cell["matrix"], np.float64).reshape(-1, dims)
                q_ids, q_rows = np.frombuffer(cell["q_ids"], np.int64), np.frombuffer(cell["q_rows"], np.int64)
                q = np.frombuffer(cell["q_matrix"], np.float64).reshape(-1, dims)
                visited = np.frombuffer(cell["visited"], np.int32)
                who = np.repeat(np.arange(len(q)), np.frombuffer(cell["n_visited"], np.int64))
                order = np.argsort(visited, kind="stable")
                visited, who = visited[order], who[order]
                score = np.full((len(q), len(x)), -np.inf)
                for leaf in np.unique(leaves):
                    a, b = np.searchsorted(leaves, leaf), np.searchsorted(leaves, leaf, side="right")
                    asked = who[np.searchsorted(visited, leaf):np.searchsorted(visited, leaf, side="right")]
                    if len(asked):
                        score[asked, a:b] = q[asked] @ x[a:b].T
                # The last bits of a matrix product depend on its shape: what may be among the best is scored again.
                spare = 4 * dims * np.finfo(float).eps * np.sqrt((q * q).sum(axis=1) * (x * x).sum(axis=1).max(initial=0))
                found = [], [], [], []
                for i in range(len(q)):
                    s = np.where(ids == q_ids[i], -np.inf, score[i])
                    edge = np.partition(s, len(s) - k)[len(s) - k] - spare[i] if len(s) > k else -np.inf
                    at = np.flatnonzero((s >= edge) & (s > -np.inf))
                    s[at] = fixed_order_products(q[i], x[at])
                    at = at[np.lexsort((ids[at], -s[at]))][:k]
                    found[0].append(np.full(len(at), q_ids[i]))
                    found[1].append(np.full(len(at), q_rows[i]))
                    found[2].append(ids[at])
                    found[3].append(s[at])
                if found[0]:
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(np.concatenate(f)) for f in found)], names=["query_id", "query_row", "vec_id", "score"])

    return run


def padded(rows: DataFrame, dims: int) -> DataFrame:
    """Shorter vectors are read as if zeros followed."""
    return rows.withColumn("vec", F.when(F.size("vec") < dims, F.concat(
        "vec", F.array_repeat(F.lit(0.0), F.lit(dims) - F.size("vec")))).otherwise(F.col("vec")))


def nearest(vectors: DataFrame, *, k: int = 20, recall: float = 0.965, sample_rows: int = 1 << 14,
            block_rows: int = 1 << 13, query_rows: int = 512) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest vectors found for every query row (id divisible by 20)."""
    spark = vectors.sparkSession
    ship_package(spark)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = V.usable(vectors).filter(F.exists("vec", lambda x: x != 0))
    total = rows.count()
    if not total:
        return empty
    share = min(1 << 20, (sample_rows << 20) // total + 1)
    sample = rows.filter(F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(1 << 20)) < share)
    dims = rows.agg(F.max(F.size("vec"))).first()[0]
    sample, rows = padded(sample, dims), padded(rows, dims)
    picked = sample.orderBy("vec_id").select("vec_id", "vec").toArrow()     # about sample_rows
    points = _vectors(picked.column("vec")) if picked.num_rows else np.zeros((0, dims))
    # Different vectors spread over the sample calibrate; the others shape the tree.
    _, one = np.unique(points, axis=0, return_index=True)
    asked = np.sort(one)[np.linspace(0, len(one) - 1, min(CALIBRATION, len(one) // 2)).astype(int)] if len(one) else one
    tree = Tree(np.delete(points, asked, axis=0) if len(points) else points)

    index = V.kept(rows.mapInArrow(_assigned(spark.sparkContext.broadcast((tree,))), "vec_id long, vec array<double>, leaf long"),
                   "tree-index")
    parts = index.mapInArrow(_leaf_parts(tree.leaves, dims), "leaf long, n long, total array<double>, square double")
    known = parts.groupBy("leaf").applyInArrow(_leaf_sum, parts.schema).toArrow()     # one row a leaf of the bounded tree
    sizes, total, square = np.zeros(tree.leaves, np.int64), np.zeros((tree.leaves, dims)), np.zeros(tree.leaves)
    at = known.column("leaf").to_numpy()
    sizes[at], total[at], square[at] = known.column("n").to_numpy(), _vectors(known.column("total")), known.column("square").to_numpy()
    tree.describe(sizes, total, square)
    visits = 1
    if len(asked):
        q = points[asked]
        best = Window.partitionBy("who").orderBy(F.desc("score"), "vec_id")
        true = index.mapInArrow(_true_nearest(picked.column("vec_id").to_numpy()[asked], q, k),
                                "who long, vec_id long, leaf long, score double") \
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("who", "leaf").toArrow()
        visits = calibrate(tree, q, true.column("who").to_numpy(), true.column("leaf").to_numpy(), recall)
    group_of = (np.cumsum(sizes) - sizes) // block_rows
    group_rows = np.bincount(group_of, weights=sizes)
    blocks = np.maximum(1, -(-group_rows // block_rows)).astype(int)
    shared = spark.sparkContext.broadcast((tree, visits, sizes, group_of))

    layout = spark.createDataFrame(
        pa.table({"leaf": pa.array(np.arange(tree.leaves)), "group": pa.array(group_of.astype(np.int64)),
                  "cuts": pa.array(blocks[group_of].astype(np.int64))}))
    placed = index.join(F.broadcast(layout), "leaf").withColumn(
        "block", F.xxhash64("group", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.col("cuts"))))
    packed = placed.groupBy("block").applyInArrow(_packed, "block long, group long, ids binary, leaves binary, matrix binary")
    queries = rows.filter(V.is_query()).dropDuplicates(["vec_id", "vec"]).withColumn("row", F.xxhash64("vec"))
    parts = max(1, -(-int(queries.count()) // query_rows))
    asked = queries.repartition(parts, "vec_id", "vec").mapInArrow(
        _visits(shared, k), "query_id long, query_row long, group long, visited binary, vec array<double>")
    asked = asked.withColumn("q_part", F.pmod(F.xxhash64("query_id"), F.lit(parts))).groupBy("group", "q_part").applyInArrow(
        _pack_visits, "group long, q_ids binary, q_rows binary, q_matrix binary, visited binary, n_visited binary")
    found = packed.join(asked, "group").mapInArrow(_score(k, dims), "query_id long, query_row long, vec_id long, score double")
    return V.best_of(found, k)
