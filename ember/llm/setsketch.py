"""Operator 5: near-duplicate classes with SetSketch registers.

A document is the set of its distinct ``shingle``-word runs.  Two documents
are linked when their Jaccard similarity is at least ``percent`` / 100; the
answer is the smallest id reachable over links.

1. *Sketch.*  ``REGISTERS`` registers hold floor(1 - log_b x) of the smallest
   value any element gives them.  An element's values lie one in each of
   ``REGISTERS`` consecutive intervals whose bounds make the values
   exponentially distributed, and its intervals go to the registers in an
   order of its own.  Values of a later interval never beat those of an
   earlier one, so the work stops when all registers are set.  Sketches of
   parts merge by the maximum.
2. *Classes.*  Equal sets (128-bit sum print and size) are one class; only its
   smallest id goes on.
3. *Bands.*  Runs of registers are hashed to buckets; the number of registers
   in a band is the largest with which a pair at the threshold is missed with
   a probability below ``MISS``.  Every bucket links its members to its
   smallest id: a bucket of g members gives g - 1 pairs, never g^2.
4. *Estimate.*  The similarity of a pair is the maximum-likelihood value given
   the registers' orders and both set sizes.  Pairs clearly apart (under
   ``LOOSE``) go; the rest form candidate clusters.
5. *Verify.*  A cluster is solved on full sets: pairs in order of estimate, a
   pair being compared exactly unless already connected or estimated
   ``SIGMAS`` deviations under the threshold.  A large cluster is solved in
   blocks that share some hubs; only where it is still in several components
   are blocks of *different* components compared with each other.

Defined cases: null or wordless text is an empty set, linked with nothing;
rows with a null id are kept and get no component; rows sharing an id are one
node; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ember.llm import textkit as K
from ember.llm.components import connected_components
from ember.llm.staging import staged
from ember.session import ship_package

REGISTERS = 256
BASE = 1.001
RATE = 20.0
TOP = (1 << 16) - 1
MISS = 1e-8
LOOSE = 0.5
SIGMAS = 5.0

# ------------------------------------------------------------------- sketch


class ShingleSets:
    """Shingle hashes of many texts, in text order, and which are the first of their kind in a text."""

    def __init__(self, texts: list[bytes | None], k: int):
        words = K.Words(texts, fold_ascii=True)
        self.n = len(texts)
        h = words.hashes()
        place = np.arange(len(h)) - words.first[:-1][words.doc]
        left = words.counts[words.doc] - place
        grams = K.gram_hashes(h, k)
        full = np.flatnonzero(left[:len(grams)] >= k)
        value, doc = grams[full], words.doc[full]
        # Shorter texts: the whole sequence is their one shingle.
        for size in range(1, k):
            at = np.flatnonzero((words.counts[words.doc] == size) & (place == 0))
            if len(at):
                with np.errstate(over="ignore"):
                    short = K.mix64(K.gram_hashes(h, size)[at] + K.U64(size))
                value, doc = np.concatenate([value, short]), np.concatenate([doc, words.doc[at]])
        order = np.argsort(doc, kind="stable")
        self.value, self.doc = value[order], doc[order]
        by = np.argsort(self.value, kind="stable")
        v, d = self.value[by], self.doc[by]
        new = np.ones(len(v), bool)
        new[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
        self.distinct = np.zeros(len(v), bool)
        self.distinct[by[new]] = True
        self.sizes = np.bincount(self.doc[self.distinct], minlength=self.n)

    def prints(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit sums over each distinct set."""
        bounds = np.searchsorted(self.doc, np.arange(self.n + 1))
        out = []
        with np.errstate(over="ignore"):
            for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
                x = np.where(self.distinct, K.mix64(self.value ^ K.U64(salt)), K.U64(0))
                run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
                out.append((run[bounds[1:]] - run[bounds[:-1]]).view(np.int64))
        return out[0], out[1]

    def sets(self) -> list[np.ndarray]:
        value, doc = self.value[self.distinct], self.doc[self.distinct]
        bounds = np.searchsorted(doc, np.arange(self.n + 1))
        return [np.sort(value[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]

    def registers(self) -> np.ndarray:
        """Register values, one row a text (0 where the set is empty)."""
        m = REGISTERS
        least = np.full(self.n * m, np.inf)
        value, doc = self.value, self.doc
        with np.errstate(over="ignore"):
            at0 = K.mix64(value + K.U64(0xA5A5A5A5))
            step = (at0 >> K.U64(40)) | K.U64(1)          # odd: visits every register once
            for j in range(m):
                target = doc * m + ((at0 + step * K.U64(j)) & K.U64(m - 1)).astype(np.int64)
                open_ = np.isinf(least[target])
                hit = target[open_]
                if len(hit):
                    draw = K.mix64(value[open_] ^ K.U64((j * 0x9E3779B97F4A7C15 + 77) & ((1 << 64) - 1)))
                    draw = (draw >> K.U64(11)).astype(np.float64) * 2.0 ** -53
                    np.minimum.at(least, hit, j + draw)
                todo = np.isinf(least.reshape(self.n, m)).any(axis=1)[doc]
                if not todo.any():
                    break
                if not todo.all():
                    value, doc, at0, step = value[todo], doc[todo], at0[todo], step[todo]
        x = -np.log1p(-np.minimum(least, m - 1e-9) / m) / RATE
        with np.errstate(divide="ignore"):
            out = np.clip(np.floor(1 - np.log(x) / math.log(BASE)), 0, TOP)
        out[np.isinf(least)] = 0
        return out.astype(np.uint16).reshape(self.n, m)


def _fraction(x: np.ndarray) -> np.ndarray:
    """Probability that one register is larger, for a difference of ``x`` in relative size."""
    return -np.log1p(-np.maximum(x, 1e-12) * (BASE - 1) / BASE) / math.log(BASE)


def estimate_jaccard(larger: np.ndarray, smaller: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity from the counts of registers where a > b and a < b, and both sizes."""
    equal = REGISTERS - larger - smaller
    u = na / (na + nb)
    v = 1 - u
    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)

    def score(j):
        p, q = _fraction(u - v * j), _fraction(v - u * j)
        return (larger * np.log(np.maximum(p, 1e-12)) + smaller * np.log(np.maximum(q, 1e-12))
                + equal * np.log(np.maximum(1 - p - q, 1e-12)))

    for _ in range(40):                     # the likelihood has one peak: narrow by thirds
        a, b = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        up = score(a) < score(b)
        lo, hi = np.where(up, a, lo), np.where(up, hi, b)
    return (lo + hi) / 2


def band_size(threshold: float) -> int:
    """The most registers a band may have so that a pair at the threshold is missed with probability under MISS."""
    fits = [r for r in range(1, 17) if (1 - threshold ** r) ** (REGISTERS // r) <= MISS]
    return max(fits, default=1)


def _sketch(k: int):
    def run(batches):
        for batch in batches:
            for part in K.byte_slices(batch, "text", 1 << 20):
                sets = ShingleSets(K.column_bytes(part, "text"), k)
                p1, p2 = sets.prints()
                reg = sets.registers()
                raw = [r.tobytes() if n else None for r, n in zip(reg, sets.sizes)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sets.sizes.astype(np.int64)), pa.array(p1), pa.array(p2),
                     pa.array(raw, pa.binary())], names=["doc_id", "n_shingles", "p1", "p2", "registers"])

    return run


def _bands(size: int):
    n = REGISTERS // size

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                reg = np.frombuffer(b"".join(part.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
                ids = part.column("doc_id").to_numpy()
                keys = np.zeros((len(ids), n), np.uint64)
                with np.errstate(over="ignore"):
                    for b in range(n):
                        h = np.full(len(ids), b + 1, np.uint64)
                        for c in range(b * size, (b + 1) * size):
                            h = K.mix64(h * K.U64(0x2545F4914F6CDD1D) + reg[:, c].astype(np.uint64))
                        keys[:, b] = h
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(ids, n))],
                                                 names=["bucket", "doc_id"])

    return run


def _estimated():
    @F.arrow_udf(DoubleType())
    def estimate(ra: pa.Array, na: pa.Array, rb: pa.Array, nb: pa.Array) -> pa.Array:
        a = np.frombuffer(b"".join(ra.to_pylist()), np.uint16).reshape(-1, REGISTERS)
        b = np.frombuffer(b"".join(rb.to_pylist()), np.uint16).reshape(-1, REGISTERS)
        return pa.array(estimate_jaccard((a > b).sum(1), (a < b).sum(1), na.to_numpy().astype(float),
                                         nb.to_numpy().astype(float)))

    return estimate


# ------------------------------------------------------------------- verify


def _roots(n: int):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    return parent, find


def solve(ids: np.ndarray, component: np.ndarray, side: np.ndarray, texts: list[bytes | None], k: int, percent: int):
    """Links that connect the members of one cluster part, found on full sets.

    Rows with equal ``component`` count as connected.  ``side`` 0 rows are
    compared with each other; with sides 1 and 2 only across.
    """
    # Word arrays exist for a slice of the texts at a time; sets and registers stay.
    members, registers, at = [], [], 0
    weight = np.cumsum([len(t or b"") + 1 for t in texts])
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(weight, (weight[at - 1] if at else 0) + (1 << 20), side="right")))
        part = ShingleSets(texts[at:end], k)
        members += part.sets()
        registers.append(part.registers())
        at = end
    reg = np.concatenate(registers)
    sizes = np.array([len(m) for m in members], float)
    parent, find = _roots(len(ids))
    for c in np.unique(component):
        same = np.flatnonzero(component == c)
        for x in same[1:]:
            parent[find(int(x))] = find(int(same[0]))
    t = percent / 100
    slack = t - SIGMAS * math.sqrt(t * (1 - t) / REGISTERS)
    rows_a, rows_b, est = [], [], []
    for i in range(len(ids)):
        other = np.arange(i + 1, len(ids))
        other = other[(component[other] != component[i]) & (np.minimum(sizes[i], sizes[other])
                                                            >= t * np.maximum(sizes[i], sizes[other]))
                      & (sizes[other] > 0) & ((side[other] != side[i]) | (side[i] == 0))]
        if not sizes[i] or not len(other):
            continue
        larger, smaller = (reg[i] > reg[other]).sum(1), (reg[i] < reg[other]).sum(1)
        # Most pairs are clearly apart: the share of equal registers bounds the estimate from above.
        near = larger + smaller <= (1 - slack) * REGISTERS * 1.2 + 1
        other, larger, smaller = other[near], larger[near], smaller[near]
        if not len(other):
            continue
        e = estimate_jaccard(larger, smaller, np.full(len(other), sizes[i]), sizes[other])
        close = e >= slack
        rows_a.append(np.full(int(close.sum()), i))
        rows_b.append(other[close])
        est.append(e[close])
    links = []
    if rows_a:
        a, b, e = np.concatenate(rows_a), np.concatenate(rows_b), np.concatenate(est)
        for p in np.argsort(-e, kind="stable"):
            x, y = int(a[p]), int(b[p])
            fx, fy = find(x), find(y)
            if fx == fy:
                continue
            both = len(np.intersect1d(members[x], members[y], assume_unique=True))
            if 100 * both >= percent * (len(members[x]) + len(members[y]) - both):
                parent[fx] = fy
                links.append((int(ids[x]), int(ids[y])))
    return links


def _solved(k: int, percent: int):
    def run(table: pa.Table) -> pa.Table:
        cluster = table.column("cluster").to_numpy()
        ids, component = table.column("doc_id").to_numpy(), table.column("component").to_numpy()
        side = table.column("side").to_numpy()
        texts = K.column_bytes(table, "text")
        links = []
        order = np.argsort(cluster, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(cluster[order]) != 0])
        for lo, hi in zip(starts, np.r_[starts[1:], len(order)]):
            at = order[lo:hi]
            at = at[np.argsort(ids[at], kind="stable")]
            links += solve(ids[at], component[at], side[at], [texts[i] for i in at], k, percent)
        return pa.table({"u": pa.array([x for x, _ in links], pa.int64()), "v": pa.array([y for _, y in links], pa.int64())})

    return run


def _cross_blocks(members: DataFrame, block: int) -> DataFrame:
    """Rows of (task, side) so that every two members of different components of a cluster meet in a task.

    Components over ``block`` members are cut into units of their own; small
    ones share mixed units.  Units of one large component are not paired.
    """
    size = members.groupBy("cluster", "component").agg(F.count("*").alias("c_size"))
    small = size.groupBy("cluster").agg(F.sum(F.when(F.col("c_size") <= block, F.col("c_size")).otherwise(0)).alias("mixed"))
    m = members.join(size, ["cluster", "component"]).join(small, "cluster")
    large = F.col("c_size") > block
    m = m.withColumn("own", F.when(large, F.col("component")).otherwise(F.lit(None).cast("long"))).withColumn(
        "part", F.when(large, F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("c_size") / block)))
        .otherwise(F.pmod(F.xxhash64("component"), F.ceil(F.col("mixed") / block))))
    m = m.withColumn("unit", F.xxhash64("cluster", F.coalesce("own", F.lit(-1)), F.col("own").isNull(), "part"))
    units = m.select("cluster", "unit", "own").distinct()
    pairs = units.alias("a").join(units.alias("b"), F.expr(
        "a.cluster = b.cluster AND a.unit <= b.unit AND (a.own IS NULL OR b.own IS NULL OR a.own <> b.own)")).select(
        F.col("a.unit").alias("left"), F.col("b.unit").alias("right"))
    pairs = pairs.withColumn("task", F.xxhash64("left", "right"))
    one = pairs.select("task", F.col("left").alias("unit"),
                       F.when(F.col("left") == F.col("right"), 0).otherwise(1).alias("side"))
    two = pairs.filter("left <> right").select("task", F.col("right").alias("unit"), F.lit(2).alias("side"))
    return m.select("cluster", "component", "doc_id", "unit", "text").join(one.unionByName(two), "unit").select(
        "task", "cluster", "component", "doc_id", F.col("side").cast("long").alias("side"), "text")


def _shared_id_links(usable: DataFrame, classes: DataFrame, prints: list[str]) -> DataFrame | None:
    """An id on several texts joins their classes: links (u, v) from its smallest class head to the others.

    None where every id has one text: then one narrow aggregation is all this costs.
    """
    same = F.struct(*prints)
    several = staged(usable.groupBy("doc_id").agg((F.min(same) < F.max(same)).alias("several")).filter("several").select("doc_id"),
                     "shared-ids")
    if several.isEmpty():
        return None
    heads = usable.select("doc_id", *prints).join(several, "doc_id", "left_semi").join(classes, prints).select("doc_id", "first_id")
    least = heads.groupBy("doc_id").agg(F.min("first_id").alias("u"))
    return heads.join(least, "doc_id").select("u", F.col("first_id").alias("v")).filter("u <> v").distinct()


def near_duplicates(docs: DataFrame, *, shingle: int = 5, percent: int = 80, block: int = 1024) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = staged(docs.mapInArrow(
        _sketch(shingle), "doc_id long, n_shingles long, p1 long, p2 long, registers binary"), "sketches")
    usable = sketch.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    prints = ["p1", "p2", "n_shingles"]
    classes = usable.groupBy(*prints).agg(F.min("doc_id").alias("first_id"))
    firsts = classes.select(F.col("first_id").alias("doc_id"), *prints)
    reps = staged(usable.join(firsts, ["doc_id", *prints], "left_semi")
                  .dropDuplicates(["doc_id", *prints]).select("doc_id", "n_shingles", "registers"), "class-sketches")

    bands = reps.mapInArrow(_bands(band_size(percent / 100)), "bucket long, doc_id long")
    hubs = bands.groupBy("bucket").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")) \
        .filter("hub < last").select("bucket", "hub")
    pairs = bands.join(hubs, "bucket").filter("doc_id <> hub").select("hub", "doc_id").distinct()
    a, b = reps.alias("a"), reps.alias("b")
    near = (pairs.alias("p").join(a, F.expr("p.doc_id = a.doc_id")).join(b, F.expr("p.hub = b.doc_id"))
            .withColumn("similar", _estimated()(F.col("a.registers"), F.col("a.n_shingles"),
                                                F.col("b.registers"), F.col("b.n_shingles")))
            .filter(F.col("similar") >= LOOSE).select(F.col("p.hub").alias("u"), F.col("p.doc_id").alias("v")))
    clusters = staged(connected_components(near), "clusters").withColumnsRenamed({"node": "doc_id", "component": "cluster"})

    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("size"))
    # The texts of all documents meet the members by a shuffle at any size: no plan switches to a broadcast.
    members = clusters.join(sizes, "cluster").join(docs.filter("text IS NOT NULL").hint("merge"), "doc_id")
    members = staged(members, "cluster-texts")
    # Small clusters share tasks; a large one is dealt into blocks that all hold its hubs.
    total = members.count()
    blocks = F.when(F.col("size") <= block, F.lit(1)).otherwise(F.ceil(F.col("size") / block))
    mine = F.when(F.col("size") <= block, F.pmod(F.xxhash64("cluster"), F.lit(max(1, total // 512)))).otherwise(
        F.xxhash64("cluster", F.pmod(F.xxhash64("doc_id"), blocks)))
    hub = (F.col("size") > block) & ((F.col("doc_id") == F.col("cluster"))
                                     | (F.pmod(F.xxhash64("doc_id", F.lit(3)), F.ceil(F.col("size") / 32)) == 0))
    dealt = members.withColumn("task", F.when(hub, F.transform(
        F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1), lambda i: F.xxhash64(F.col("cluster"), i))).otherwise(F.array(mine)))
    dealt = dealt.withColumn("task", F.explode("task")).select(
        "task", "cluster", F.col("doc_id").alias("component"), "doc_id", F.lit(0).cast("long").alias("side"), "text")
    run = _solved(shingle, percent)
    links = dealt.groupBy("task").applyInArrow(run, "u long, v long")
    shared = _shared_id_links(usable, classes, prints)
    links = staged(links if shared is None else links.unionByName(shared), "verified")
    found = staged(connected_components(links), "found")
    # Large clusters that are still in several components: compare across them.
    big = members.filter(F.col("size") > block)
    if big.limit(1).count():
        now = big.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
            "component", F.coalesce("component", "doc_id"))
        several = now.groupBy("cluster").agg((F.min("component") < F.max("component")).alias("several")).filter("several")
        cross = _cross_blocks(now.join(several.select("cluster"), "cluster", "left_semi"), block)
        more = staged(cross.groupBy("task").applyInArrow(run, "u long, v long"), "verified")
        if not more.isEmpty():
            stars = found.select(F.col("node").alias("u"), F.col("component").alias("v"))
            found = staged(connected_components(stars.unionByName(more)), "found")
    heads = classes.join(found, F.col("first_id") == F.col("node"), "left").select(
        *prints, F.coalesce("component", "first_id").alias("component_id"))
    rows = sketch.drop("registers").alias("s").join(heads.alias("h"), prints, "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("component_id", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"),
                       F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
