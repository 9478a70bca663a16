"""Operator 1: substring dedup with difference-cover anchors.

A window is ``window`` consecutive words of one document.  A word goes when
a window that covers it also starts in a document with a smaller id;
windows are judged on the input.

Method.  With the difference cover D = {0, 1, 3} modulo 7 every residue is a
difference of two cover elements.  Two equal windows starting at i and j
therefore meet at an offset k < 7 where i+k and j+k are both cover positions,
so the ``window - 6`` words there are an *aligned anchor* that both documents
hash, although each hashes only 3 of 7 positions.

1. Each home (a unit of 1 to 16 MB of text, placed by the hash of
   the id) sends its distinct anchors, as packed 40-bit prints, to buckets.
   A bucket answers one bit per print: does another home hold it?
2. Around shared anchors the match is extended: each home sends the distinct
   whole windows that contain one (96-bit prints and its smallest id).  A
   bucket answers one bit: does another home hold it under a smaller id?
3. Each home marks the words of answered windows and rewrites its texts.

Every print leaves a home once, however often it occurs there, so a passage
shared by a third of all documents costs a bucket one entry per home.  No
pair of documents is formed.  False matches of step 1 cost work only; step 2
decides, with 96-bit prints of whole windows.

Defined cases: null text has no words; a row with null id is returned
unchanged (it is neither earlier nor later than another); rows with equal ids
do not remove each other's words; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ember.llm import textkit as K
from ember.session import ship_package

COVER = (0, 1, 3)
PERIOD = 7
PRINT_BITS = 40

_REPLY = "home long, step int, bucket long, bits binary"
_RESULT = "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string"


class _Home:
    """The words, anchors and windows of one home, in an order that does not depend on row order."""

    def __init__(self, table: pa.Table, window: int):
        self.ids, self.valid = K.ids_of(table, "doc_id")
        self.words = K.Words(K.column_bytes(table, "text"))
        self.window = window
        w = self.words
        self.hash = w.hashes()
        n = len(self.hash)
        self.place = np.arange(n) - w.first[:-1][w.doc]       # position inside its document
        self.left = w.counts[w.doc] - self.place              # words from here to the document's end
        self.usable = self.valid[w.doc] if n else np.zeros(0, bool)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        size = self.window - PERIOD + 1
        grams = K.gram_hashes(self.hash, size)
        m = len(grams)
        at = np.flatnonzero(np.isin(self.place[:m] % PERIOD, COVER) & (self.left[:m] >= size) & self.usable[:m])
        return at, grams[at]

    def spread(self, grams: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (bucket, print) pairs in order, and each anchor's index in them."""
        bucket = (grams >> K.U64(PRINT_BITS)) % K.U64(buckets)
        key = (bucket << K.U64(PRINT_BITS)) | (grams & K.U64((1 << PRINT_BITS) - 1))
        uniq, inverse = np.unique(key, return_inverse=True)
        return uniq >> K.U64(PRINT_BITS), uniq & K.U64((1 << PRINT_BITS) - 1), inverse

    def doc_rank(self) -> np.ndarray:
        return self.ids[self.words.doc]


def _in_two_docs(inverse: np.ndarray, n: int, doc: np.ndarray) -> np.ndarray:
    """For each of ``n`` distinct prints: does it occur in two different documents of this home?"""
    lo = np.full(n, np.iinfo(np.int64).max)
    hi = np.full(n, np.iinfo(np.int64).min)
    np.minimum.at(lo, inverse, doc)
    np.maximum.at(hi, inverse, doc)
    return lo < hi


def _answers(replies: pa.Table, step: int) -> dict[int, bytes]:
    return {b: bits for s, b, bits in zip(replies.column("step").to_pylist(), replies.column("bucket").to_pylist(),
                                          replies.column("bits").to_pylist()) if s == step}


def _flags(bucket: np.ndarray, answers: dict[int, bytes]) -> np.ndarray:
    """Spread each bucket's answer bits over the home's entries, which are sorted by bucket."""
    out = np.zeros(len(bucket), bool)
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
    ends = np.r_[starts[1:], len(bucket)] if len(bucket) else []
    for lo, hi in zip(starts, ends):
        bits = answers.get(int(bucket[lo]))
        if bits is not None:
            out[lo:hi] = np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo).astype(bool)
    return out


def _by_bucket(bucket: np.ndarray):
    if not len(bucket):
        return
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    for lo, hi in zip(starts, np.r_[starts[1:], len(bucket)]):
        yield int(bucket[lo]), int(lo), int(hi)


class _Windows:
    """Distinct candidate windows of a home after step 1."""

    def __init__(self, home: _Home, replies: pa.Table, anchor_buckets: int, window_buckets: int):
        at, grams = home.anchors()
        bucket, _, inverse = home.spread(grams, anchor_buckets)
        shared = _flags(bucket, _answers(replies, 1)) | _in_two_docs(inverse, len(bucket), home.doc_rank()[at])
        hot = at[shared[inverse]] if len(at) else at
        n = len(home.hash)
        # A shared anchor at p is inside the windows that start in p-6 .. p of the same document.
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, np.maximum(hot - (PERIOD - 1), hot - home.place[hot]), 1)
        np.add.at(edge, hot + 1, -1)
        self.at = np.flatnonzero((np.cumsum(edge[:n]) > 0) & (home.left >= home.window))
        self.doc = home.doc_rank()[self.at]
        one = K.gram_hashes(home.hash, home.window)[self.at] if len(self.at) else np.zeros(0, K.U64)
        with np.errstate(over="ignore"):
            second = K.mix64(home.hash ^ K.U64(0xA0761D6478BD642F))
        two = (K.gram_hashes(second, home.window)[self.at] >> K.U64(32)).astype(np.uint32) if len(self.at) \
            else np.zeros(0, np.uint32)
        place = K.mix64(one) % K.U64(window_buckets) if len(one) else one
        order = np.lexsort((two, one, place))
        new = np.ones(len(order), bool)
        if len(order):
            o, t = one[order], two[order]
            new[1:] = (o[1:] != o[:-1]) | (t[1:] != t[:-1])
        self.inverse = np.empty(len(order), np.int64)
        self.inverse[order] = np.cumsum(new) - 1
        keep = order[new]
        self.bucket, self.one, self.two = place[keep].astype(np.int64), one[keep], two[keep]
        self.least = np.full(len(keep), np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.inverse, self.doc)


def _send_anchors(window: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        home = _Home(table, window)
        _, grams = home.anchors()
        bucket, prints, _ = home.spread(grams, buckets)
        rows = [(b, prints[lo:hi]) for b, lo, hi in _by_bucket(bucket)]
        name = table.column("home")[0].as_py()
        packed = [p.view(np.uint8).reshape(-1, 8)[:, :PRINT_BITS // 8].tobytes() for _, p in rows]
        return pa.table({"bucket": pa.array([b for b, _ in rows], pa.int64()),
                         "home": pa.array([name] * len(rows), pa.int64()), "prints": pa.array(packed, pa.binary())})

    return run


def _answer_anchors(table: pa.Table) -> pa.Table:
    blobs = table.column("prints").to_pylist()
    width = PRINT_BITS // 8
    sizes = np.array([len(b) // width for b in blobs])
    raw = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, width)
    full = np.zeros((len(raw), 8), np.uint8)
    full[:, :width] = raw
    keys = full.view(np.uint64).reshape(-1)
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = np.zeros(len(k), bool)
    if len(k):
        eq = k[1:] == k[:-1]
        same[1:] |= eq
        same[:-1] |= eq
    shared = np.zeros(len(k), bool)
    shared[order] = same
    return _reply(table, sizes, shared, 1)


def _reply(table: pa.Table, sizes: np.ndarray, flag: np.ndarray, step: int) -> pa.Table:
    homes, bucket = table.column("home").to_pylist(), table.column("bucket")[0].as_py()
    ends = np.cumsum(sizes)
    out = [(h, np.packbits(flag[e - s:e]).tobytes()) for h, s, e in zip(homes, sizes, ends) if flag[e - s:e].any()]
    return pa.table({"home": pa.array([h for h, _ in out], pa.int64()), "step": pa.array([step] * len(out), pa.int32()),
                     "bucket": pa.array([bucket] * len(out), pa.int64()),
                     "bits": pa.array([b for _, b in out], pa.binary())})


def _send_windows(window: int, anchor_buckets: int, window_buckets: int):
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        rows = []
        if table.num_rows:
            found = _Windows(_Home(table, window), replies, anchor_buckets, window_buckets)
            name = table.column("home")[0].as_py()
            for b, lo, hi in _by_bucket(found.bucket):
                rows.append((b, name, found.one[lo:hi].tobytes(), found.two[lo:hi].tobytes(),
                             K.planes(found.least[lo:hi])))
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int64()),
                         "home": pa.array([r[1] for r in rows], pa.int64()),
                         "one": pa.array([r[2] for r in rows], pa.binary()),
                         "two": pa.array([r[3] for r in rows], pa.binary()),
                         "least": pa.array([r[4] for r in rows], pa.binary())})

    return run


def _answer_windows(table: pa.Table) -> pa.Table:
    one = np.frombuffer(b"".join(table.column("one").to_pylist()), np.uint64)
    two = np.frombuffer(b"".join(table.column("two").to_pylist()), np.uint32)
    sizes = np.array([len(b) // 4 for b in table.column("two").to_pylist()])
    least = np.concatenate([K.from_planes(b, np.int64) for b in table.column("least").to_pylist()])
    order = np.lexsort((least, two, one))
    o, t = one[order], two[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (t[1:] != t[:-1])
    group_least = least[order][new][np.cumsum(new) - 1]
    later = np.zeros(len(o), bool)
    later[order] = group_least < least[order]
    return _reply(table, sizes, later, 2)


def _rewrite(window: int, anchor_buckets: int, window_buckets: int, carry: tuple[str, ...]):
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _carried(_result([], [], [], []), table, carry)
        home = _Home(table, window)
        found = _Windows(home, replies, anchor_buckets, window_buckets)
        later = _flags(found.bucket, _answers(replies, 2))
        hit = found.at[later[found.inverse] | (found.doc > found.least[found.inverse])] if len(found.at) else found.at
        n = len(home.hash)
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + window, -1)
        gone = np.cumsum(edge[:n]) > 0
        w = home.words
        # Bytes of kept words, each with the separator behind it turned into a space.
        keep = np.zeros(len(w.buf) + 1, np.int8)
        keep[w.starts[~gone]] = 1
        keep[w.ends[~gone] + 1] -= 1
        mask = np.cumsum(keep[:-1], dtype=np.int8).astype(bool)
        flat = w.buf.copy()
        flat[w.ends] = 0x20
        kept = flat[mask].tobytes()
        cut = np.r_[0, np.cumsum(mask)][w.offsets]
        texts = [kept[a:max(a, b - 1)] for a, b in zip(cut[:-1], cut[1:])]
        removed = np.bincount(w.doc[gone], minlength=table.num_rows)
        ids = [int(i) if v else None for i, v in zip(home.ids, home.valid)]
        return _carried(_result(ids, w.counts, removed, texts), table, carry)

    return run


def _carried(result: pa.Table, table: pa.Table, carry: tuple[str, ...]) -> pa.Table:
    for name in carry:
        result = result.append_column(name, table.column(name))
    return result


def _result(ids, counts, removed, texts) -> pa.Table:
    return pa.table({
        "doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(np.asarray(counts, np.int64)),
        "n_removed": pa.array(np.asarray(removed, np.int64)),
        "kept_text": pa.array(texts, pa.binary()).cast(pa.string()),
        "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())})


def substring_dedup(docs: DataFrame, *, window: int = 13, home_bytes: int | None = None,
                    bucket_prints: int = 1 << 20, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text, kept_sha256 of every row of ``docs(doc_id, text)``.

    Columns of ``docs`` named in ``carry`` (``text`` too) come back with their own row, so that rows sharing an id
    need no join.

    ``home_bytes`` of text form one unit of work and ``bucket_prints`` prints
    one bucket; the numbers of both follow from the measured size of the table.
    By default a home is 1 MB, beyond 16 GB of text a 16,384th of it up to
    16 MB, so that the rows sent from homes to buckets stay well filled.
    """
    if window < PERIOD + 1:
        raise ValueError(f"window must be over {PERIOD} words")
    ship_package(docs.sparkSession)
    extra = [c for c in carry if c != "text"]
    if {"doc_id", "home", "n_words", "n_removed", "kept_text", "kept_sha256"} & set(carry):
        raise ValueError("carry names a column of the result")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *extra)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    home_bytes = home_bytes or min(16 << 20, max(1 << 20, total >> 14))
    homes = max(1, -(-total // home_bytes))
    # About six bytes a word, three anchors in seven words.
    anchors = max(1, -(-(total // 14) // bucket_prints))
    windows = max(1, -(-(total // 12) // bucket_prints))
    placed = docs.withColumn("home", F.pmod(F.xxhash64(F.coalesce("doc_id", F.xxhash64("text"))), F.lit(homes)))
    asked = placed.groupBy("home").applyInArrow(_send_anchors(window, anchors), "bucket long, home long, prints binary")
    first = asked.groupBy("bucket").applyInArrow(_answer_anchors, _REPLY)
    sent = placed.groupBy("home").cogroup(first.groupBy("home")).applyInArrow(
        _send_windows(window, anchors, windows), "bucket long, home long, one binary, two binary, least binary")
    second = sent.groupBy("bucket").applyInArrow(_answer_windows, _REPLY)
    return placed.groupBy("home").cogroup(first.unionByName(second).groupBy("home")).applyInArrow(
        _rewrite(window, anchors, windows, carry),
        ", ".join([_RESULT, *(f"`{c}` {placed.schema[c].dataType.simpleString()}" for c in carry)]))
