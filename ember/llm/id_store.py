"""Operator 12: token ids in binary files with a minimal perfect hash index.

``write_store`` range-sorts the documents by key and writes every range as a
shard of two files; ``read_documents`` finds the documents of given keys in them.

*Payload* (``.ids``): the ids of the shard's documents one behind the other,
little-endian, in the smallest unsigned width that holds the vocabulary.

*Index* (``.idx``): a header, then for every distinct key, at the slot its
minimal perfect hash gives, a 32-bit fingerprint and the number of its first
document, how many documents share the key, and the position of every
document.  The hash has levels: a level is a bit array of twice as many bits
as keys are left; keys alone on their bit are done, the others go on to the
next level.  A key's slot is the number of bits set before its own, so n keys
have the slots 0 to n - 1, a look-up reads one bit array after another (1.6 on
average), and no key is stored.  A key that is not there is told by its fingerprint.

*Manifest*: one row a shard (files, bounds of the keys, counts), taken only from
tasks that succeeded.  Files of lost attempts have names of their own and are
never read.  Files are written and read through ``pyarrow.fs``, which takes the
shared folder's own URI.

A task holds the index of one shard (20 bytes a document) and a slice of about
1 MB of text; shards are sized by text bytes.  Keys looked up are routed to
shards by the key bounds: 16 bytes a shard on the driver and in each task.

Defined cases: null text is empty and holds the end id alone; null keys come
first and are found as null; documents that share a key are stored in the order
of their text's hash and are all returned, also where they lie in several
shards, so a hot key is cut like any other rows; asked keys are taken once; an
empty table gives an empty store; extra columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ember.llm import textkit as K
from ember.llm.packing import Encoder
from ember.llm.staging import staged
from ember.session import shared_dir, ship_package

MAGIC = b"IDSTORE1"
SPREAD = 2                     # bits of a level per key left
NO_KEY = -(1 << 63)            # how null keys sort and are routed; told apart from that very key by their hash

_MANIFEST = ("shard long, payload string, index string, n_docs long, n_ids long, low long, high long")


# ------------------------------------------------------------- perfect hash


def key_hashes(keys: np.ndarray, valid: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of every key; null is a key of its own."""
    with np.errstate(over="ignore"):
        h = K.mix64(keys.astype(np.int64).view(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15) & ((1 << 64) - 1)))
        return K.mix64(h + np.where(valid, np.uint64(0), np.uint64(0xD1B54A32D192ED03)))


class PerfectHash:
    """Minimal perfect hash of distinct keys: level sizes, the levels' bits, and set bits before every word."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.start = np.cumsum(sizes) - sizes                       # in bits; levels are whole words
        self.before = np.r_[0, np.cumsum(np.bitwise_count(words).astype(np.int64))]

    @classmethod
    def build(cls, keys: np.ndarray, valid: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        left = np.arange(len(keys))
        while len(left):
            size = -(-max(SPREAD * len(left), 64) // 64) * 64
            bit = (key_hashes(keys[left], valid[left], len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(bit, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[~alone[bit]]
        return cls(np.array(sizes, np.int64), np.concatenate(levels) if levels else np.zeros(0, "<u8"))

    def slots(self, keys: np.ndarray, valid: np.ndarray) -> np.ndarray:
        """Slot of every key; -1 or any slot for a key that was not built in."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (size, start) in enumerate(zip(self.sizes.tolist(), self.start.tolist())):
            if not len(left):
                break
            bit = start + (key_hashes(keys[left], valid[left], level) % np.uint64(size)).astype(np.int64)
            word, shift = self.words[bit >> 6], (bit & 63).astype(np.uint64)
            hit = (word >> shift) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
            out[left[hit]] = (self.before[bit >> 6] + below)[hit]
            left = left[~hit]
        return out


def fingerprints(keys: np.ndarray, valid: np.ndarray) -> np.ndarray:
    return (key_hashes(keys, valid, 0xF1) >> np.uint64(32)).astype("<u4")


class ShardIndex:
    """Keys of one shard -> numbers of their documents -> positions of the ids."""

    def __init__(self, hashed: PerfectHash, prints: np.ndarray, first: np.ndarray, number: np.ndarray, ends: np.ndarray,
                 width: int):
        self.hashed, self.prints, self.first, self.number, self.ends, self.width = hashed, prints, first, number, ends, width

    @classmethod
    def build(cls, keys: np.ndarray, valid: np.ndarray, lengths: np.ndarray, width: int) -> ShardIndex:
        """Documents in shard order: equal keys lie together."""
        head = np.r_[True, (keys[1:] != keys[:-1]) | (valid[1:] != valid[:-1])] if len(keys) else np.zeros(0, bool)
        at = np.flatnonzero(head)
        k, v = keys[at], valid[at]
        hashed = PerfectHash.build(k, v)
        slot = hashed.slots(k, v)
        prints, first, number = np.zeros(len(at), "<u4"), np.zeros(len(at), "<u4"), np.zeros(len(at), "<u4")
        prints[slot], first[slot], number[slot] = fingerprints(k, v), at, np.diff(np.r_[at, len(keys)])
        return cls(hashed, prints, first, number, np.cumsum(lengths, dtype="<u8"), width)

    def dump(self) -> bytes:
        head = MAGIC + struct.pack("<5q", self.width, len(self.prints), len(self.ends), len(self.hashed.sizes), len(self.hashed.words))
        parts = (self.hashed.sizes.astype("<i8"), self.hashed.words, self.prints, self.first, self.number, self.ends)
        return head + b"".join(p.tobytes() for p in parts)

    @classmethod
    def load(cls, raw: bytes) -> ShardIndex:
        if raw[:8] != MAGIC:
            raise ValueError("not an index file")
        width, n, docs, levels, words = struct.unpack_from("<5q", raw, 8)
        at, parts = 48, []
        for kind, size in (("<i8", levels), ("<u8", words), ("<u4", n), ("<u4", n), ("<u4", n), ("<u8", docs)):
            parts.append(np.frombuffer(raw, kind, size, at))
            at += parts[-1].nbytes
        sizes, bits, prints, first, number, ends = parts
        return cls(PerfectHash(sizes, bits), prints, first, number, ends, width)

    def find(self, keys: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document and number of documents (0: the key is not here) of every key."""
        slot = self.hashed.slots(keys, valid)
        if not len(self.prints):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        held = (slot >= 0) & (self.prints[slot] == fingerprints(keys, valid))
        return self.first[slot].astype(np.int64), np.where(held, self.number[slot].astype(np.int64), 0)

    def span(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions, in ids, where documents begin and end."""
        return np.where(docs > 0, self.ends[docs - 1], 0).astype(np.int64), self.ends[docs].astype(np.int64)


# ------------------------------------------------------------------ writing


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def _write(root: str, tokenizer_path: str, end_id: int):
    def run(batches):
        encoder = Encoder.get(tokenizer_path)
        width = 2 if max(encoder.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1) <= 1 << 16 else 4
        where, folder = _opened(root)
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex[:12]}"
        keys, valid, lengths = [], [], []
        out = None
        try:
            for batch in batches:
                for part in K.byte_slices(batch, "text"):
                    if out is None:
                        where.create_dir(folder, recursive=True)
                        out = where.open_output_stream(f"{folder}/{name}.ids")
                    ids, bounds = encoder.encode(part.column("text").to_pylist(), end_id)
                    out.write(ids.astype(f"<u{width}").tobytes())
                    k, v = K.ids_of(part, "doc_id")
                    for held, new in ((keys, k), (valid, v), (lengths, np.diff(bounds))):
                        held.append(new)
        finally:
            if out is not None:
                out.close()
        if out is None:
            return
        k, v, n = np.concatenate(keys), np.concatenate(valid), np.concatenate(lengths)
        with where.open_output_stream(f"{folder}/{name}.idx") as index:
            index.write(ShardIndex.build(k, v, n, width).dump())
        bound = np.where(v, k, NO_KEY)
        yield pa.RecordBatch.from_pydict({
            "shard": [shard], "payload": [f"{root}/{name}.ids"], "index": [f"{root}/{name}.idx"], "n_docs": [len(k)],
            "n_ids": [int(n.sum())], "low": [int(bound[0])], "high": [int(bound[-1])]})

    return run


def write_store(docs: DataFrame, tokenizer_path: str, *, end_id: int = 0, root: str | None = None,
                shard_bytes: int = 64 << 20) -> DataFrame:
    """Write ``docs(doc_id, text)`` to ``root`` (a fresh shared folder by default) in ascending doc_id order; the manifest.

    The manifest has one row a shard: shard, payload, index, n_docs, n_ids, low, high, and ``start``, the ids of all
    shards before it.
    """
    spark = docs.sparkSession
    ship_package(spark)
    root = root or shared_dir(spark, "id-store")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    # Equal rows are cut apart by where they were read; they are interchangeable, so the result is the same.
    keyed = rows.withColumn("print", F.xxhash64("text")).withColumn("at", F.monotonically_increasing_id())
    ordered = keyed.repartitionByRange(max(1, -(-total // shard_bytes)), "doc_id", "print", "at") \
        .sortWithinPartitions("doc_id", "print", "at").select("doc_id", "text")
    made = staged(ordered.mapInArrow(_write(root, tokenizer_path, end_id), _MANIFEST), "id-manifest")
    return _with_starts(made)


def _with_starts(made: DataFrame) -> DataFrame:
    """The manifest with the ids before every shard; one small row a shard passes through the driver."""
    spark = made.sparkSession
    table = made.select("shard", "n_ids").toArrow().sort_by("shard")
    shard, n = (np.asarray(table.column(c), np.int64) for c in ("shard", "n_ids"))
    starts = spark.createDataFrame(pa.table({"shard": pa.array(shard), "start": pa.array(np.cumsum(n) - n)}))
    return made.join(starts, "shard")


# ------------------------------------------------------------------ reading

_DOCUMENT = "doc_id long, shard long, start long, n_tokens long, ids binary"


def _read():
    def run(batches):
        now, index, payload = None, None, None
        for batch in batches:
            keys, valid = K.ids_of(batch, "doc_id")
            names = batch.column("index").to_pylist()
            heads = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]] + [len(names)]
            for a, b in zip(heads[:-1], heads[1:]):
                if names[a] != now:
                    now = names[a]
                    where, file = _opened(now)
                    with where.open_input_file(file) as f:
                        index = ShardIndex.load(f.read())
                    if payload is not None:
                        payload.close()
                    payload = where.open_input_file(_opened(batch.column("payload")[a].as_py())[1])
                first, number = index.find(keys[a:b], valid[a:b])
                row = np.repeat(np.arange(a, b), number)
                doc = np.repeat(first, number) + np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
                lo, hi = index.span(doc)
                base = batch.column("start")[a].as_py()
                total = np.cumsum(hi - lo) * index.width
                x = 0
                while x < len(row):                                     # about 1 MB of payload at once, one document at least
                    y = max(x + 1, int(np.searchsorted(total, (total[x - 1] if x else 0) + K.CHUNK_BYTES, side="right")))
                    ids = []
                    for s, e in zip(lo[x:y].tolist(), hi[x:y].tolist()):
                        payload.seek(s * index.width)
                        ids.append(np.frombuffer(payload.read((e - s) * index.width), f"<u{index.width}").astype("<u4").tobytes())
                    at = pa.array(row[x:y])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(at), batch.column("shard").take(at), pa.array(base + lo[x:y]),
                         pa.array(hi[x:y] - lo[x:y]), pa.array(ids, pa.binary())],
                        names=["doc_id", "shard", "start", "n_tokens", "ids"])
                    x = y
        if payload is not None:
            payload.close()

    return run


def read_documents(keys: DataFrame, manifest: DataFrame) -> DataFrame:
    """doc_id, shard, start, n_tokens, ids (little-endian unsigned 32-bit) of the stored documents of ``keys(doc_id)``.

    ``start`` counts the ids of all documents before it; keys that are not stored give no row.
    """
    spark = keys.sparkSession
    ship_package(spark)
    table = manifest.select("shard", "low", "high").toArrow().sort_by("shard")        # 24 bytes a shard
    shard, low, high = (np.asarray(table.column(c), np.int64) for c in ("shard", "low", "high"))
    asked = keys.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    routed = asked.mapInArrow(_route(shard, low, high), "doc_id long, shard long")
    placed = routed.join(manifest.select("shard", "payload", "index", "start"), "shard")
    return placed.repartition("shard").sortWithinPartitions("shard", "doc_id").mapInArrow(_read(), _DOCUMENT)


def _route(shard: np.ndarray, low: np.ndarray, high: np.ndarray):
    def run(batches):
        for batch in batches:
            keys, valid = K.ids_of(batch, "doc_id")
            bound = np.where(valid, keys, NO_KEY)
            a, b = np.searchsorted(high, bound, side="left"), np.searchsorted(low, bound, side="right")
            n = np.maximum(b - a, 0)
            row = np.repeat(np.arange(len(keys)), n)
            to = np.repeat(a, n) + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row)), pa.array(shard[to])],
                                             names=["doc_id", "shard"])

    return run

