"""Operator 10: packing along a space-filling curve.

Every document's hashed word vector is projected to ``DIMS`` dimensions by
random signs, scaled to a grid cell, and the cell gets its Hilbert index.
Documents are range-sorted by (index, id), so neighbours on the curve, which
share vocabulary, are packed next to each other.  Each range partition packs
its documents into sequences of ``length`` ids, cutting a document where a
sequence is full; only the last sequence of a partition has padding.

Ids are the tokenizer's own.  Texts are cut into its pre-tokens with array
operations, each distinct pre-token is encoded once by the library, and a
bounded per-worker cache supplies the repeats.  A text that holds an added
token's string goes through the library whole.

Equal texts share an index, but the sort key ends in the id, so a group of
copies is cut over partitions like any other rows.

Defined cases: null text is empty and gives the end id alone; null ids come
first among equal keys; identical rows are packed separately; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ember.llm import textkit as K
from ember.session import ship_package

DIMS = 4
GRID_BITS = 12

# ------------------------------------------------------------ Hilbert order


def hilbert_index(cells: np.ndarray, bits: int = GRID_BITS) -> np.ndarray:
    """Index along the Hilbert curve of integer cells, one row a point (Skilling's transform)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[n - 1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= flip
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def curve_keys(texts: list[bytes | None]) -> np.ndarray:
    """Hilbert key of every text's projected word vector; texts without words are at the origin."""
    words = K.Words(texts)
    h = words.hashes(seed=10)
    cells = np.zeros((len(texts), DIMS), np.int64)
    n = np.maximum(words.counts, 1)
    for d in range(DIMS):
        sign = ((h >> K.U64(11 * d)) & K.U64(1)).astype(np.int64) * 2 - 1
        run = np.r_[0, np.cumsum(sign)]
        mean = (run[words.first[1:]] - run[words.first[:-1]]) / n
        cells[:, d] = np.clip((np.tanh(3 * mean) + 1) / 2 * (1 << GRID_BITS), 0, (1 << GRID_BITS) - 1)
    return hilbert_index(cells)


@F.arrow_udf(LongType())
def _curve_key(text: pa.Array) -> pa.Array:
    batch = pa.RecordBatch.from_arrays([text], names=["text"])
    keys = [curve_keys(K.column_bytes(part, "text")) for part in K.byte_slices(batch, "text")]
    return pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64))


# ------------------------------------------------------- pre-tokens and ids

# Fixed values of the public byte-level pre-token pattern: clitics that are tokens of their own.
CLITICS_1 = "stmd"
CLITICS_2 = ("re", "ve", "ll")
OTHER, LETTER, NUMBER, SPACE, END = range(5)


def _class_table() -> np.ndarray:
    import regex

    table = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        table[[ord(c) for c in regex.findall(pattern, every)]] = kind
    return table


def pretoken_bounds(points: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where a pre-token begins, in texts laid end to end, each closed by one END position."""
    n = len(points)
    before = np.empty_like(kind)
    before[0], before[1:] = END, kind[:-1]
    after = np.empty_like(kind)
    after[-1], after[:-1] = END, kind[1:]
    blank = (points == 0x20) & (kind == SPACE)
    glued = np.zeros(n, bool)
    glued[1:] = blank[:-1]
    change = kind != before
    start = change & ~glued
    # A run of white space gives its last character to what follows it.
    space = kind == SPACE
    start[space] = (change & space)[space]
    start |= space & (after != SPACE) & (after != END)
    start |= kind == END
    mark = np.flatnonzero((points == 0x27) & change & ~glued & (kind == OTHER) & (after == LETTER))
    if len(mark):
        padded = np.append(points, [0, 0])
        a, b = padded[mark + 1], padded[mark + 2]
        size = np.where(np.isin(a, [ord(c) for c in CLITICS_1]), 1, 0)
        for pair in CLITICS_2:
            size = np.where((size == 0) & (a == ord(pair[0])) & (b == ord(pair[1])), 2, size)
        mark, size = mark[size > 0], size[size > 0]
        start[mark + 1] = False
        start[mark[size == 2] + 2] = False
        rest = mark + 1 + size
        start[rest[kind[rest] == LETTER]] = True
    return start


class Encoder:
    """Ids of many texts by one tokenizers file; one per worker and file."""

    known: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.plain = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                      and not pre.get("add_prefix_space") and pre.get("use_regex", True))
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.classes = _class_table()
        self.limit = 500_000
        self._fresh()

    def _fresh(self) -> None:
        self.cache = K.SpanCache(self.limit)
        self.flat, self.offset = K.Grown(np.uint32), K.Grown(np.int64, [0])

    @classmethod
    def get(cls, path: str) -> Encoder:
        if path not in cls.known:
            cls.known[path] = cls(path)
        return cls.known[path]

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, ``end_id`` after each text, and the bounds of every text."""
        odd = [i for i, t in enumerate(texts) if not self.plain or any(a in t for a in self.added)]
        body = list(texts)
        for i in odd:
            body[i] = ""
        ids, bounds = self._encode_plain(body, end_id)
        if odd:
            whole = {i: np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids + [end_id], np.uint32)
                     for i in odd}
            parts = [whole.get(i, ids[bounds[i]:bounds[i + 1]]) for i in range(len(texts))]
            ids = np.concatenate(parts)
            bounds = np.r_[0, np.cumsum([len(p) for p in parts])]
        return ids, bounds

    def encode_text(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids without end ids; the strings of added tokens are ordinary text."""
        if not self.plain:
            raise ValueError("needs a byte-level tokenizer without normalizer")
        ids, bounds = self._encode_plain(texts, 0)
        keep = np.ones(len(ids), bool)
        keep[bounds[1:] - 1] = False
        return ids[keep], bounds - np.arange(len(bounds))

    def _encode_plain(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        joined = "\0".join(texts) + "\0"
        raw = joined.encode("utf-32-le")
        points = np.frombuffer(raw, np.uint32)
        closing = np.cumsum([len(t) + 1 for t in texts]) - 1
        kind = self.classes[points]
        kind[closing] = END
        starts = np.flatnonzero(pretoken_bounds(points, kind))
        ends = np.append(starts[1:], len(points))
        if self.cache.full():
            self._fresh()
        key = K.span_hashes(raw + b"\0" * 8, starts * 4, ends * 4)
        is_end = kind[starts] == END
        key[is_end] = end_id + 1                  # word hashes do not meet such small values
        uniq, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        row = self.cache.find(uniq)
        missing = np.flatnonzero(row < 0)
        if len(missing):
            found = [[end_id] if is_end[i] else None for i in first[missing]]
            ask = [k for k, f in enumerate(found) if f is None]
            spans = first[missing[ask]]
            for k, e in zip(ask, self.tokenizer.encode_batch_fast(
                    [joined[a:b] for a, b in zip(starts[spans].tolist(), ends[spans].tolist())],
                    add_special_tokens=False)):
                found[k] = e.ids
            base = self.offset.size - 1
            row[missing] = np.arange(base, base + len(missing))
            self.cache.add(uniq[missing], row[missing])
            self.offset.append(self.flat.size + np.cumsum([len(f) for f in found]))
            self.flat.append(np.array([i for f in found for i in f], np.uint32))
        flat, offset = self.flat.view(), self.offset.view()
        row = row[inverse]
        size = offset[row + 1] - offset[row]
        at = np.cumsum(size)
        ids = flat[np.arange(at[-1]) + np.repeat(offset[row] - at + size, size)]
        return ids, np.r_[0, at[is_end]]


# ------------------------------------------------------------------ packing

RANGE_BYTES = 128 << 20       # text of one range of the curve, about

_PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def _pack(path: str, length: int, end_id: int, with_ids: bool):
    def run(batches):
        encoder = Encoder.get(path)
        base = TaskContext.get().partitionId() << 33
        at = 0                                    # ids packed by this partition so far
        for batch in batches:
            for part in K.byte_slices(batch, "text"):
                texts = part.column("text").to_pylist()
                ids, bounds = encoder.encode(texts, end_id)
                # Pieces end where a document ends and where a sequence is full.
                full = np.arange(length - at % length, len(ids), length)
                cuts = np.union1d(bounds, full)
                lo, hi = cuts[:-1], cuts[1:]
                doc = np.searchsorted(bounds, lo, side="right") - 1
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(lo.tolist(), hi.tolist())]
                out = [part.column("doc_id").take(pa.array(doc)), pa.array(lo - bounds[doc]), pa.array(hi - lo),
                       pa.array(crc, pa.int64()), pa.array(np.diff(bounds)[doc]),
                       pa.array(base + (at + lo) // length), pa.array((at + lo) % length)]
                if with_ids:
                    out.append(pa.array([bytes(raw[4 * a:4 * b]) for a, b in zip(lo.tolist(), hi.tolist())], pa.binary()))
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                                             "sequence_id", "offset"] + ["ids"] * with_ids)
                at += len(ids)

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, *, length: int = 2048, end_id: int = 1,
                   with_ids: bool = True) -> DataFrame:
    """Pieces of every row of ``docs(doc_id, text)`` and their place in the packed sequences.

    ``ids`` (little-endian unsigned 32-bit) is left out with ``with_ids=False``.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # The number of ranges follows the input; a small one keeps the session's parallelism.
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    # The tokenizer runs behind the exchange: sampling the range sees only the cheap key.
    ordered = (rows.withColumn("key", _curve_key("text")).repartitionByRange(ranges, "key", "doc_id")
               .sortWithinPartitions("key", "doc_id").select("doc_id", "text"))
    return ordered.mapInArrow(_pack(tokenizer_path, length, end_id, with_ids),
                              _PIECES + (", ids binary" if with_ids else ""))
