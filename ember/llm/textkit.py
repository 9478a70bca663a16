"""Vectorised text helpers used inside Arrow tasks: words, hashes, packed columns.

Words are maximal runs of bytes other than space and ``\\t\\n\\v\\f\\r``.  All
separators are ASCII, so UTF-8 can be cut byte by byte without decoding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD_PATTERN = r"[^\x20\x09-\x0D]+"

U64 = np.uint64
_SEP = np.zeros(256, bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True

CHUNK_BYTES = 1 << 20          # text handled at once inside a task


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(32))
    x = x * U64(0x9E3779B97F4A7C15)
    x ^= x >> U64(29)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


def byte_slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each slice holds about ``limit`` text bytes (one row at least)."""
    n = batch.num_rows
    if n == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes.astype(np.int64) + 1)
    lo = 0
    while lo < n:
        base = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


class Words:
    """Word spans of a list of texts laid out in one byte buffer.

    ``starts``/``ends`` are byte positions, ``first[d]:first[d+1]`` the words
    of text ``d``, ``doc`` the text of each word.  One separator byte follows
    every text, so a word's end is always a valid position.
    """

    def __init__(self, texts: list[bytes | None], fold_ascii: bool = False):
        parts = [t or b"" for t in texts]
        joined = b"\n".join(parts) + b"\n"
        if fold_ascii:
            joined = joined.lower()        # bytes.lower changes A-Z only
        self.raw = joined + b"\0" * 8
        self.buf = np.frombuffer(joined, np.uint8)
        sep = _SEP[self.buf]
        before = np.empty_like(sep)
        before[0] = True
        before[1:] = sep[:-1]
        self.starts = np.flatnonzero(before & ~sep)
        self.ends = np.flatnonzero(sep & ~before)
        offsets = np.zeros(len(parts) + 1, np.int64)
        np.cumsum([len(p) + 1 for p in parts], out=offsets[1:])
        self.offsets = offsets
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(parts)), self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        return span_hashes(self.raw, self.starts, self.ends, seed)


_LANE_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def span_hashes(raw: bytes, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of every byte span; ``raw`` ends with 8 spare bytes."""
    lanes = np.ndarray(shape=(max(len(raw) - 7, 0),), dtype="<u8", buffer=raw, strides=(1,))
    size = ends - starts
    with np.errstate(over="ignore"):
        h = mix64(size.astype(U64) + U64((seed * 0x632BE59BD9B4E019 + 0x1234567) & ((1 << 64) - 1)))
        todo = np.arange(len(starts))
        at = starts
        left = size
        while len(todo):
            lane = lanes[at] & _LANE_MASK[np.minimum(left, 8)]
            h[todo] = mix64((h[todo] ^ lane) * U64(0xFF51AFD7ED558CCD))
            more = left > 8
            if not more.any():
                break
            todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return h


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes (length ``len - k + 1``, none if shorter)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        out = words[:n].copy()
        for j in range(1, k):
            out *= U64(0x9FB21C651E98DF25)
            out += words[j:j + n]
        return mix64(out)


def column_bytes(batch: pa.RecordBatch | pa.Table, name: str) -> list[bytes | None]:
    col = batch.column(name)
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    return col.cast(pa.binary()).to_pylist()


def ids_of(batch: pa.RecordBatch | pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Integer column as (values with 0 for null, valid mask)."""
    col = batch.column(name)
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    valid = col.is_valid().to_numpy(zero_copy_only=False)
    return pc.fill_null(col, 0).to_numpy(zero_copy_only=False).astype(np.int64), valid


def planes(values: np.ndarray) -> bytes:
    """Little-endian bytes grouped by significance: equal high bytes lie together and compress away."""
    a = np.ascontiguousarray(values)
    return a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()


def from_planes(raw: bytes, dtype) -> np.ndarray:
    dt = np.dtype(dtype)
    n = len(raw) // dt.itemsize
    return np.frombuffer(raw, np.uint8).reshape(dt.itemsize, n).T.copy().view(dt).reshape(n)


class SpanCache:
    """Bounded per-worker memory: word hash -> row of a value table.

    Keys lie in sorted runs, each less than half as long as the one before:
    a key is merged a logarithmic number of times, never at every ``add``.
    When the bound is reached the owner starts a fresh cache, so memory never
    follows the vocabulary of the corpus.
    """

    def __init__(self, limit: int = 1_000_000):
        self.limit = limit
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of every key, -1 where unknown."""
        out = np.full(len(keys), -1, np.int64)
        for known, rows in self.runs:
            at = np.searchsorted(known, keys)
            at[at == len(known)] = 0
            np.copyto(out, rows[at], where=known[at] == keys)
        return out

    def add(self, keys: np.ndarray, rows: np.ndarray) -> None:
        """Remember keys that ``find`` does not know."""
        if not len(keys):
            return
        self.runs.append((keys, rows))
        first = len(self.runs) - 1
        size = len(keys)
        while first and len(self.runs[first - 1][0]) < 2 * size:
            first -= 1
            size += len(self.runs[first][0])
        keys = np.concatenate([k for k, _ in self.runs[first:]])
        order = np.argsort(keys, kind="stable")
        self.runs[first:] = [(keys[order], np.concatenate([r for _, r in self.runs[first:]])[order])]

    def __len__(self) -> int:
        return sum(len(k) for k, _ in self.runs)

    def full(self) -> bool:
        return len(self) >= self.limit


class Grown:
    """An array that grows at its end; room doubles, so appending does not copy all of it each time."""

    def __init__(self, dtype, start=()):
        self.room = np.zeros(1024, dtype)
        self.size = 0
        self.append(np.asarray(start, dtype))

    def append(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.room):
            room = np.zeros(max(need, 2 * len(self.room)), self.room.dtype)
            room[:self.size] = self.room[:self.size]
            self.room = room
        self.room[self.size:need] = values
        self.size = need

    def view(self) -> np.ndarray:
        return self.room[:self.size]
