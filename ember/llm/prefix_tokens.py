"""Operator 6: exact token counts of every prefix, by dynamic programming.

For a BPE vocabulary a token sequence is the encoding of its text exactly
when every token encodes to itself and every two neighbours encode to
themselves together.  So the encoding of a prefix ends in the one token that
fits behind the encoding of the shorter prefix, and

    count[i] = count[i - len(last[i])] + 1

gives the exact count at every prefix in one pass; truncation and budget
questions are then look-ups (``cut_chars``), without encoding again.

No piece of the vocabulary has the space mark after another character, so
prefixes of a text are whole segments (spaces and the run behind them) plus a
prefix of one segment.  Segments repeat: each distinct one gets its prefix
table once per worker (a bounded cache), and a text's table is the running
sum over its segments.  The new segments of a slice advance together: a trie
of the reversed vocabulary, held as arrays, gives every token that ends at
every position, and the programme takes one array step for each (position,
token length).  A character outside the vocabulary counts as its UTF-8 bytes
(byte fallback).

Defined cases: null and empty texts have 0 tokens; null ids are kept; strings
that look like control tokens are ordinary text, as the library treats them;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ember.llm import textkit as K
from ember.session import ship_package

MARK = "▁"
LONG_SEGMENT = 64             # longer segments are not kept in the cache
PAIRS = 500_000               # remembered pairs; beyond, they are found again


class PrefixBpe:
    """Prefix counts for a sentencepiece BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size())
                      if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        if any(MARK in p.lstrip(MARK) for p in self.score):
            raise ValueError("the vocabulary has a space mark inside a piece: segments are not independent")
        self.longest = max(map(len, self.score))
        self.own = {p for p in self.score if len(p) == 1 or self._merge(p) == [p]}
        self.pairs: dict[int, bool] = {}
        self.names = sorted(self.own)
        self._reversed_trie()

    def _reversed_trie(self) -> None:
        """Edges ``node << 21 | character`` in order, their children, and the token that ends a path."""
        edges: dict[int, int] = {}
        token = {}
        for t, name in enumerate(self.names):
            node = 0
            for c in reversed(name):
                node = edges.setdefault(node << 21 | ord(c), len(edges) + 1)
            token[node] = t
        self.edge = np.array(sorted(edges), np.int64)
        self.child = np.array([edges[e] for e in self.edge.tolist()], np.int64)
        self.token = np.full(len(edges) + 1, -1, np.int64)
        self.token[list(token)] = list(token.values())

    def _merge(self, text: str) -> list[str]:
        """The BPE merges of a short string: best score first, leftmost on ties."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _name(self, token: int) -> str:
        """A token's text; tokens from ``len(names)`` are characters outside the vocabulary."""
        return self.names[token] if token < len(self.names) else chr(token - len(self.names))

    def _fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each pair of neighbouring tokens encodes to itself."""
        keys = (left << 32 | right).tolist()
        known = self.pairs
        if len(known) > PAIRS:
            known.clear()
        for key in set(keys).difference(known):
            a, b = self._name(key >> 32), self._name(key & 0xFFFFFFFF)
            known[key] = self._merge(a + b) == [a, b]
        return np.fromiter(map(known.__getitem__, keys), bool, len(keys))

    def _ending(self, chars: np.ndarray, place: np.ndarray):
        """Every token that ends at a character: (index of the character, length, token), in array parts."""
        ends, node, width = np.arange(len(chars)), np.zeros(len(chars), np.int64), 0
        found = []
        single = np.zeros(len(chars), bool)
        while len(ends):
            key = node << 21 | chars[ends - width]
            at = np.searchsorted(self.edge, key)
            at[at == len(self.edge)] = 0
            hit = self.edge[at] == key
            ends, node, width = ends[hit], self.child[at[hit]], width + 1
            token = self.token[node]
            is_token = token >= 0
            found.append((ends[is_token], np.full(int(is_token.sum()), width), token[is_token]))
            if width == 1:
                single[found[0][0]] = True
            longer = place[ends] >= width
            ends, node = ends[longer], node[longer]
        odd = np.flatnonzero(~single)
        found.append((odd, np.ones(len(odd), np.int64), len(self.names) + chars[odd]))
        return [np.concatenate(part) for part in zip(*found)]

    def many(self, chars: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """``prefixes`` of segments that lie one behind another in ``chars`` (code points, marks for spaces)."""
        chars = chars.astype(np.int64)
        place = np.arange(len(chars)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        end, width, token = self._ending(chars, place)
        order = np.lexsort((-width, place[end]))
        end, width, token = end[order], width[order], token[order]
        step = place[end] << 32 | width
        cuts = np.flatnonzero(np.diff(step, prepend=-1, append=-1))
        cost = np.where(token < len(self.names), 1, 1 + (chars[end] > 0x7F) + (chars[end] > 0x7FF) + (chars[end] > 0xFFFF))
        count, last = np.zeros(len(chars), np.int32), np.full(len(chars), -1, np.int64)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            w = int(width[a])
            open_ = np.flatnonzero(last[end[a:b]] < 0) + a          # no longer token has been taken there
            at, new, more = end[open_], token[open_], cost[open_]
            if int(place[end[a]]) == w - 1:
                count[at], last[at] = more, new
                continue
            before = at - w
            fits = new >= len(self.names)
            known = np.flatnonzero(~fits)
            fits[known] = self._fit(last[before[known]], new[known])
            at, before = at[fits], before[fits]
            count[at], last[at] = count[before] + more[fits], new[fits]
        return count

    def prefixes(self, segment: str) -> list[int]:
        """Tokens of ``segment[:i]`` for every i from 1; spaces are already marks.

        One segment alone, for those too long to be worth array steps.
        """
        n = len(segment)
        count, last = [0] * (n + 1), [""] * (n + 1)
        own, longest, merge = self.own, self.longest, self._merge
        pairs: dict[tuple[str, str], bool] = {}

        def fits(left: str, right: str) -> bool:
            known = pairs.get((left, right))
            if known is None:
                if len(pairs) > PAIRS:
                    pairs.clear()
                known = pairs[left, right] = merge(left + right) == [left, right]
            return known

        for i in range(1, n + 1):
            for j in range(max(0, i - longest), i):
                token = segment[j:i]
                if token in own:
                    if j == 0 or fits(last[j], token):
                        count[i], last[i] = count[j] + 1, token
                        break
                elif j == i - 1 and token not in self.score:
                    count[i], last[i] = count[j] + len(token.encode()), token
        return count[1:]


class _Worker:
    """One vocabulary and one bounded cache of segment tables per Python worker."""

    known: dict[str, _Worker] = {}

    def __init__(self, path: str):
        self.bpe = PrefixBpe(path)
        self.cache = K.SpanCache()
        self._fresh()

    def _fresh(self) -> None:
        self.cache = K.SpanCache(self.cache.limit)
        self.offset, self.flat = K.Grown(np.int64, [0]), K.Grown(np.int32)

    @classmethod
    def get(cls, path: str) -> _Worker:
        if path not in cls.known:
            cls.known[path] = cls(path)
        return cls.known[path]

    def tables(self, raw: bytes, starts: np.ndarray, ends: np.ndarray):
        """Offsets and lengths of every segment's prefix counts in one flat array."""
        key = K.span_hashes(raw, starts, ends)
        uniq, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        if self.cache.full():
            self._fresh()
        row = self.cache.find(uniq)
        new = np.flatnonzero(row < 0)
        at = first[new]
        short = ends[at] - starts[at] <= LONG_SEGMENT
        fresh, at = new[short], at[short]
        if len(fresh):
            chars, sizes = _code_points(raw, starts[at], ends[at])
            row[fresh] = np.arange(len(fresh)) + self.offset.size - 1
            self.cache.add(uniq[fresh], row[fresh])
            self.offset.append(self.flat.size + np.cumsum(sizes))
            self.flat.append(self.bpe.many(chars, sizes))
        flat, offset = self.flat.view(), self.offset.view()
        if not short.all():
            alone = [np.array(self.bpe.prefixes(raw[starts[i]:ends[i]].decode().replace(" ", MARK)), np.int32)
                     for i in first[new[~short]]]
            row[new[~short]] = np.arange(len(alone)) + len(offset) - 1
            offset = np.concatenate([offset, len(flat) + np.cumsum([len(c) for c in alone])])
            flat = np.concatenate([flat, *alone])
        row = row[inverse]
        return flat, offset[row], offset[row + 1]


def _code_points(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of byte spans, one span behind another with marks for spaces, and each span's number of them."""
    size = ends - starts
    upto = np.cumsum(size)
    text = np.frombuffer(raw, np.uint8)[np.arange(upto[-1]) + np.repeat(starts - upto + size, size)]
    chars = np.frombuffer(text.tobytes().decode().encode("utf-32-le"), "<u4").copy()
    chars[chars == 0x20] = ord(MARK)
    lead = np.r_[0, np.cumsum((text & 0xC0) != 0x80)]
    return chars, lead[upto] - lead[upto - size]


def _segments(texts: list[bytes | None]):
    """Texts with the leading space the library adds, and their segments as byte spans."""
    parts = [b" " + t.replace(MARK.encode(), b" ") if t else b"" for t in texts]
    raw = b"".join(parts)
    buf = np.frombuffer(raw, np.uint8)
    bounds = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=bounds[1:])
    space = buf == 0x20
    start = space.copy()
    start[1:] &= ~space[:-1]
    start[bounds[:-1][np.diff(bounds) > 0]] = True
    starts = np.flatnonzero(start)
    ends = np.append(starts[1:], len(buf))[:len(starts)]
    return raw + b"\0" * 8, starts, ends, np.searchsorted(starts, bounds)


def _count(path: str, limit: int):
    def run(batches):
        worker = _Worker.get(path)
        for batch in batches:
            for part in K.byte_slices(batch, "text"):
                raw, starts, ends, first = _segments(K.column_bytes(part, "text"))
                flat, lo, hi = worker.tables(raw, starts, ends)
                total = flat[hi - 1] if len(hi) else np.zeros(0, np.int32)
                run_tokens = np.r_[0, np.cumsum(total, dtype=np.int64)]
                run_chars = np.r_[0, np.cumsum(hi - lo, dtype=np.int64)]
                tokens, cuts = [], []
                for d in range(part.num_rows):
                    a, b = int(first[d]), int(first[d + 1])
                    n = int(run_tokens[b] - run_tokens[a])
                    tokens.append(n)
                    chars = int(run_chars[b] - run_chars[a])
                    if n > limit:
                        s = int(np.searchsorted(run_tokens[a:b + 1], run_tokens[a] + limit, side="right")) - 1 + a
                        # Counts inside a segment can fall when a character completes a longer token.
                        inside = flat[lo[s]:hi[s]] + (run_tokens[s] - run_tokens[a])
                        fits = np.flatnonzero(inside <= limit)
                        chars = int(run_chars[s] - run_chars[a]) + (int(fits[-1]) + 1 if len(fits) else 0)
                    cuts.append(max(0, chars - 1))          # without the added space
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_bytes"), pa.array(tokens, pa.int64()),
                     pa.array([t > limit for t in tokens]), pa.array(cuts, pa.int64())],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit", "cut_chars"])

    return run


def count_tokens(docs: DataFrame, model_path: str, *, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, cut_chars of every row of ``docs(doc_id, text)``.

    ``cut_chars`` is the longest prefix, in characters, of at most ``limit`` tokens.
    """
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.octet_length(text).cast("long").alias("n_bytes"))
    return rows.mapInArrow(_count(model_path, limit),
                           "doc_id long, n_bytes long, n_tokens long, over_limit boolean, cut_chars long")


def _tables(path: str):
    def run(batches):
        worker = _Worker.get(path)
        for batch in batches:
            for part in K.byte_slices(batch, "text"):
                raw, starts, ends, first = _segments(K.column_bytes(part, "text"))
                flat, lo, hi = worker.tables(raw, starts, ends)
                out = []
                for d in range(part.num_rows):
                    before, row = 0, []
                    for s in range(int(first[d]), int(first[d + 1])):
                        counts = flat[lo[s]:hi[s]] + before
                        before = int(counts[-1])
                        row.append(counts)
                    out.append(np.concatenate(row)[1:].tolist() if row else [])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.list_(pa.int32()))],
                                                 names=["doc_id", "prefix_tokens"])

    return run


def prefix_table(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id and the token count of every prefix of 1, 2, ... characters of the text."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_tables(model_path), "doc_id long, prefix_tokens array<int>")
