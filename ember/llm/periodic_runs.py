"""Operator 11: periodic runs of words, found on a Re-Pair grammar.

A run is a stretch of words with smallest period q (words q apart are equal)
and a length of at least max(``min_length``, ``min_exponent`` * q) that no
neighbouring word extends.

1. *Grammar.*  The word ids of a slice of documents are compressed by Re-Pair:
   every round replaces the pairs that are more frequent than the pairs they
   overlap with (ties in an order of their own, so a long repeat halves per
   round), until no pair occurs twice.  What is left of each document is closed
   by a balanced tree of single rules.  Rules never span two documents.
2. *Crossing runs.*  A rule's expansion is looked at once, at its first place:
   only runs that cross the boundary of its two halves.  One side of such a run
   holds two periods, so it is seen by comparing words q apart at a few points
   beside the boundary; what survives is extended word by word.  Multiples of a
   period that is known for the same stretch are passed over.
3. *Positions.*  The runs are moved to every place of the rule's derivation.
   A run of the document crosses the boundary of the lowest rule that holds it,
   so it is among them; shorter pieces of it, cut off by the borders of lower
   rules, have the same period and lie inside it, and go.

Words are numbered exactly (a dictionary, no hashes).  Tasks hold one slice of
about 1 MB of text, or one document where that is longer; nothing is shuffled.

Defined cases: null and empty texts have no words and no runs; null ids are
kept; repeated rows are answered one by one; equal words are equal bytes; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ember.llm import textkit as K
from ember.session import ship_package

PAIRS_AT_ONCE = 1 << 20       # (boundary, period) pairs compared at once


def word_ids(words: K.Words) -> np.ndarray:
    """A number for every word; equal numbers are equal bytes."""
    size = words.ends - words.starts
    inside = np.zeros(len(words.buf) + 1, np.int8)
    inside[words.starts] += 1
    inside[words.ends] -= 1
    body = words.buf[np.cumsum(inside[:-1]) > 0]
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    array = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
    return array.dictionary_encode().indices.to_numpy().astype(np.int64)


class Rules:
    """Rules of a grammar: words ``lo:hi`` at the first place, halves meeting at ``mid``, all places."""

    def __init__(self):
        self.lo, self.mid, self.hi, self.places, self.count = [], [], [], [], []

    def add(self, lo, mid, hi, places, count) -> None:
        """``places`` lists the places of the first rule, then of the next; ``count`` how many each has."""
        for held, new in zip((self.lo, self.mid, self.hi, self.places, self.count), (lo, mid, hi, places, count)):
            held.append(new)

    def close(self, least: int) -> None:
        """Join the parts and forget rules of fewer than ``least`` words."""
        none = [np.zeros(0, np.int64)]
        lo, mid, hi, places, count = (np.concatenate(x or none) for x in
                                      (self.lo, self.mid, self.hi, self.places, self.count))
        keep = hi - lo >= least
        self.places = places[np.repeat(keep, count)]
        self.lo, self.mid, self.hi = lo[keep], mid[keep], hi[keep]
        self.first = np.r_[0, np.cumsum(count[keep])]


def re_pair(ids: np.ndarray, bounds: np.ndarray, least: int = 6) -> Rules:
    """A grammar for the documents ``ids[bounds[d]:bounds[d + 1]]``; a document of two words or more has a root."""
    rules = Rules()
    sym, at = ids.astype(np.int64), np.arange(len(ids))
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    width = np.ones(len(ids), np.int64)
    fresh = int(ids.max()) + 1 if len(ids) else 0
    turn = 0
    while len(sym) > 1:
        turn += 1
        joint = doc[:-1] == doc[1:]
        # In a stretch of one symbol only every second pair counts.
        twin = joint & (sym[:-1] == sym[1:])
        place = np.arange(len(twin))
        begin = np.maximum.accumulate(np.where(np.r_[False, twin[:-1]], 0, place))
        joint &= ~(twin & ((place - begin) % 2 == 1))
        open_ = np.flatnonzero(joint)
        uniq, inverse, count = np.unique(sym[open_] * fresh + sym[open_ + 1], return_inverse=True, return_counts=True)
        if not len(uniq) or count.max() < 2:
            break
        with np.errstate(over="ignore"):
            order = K.mix64(uniq.astype(np.uint64) + np.uint64(turn) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)
        worth = np.where(count >= 2, np.minimum(count, (1 << 23) - 1).astype(np.uint64) << np.uint64(40) | order,
                         np.uint64(0))
        score = np.zeros(len(sym) + 1, np.uint64)
        score[open_ + 1] = worth[inverse]
        chosen = score[open_ + 1] > np.maximum(score[open_], np.r_[score, np.uint64(0)][open_ + 2])
        chosen &= np.bincount(inverse[chosen], minlength=len(uniq))[inverse] >= 2
        if not chosen.any():
            break
        left, kind = open_[chosen], inverse[chosen]
        by_kind = np.argsort(kind, kind="stable")
        used, first, number, n = np.unique(kind[by_kind], return_index=True, return_inverse=True, return_counts=True)
        lead = left[by_kind][first]
        rules.add(at[lead], at[lead + 1], at[lead + 1] + width[lead + 1], at[left[by_kind]], n)
        sym[left[by_kind]] = fresh + number
        fresh += len(used)
        width[left] += width[left + 1]
        keep = np.ones(len(sym), bool)
        keep[left + 1] = False
        sym, at, doc, width = sym[keep], at[keep], doc[keep], width[keep]
    while len(at) > 1:
        head = np.r_[True, doc[1:] != doc[:-1]]
        place = np.arange(len(at))
        inside = place - np.maximum.accumulate(np.where(head, place, 0))
        left = np.flatnonzero((inside[:-1] % 2 == 0) & ~head[1:])
        if not len(left):
            break
        rules.add(at[left], at[left + 1], at[left + 1] + width[left + 1], at[left], np.ones(len(left), np.int64))
        width[left] += width[left + 1]
        keep = np.ones(len(at), bool)
        keep[left + 1] = False
        at, doc, width = at[keep], doc[keep], width[keep]
    rules.close(least)
    return rules


def _stretch(ids: np.ndarray, i: int, q: int, lo: int, hi: int) -> tuple[int, int]:
    """The longest stretch inside ``lo:hi`` around the equal words ``i`` and ``i + q`` that has period ``q``."""
    end, step = i + 1, 32
    while end < hi - q:
        stop = min(end + step, hi - q)
        differ = ids[end:stop] != ids[end + q:stop + q]
        if differ.any():
            end += int(differ.argmax())
            break
        end, step = stop, step * 4
    begin, step = i, 32
    while begin > lo:
        stop = max(begin - step, lo)
        differ = ids[stop:begin] != ids[stop + q:begin + q]
        if differ.any():
            begin -= int(differ[::-1].argmax())
            break
        begin, step = stop, step * 4
    return begin, end + q


def _seen(ids, mid, side, q, min_length):
    """Which (rule, side, period) may have a run: words q apart are equal at points of the two periods beside the boundary."""
    reach = np.maximum(2 * q, (min_length + 1) // 2) - q
    ok = np.arange(len(q))
    for part in (0, 4, 2, 1, 3):
        back = (reach[ok] - 1) * part // 4
        i = np.where(side[ok] == 0, mid[ok] + back, mid[ok] - 1 - q[ok] - back)
        ok = ok[ids[i] == ids[i + q[ok]]]
    return ok


def crossing_runs(ids: np.ndarray, rules: Rules, min_length: int, min_exponent: int):
    """(rule, start, end, period) of the runs inside every rule that cross its boundary."""
    lo, mid, hi = rules.lo, rules.mid, rules.hi
    least = (min_length + 1) // 2
    most = [np.where(part >= least, np.minimum((hi - lo) // min_exponent, part // 2), 0) for part in (hi - mid, mid - lo)]
    rule = np.tile(np.arange(len(lo)), 2)
    side = np.repeat([0, 1], len(lo))
    number = np.concatenate(most)
    order = np.lexsort((side, rule))
    rule, side, number = rule[order], side[order], number[order]
    keep = number > 0
    rule, side, number = rule[keep], side[keep], number[keep]
    total = np.cumsum(number)
    out: list[tuple[int, int, int, int]] = []
    a = 0
    while a < len(rule):
        base = total[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(total, base + PAIRS_AT_ONCE, side="right")))
        n = number[a:b]
        which = np.repeat(np.arange(a, b), n)
        q = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + 1
        r = rule[which]
        ok = _seen(ids, mid[r], side[which], q, min_length)
        which, q = which[ok], q[ok]
        cuts = np.flatnonzero(np.r_[True, which[1:] != which[:-1], True]) if len(which) else [0]
        for x, y in zip(cuts[:-1], cuts[1:]):
            r, s = int(rule[which[x]]), int(side[which[x]])
            left, border, right = int(lo[r]), int(mid[r]), int(hi[r])
            rest = q[x:y]
            while len(rest):
                p = int(rest[0])
                begin, end = _stretch(ids, border if s == 0 else border - 1 - p, p, left, right)
                rest = rest[1:]
                if end - begin < max(min_length, min_exponent * p):
                    continue
                if begin < border < end:
                    out.append((r, begin, end, p))
                inside = border + 2 * rest <= end if s == 0 else border - 2 * rest >= begin
                rest = rest[~((rest % p == 0) & inside)]
        a = b
    return np.array(out, np.int64).reshape(-1, 4)


def find_runs(ids: np.ndarray, bounds: np.ndarray, min_length: int = 6, min_exponent: int = 4):
    """(start, end, period) of all runs, by start and period; positions are those of ``ids``."""
    rules = re_pair(ids, bounds, min_length)
    found = crossing_runs(ids, rules, min_length, min_exponent)
    if not len(found):
        return np.zeros((0, 3), np.int64)
    rule, begin, end, period = found.T
    n = rules.first[rule + 1] - rules.first[rule]
    row = np.repeat(np.arange(len(rule)), n)
    place = rules.places[rules.first[rule][row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)]
    move = place - rules.lo[rule][row]
    begin, end, period = begin[row] + move, end[row] + move, period[row]
    # The smallest period of a stretch, then the stretches that no other of their period holds.
    order = np.lexsort((period, end, begin))
    begin, end, period = begin[order], end[order], period[order]
    keep = np.r_[True, (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])]
    begin, end, period = begin[keep], end[keep], period[keep]
    order = np.lexsort((-end, begin, period))
    begin, end, period = begin[order], end[order], period[order]
    reach = np.maximum.accumulate(period * (len(ids) + 1) + end)
    keep = np.r_[True, period[1:] * (len(ids) + 1) + end[1:] > reach[:-1]]
    begin, end, period = begin[keep], end[keep], period[keep]
    order = np.lexsort((period, begin))
    return np.stack([begin[order], end[order], period[order]], axis=1)


_RESULT = ("doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _answer(min_length: int, min_exponent: int):
    def run(batches):
        for batch in batches:
            for part in K.byte_slices(batch, "text"):
                texts = K.column_bytes(part, "text")
                words = K.Words(texts)
                first = words.first
                runs = find_runs(word_ids(words), first, min_length, min_exponent)
                doc = np.searchsorted(first, runs[:, 0], side="right") - 1
                cut = np.searchsorted(doc, np.arange(len(texts) + 1))
                listed, collapsed = [], []
                for d, text in enumerate(texts):
                    mine = runs[cut[d]:cut[d + 1]] - [first[d], first[d], 0]
                    kept = (text or b"").split()
                    listed.append([{"start": s, "length": e - s, "period": p} for s, e, p in mine.tolist()])
                    if len(mine):
                        drop = np.zeros(len(kept) + 1, np.int64)
                        np.add.at(drop, mine[:, 0] + mine[:, 2], 1)
                        np.add.at(drop, mine[:, 1], -1)
                        kept = [kept[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0)]
                    collapsed.append(b" ".join(kept))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(first), pa.int64()), pa.array(listed, _RUN),
                     pa.array(collapsed, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, *, min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """doc_id, n_words, runs (by start, then period), collapsed of every row of ``docs(doc_id, text)``.

    ``collapsed`` has the words that no run holds after its first period, joined
    by one space.  Runs of less than four periods are not looked for.
    """
    if min_exponent < 4 or min_length < 1:
        raise ValueError("min_exponent is 4 or more, min_length 1 or more")
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_answer(min_length, min_exponent), _RESULT)
