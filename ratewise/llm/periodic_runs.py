"""Runs of periodic words by internal pattern matching.

A text is a sequence of words.  A run is a stretch of words with smallest period q (words q apart are
identical) and at least ``max(LEAST, REPEATS * q)`` words that no neighbouring word extends.

One index serves a chunk of whole texts, which are put one after the other with separators that match
nothing: the suffix array of its words by doubling, and a wavelet tree over it.  Doubling also names
the dyadic blocks (2**k words from a multiple of 2**k on) and gives each its interval of the suffix
array.  A run of period q holds an aligned block of b words, b <= q < 2b, whose shift by q it holds
too; so each block asks the wavelet tree for its occurrences in the neighbouring window of starts from
b to 2b - 1 further on: how many, the first and the second (range successor); blocks with a word that does not recur within
that distance are passed over.  In a window that short
the occurrences form one arithmetic progression, and its members are the candidate periods.  Neighbouring
blocks with one candidate make a chain, which is extended by less than a block at either end.  Levels
rise, so a run of a smaller period is known before its multiples are looked at, and a stretch that
lies inside it is left out.

Defined results: null, empty and blank texts have no words and no runs; any text length is taken, the
index grows in proportion to the longest text.  Rows are independent of each other, so repeated rows,
ties and further columns change nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ratewise.llm.common import chunks, text_bytes, word_identities, words

REPEATS = 4                 # periods a run spans at least
LEAST = 6                   # words a run has at least

RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
RESULT = "struct<runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: binary>"


class WaveletTree:
    """Levelwise wavelet tree over integers below ``2 ** bits``: counts and order statistics of intervals."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values)).bit_length())
        self.levels = []
        for b in range(self.bits - 1, -1, -1):
            bit = (values >> b & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            block = np.zeros(len(values) // 64 + 1, dtype=np.uint64)
            block.view(np.uint8)[:len(packed)] = packed
            before = np.zeros(len(block), dtype=np.int64)
            np.cumsum(np.bitwise_count(block[:-1]), out=before[1:])
            self.levels.append((b, block, before, len(values) - int(bit.sum())))
            values = np.concatenate([values[~bit], values[bit]])

    @staticmethod
    def _ones(block: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[at >> 6] + np.bitwise_count(block[at >> 6] & low)

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of [lo, hi) are below x."""
        x = np.minimum(x, (1 << self.bits) - 1)
        count = np.zeros(len(lo), dtype=np.int64)
        for b, block, before, zeros in self.levels:
            left, right = self._ones(block, before, lo), self._ones(block, before, hi)
            one = (x >> b & 1).astype(bool)
            count += np.where(one, (hi - lo) - (right - left), 0)
            lo, hi = np.where(one, zeros + left, lo - left), np.where(one, zeros + right, hi - right)
        return count

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value of [lo, hi), from 0."""
        value = np.zeros(len(lo), dtype=np.int64)
        for b, block, before, zeros in self.levels:
            left, right = self._ones(block, before, lo), self._ones(block, before, hi)
            none = (hi - lo) - (right - left)
            one = k >= none
            k = np.where(one, k - none, k)
            value |= one.astype(np.int64) << b
            lo, hi = np.where(one, zeros + left, lo - left), np.where(one, zeros + right, hi - right)
        return value


def _grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys: index of the first equal one, and one past the last."""
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(key)))
    return np.repeat(first, size), np.repeat(first + size, size)


def blocks_and_suffixes(text: np.ndarray, longest: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Intervals (lo, hi) in the suffix array of the aligned blocks of 1, 2, 4 ... words, as far as a run
    of ``longest`` words can need, and the suffix array.  All suffixes of ``text`` must differ."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    lo, hi = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    lo[order], hi[order] = _grouped(text[order])
    levels, width = [], 1
    while True:
        if REPEATS * width <= longest:
            levels.append((lo[::width].copy(), hi[::width].copy()))
        same = np.flatnonzero(hi - lo > 1)
        if not len(same):
            break
        follow = np.full(len(same), -1, dtype=np.int64)
        inside = same + width < n
        follow[inside] = lo[same[inside] + width]
        order = np.argsort(lo[same] * (n + 1) + follow + 1, kind="stable")
        same, follow = same[order], follow[order]
        old = lo[same]
        base, _ = _grouped(old)
        first, last = _grouped(old * (n + 1) + follow + 1)
        lo[same], hi[same] = old + first - base, old + last - base
        width *= 2
    suffixes = np.empty(n, dtype=np.int64)
    suffixes[lo] = np.arange(n)
    return levels, suffixes


def next_distances(text: np.ndarray) -> np.ndarray:
    """How far on each number occurs again; the length of the text where it does not."""
    order = np.argsort(text, kind="stable")
    out = np.full(len(text), len(text), dtype=np.int64)
    same = np.flatnonzero(text[order[1:]] == text[order[:-1]])
    out[order[same]] = order[same + 1] - order[same]
    return out


def _candidates(tree: WaveletTree, lo: np.ndarray, hi: np.ndarray, far: np.ndarray, width: int,
                reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of aligned blocks, and the periods that the progressions of their occurrences give.  ``far``: the
    largest distance of a block's words to their next occurrence, which no period can be below."""
    at = np.flatnonzero((hi - lo > 1) & (far < 2 * width))
    lo, hi, at = lo[at], hi[at], at * width
    open_ = reach[at] < at + 2 * width                       # not well inside a run of a smaller period
    lo, hi, at = lo[open_], hi[open_], at[open_]
    skip = tree.below(lo, hi, at + width)
    count = tree.below(lo, hi, at + 2 * width) - skip
    some = np.flatnonzero(count)
    lo, hi, at, skip, count = lo[some], hi[some], at[some], skip[some], count[some]
    first = tree.smallest(lo, hi, skip)
    step = np.zeros(len(at), dtype=np.int64)
    more = np.flatnonzero(count > 1)
    step[more] = tree.smallest(lo[more], hi[more], skip[more] + 1) - first[more]
    turn = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = np.repeat(at, count)
    period = np.repeat(first, count) + turn * np.repeat(step, count) - start
    open_ = reach[start] < start + period + width
    return start[open_], period[open_]


def _extended(text: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of equal words ``period`` apart, extended by up to ``width`` at both ends."""
    n = len(text)
    if width <= 64:
        for sign, edge, stop in ((-1, start, 0), (1, end, n)):
            live = np.arange(len(edge))
            for _ in range(width):
                at = edge[live] - 1 if sign < 0 else edge[live]
                live, at = (live[at >= 0], at[at >= 0]) if sign < 0 else (
                    live[at + period[live] < stop], at[at + period[live] < stop])
                live = live[text[at] == text[at + period[live]]]
                if not len(live):
                    break
                edge[live] += sign
    else:
        for k in range(len(start)):
            a, e, q = int(start[k]), int(end[k]), int(period[k])
            left = max(0, a - width)
            unlike = np.flatnonzero(text[left:a] != text[left + q:a + q])
            start[k] = left + int(unlike[-1]) + 1 if len(unlike) else left
            right = min(n - q, e + width)
            unlike = np.flatnonzero(text[e:right] != text[e + q:right + q])
            end[k] = e + int(unlike[0]) if len(unlike) else max(e, right)
    return start, end


def runs(text: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length, period of all runs of a sequence of numbers whose suffixes all differ, by start and period;
    no run is longer than ``longest``."""
    none = np.zeros(0, dtype=np.int64)
    if longest < LEAST:
        return none, none, none
    levels, suffixes = blocks_and_suffixes(text, longest)
    tree = WaveletTree(suffixes)
    reach = np.zeros(len(text) + 1, dtype=np.int64)          # how far runs found so far reach that start up to here
    found = []
    far = next_distances(text)
    for k, (lo, hi) in enumerate(levels):
        width = 1 << k
        if k:
            far = np.maximum(far[::2], np.append(far[1::2], far[-1:] if len(far) % 2 else far[:0]))
        at, period = _candidates(tree, lo, hi, far, width, reach)
        if not len(at):
            continue
        order = np.lexsort((at, period))
        at, period = at[order], period[order]
        new = np.append(True, (period[1:] != period[:-1]) | (at[1:] != at[:-1] + width))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        long = at[last] + width - at[first] + 2 * width > (REPEATS - 1) * period[first]
        first, last = first[long], last[long]
        period = period[first]
        start, end = _extended(text, at[first].copy(), at[last] + width, period, width)
        length = end - start + period
        whole = (length >= np.maximum(LEAST, REPEATS * period)) & (reach[start] < start + length)
        start, length, period = start[whole], length[whole], period[whole]
        found.append((start, length, period))
        np.maximum.at(reach, start, start + length)
        np.maximum.accumulate(reach, out=reach)
    if not found:
        return none, none, none
    start, length, period = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _chunk(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Runs and collapsed text of each row."""
    n = len(offsets) - 1
    w_start, w_end, row = words(data, offsets)
    names = np.unique(word_identities(data, w_start, w_end), return_inverse=True)[1].astype(np.int64)
    count = np.bincount(row, minlength=n)
    bounds = np.concatenate([[0], np.cumsum(count)])
    place = np.arange(len(names)) + row                      # a separator after each row
    text = np.empty(len(names) + n, dtype=np.int64)
    text[place] = names
    text[bounds[1:] + np.arange(n)] = len(names) + np.arange(n)
    start, length, period = runs(text, int(count.max(initial=0)))

    base = bounds[:-1] + np.arange(n)
    own = np.searchsorted(base, start, side="right") - 1
    ends = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=n))])
    listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(start - base[own]), pa.array(length), pa.array(period)], ["start", "length", "period"]))

    change = np.zeros(len(text) + 1, dtype=np.int64)         # the words after a run's first period go
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    keep = np.cumsum(change)[place] == 0
    size = (w_end - w_start)[keep]
    kept_row = row[keep]
    last = np.append(kept_row[1:] != kept_row[:-1], True) if len(kept_row) else np.zeros(0, bool)
    wide = size + ~last                                      # a space between words
    out_at = np.cumsum(wide) - wide
    out = np.full(int(wide.sum()), 32, dtype=np.uint8)
    within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(out_at, size) + within] = data[np.repeat(w_start[keep], size) + within]
    total = np.concatenate([[0], np.cumsum(np.bincount(kept_row, weights=wide, minlength=n).astype(np.int64))])
    text_out = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(total.astype(np.int32).tobytes()), pa.py_buffer(out.tobytes())])
    return listed, text_out


def _batch(texts: pa.Array) -> pa.Array:
    parts = [_chunk(data, offsets) for _, _, data, offsets in chunks(texts)]
    if not parts:
        return pa.StructArray.from_arrays([pa.array([], RUNS), pa.array([], pa.binary())], ["runs", "collapsed"])
    return pa.StructArray.from_arrays([pa.concat_arrays([p[0] for p in parts]), pa.concat_arrays([p[1] for p in parts])],
                                      ["runs", "collapsed"])


def periodic_runs(text: str | Column) -> Column:
    """Struct of ``runs`` (start, length, period in words; by start, then period) and ``collapsed``, the
    words that lie in no run after its first period, joined by one space (UTF-8 bytes)."""
    return F.arrow_udf(_batch, RESULT).asNondeterministic()(text_bytes(text))
