"""Suffix arrays by induced sorting, and permuted common prefixes.

Bytes are induced a whole bucket at a time with array operations; the string of substring names that
this leaves is sorted by prefix doubling.
"""

from __future__ import annotations

import numpy as np

from ratewise.llm.common import mix, powers


def _types(text: np.ndarray) -> np.ndarray:
    """True for S-type suffixes (smaller than the next one); the last symbol is S."""
    n = len(text)
    differs = np.flatnonzero(text[:-1] != text[1:])
    out = np.zeros(n, dtype=bool)
    out[-1] = True
    if len(differs):
        at = np.searchsorted(differs, np.arange(n - 1))
        known = at < len(differs)
        place = differs[at[known]]
        out[:-1][known] = text[place] < text[place + 1]
    return out


def _names(text: np.ndarray, lms: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, int]:
    """Name of each leftmost-smaller substring (text order) by rank among the distinct ones; ``order``
    holds the substrings' starts sorted."""
    up, down = powers(len(text) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(text.astype(np.uint64)) * up[:len(text)])])
    end = np.append(lms[1:] + 1, len(text))                   # its closing symbol included
    key = mix((sums[end] - sums[lms]) * down[lms]) ^ (end - lms).astype(np.uint64)
    rank = np.searchsorted(lms, order)
    ordered = key[rank]
    name = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
    out = np.empty(len(lms), dtype=np.int64)
    out[rank] = name
    return out, int(name[-1]) + 1


def _induce(text: np.ndarray, s_type: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Suffix array induced from leftmost-smaller suffixes given in order (per first symbol)."""
    n, symbols = len(text), len(sizes)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    sa = np.full(n, -1, dtype=np.int64)
    seeds_by = text[lms]
    seed_count = np.bincount(seeds_by, minlength=symbols)
    seeds = lms[np.argsort(seeds_by, kind="stable")]
    seed_at = np.cumsum(seed_count) - seed_count

    def place(batch: np.ndarray, want_s: bool) -> np.ndarray:
        """Predecessors of a batch that have the wanted type, in the batch's order."""
        before = batch[batch > 0] - 1
        return before[s_type[before] == want_s]

    # L-type suffixes, buckets upwards; in a bucket they precede the seeds
    head = starts.copy()
    for c in range(symbols):
        if not sizes[c]:
            continue
        done = starts[c]
        seeded = False
        while True:
            if done < head[c]:
                batch, done = sa[done:head[c]], head[c]
            elif not seeded:
                batch, seeded = seeds[seed_at[c]:seed_at[c] + seed_count[c]], True
            else:
                break
            new = place(batch, False)
            if len(new):
                _append(sa, new, text[new], head, 1)
    # S-type suffixes, buckets downwards; they fill a bucket from its end
    tail = ends.copy()
    for c in range(symbols - 1, -1, -1):
        if not sizes[c]:
            continue
        done = ends[c]
        while done > tail[c]:
            batch, done = sa[tail[c]:done][::-1], tail[c]
            new = place(batch, True)
            if len(new):
                _append(sa, new, text[new], tail, -1)
        batch = sa[starts[c]:head[c]][::-1]
        new = place(batch, True)
        if len(new):
            _append(sa, new, text[new], tail, -1)
    return sa


def _append(sa: np.ndarray, new: np.ndarray, symbol: np.ndarray, edge: np.ndarray, step: int) -> None:
    """Put positions into their buckets, in order, from each bucket's edge onwards."""
    order = np.argsort(symbol, kind="stable")
    s = symbol[order]
    first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    count = np.diff(np.append(first, len(s)))
    within = np.arange(len(s)) - np.repeat(first, count)
    if step > 0:
        sa[edge[s] + within] = new[order]
        edge[s[first]] += count
    else:
        sa[edge[s] - 1 - within] = new[order]
        edge[s[first]] -= count


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of integers >= 1 over a small alphabet; a closing sentinel 0 is added and left out
    of the result."""
    if not len(text):
        return np.zeros(0, dtype=np.int64)
    t = np.append(text, 0).astype(np.uint16)
    s_type = _types(t)
    lms = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    sizes = np.bincount(t)
    tail_only = _with_sentinel(_induce(t, s_type, lms, sizes), len(t))
    is_lms = np.zeros(len(t), dtype=bool)
    is_lms[lms] = True
    order = tail_only[is_lms[tail_only]]
    names, kinds = _names(t, lms, order)
    if kinds < len(lms):
        order = lms[_sorted_suffixes(names, kinds)]
    return _with_sentinel(_induce(t, s_type, order, sizes), len(t))[1:]


def _with_sentinel(sa: np.ndarray, n: int) -> np.ndarray:
    """The sentinel is a seed that no suffix induces."""
    sa[0] = n - 1
    return sa


def _sorted_suffixes(text: np.ndarray, symbols: int) -> np.ndarray:
    """Suffix array of a string over 0 .. ``symbols`` - 1 whose last symbol is its single smallest one, by
    prefix doubling; a round sorts only the suffixes that are not told apart yet."""
    n = len(text)
    sizes = np.bincount(text, minlength=symbols)
    sa = np.argsort(text, kind="stable")
    rank = (np.cumsum(sizes) - sizes)[text]                   # first place of the suffix's group
    places = np.flatnonzero(sizes[text[sa]] > 1)              # of suffixes that share a group
    known = 1                                                 # symbols that the groups agree on
    while len(places):
        own = sa[places]                                      # their first symbols don't reach the last one,
        key = rank[own] * n + rank[own + known]               # so own + known is inside
        order = np.argsort(key, kind="stable")
        own, key = own[order], key[order]
        sa[places] = own
        first = np.append(True, key[1:] != key[:-1])
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(key)))
        rank[own] = np.repeat(places[starts], sizes)
        places = places[np.repeat(sizes > 1, sizes)]
        known *= 2
    return sa


def permuted_common_prefixes(text: np.ndarray, sa: np.ndarray, limit: int) -> np.ndarray:
    """For each position in text order, the length (at most ``limit``) that its suffix has in common
    with the suffix before it in the suffix array."""
    n = len(text)
    out = np.zeros(n, dtype=np.int64)
    if n < 2:
        return out
    before = np.full(n, -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate([text.astype(np.uint16), np.zeros(limit + 8, np.uint16)])
    padded[n] = 0xFFFF                                          # the end differs from every symbol
    word = padded[:n + limit + 4].astype(np.uint64)
    for k in range(1, 4):                                       # four symbols at a time
        word |= padded[k:k + n + limit + 4].astype(np.uint64) << np.uint64(16 * k)
    live = np.flatnonzero(before >= 0)
    length = 0
    while len(live) and length + 4 <= limit:
        same = word[live + length] == word[before[live] + length]
        rest = live[~same]
        own = np.full(len(rest), length)
        for k in range(3):
            go = (own == length + k) & (padded[rest + length + k] == padded[before[rest] + length + k])
            own += go
        out[rest] = own
        live = live[same]
        length += 4
    for k in range(limit - length):
        go = padded[live + length] == padded[before[live] + length]
        out[live[~go]] = length
        live, length = live[go], length + 1
    out[live] = limit
    return out
