"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy.

Suffixes are classified by whether they are smaller than their right
neighbour; the leftmost-smaller substrings are sorted by inducing from their
first symbols, named, and sorted as a shorter text by the same method, down to
a size that is sorted directly; two linear scans then induce the whole array from their order. A scan goes by
blocks: all entries of a block place their left neighbours at once, and a block
ends before the first of its own places that it fills.
"""

from __future__ import annotations

import numpy as np

SMALL, LARGE = 64, 1 << 16       # entries of a scan block
SHORT = 1 << 18                  # named texts of fewer symbols end the recursion
CELLS = 1 << 21                  # symbols compared at a time


def common(s: np.ndarray, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None
           ) -> np.ndarray:
    """Lengths of the common prefixes of the suffixes at a and b (a != b) of a
    text that ends in a symbol found nowhere else; with ``limit`` at most that."""
    out = np.zeros(len(a), np.int64)
    left, off, width = np.arange(len(a)), 0, 8
    while left.size:
        width = max(8, min(width, CELLS // left.size))
        step, still = np.arange(off, off + width), []
        for at in range(0, left.size, max(1, CELLS // width)):
            part = left[at:at + max(1, CELLS // width)]
            same = (s.take(a[part][:, None] + step, mode="clip")
                    == s.take(b[part][:, None] + step, mode="clip"))
            whole = same.all(axis=1)
            out[part] = off + np.where(whole, width, same.argmin(axis=1))
            still.append(part[whole])
        left, off = np.concatenate(still), off + width
        if limit is not None:
            left = left[limit[left] > off]
        width *= 2
    return out if limit is None else np.minimum(out, limit)


def smaller_than_next(s: np.ndarray) -> np.ndarray:
    """Per suffix: smaller than the suffix that starts one later; the last is."""
    out = np.ones(len(s), bool)
    if len(s) > 1:
        d = np.diff(s)
        place = np.where(d != 0, np.arange(len(d)), len(d))
        place = np.minimum.accumulate(place[::-1])[::-1]
        out[:-1] = np.append(d, 1)[place] > 0
    return out


def _scan(sa: np.ndarray, s: np.ndarray, wanted: np.ndarray, free: np.ndarray, step: int) -> None:
    """From the left (step 1) or right (-1) end, each entry places its left
    neighbour, if that is of the ``wanted`` type, on its symbol's next free place."""
    n, size, i = len(sa), 4096, 0                          # i entries are scanned
    view = sa if step == 1 else sa[::-1]
    count = np.arange(LARGE)
    fresh = np.ones(LARGE, bool)                           # the first of its symbol
    while i < n:
        entries = view[i:i + size]
        end = i + len(entries)
        before = entries - 1
        hit = wanted.take(before, mode="wrap")
        hit &= entries > 0
        at = hit.nonzero()[0]
        m = len(at)
        if not m:
            i, size = end, min(size * 2, LARGE)
            continue
        src = before[at]
        ch = s[src]
        order = ch.argsort(kind="stable")
        ch = ch[order]
        np.not_equal(ch[1:], ch[:-1], out=fresh[1:m])
        first = fresh[:m].nonzero()[0]
        groups = ch[first]
        # equal symbols take places in the order of the scan
        size_of = np.empty(len(first), np.int64)
        np.subtract(first[1:], first[:-1], out=size_of[:-1])
        size_of[-1] = m - first[-1]
        start = free[groups]
        cut = int(start.min() if step == 1 else n - 1 - start.max())
        if cut < end:              # those after the cut wait for what lands there
            keep = at[order] < cut - i
            rank = count[:m] - first.repeat(size_of)
            ch, order, rank = ch[keep], order[keep], rank[keep]
            place = free[ch] + step * rank
            size = min(max(SMALL, 3 * (cut - i) // 2), LARGE)
            end = cut
            sa[place] = src[order]
            free[ch] = place + step                        # the last of equals stays
        else:
            size = min(size * 2, LARGE)
            place = (start - step * first).repeat(size_of) + step * count[:m]
            sa[place] = src[order]
            free[groups] = start + step * size_of
        i = end


def _induce(s: np.ndarray, small: np.ndarray, ordered: np.ndarray, ends: np.ndarray
            ) -> np.ndarray:
    """The array induced from leftmost-smaller suffixes in the given order."""
    sa = np.full(len(s), -1, np.int32)
    ch = s[ordered]
    by = np.argsort(ch, kind="stable")
    ch = ch[by]
    after = np.searchsorted(ch, ch, side="right")          # entries up to this symbol's last
    sa[ends[ch] - (after - np.arange(len(ch)))] = ordered[by]
    _scan(sa, s, ~small, np.append(0, ends[:-1]), 1)
    sa[1:][small[sa[1:]] | (sa[1:] < 0)] = -1
    _scan(sa, s, small, ends - 1, -1)
    return sa


def doubled(s: np.ndarray) -> np.ndarray:
    """The array by doubling the compared length: ends the recursion, where the
    many symbols of a short named text make scan blocks tiny."""
    n, k = len(s), 1
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
    while True:
        key = rank * (n + 1)
        key[:-k] += rank[k:] + 1
        order = key.argsort(kind="stable")
        key = key[order]
        place = np.append(0, np.cumsum(key[1:] != key[:-1]))
        if place[-1] == n - 1:
            return order
        rank[order] = place
        k *= 2


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``s`` in order; s holds fewer than 2^31 whole
    numbers from 0 and ends in its only 0."""
    n = len(s)
    kinds = np.bincount(s)
    if kinds.max() == 1:                                   # first symbols decide
        return np.argsort(s)
    ends = np.cumsum(kinds)
    small = smaller_than_next(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    sa = _induce(s, small, lms, ends)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    by_string = sa[is_lms[sa]]
    size = np.zeros(n, np.int64)
    size[lms] = np.append(np.diff(lms) + 1, 1)             # up to the next one, included
    a, b = by_string[:-1], by_string[1:]
    differ = size[a] != size[b]
    alike = np.flatnonzero(~differ)
    differ[alike] = common(s, a[alike], b[alike], size[a[alike]]) < size[a[alike]]
    names = np.append(0, np.cumsum(differ))
    if names[-1] + 1 < len(lms):
        name = np.empty(n, np.int32)
        name[by_string] = names
        named = name[lms]
        by_string = lms[suffix_array(named) if len(named) > SHORT else doubled(named)]
    return _induce(s, small, by_string, ends)


def permuted_prefixes(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Per start, the common prefix with the suffix before it in the array. Only
    where the symbols to the left differ is it compared; else it is one less
    than at the start before."""
    n = len(s)
    phi = np.full(n, -1, np.int32)
    phi[sa[1:]] = sa[:-1]
    own = np.ones(n, bool)
    own[1:] = (phi[1:] <= 0) | (s[:-1] != s[phi[1:] - 1])
    out = np.zeros(n, np.int64)
    at = np.flatnonzero(own & (phi >= 0))
    out[at] = common(s, at, phi[at])
    start = np.maximum.accumulate(np.where(own, np.arange(n), 0))
    return out[start] - (np.arange(n) - start)


def longest_repeats(s: np.ndarray) -> np.ndarray:
    """Per start, the longest prefix of its suffix that starts elsewhere, too."""
    sa = suffix_array(s)
    prefix = permuted_prefixes(s, sa)
    out = prefix.copy()
    out[sa[:-1]] = np.maximum(out[sa[:-1]], prefix[sa[1:]])
    return out
