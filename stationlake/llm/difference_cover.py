"""Suffix sorting with the difference cover {1, 2} modulo 3, in numpy.

The suffixes at positions 1 and 2 modulo 3 are the sample: their first three symbols are
sorted and named, and where names repeat, the string of names is sorted in the same way.
The other suffixes follow from one symbol and the rank of the sample suffix behind it, and
are merged with the sample by comparisons that end at sampled suffixes.

Only the first ``need`` symbols matter to a caller who looks for matches of that length, so
the recursion ends as soon as the names span them: suffixes that agree so far may share a rank.
"""

from __future__ import annotations

import numpy as np


def _order(key: np.ndarray) -> np.ndarray:
    """Positions in the order of a non-negative key. Sorting key and position in one word is
    several times faster than sorting positions by key, so it is done where both fit."""
    bits = max(1, len(key) - 1).bit_length()
    if int(key.max(initial=0)).bit_length() + bits <= 63:
        both = np.sort((key << bits) | np.arange(len(key)))
        return both & ((1 << bits) - 1)
    return np.argsort(key)


def _dense(*columns: np.ndarray) -> np.ndarray:
    """Ranks from 1 of the rows of non-negative columns in lexicographic order; equal rows share one."""
    key = columns[0].astype(np.int64)
    bits = max(1, len(key) - 1).bit_length()
    for c in columns[1:]:
        wide = int(c.max(initial=0)).bit_length()
        if int(key.max(initial=0)).bit_length() + wide + bits > 63:
            key = _numbered(key)
        key = (key << wide) | c
    return _numbered(key)


def _numbered(key: np.ndarray) -> np.ndarray:
    order = _order(key)
    inside = key[order]
    out = np.empty(len(key), np.int64)
    out[order] = np.cumsum(np.concatenate([[True], inside[1:] != inside[:-1]])[:len(key)])
    return out


def ranks(s: np.ndarray, need: int) -> np.ndarray:
    """Rank of the suffix at every position of ``s`` (non-negative; zeros follow its end).

    A smaller rank means a smaller suffix; equal ranks, that ``need`` symbols or more agree."""
    n = len(s)
    if n < 3:
        p = np.concatenate([s, [0, 0, 0]]).astype(np.int64)
        i = np.arange(n)
        return _dense(p[i], p[i + 1], p[i + 2]) if n else np.zeros(0, np.int64)
    p = np.concatenate([s, [0, 0, 0]]).astype(np.int64)
    one, two, rest = np.arange(1, n, 3), np.arange(2, n, 3), np.arange(0, n, 3)
    sample = np.concatenate([one, two])
    names = _dense(p[sample], p[sample + 1], p[sample + 2])
    if need > 3 and names.max() < len(names):
        inner = ranks(np.concatenate([names[:len(one)], [0], names[len(one):]]), -(-need // 3))
        names = np.concatenate([inner[:len(one)], inner[len(one) + 1:]])
    r = np.zeros(n + 3, np.int64)
    r[sample] = names
    # the other suffixes: one symbol, then the rank of a sampled suffix
    span = np.int64(int(r.max()) + 1)
    key_one = p[:n] * span + r[1:n + 1]
    rest = rest[_order(key_one[rest])]
    width = int(p.max()) + 1
    pair = p[:n] * width + p[1:n + 1] if width * width * int(span) < 1 << 63 else _dense(p[:n], p[1:n + 1])
    key_two = pair * span + r[2:n + 2]
    # merge: how many of the others stand before each sampled suffix, in sample order
    order = sample[_order(names)]
    residue = np.tile(np.array([0, 1, 2], np.int8), n // 3 + 1)[:n]
    first = residue[order] == 1
    before = np.empty(len(order), np.int64)
    before[first] = np.searchsorted(key_one[rest], key_one[order[first]])  # asked in ascending order: fast
    before[~first] = np.searchsorted(key_two[rest], key_two[order[~first]])
    before = np.maximum.accumulate(before)
    at = np.empty(n, np.int64)
    place = before + np.arange(len(order))
    at[place] = order
    free = np.ones(n, bool)
    free[place] = False
    at[free] = rest
    # neighbours are equal where the comparison that fits their residues cannot tell them apart
    kind = residue[at]
    by_rank, by_one, by_two = ((k[1:] == k[:-1]) for k in (r[at], key_one[at], key_two[at]))
    sampled, second = (kind[1:] > 0) & (kind[:-1] > 0), (kind[1:] == 2) | (kind[:-1] == 2)
    same = np.where(sampled, by_rank, np.where(second, by_two, by_one))
    out = np.empty(n, np.int64)
    out[at] = np.cumsum(np.concatenate([[1], ~same]))
    return out


def match_classes(text: np.ndarray, need: int, starts: np.ndarray) -> np.ndarray:
    """For each of ``starts`` (with ``need`` symbols of ``text`` from it) the number of its class:
    two have the same where these symbols are equal. The suffixes are put in order, and each is
    compared with its neighbour."""
    order = starts[_order(ranks(text, need)[starts])]
    differs = np.zeros(max(0, len(order) - 1), bool)
    # adjacent prefixes, as many symbols at a time as a word holds
    bits = max(1, int(text.max(initial=0)).bit_length())
    some = min(need, 64 // bits)
    word = np.zeros(len(text), np.uint64)
    for i in range(some):
        word <<= np.uint64(bits)
        word[:max(0, len(text) - i)] |= text[i:].astype(np.uint64)
    for i in [*range(0, need - some, some), need - some]:
        column = word[order + i]
        differs |= column[1:] != column[:-1]
    number = np.zeros(len(text), np.int64)
    number[order] = np.cumsum(np.concatenate([[0], differs])) if len(order) else 0
    return number[starts]
