"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

The array of a shard of a few megabytes is made by classifying its suffixes, sorting
the substrings between leftmost-smaller positions by naming them and then ever longer
runs of names, and inducing all other suffixes from these in one pass up and one pass
down the buckets of first bytes. Each pass takes a bucket's entries together.
"""

from __future__ import annotations

import numpy as np

#: Characters that one sorting key holds: ten bits each, of a byte and its type.
PACKED = 6
ALPHABET = 257
#: Positions after which a common prefix is compared anew, so that no comparison is longer than this beyond need.
STRIDE = 1024


def types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last, a lone least sign, is."""
    step = text[:-1].astype(np.int16) - text[1:].astype(np.int16)
    n = len(text)
    place = np.where(step != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(place[::-1])[::-1]
    small = np.ones(n, bool)
    inner = following < n
    small[:-1][inner] = step[following[inner]] < 0
    return small


def _names(text: np.ndarray, small: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Ranks of the substrings from each mark to the next one, equal where they are equal."""
    signs = np.concatenate([2 * text.astype(np.uint64) + small + np.uint64(1), np.zeros(PACKED, np.uint64)])
    ends = np.append(marks[1:], len(text) - 1)
    rank = np.zeros(len(marks), np.int64)
    active = np.arange(len(marks))
    done = 0
    while len(active):
        at = marks[active] + done
        left = ends[active] - at + 1
        word = np.zeros(len(active), np.uint64)
        for k in range(PACKED):
            word = (word << np.uint64(10)) | np.where(k < left, signs[np.minimum(at + k, len(signs) - 1)], np.uint64(0))
        order, same, first = _split(rank[active], word)
        rank[active[order]] += first
        done += PACKED
        # Only ties whose substrings go on need another key.
        go = same & (left[order] > PACKED)
        active = active[order][go]
    return rank


def _split(rank: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (rank, word); which entries share both with another; each one's offset within its rank."""
    order = np.lexsort((word, rank))
    r, w = rank[order], word[order]
    place = np.arange(len(order))
    new_rank = np.ones(len(order), bool)
    new_rank[1:] = r[1:] != r[:-1]
    new = new_rank.copy()
    new[1:] |= w[1:] != w[:-1]
    begin = np.maximum.accumulate(np.where(new_rank, place, 0))
    start = np.maximum.accumulate(np.where(new, place, 0))
    last = np.ones(len(order), bool)
    last[:-1] = new[1:]
    return order, ~(new & last), start - begin


def _sorted_marks(names: np.ndarray, spans: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of the string of names, as far as ``depth`` bytes tell.

    Ranks of runs of names give ranks of runs twice as long, for the ties only.
    """
    rank, reach, n = names.copy(), 1, len(names)
    _, place, times = np.unique(rank, return_inverse=True, return_counts=True)
    active = np.flatnonzero(times[place] > 1)
    covered = np.append(np.cumsum(spans[::-1])[::-1], 0)
    while len(active):
        after = np.minimum(active + reach, n)
        # Runs that already cover the depth may stay tied.
        deep = covered[active] - covered[after] >= depth
        active, after = active[~deep], after[~deep]
        if not len(active):
            break
        word = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0).astype(np.uint64)
        order, same, first = _split(rank[active], word)
        entries = active[order]
        rank[entries] += first
        active = entries[same]
        reach *= 2
    return np.argsort(rank, kind="stable")


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes of ``data`` in order; ties beyond ``depth`` equal bytes may stand in any order.

    >>> suffix_array(np.frombuffer(b"mississippi", np.uint8), 99).tolist()
    [10, 7, 4, 1, 0, 9, 8, 6, 3, 5, 2]
    """
    text = np.append(data.astype(np.uint16) + np.uint16(1), np.uint16(0))
    n = len(text)
    small = types(text)
    marks = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    names = _names(text, small, marks)
    spans = np.diff(np.append(marks, n))
    ordered = marks[_sorted_marks(names, spans, depth)]
    counts = np.bincount(text, minlength=ALPHABET)
    tails = np.cumsum(counts)
    heads = tails - counts
    array = np.zeros(n, np.int64)
    mark_counts = np.bincount(text[ordered], minlength=ALPHABET)
    mark_heads = np.concatenate([[0], np.cumsum(mark_counts)])
    free = heads.copy()
    for c in np.flatnonzero(counts).tolist():  # upwards: larger ones from their smaller followers
        begin = heads[c]
        while begin < free[c]:
            chunk = array[begin : free[c]]
            begin = free[c]
            _induce_up(text, small, array, free, chunk)
        _induce_up(text, small, array, free, ordered[mark_heads[c] : mark_heads[c + 1]])
    free = tails.copy()
    large = heads + np.bincount(text[~small], minlength=ALPHABET)
    for c in np.flatnonzero(counts)[::-1].tolist():  # downwards: smaller ones from their larger followers
        if c == 0:
            array[0] = n - 1
            continue
        end = tails[c]
        while end > free[c]:
            chunk = array[free[c] : end][::-1]
            end = free[c]
            _induce_down(text, small, array, free, chunk)
        _induce_down(text, small, array, free, array[heads[c] : large[c]][::-1])
    return array[1:]


def _induce_up(text, small, array, free, chunk) -> None:
    before = chunk[chunk > 0] - 1
    before = before[~small[before]]
    _place(text, array, free, before, 1)


def _induce_down(text, small, array, free, chunk) -> None:
    before = chunk[chunk > 0] - 1
    before = before[small[before]]
    _place(text, array, free, before, -1)


def _place(text, array, free, entries, step) -> None:
    """Put entries, in their order, at the front (or, downwards, the back) of what is free in their buckets."""
    if not len(entries):
        return
    first = text[entries]
    order = np.argsort(first, kind="stable")
    first, entries = first[order], entries[order]
    counts = np.bincount(first, minlength=ALPHABET)
    within = np.arange(len(entries)) - (np.cumsum(counts) - counts)[first]
    if step > 0:
        array[free[first] + within] = entries
        free += counts
    else:
        array[free[first] - 1 - within] = entries
        free -= counts


def common_prefixes(data: np.ndarray, array: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """In text order: each suffix's predecessor in the array (-1: none) and their common prefix.

    Where the bytes before a suffix and before its predecessor agree, the length is one less
    than that of the suffix before; only the others are compared, a word at a time. Lengths
    under ``least`` are given as 0; others may be cut, at ``least`` or more.

    >>> d = np.frombuffer(b"mississippi", np.uint8)
    >>> common_prefixes(d, suffix_array(d, 99))[1].tolist()
    [0, 4, 3, 2, 1, 1, 0, 1, 1, 0, 0]
    """
    n, place = len(data), np.arange(len(data))
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    known = np.zeros(n, bool)
    known[1:] = (before[1:] == before[:-1] + 1) & (before[:-1] >= 0) & (data[:-1] == data[before[:-1]])
    source = np.maximum.accumulate(np.where(~known, place, 0))
    known &= (place - source) % STRIDE != 0
    fresh = np.flatnonzero(~known & (before >= 0))
    lengths = np.zeros(n, np.int64)
    lengths[fresh] = _compared(data, fresh, before[fresh], least)
    source = np.maximum.accumulate(np.where(~known, place, 0))
    lengths = lengths[source] - (place - source)
    return before, np.where(lengths >= least, lengths, 0)


def _compared(data: np.ndarray, a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray:
    """Common prefixes of pairs of suffixes, 0 if under ``least``, cut at ``least`` and STRIDE more."""
    n, most = len(data), least + STRIDE
    raw = np.concatenate([data, np.zeros(16, np.uint8)])
    words = np.empty(n + 8, np.uint64)
    for k in range(8):
        part = np.frombuffer(raw[k : k + (n + 8 - k + 7) // 8 * 8].tobytes(), np.uint64)
        words[k::8] = part[: len(words[k::8])]
    out = np.zeros(len(a), np.int64)
    active = np.flatnonzero(np.maximum(a, b) + least <= n)
    if least >= 8:  # most pairs differ somewhere further on, too
        for at in (least - 8, least // 2):
            active = active[words[a[active] + at] == words[b[active] + at]]
    reach = 0
    while len(active) and reach < most:
        x, y = a[active] + reach, b[active] + reach
        inside = np.maximum(x, y) < n
        difference = words[np.minimum(x, n)] ^ words[np.minimum(y, n)]
        equal = (difference == 0) & inside
        if reach + 8 > least or least < 8:
            stop = ~equal
            low = difference[stop] & (~difference[stop] + np.uint64(1))
            bits = np.where(low > 0, np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)), 0).astype(np.int64)
            out[active[stop]] = reach + np.where(inside[stop], bits // 8, 0)
        active = active[equal]
        reach += 8
    out[active] = reach
    return np.minimum(out, n - np.maximum(a, b))
