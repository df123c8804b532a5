"""Suffix arrays by induced sorting, in whole-array steps, and their permuted common prefixes.

Texts are byte strings that end with a separator byte which UTF-8 never has.
"""

from __future__ import annotations

import numpy as np

from tallyguard.llm.common import BYTE_CODES, mixed, powers

SEPARATOR = 0xFF
_PAD = 0xFE


def _suffix_types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one. The last symbol is the unique smallest."""
    n = len(s)
    step = np.sign(s[1:].astype(np.int32) - s[:-1])
    change = np.where(step != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(change[::-1])[::-1]
    smaller = np.ones(n, bool)
    smaller[:-1] = step[np.minimum(following, n - 2)] > 0
    return smaller


def _deal(buckets: list[list[np.ndarray]], places: np.ndarray, symbols: np.ndarray) -> None:
    """Append places to the buckets of their symbols, in order."""
    if not len(places):
        return
    order = np.argsort(symbols, kind="stable")
    places, symbols = places[order], symbols[order]
    cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
    for part, symbol in zip(np.split(places, cuts), symbols[np.concatenate([[0], cuts])]):
        buckets[symbol].append(part)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def _induced(s: np.ndarray, smaller: np.ndarray, starts: np.ndarray, alphabet: int) -> np.ndarray:
    """All suffixes in order, given the leftmost-smaller ones in order.

    A bucket is scanned in waves: what a wave puts into its own bucket is the
    next wave, as in a queue, so the order is that of the one-by-one scan.
    """
    seeds = [[] for _ in range(alphabet)]
    _deal(seeds, starts, s[starts])
    larger_in = [[] for _ in range(alphabet)]
    larger: list[np.ndarray] = []
    for c in range(alphabet):
        done, wave = [], _joined(larger_in[c])
        while len(wave):
            done.append(wave)
            before = wave[wave > 0] - 1
            before = before[~smaller[before]]
            symbols = s[before]
            wave = before[symbols == c]
            _deal(larger_in, before[symbols != c], symbols[symbols != c])
        larger.append(_joined(done))
        seed = _joined(seeds[c])
        before = seed[seed > 0] - 1
        before = before[~smaller[before]]
        _deal(larger_in, before, s[before])
    smaller_in = [[] for _ in range(alphabet)]
    smaller_in[s[-1]].append(np.array([len(s) - 1], np.int32))
    out: list[np.ndarray] = []
    for c in range(alphabet - 1, -1, -1):
        done, wave = [], _joined(smaller_in[c])
        while len(wave):
            done.append(wave)
            before = wave[wave > 0] - 1
            before = before[smaller[before]]
            symbols = s[before]
            wave = before[symbols == c]
            _deal(smaller_in, before[symbols != c], symbols[symbols != c])
        out.append(_joined(done))
        tail = larger[c][::-1]
        before = tail[tail > 0] - 1
        before = before[smaller[before]]
        _deal(smaller_in, before, s[before])
        out.append(tail)
    return _joined(out)[::-1]


def _ranked(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names: the names of pairs are sorted, then of
    pairs of pairs, until all differ. Only suffixes that still tie are sorted again."""
    m = len(names)
    order = np.argsort(names, kind="stable")
    rank = np.empty(m, np.int64)
    tied = names[order]
    head = np.concatenate([[True], tied[1:] != tied[:-1]])
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(m), 0))
    step = 1
    while True:
        single = head & np.concatenate([head[1:], [True]])
        open_at = np.flatnonzero(~single)
        if not len(open_at):
            return order
        places = order[open_at]
        later = places + step
        second = np.where(later < m, rank[np.minimum(later, m - 1)] + 1, 0)
        by = np.lexsort((second, rank[places]))
        places, second = places[by], second[by]
        first = rank[places]
        order[open_at] = places
        new = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        head[open_at] = new
        rank[places] = open_at[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]
        step *= 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The order of all suffixes of a byte array."""
    if not len(text):
        return np.zeros(0, np.int32)
    s = np.zeros(len(text) + 1, np.uint16)
    s[:-1] = text
    s[:-1] += 1
    smaller = _suffix_types(s)
    starts = np.flatnonzero(smaller[1:] & ~smaller[:-1]).astype(np.int32) + 1
    # A first induction orders the leftmost-smaller substrings; equal ones get one name.
    rough = _induced(s, smaller, starts, 257)
    is_start = np.zeros(len(s), bool)
    is_start[starts] = True
    rough = rough[is_start[rough]]
    ends = np.concatenate([starts[1:] + 1, [len(s)]])
    codes = _span_codes(s, starts, ends)
    at = np.searchsorted(starts, rough)
    codes = codes[at]
    named = np.empty(len(starts), np.int64)
    named[at] = np.cumsum(np.concatenate([[0], codes[1:] != codes[:-1]]))
    ordered = starts[_ranked(named)]
    return _induced(s, smaller, ordered, 257)[1:]


def _span_codes(s: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = powers(len(s) + 1)
    sums = np.zeros(len(s) + 1, np.uint64)
    codes = np.concatenate([[np.uint64(0x5851F42D4C957F2D)], BYTE_CODES])
    np.cumsum(codes[s] * up[: len(s)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place in ``order``, the bytes its suffix shares with the one before it.

    Computed in text order: a suffix whose left neighbour equals that of its
    predecessor in the order shares one byte less than the suffix to its left, so
    only the others are compared, eight bytes at a time.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int32)
    padded = np.full(n + 16, _PAD, np.uint8)
    padded[:n] = text
    words = np.ndarray((n + 8,), "<u8", padded.data, strides=(1,))
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    place = np.arange(n)
    derived = (place > 0) & (before > 0)
    derived[derived] = text[place[derived] - 1] == text[before[derived] - 1]
    own = np.flatnonzero(~derived & (before >= 0))
    shared = np.zeros(n, np.int64)
    active, length = own, np.zeros(len(own), np.int64)
    while len(active):
        other = before[active]
        differ = words[np.minimum(active + length, n)] ^ words[np.minimum(other + length, n)]
        ended = differ != 0
        low = differ[ended]
        low &= ~low + np.uint64(1)
        shared[active[ended]] = length[ended] + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
        active, length = active[~ended], length[~ended] + 8
    known = np.maximum.accumulate(np.where(~derived, place, 0))
    permuted = np.maximum(shared[known] - (place - known), 0)
    return permuted[order]
