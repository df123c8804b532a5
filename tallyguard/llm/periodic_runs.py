"""Periodic runs of words, found in a grammar of each text, and texts with the runs collapsed.

The words of each text are compressed by Re-Pair. It works in rounds over a slice of
texts: a pair of neighbouring symbols that occurs twice or more in its text becomes a
new symbol, and where pairs overlap the more frequent one goes first. What is left of a
text is joined by a balanced tree. A run with smallest period q crosses the border of
the two parts of some nonterminal that derives all of it, so each nonterminal is looked
at once, at its first place: three words at its border that come again within it give
the possible periods, and how far the text agrees with itself at that distance gives
the run. Runs of a nonterminal are then moved to all places that derive it, and those
that a nonterminal's ends cut short are merged into the maximal ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import byte_slices, mixed, powers, utf8
from tallyguard.llm.words import NOT_SPACE, cut_words


@dataclass(frozen=True)
class RunParams:
    #: A run has at least so many words, and at least twice its period.
    min_words: int = 12
    slice_bytes: int = 2 << 20


#: Words that begin or end at a border and come again in the nonterminal.
_SEED = 3
#: Possible periods looked at together.
_CHUNK = 1 << 20
_FOUND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def periodic_runs(
    docs: DataFrame, params: RunParams | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (start, length, period; ordered by
    start, then period) and ``collapsed``, the text's words without those behind the first
    period of a run, joined by one space.

    Null and empty texts have no words, no runs and an empty collapsed text. Identifiers
    are passed on as they are; repeated rows are treated one by one. Other columns are
    ignored. A slice of texts, or one longer text, takes about 300 bytes a word.
    """
    params = params or RunParams()
    if params.min_words < 2 * _SEED:
        raise ValueError(f"min_words is at least {2 * _SEED}")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 1, params.slice_bytes):
                yield _slice_runs(part, params)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(found, _FOUND)


def _slice_runs(part: pa.RecordBatch, params: RunParams) -> pa.RecordBatch:
    words, counts = cut_words(*utf8(part.column(1)), NOT_SPACE, lower=False)
    codes = words.indices.to_numpy().astype(np.int64)
    borders = np.concatenate([[0], np.cumsum(counts)])
    start, end, period = find_runs(codes, borders, params.min_words)
    change = np.zeros(len(codes) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.subtract.at(change, end, 1)
    kept = np.cumsum(change[:-1]) == 0
    cuts = np.concatenate([[0], np.cumsum(kept)])[borders].tolist()
    names = words.dictionary.to_pylist()
    sequence = list(map(names.__getitem__, codes[kept].tolist()))
    collapsed = [" ".join(sequence[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    at = np.searchsorted(start, borders)
    row = np.searchsorted(borders, start, "right") - 1
    runs = pa.StructArray.from_arrays(
        [pa.array(start - borders[row]), pa.array(end - start), pa.array(period)], ["start", "length", "period"]
    )
    return pa.record_batch(
        [
            part.column(0),
            pa.array(counts.astype(np.int64)),
            pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), runs),
            pa.array(collapsed, pa.string()),
        ],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def find_runs(codes: np.ndarray, borders: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs of texts laid end to end, by start and then period.

    Stretches are compared by hashes, and the runs word by word afterwards; were a hash
    ever wrong, all is compared word by word.
    """
    if not len(codes):
        return (np.zeros(0, np.int64),) * 3
    nodes = derivation(codes, borders, min_words)
    runs = _runs_of(nodes, _Texts(codes, by_hash=True), min_words)
    if not _right(codes, borders, *runs):
        runs = _runs_of(nodes, _Texts(codes, by_hash=False), min_words)
    return runs


def derivation(codes: np.ndarray, borders: np.ndarray, least: int = 2) -> np.ndarray:
    """The inner nodes of the derivation trees: symbol, start, border of the two parts, end.

    Nodes of fewer than ``least`` words are left out. Equal symbols derive equal words.
    """
    row = np.repeat(np.arange(len(borders) - 1), np.diff(borders))
    size = int(codes.max()) + 1
    symbols = np.unique(row * size + codes, return_inverse=True)[1].astype(np.int64)
    count = int(symbols.max()) + 1
    start, end = np.arange(len(codes)), np.arange(1, len(codes) + 1)
    nodes: list[np.ndarray] = []
    rest: list[tuple[np.ndarray, ...]] = []
    while len(symbols):
        at, kind = _frequent_pairs(symbols, row, count)
        active = np.zeros(len(borders), bool)
        active[row[at]] = True
        done = ~active[row]
        if len(at):
            nodes.append(np.stack([kind, start[at], start[at + 1], end[at + 1]]))
            count = int(kind.max()) + 1
            symbols[at], end[at] = kind, end[at + 1]
        rest.append((row[done], start[done], end[done]))
        stay = ~done
        stay[at + 1] = False
        symbols, row, start, end = symbols[stay], row[stay], start[stay], end[stay]
    row, start, end = (np.concatenate(parts) for parts in zip(*rest))
    order = np.argsort(start)
    row, start, end = row[order], start[order], end[order]
    while True:
        heads = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        place = np.arange(len(row)) - np.repeat(heads, np.diff(np.concatenate([heads, [len(row)]])))
        at = np.flatnonzero((place[:-1] % 2 == 0) & (row[1:] == row[:-1]))
        if not len(at):
            break
        nodes.append(np.stack([count + np.arange(len(at)), start[at], start[at + 1], end[at + 1]]))
        count += len(at)
        end[at] = end[at + 1]
        stay = np.ones(len(row), bool)
        stay[at + 1] = False
        row, start, end = row[stay], start[stay], end[stay]
    found = np.concatenate(nodes, axis=1) if nodes else np.zeros((4, 0), np.int64)
    return found[:, found[3] - found[1] >= least]


def _frequent_pairs(symbols: np.ndarray, row: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs to replace in this round, and their new symbols, from ``count`` on.

    Of two overlapping pairs the more frequent one is replaced, of equal neighbours every other.
    """
    none = np.zeros(0, np.int64)
    often = np.bincount(symbols, minlength=count) > 1
    often = often[symbols]
    at = np.flatnonzero((row[1:] == row[:-1]) & often[1:] & often[:-1])
    if not len(at):
        return none, none
    keys = symbols[at] * count + symbols[at + 1]
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    counts = np.diff(np.concatenate([heads, [len(keys)]]))
    kind = np.empty(len(at), np.int64)
    kind[order] = np.repeat(np.arange(len(heads)), counts)
    # The rank of a kind among all, by count.
    by_count = np.empty(len(heads), np.int64)
    by_count[np.argsort(counts, kind="stable")] = np.arange(len(heads))
    repeated = counts[kind] > 1
    at, kind = at[repeated], kind[repeated]
    if not len(at):
        return none, none
    # In a stretch of overlapping equal pairs only every other one can be replaced.
    again = np.concatenate([[False], (at[1:] == at[:-1] + 1) & (kind[1:] == kind[:-1])])
    first = np.maximum.accumulate(np.where(again, 0, np.arange(len(at))))
    even = (np.arange(len(at)) - first) % 2 == 0
    at, kind = at[even], kind[even]
    rank = by_count[kind]
    taken: list[np.ndarray] = []
    left = np.arange(len(at))
    while len(left):
        place, own = at[left], rank[left]
        touch = place[1:] == place[:-1] + 1
        wins = np.ones(len(left), bool)
        wins[1:] &= ~touch | (own[1:] > own[:-1])
        wins[:-1] &= ~touch | (own[:-1] > own[1:])
        taken.append(left[wins])
        stay = ~wins
        stay[1:] &= ~(touch & wins[:-1])
        stay[:-1] &= ~(touch & wins[1:])
        left = left[stay]
    chosen = np.sort(np.concatenate(taken))
    return at[chosen], count + np.unique(kind[chosen], return_inverse=True)[1]


class _Texts:
    """Words laid end to end, and how far two places of them agree."""

    def __init__(self, codes: np.ndarray, by_hash: bool) -> None:
        self.codes, self.by_hash = codes, by_hash
        values = mixed(codes.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
        self.values = values
        if by_hash:
            self.up = powers(len(codes) + 1)[0]
            self.sums = np.zeros(len(codes) + 1, np.uint64)
            np.cumsum(values * self.up[:-1], out=self.sums[1:])

    def agree(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        """How many words agree from a and b (a < b) on (step 1) or before them (step -1), up to ``most``."""
        if not self.by_hash:
            return self._one_by_one(a, b, most, step)
        low, high = np.zeros(len(a), np.int64), most.copy()
        shift = self.up[b - a]
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_] + 1) >> 1
            p, q = a[open_], b[open_]
            if step < 0:
                p, q = p - middle, q - middle
            same = (self.sums[p + middle] - self.sums[p]) * shift[open_] == self.sums[q + middle] - self.sums[q]
            low[open_[same]] = middle[same]
            high[open_[~same]] = middle[~same] - 1
            open_ = open_[low[open_] < high[open_]]
        return low

    def _one_by_one(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        length = np.zeros(len(a), np.int64)
        open_ = np.flatnonzero(length < most)
        while len(open_):
            ahead = length[open_] if step > 0 else -length[open_] - 1
            open_ = open_[self.codes[a[open_] + ahead] == self.codes[b[open_] + ahead]]
            length[open_] += 1
            open_ = open_[length[open_] < most[open_]]
        return length


def _runs_of(nodes: np.ndarray, texts: _Texts, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    symbol, first = np.unique(nodes[0], return_index=True)
    number, start, end, period = _crossing(nodes[:, first], texts, min_words)
    # The runs of a symbol, moved to all places that derive it.
    order = np.argsort(nodes[0], kind="stable")
    heads = np.searchsorted(nodes[0][order], symbol)
    times = np.diff(np.concatenate([heads, [len(order)]]))[number]
    which = np.repeat(np.arange(len(number)), times)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
    to = nodes[1][order[heads[number[which]] + nth]] - nodes[1][first[number[which]]]
    return _maximal(start[which] + to, end[which] + to, period[which])


def _crossing(nodes: np.ndarray, texts: _Texts, min_words: int) -> tuple[np.ndarray, ...]:
    """Runs across the borders of nodes, each once: node, start, end and period."""
    n = len(texts.codes)
    _, low, border, high = nodes
    values = texts.values
    found: list[np.ndarray] = [np.zeros((4, 0), np.int64)]
    if n >= _SEED:
        seeds = mixed(values[:-2] + mixed(values[1:-1] + mixed(values[2:])))
        order = np.argsort(seeds, kind="stable")
        ordered = seeds[order]
        rank = np.empty(len(seeds), np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        keys = rank[order] * n + order
        for back in (0, _SEED):
            seed = border - back
            own = np.flatnonzero((seed >= low) & (seed + _SEED <= high))
            base = rank[seed[own]] * n
            begin = np.searchsorted(keys, base + low[own])
            counts = np.searchsorted(keys, base + high[own] - _SEED, "right") - begin
            several = counts > 1
            own, begin, counts = own[several], begin[several], counts[several]
            upto = np.cumsum(counts)
            done = 0
            while done < len(own):
                before = upto[done - 1] if done else 0
                stop = max(done + 1, int(np.searchsorted(upto, before + _CHUNK, "right")))
                times = counts[done:stop]
                which = np.repeat(own[done:stop], times)
                nth = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
                other = order[np.repeat(begin[done:stop], times) + nth] + back
                found.append(_stretches(nodes, which, other, texts, min_words))
                done = stop
    node, start, end, period = np.concatenate(found, axis=1)
    # Of equal stretches the smallest period is the run's own.
    by = np.lexsort((period, end, start, node))
    node, start, end, period = node[by], start[by], end[by], period[by]
    new = np.ones(len(node), bool)
    new[1:] = (node[1:] != node[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return node[new], start[new], end[new], period[new]


def _stretches(
    nodes: np.ndarray, which: np.ndarray, other: np.ndarray, texts: _Texts, min_words: int
) -> np.ndarray:
    """The periodic stretches, within nodes, around their borders and the places ``other``."""
    _, low, border, high = nodes[:, which]
    a, b = np.minimum(border, other), np.maximum(border, other)
    apart = np.flatnonzero(a < b)
    which, a, b, low, high = which[apart], a[apart], b[apart], low[apart], high[apart]
    start = a - texts.agree(a, b, a - low, -1)
    end = b + texts.agree(a, b, high - b, 1)
    fits = end - start >= np.maximum(min_words, 2 * (b - a))
    return np.stack([which[fits], start[fits], end[fits], (b - a)[fits]])


def _maximal(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches that lie in no other one of their period, each with its smallest period."""
    by = np.lexsort((-end, start, period))
    start, end, period = start[by], end[by], period[by]
    reach = np.unique(period, return_inverse=True)[1] * (int(end.max(initial=0)) + 1) + end
    outer = np.ones(len(start), bool)
    outer[1:] = reach[1:] > np.maximum.accumulate(reach)[:-1]
    start, end, period = start[outer], end[outer], period[outer]
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    by = np.lexsort((period, start))
    return start[by], end[by], period[by]


def _right(
    codes: np.ndarray, borders: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray
) -> bool:
    """Whether all runs have their period, and no neighbouring word extends one."""
    row = np.searchsorted(borders, start, "right") - 1
    wider = (start > borders[row]) & (codes[start - 1] == codes[start - 1 + period])
    wider |= (end < borders[row + 1]) & (codes[np.minimum(end, len(codes) - 1)] == codes[end - period])
    if wider.any():
        return False
    lengths = end - start - period
    upto = np.cumsum(lengths)
    done = 0
    while done < len(start):
        stop = max(done + 1, int(np.searchsorted(upto, (upto[done - 1] if done else 0) + _CHUNK, "right")))
        times = lengths[done:stop]
        place = np.repeat(start[done:stop], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        if (codes[place] != codes[place + np.repeat(period[done:stop], times)]).any():
            return False
        done = stop
    return True
