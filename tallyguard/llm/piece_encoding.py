"""SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a batch are laid end to end and indexed by a suffix array.
Every vocabulary piece is found by binary search, its range of suffixes gives
all its occurrences, and these edges are sorted by position. The given model is
of the byte-pair kind, so edges are not relaxed to the best sum of scores but by
rank: in each word the best edge over two neighbouring symbols joins them, the
leftmost of equals first, until no edge joins two symbols. Characters without a
piece become bytes. The identifiers are those of the library.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import byte_slices, split_words
from tallyguard.llm.suffix_array import SEPARATOR, suffix_array

MODEL = "piece_bpe_32k.model"
GROUP_BYTES = 2 << 20
INDEX_BYTES = 1 << 19
#: Distinct words that a task remembers.
REMEMBERED = 400_000
#: Longer words are joined with a heap instead of side by side with the others.
LONG_WORD = 400
MARK = "▁"
_NONE = np.int32(2**31 - 1)


class PieceModel:
    """The vocabulary of a model file: pieces with their ranks, and bytes for what has no piece."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.bytes_of: list[bytes] = [b""] * n
        self.byte_ids = np.zeros(256, np.int32)
        pieces, ids, scores = [], [], []
        for i in range(n):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(name[1:-1], 16)
                self.byte_ids[value] = i
                self.bytes_of[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.bytes_of[i] = name.replace(MARK, " ").encode()
                pieces.append(name.encode())
                ids.append(i)
                scores.append(model.get_score(i))
        if any(MARK in name.decode().lstrip(MARK) for name in pieces):
            raise ValueError("a piece has the space mark behind another character")
        self.pieces, self.ids = pieces, np.array(ids, np.int32)
        self.ranks = np.unique(-np.array(scores), return_inverse=True)[1].astype(np.int32)
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.widest = -(-int(self.lengths.max()) // 8) * 8
        padded = np.zeros((len(pieces), self.widest), np.uint8)
        for row, piece in zip(padded, pieces):
            row[: len(piece)] = np.frombuffer(piece, np.uint8)
        self.words = padded.view(">u8").astype(np.uint64)
        # Codes of the first two bytes of all texts that begin with a piece.
        self.head = padded[:, 0].astype(np.int64) * 256 + padded[:, 1]
        self.behind = self.head + np.where(self.lengths > 1, 1, 256)
        ones = np.arange(self.widest)[None, :] < self.lengths[:, None]
        self.masks = (ones * np.uint8(255)).astype(np.uint8).view(">u8").astype(np.uint64)

    def decode(self, ids) -> str:
        """The text of identifiers; the space in front of the first word is the model's own."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode(errors="replace")

    def _ranges(self, text: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every piece, the range of suffixes that begin with it.

        The first two bytes of a suffix give the range of all that share them, by counting;
        only longer pieces are searched, each within the range of its own two bytes.
        """
        n = len(text)
        padded = np.zeros(n + self.widest, np.uint8)
        padded[:n] = text
        counts = np.bincount(padded[:n].astype(np.int64) * 256 + padded[1 : n + 1], minlength=1 << 16)
        before = np.concatenate([[0], np.cumsum(counts)])
        low, high = before[self.head], before[self.behind]
        view = np.ndarray((n + self.widest - 7,), ">u8", padded.data, strides=(1,))
        first = view[order].astype(np.uint64)
        deep = np.flatnonzero((self.lengths > 2) & (low < high))
        own = low[deep], high[deep]
        low[deep] = self._bound(view, order, first, deep, *own, upper=False)
        high[deep] = self._bound(view, order, first, deep, low[deep], own[1], upper=True)
        return low, high

    def _bound(
        self, view: np.ndarray, order: np.ndarray, first: np.ndarray, pieces: np.ndarray, low: np.ndarray, high: np.ndarray, upper: bool
    ) -> np.ndarray:
        """For each of ``pieces``, the first suffix from low to high not below it (or above all that begin with it)."""
        low, high = low.copy(), high.copy()
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            piece = pieces[open_]
            start = first[middle] & self.masks[piece, 0]
            below, equal = start < self.words[piece, 0], start == self.words[piece, 0]
            for k in range(1, self.widest // 8):
                # Eight bytes more, where all before them are equal and the piece goes on.
                on = np.flatnonzero(equal & (self.lengths[piece] > 8 * k))
                if not len(on):
                    break
                more = view[order[middle[on]] + 8 * k].astype(np.uint64) & self.masks[piece[on], k]
                wanted = self.words[piece[on], k]
                below[on], equal[on] = more < wanted, more == wanted
            right = below | (equal & upper)
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]
            open_ = open_[low[open_] < high[open_]]
        return low

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All occurrences of all pieces, sorted by position and length: keys and piece numbers."""
        order = suffix_array(text)
        low, high = self._ranges(text, order)
        counts = high - low
        piece = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        at = np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts) + low[piece]
        keys = order[at].astype(np.int64) * 64 + self.lengths[piece]
        by = np.argsort(keys)
        return keys[by], piece[by]


def _found(keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The number of the edge from start to end, -1 where there is none."""
    size = ends - starts
    wanted = starts * 64 + np.minimum(size, 63)
    at = np.searchsorted(keys, wanted)
    hit = (at < len(keys)) & (size < 64)
    hit[hit] = keys[at[hit]] == wanted[hit]
    return np.where(hit, at, -1)


class PieceEncoder:
    def __init__(self, path: str) -> None:
        self.model = PieceModel(path)
        self._forget()

    def _forget(self) -> None:
        """``known`` has the number of each word; its identifiers lie in ``flat``."""
        self.known: dict[str, int] = {}
        self.flat, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def _ranks(self, keys, piece, starts, ends) -> np.ndarray:
        at = _found(keys, starts, ends)
        return np.where(at >= 0, self.model.ranks[piece[at]], _NONE)

    def _relaxed(self, text: np.ndarray, word_of: np.ndarray, keys, piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and words of the symbols that are left when no edge joins two of them."""
        starts = np.flatnonzero((text & 0xC0) != 0x80)
        starts = starts[text[starts] != SEPARATOR]
        word = word_of[starts]
        ends = np.append(starts[1:], len(text))
        ends[text[ends - 1] == SEPARATOR] -= 1
        done: list[tuple] = []
        sizes = np.bincount(word)
        long = sizes[word] > LONG_WORD
        for w in np.unique(word[long]):
            mine = word == w
            done.append((*self._heaped(keys, piece, starts[mine], ends[mine]), w))
        starts, ends, word = starts[~long], ends[~long], word[~long]
        pair = self._pairs(keys, piece, starts, ends, word)
        out_s, out_e, out_w = [], [], []
        while len(starts):
            heads = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(pair, heads)
            group = np.cumsum(np.append(False, word[1:] != word[:-1]))
            over = best[group] == _NONE
            if over.any():
                out_s.append(starts[over]), out_e.append(ends[over]), out_w.append(word[over])
                starts, ends, word, pair = starts[~over], ends[~over], word[~over], pair[~over]
                continue
            match = np.flatnonzero(pair == best[group])
            left = match[np.append(True, word[match][1:] != word[match][:-1])]
            ends[left] = ends[left + 1]
            keep = np.ones(len(starts), bool)
            keep[left + 1] = False
            left = left - np.arange(len(left))
            starts, ends, word, pair = starts[keep], ends[keep], word[keep], pair[keep]
            changed = np.zeros(len(starts), bool)
            changed[left] = True
            changed[left[left > 0] - 1] = True
            touched = np.flatnonzero(changed)
            pair[touched] = self._pairs_at(keys, piece, starts, ends, word, touched)
        for s, e, w in done:
            out_s.append(s), out_e.append(e), out_w.append(np.full(len(s), w))
        s, e, w = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_s, out_e, out_w))
        by = np.argsort(s, kind="stable")
        return s[by], e[by], w[by]

    def _pairs_at(self, keys, piece, starts, ends, word, at) -> np.ndarray:
        following = np.minimum(at + 1, len(starts) - 1)
        joined = (at + 1 < len(starts)) & (word[at] == word[following])
        out = np.full(len(at), _NONE, np.int32)
        out[joined] = self._ranks(keys, piece, starts[at[joined]], ends[following[joined]])
        return out

    def _pairs(self, keys, piece, starts, ends, word) -> np.ndarray:
        return self._pairs_at(keys, piece, starts, ends, word, np.arange(len(starts)))

    def _heaped(self, keys, piece, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """One long word: the same joins from a heap of pairs."""
        low, high = np.searchsorted(keys, [starts[0] * 64, ends[-1] * 64 + 64])
        ranks = dict(zip(keys[low:high].tolist(), self.model.ranks[piece[low:high]].tolist()))
        start, end = starts.tolist(), ends.tolist()
        after, before, alive = list(range(1, len(start) + 1)), list(range(-1, len(start) - 1)), [True] * len(start)
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(start):
                size = end[after[i]] - start[i]
                rank = ranks.get(start[i] * 64 + size) if size < 64 else None
                if rank is not None:
                    heapq.heappush(heap, (rank, start[i], i, end[after[i]]))

        for i in range(len(start)):
            offer(i)
        while heap:
            _, _, i, stop = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= len(start) or end[j] != stop:
                continue
            end[i], alive[j], after[i] = end[j], False, after[j]
            if after[j] < len(start):
                before[after[j]] = i
            offer(before[i])
            offer(i)
        kept = [i for i in range(len(start)) if alive[i]]
        return np.array([start[i] for i in kept]), np.array([end[i] for i in kept])

    def _encode_new(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of distinct words end to end, each with the space mark in front, and their counts."""
        raw = [(MARK + w.replace(" ", MARK)).encode() for w in words]
        separator = bytes([SEPARATOR])
        text = np.frombuffer(separator.join(raw) + separator, np.uint8)
        word_of = np.repeat(np.arange(len(raw)), [len(r) + 1 for r in raw])
        keys, piece = self.model.edges(text)
        starts, ends, word = self._relaxed(text, word_of, keys, piece)
        at = _found(keys, starts, ends)
        sizes = np.where(at >= 0, 1, ends - starts)
        ids = np.empty(int(sizes.sum()), np.int32)
        places = np.cumsum(sizes) - sizes
        hit = at >= 0
        ids[places[hit]] = self.model.ids[piece[at[hit]]]
        for s, e, p in zip(starts[~hit], ends[~hit], places[~hit]):
            ids[p : p + e - s] = self.model.byte_ids[text[s:e]]
        return ids, np.bincount(word, sizes, len(raw)).astype(np.int64)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Identifiers of each text."""
        words, counts = split_words(texts)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) + len(distinct) > REMEMBERED:
            self._forget()
        todo = [w for w in distinct if w not in self.known]
        at = 0
        while at < len(todo):
            size, stop = 0, at
            while stop < len(todo) and (stop == at or size < INDEX_BYTES):
                size += len(todo[stop]) + 4
                stop += 1
            ids, sizes = self._encode_new(todo[at:stop])
            self.known.update(zip(todo[at:stop], range(len(self.sizes), len(self.sizes) + len(sizes))))
            self.flat, self.sizes = np.concatenate([self.flat, ids]), np.concatenate([self.sizes, sizes])
            at = stop
        number = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        heads, sizes = (np.cumsum(self.sizes) - self.sizes)[number], self.sizes[number]
        ends = np.cumsum(sizes)
        ids = self.flat[np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes) + np.repeat(heads, sizes)]
        borders = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return [ids[s:e] for s, e in zip(borders[:-1], borders[1:])]


def encode_and_decode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None
) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids, decoded, exact.

    Null and empty texts have no identifiers and decode to an empty text. ``exact`` tells
    whether the decoded text is the text; only texts that hold the space mark itself differ.
    Repeated rows are encoded alike; other columns are ignored.
    """
    path = model or public_tokenizers.path(MODEL)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(path)
        for batch in batches:
            for part in byte_slices(batch, 1, GROUP_BYTES):
                ids = encoder.encode(part.column(1))
                decoded = [encoder.model.decode(x.tolist()) for x in ids]
                exact = pc.equal(pa.array(decoded, pa.string()), part.column(1).fill_null(""))
                borders = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())
                yield pa.record_batch(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(borders), flat), pa.array(decoded, pa.string()), exact],
                    names=["doc_id", "ids", "decoded", "exact"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(code, "doc_id long, ids array<int>, decoded string, exact boolean")
