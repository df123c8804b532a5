"""Substring de-duplication by sliding spans of sentences.

Runs of consecutive sentences are hashed; a hash that occurs again anywhere marks
all its occurrences but the first, and every sentence that a marked run covers is
removed. Long sentences are cut at places that only the words nearby decide, so a
passage has the same cuts wherever it stands.

Texts are cut and hashed in slices as arrays of bytes. A slice sends each
hash once, with its earliest place there: what comes later within the slice is known
to be a repeat, so a passage in a third of all documents costs one row a slice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import byte_slices, mixed, powers, span_hashes, utf8, whole_text, words_of, written


@dataclass(frozen=True)
class SpanParams:
    #: Consecutive sentences in a run, at least: more only where these have too few words.
    span: int = 2
    #: Runs of fewer words repeat by chance.
    min_words: int = 12
    #: Sentences of more words are cut, once at least in each ``cut_window`` words. With these sizes
    #: every repeated passage of over 50 words and with the same line breaks has a run whole.
    long_words: int = 16
    cut_window: int = 8
    #: Bytes of text that are cut and hashed at once.
    slice_bytes: int = 1 << 19

    def __post_init__(self) -> None:
        if not 1 <= max(self.span, self.min_words) < _MOST_SENTENCES:
            raise ValueError(f"span and min_words must be below {_MOST_SENTENCES}")


#: A place is packed as sentence * _MOST_SENTENCES + sentences in the run, below 24 bits of a second hash.
_MOST_SENTENCES = 1 << 10
_PLACE_BITS = 40
_PLACE_MASK = (1 << _PLACE_BITS) - 1
#: The second hash of a row that its slice already knows to be a repeat.
_KNOWN = (1 << 24) - 1


@dataclass
class Cut:
    """Sentences of a slice of texts. ``first`` and ``last`` are each text's range of sentences."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    last: np.ndarray
    #: Number of the first word of each sentence, and at the end that of all words.
    words: np.ndarray
    #: A hash of each word.
    codes: np.ndarray


def _cut_inside(codes: np.ndarray, heads: np.ndarray, params: SpanParams) -> np.ndarray:
    """Words at which long sentences are cut: behind the last of the least pairs of each window of pairs."""
    n, window = len(codes), params.cut_window
    cut = np.zeros(n, bool)
    sizes = np.diff(np.append(heads, n))
    left = np.repeat(heads + sizes, sizes) - np.arange(n)
    wide = np.repeat(sizes > max(params.long_words, window), sizes) & (left > window)
    at = np.flatnonzero(wide)
    if not len(at):
        return cut
    with np.errstate(over="ignore"):
        pairs = mixed(codes[:-1] * np.uint64(3) + mixed(codes[1:]))
    least, where = pairs[at], at.copy()
    for k in range(1, window):
        other = pairs[at + k]
        lower = other <= least
        least = np.where(lower, other, least)
        where[lower] = at[lower] + k
    cut[where + 1] = True
    return cut


def cut_sentences(data: np.ndarray, borders: np.ndarray, params: SpanParams) -> Cut:
    """Cut texts behind marks and white space, at line ends and inside long sentences.

    All of a text belongs to one of its sentences, each of which has a word; a text without
    words is one sentence, an empty one none. White space before the first word goes with it.
    """
    starts, ends, row = words_of(data, borders)
    codes = span_hashes(data, starts, ends)
    n = len(starts)
    new = np.zeros(n, bool)
    if n:
        # A line end or a mark before the white space in front of a word.
        lines = np.zeros(len(data) + 1, np.int64)
        np.cumsum(data == 10, out=lines[1:])
        tails = np.isin(data[ends - 1], np.frombuffer(b".!?", np.uint8))
        new[1:] = (row[1:] != row[:-1]) | tails[:-1] | (lines[starts[1:]] > lines[ends[:-1]])
        new[0] = True
        new |= _cut_inside(codes, np.flatnonzero(new), params)
    heads = np.flatnonzero(new)
    owner = row[heads]
    begins = starts[heads]
    opening = np.ones(len(heads), bool)
    opening[1:] = owner[1:] != owner[:-1]
    begins[opening] = borders[owner[opening]]
    # Texts of white space alone are one sentence without a word.
    size = np.diff(borders)
    blank = np.flatnonzero((size > 0) & (np.bincount(owner, minlength=len(size)) == 0))
    if len(blank):
        order = np.argsort(np.concatenate([begins, borders[blank]]), kind="stable")
        heads = np.concatenate([heads, np.searchsorted(starts, borders[blank])])[order]
        owner = np.concatenate([owner, blank])[order]
        begins = np.concatenate([begins, borders[blank]])[order]
    rows = np.arange(len(size))
    first, last = np.searchsorted(owner, rows), np.searchsorted(owner, rows, "right")
    stops = np.append(begins[1:], len(data))
    return Cut(begins, stops, first, last, np.append(heads, n), codes)


def runs_of(cut: Cut, params: SpanParams) -> tuple[np.ndarray, np.ndarray]:
    """First sentence and sentences of the shortest run with enough words from each start and to each end.

    So they cover all of any stretch of ``span`` or more sentences with enough words. A sentence
    with the words of two runs is one too, and so is a text of fewer sentences than ``span``.
    """
    n = len(cut.starts)
    i = np.arange(n)
    counts = cut.last - cut.first
    text_end, text_start = np.repeat(cut.last, counts), np.repeat(cut.first, counts)
    words = cut.words
    stop = np.maximum(i + params.span, np.searchsorted(words, words[:-1] + params.min_words))
    fits = stop <= text_end
    begin = np.minimum(i + 1 - params.span, np.searchsorted(words, words[1:] - params.min_words, "right") - 1)
    back = begin >= text_start
    alone = words[1:] - words[:-1] >= 2 * params.min_words
    few = np.flatnonzero((counts > 0) & (counts < params.span))
    few = few[words[cut.last[few]] - words[cut.first[few]] >= params.min_words]
    places = np.concatenate([i[fits], begin[back], i[alone], cut.first[few]])
    sizes = np.concatenate([(stop - i)[fits], (i + 1 - begin)[back], np.ones(alone.sum(), np.int64), counts[few]])
    keys = np.unique(places * _MOST_SENTENCES + sizes)
    return keys // _MOST_SENTENCES, keys % _MOST_SENTENCES


def run_hashes(cut: Cut, places: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64 and 24 bits for the words of each run."""
    up, down = powers(len(cut.codes) + 1)
    a, b = cut.words[places], cut.words[places + sizes]
    found = []
    with np.errstate(over="ignore"):
        for codes in (cut.codes, mixed(cut.codes ^ np.uint64(0x5851F42D4C957F2D))):
            sums = np.zeros(len(codes) + 1, np.uint64)
            np.cumsum(codes * up[:-1], out=sums[1:])
            found.append(mixed((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)))
    tags = (found[1] >> np.uint64(40)).astype(np.int64)
    return found[0].view(np.int64), np.where(tags == _KNOWN, 0, tags)


_RUN = "h long, doc long, twin long, at long"


def sentence_runs(texts: DataFrame, params: SpanParams) -> DataFrame:
    """(h, doc, twin, at): each run's hash with its earliest place in a slice, and repeats known there."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, 2, params.slice_bytes):
                doc, twin = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                data, borders = utf8(batch.column(2))
                cut = cut_sentences(data, borders, params)
                places, sizes = runs_of(cut, params)
                if not len(places):
                    continue
                h, tags = run_hashes(cut, places, sizes)
                row = np.searchsorted(cut.last, places, "right")
                at = (places - cut.first[row]) * _MOST_SENTENCES + sizes
                # Texts by identifier; runs of a text are in the order of their places already.
                rank = np.empty(len(doc), np.int64)
                by_id = np.lexsort((twin, doc))
                changed = np.ones(len(doc), bool)
                changed[1:] = (np.diff(doc[by_id]) != 0) | (np.diff(twin[by_id]) != 0)
                rank[by_id] = np.cumsum(changed)
                order = np.lexsort((rank[row], tags, h))
                h, tags, at, row = h[order], tags[order], at[order], row[order]
                fresh = np.ones(len(h), bool)
                fresh[1:] = (h[1:] != h[:-1]) | (tags[1:] != tags[:-1])
                lead = np.maximum.accumulate(np.where(fresh, np.arange(len(h)), 0))
                own = (rank[row] == rank[row][lead]) & (at == at[lead])
                known = ~fresh & ~own
                keep = fresh | known
                # Known repeats need not meet anything: they are spread by their places.
                with np.errstate(over="ignore"):
                    spread = mixed(mixed(doc[row].view(np.uint64)) + at.view(np.uint64)).view(np.int64)
                h = np.where(known, spread, h)[keep]
                at = (np.where(known, _KNOWN, tags) << _PLACE_BITS | at)[keep]
                row = row[keep]
                yield pa.record_batch([pa.array(c) for c in (h, doc[row], twin[row], at)], names=["h", "doc", "twin", "at"])

    return texts.mapInArrow(runs, _RUN)


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that are not the first place of their hash; rows come by hash, then by place."""
    held = np.zeros((4, 0), np.int64)
    for batch in batches:
        new = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)])
        h, doc, twin, at = rows = np.concatenate([held, new], axis=1)
        if not len(h):
            continue
        tag, place = at >> _PLACE_BITS & _KNOWN, at & _PLACE_MASK
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (tag[1:] != tag[:-1])
        lead = np.maximum.accumulate(np.where(fresh, np.arange(len(h)), 0))
        other = (doc != doc[lead]) | (twin != twin[lead]) | (place != place[lead])
        found = np.flatnonzero((tag == _KNOWN) | other)
        found = found[found >= held.shape[1]]
        held = rows[:, lead[-1:]].copy()
        if len(found):
            yield pa.record_batch([pa.array(c[found]) for c in (doc, twin, place)], names=["doc", "twin", "at"])


_RESULT = "doc_id long, n_sentences long, n_removed long, kept_sha256 string, kept_text string"


def _removal(params: SpanParams):
    """Marks and texts, by text with its marks first, to the rows of the result."""

    def removed(batch: pa.RecordBatch, same: np.ndarray, marks: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        data, borders = utf8(batch.column("text"))
        cut = cut_sentences(data, borders, params)
        counts = cut.last - cut.first
        # Covered sentences: +1 where a run begins, -1 behind it.
        edges = np.zeros(len(cut.starts) + 1, np.int64)
        row, at = marks
        if same.any():
            places, sizes = runs_of(cut, params)
            owner = np.searchsorted(cut.last, places, "right")
            every = same[owner]
            np.add.at(edges, places[every], 1)
            np.add.at(edges, (places + sizes)[every], -1)
        begin = cut.first[row] + at // _MOST_SENTENCES
        np.add.at(edges, begin, 1)
        np.add.at(edges, begin + at % _MOST_SENTENCES, -1)
        gone = np.cumsum(edges)[:-1] > 0
        n_gone = np.concatenate([[0], np.cumsum(gone)])
        stays = np.repeat(~gone, cut.ends - cut.starts)
        kept_before = np.zeros(len(data) + 1, np.int64)
        np.cumsum(stays, out=kept_before[1:])
        kept, at_byte = data[stays], kept_before[borders]
        flat = kept.tobytes()
        cuts = at_byte.tolist()
        shas = [hashlib.sha256(flat[a:b]).hexdigest() for a, b in zip(cuts, cuts[1:])]
        text = pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(at_byte), pa.py_buffer(flat)).cast(pa.string())
        columns = [batch.column("doc"), pa.array(counts), pa.array(n_gone[cut.last] - n_gone[cut.first]), pa.array(shas, pa.string()), text]
        return pa.record_batch(columns, names=["doc_id", "n_sentences", "n_removed", "kept_sha256", "kept_text"])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = np.zeros(0, np.int64), None
        for batch in batches:
            at = batch.column("at")
            is_mark = at.is_valid().to_numpy(zero_copy_only=False)
            lines = np.flatnonzero(~is_mark)
            marks = np.concatenate([held, at.drop_null().to_numpy(zero_copy_only=False)])
            # Each mark is for the next text; those behind the last text wait for the next batch.
            target = np.searchsorted(lines, np.concatenate([np.full(len(held), -1), np.flatnonzero(is_mark)]))
            ready = target < len(lines)
            held = marks[~ready]
            if not len(lines):
                continue
            texts = batch.take(pa.array(lines))
            doc, twin = texts.column("doc"), texts.column("twin").to_numpy(zero_copy_only=False)
            named = doc.is_valid().to_numpy(zero_copy_only=False)
            ids = doc.fill_null(0).to_numpy(zero_copy_only=False)
            same = np.zeros(len(lines), bool)
            same[1:] = named[1:] & named[:-1] & (ids[1:] == ids[:-1]) & (twin[1:] == twin[:-1])
            same[0] = bool(named[0]) and before == (int(ids[0]), int(twin[0]))
            before = (int(ids[-1]), int(twin[-1])) if named[-1] else None
            target, marks = target[ready], marks[ready]
            done = 0
            for part in byte_slices(texts, texts.schema.get_field_index("text"), params.slice_bytes):
                a, b = np.searchsorted(target, [done, done + part.num_rows])
                yield removed(part, same[done : done + part.num_rows], (target[a:b] - done, marks[a:b]))
                done += part.num_rows

    return remove


def remove_repeated_sentences(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    params: SpanParams | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_sentences, n_removed, kept_sha256, kept_text.

    Null is an empty text; a text of one sentence is a run. Pieces of a long
    sentence count as sentences. Repeats of under ``min_words`` words stay. The
    first occurrence has the smallest identifier, then the earliest place. Different texts
    that share an identifier are documents of their own, ordered by a hash of the text; of
    rows that are equal in both, one keeps its text and the others lose all their runs.
    Rows without an identifier lose nothing and count for nothing. Other columns are
    ignored. A text is cut whole in one task, which takes about 100 bytes for each of its bytes.
    """
    params = params or SpanParams()
    own = docs.select(F.col(id_col).cast("long").alias("doc"), whole_text(text_col).alias("text"))
    # Identifiers of several rows, mostly none: as a table its size is known when the join is planned.
    shared = written(own.where("doc is not null").groupBy("doc").count().where("count > 1").select("doc"), "shared-ids")
    own = own.join(shared.withColumn("is_shared", F.lit(True)), "doc", "left")
    twin = F.when(F.col("doc").isNull() | F.col("is_shared"), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    own = own.select("doc", twin.alias("twin"), "text")
    found = sentence_runs(own.where(F.col("doc").isNotNull()), params)
    by_hash = found.repartition("h").sortWithinPartitions("h", F.shiftright("at", _PLACE_BITS), "doc", "twin", "at")
    marks = by_hash.mapInArrow(_later, "doc long, twin long, at long").select("*", F.lit(None).cast("string").alias("text"))
    rows = marks.unionByName(own.withColumn("at", F.lit(None).cast("long")))
    placed = rows.repartition("doc", "twin").sortWithinPartitions("doc", "twin", F.col("at").asc_nulls_last())
    return placed.mapInArrow(_removal(params), _RESULT)
