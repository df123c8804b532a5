"""Removal of repeated byte strings with suffix arrays.

Strings of ``length`` bytes that are equal choose the same anchor, the smallest
hash among the grams inside, and so meet under it. Stretches of text around
anchors that occur once cannot repeat and go no further. Equal stretches under
an anchor are kept once, with their first place. The different ones are dealt to
shards by anchor, each shard's suffix array is made by induced sorting, and
neighbours with long common prefixes tell which strings also start earlier.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.llm.common import BYTE_CODES, mixed, powers, span_hashes, utf8, whole_text, written
from tallyguard.llm.suffix_array import SEPARATOR, common_prefixes, suffix_array


@dataclass(frozen=True)
class SuffixParams:
    length: int = 100
    gram: int = 24
    piece_bytes: int = 1 << 20
    shard_bytes: int = 2 << 20
    #: An anchor with more different stretches has its strings compared by hash, over many tasks.
    stretches: int = 10_000


def _pieces(batch: pa.RecordBatch, most: int, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, borders, row numbers and offsets in the row; long rows come in overlapping pieces."""
    data, borders = utf8(batch.column(1))
    start, n = 0, batch.num_rows
    while start < n:
        stop = int(np.searchsorted(borders, borders[start] + most, "right")) - 1
        if stop > start:
            stop = min(stop, n)
            yield data[borders[start] : borders[stop]], borders[start : stop + 1] - borders[start], np.arange(start, stop), np.zeros(stop - start, np.int64)
            start = stop
            continue
        row = data[borders[start] : borders[start + 1]]
        for at in range(0, len(row), most):
            part = row[at : at + most + overlap]
            yield part, np.array([0, len(part)]), np.array([start]), np.array([at])
        start += 1


def _anchored(data: np.ndarray, borders: np.ndarray, params: SuffixParams):
    """Stretches of window starts that share an anchor: piece row, first start, count, anchor and stretch hashes."""
    length, gram = params.length, params.gram
    width = length - gram + 1
    if len(data) < length:
        return None
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * up[: len(data)], out=sums[1:])
    grams = mixed((sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1])
    lowest = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        lowest = np.minimum(lowest[:-span], lowest[span:])
        span *= 2
    if span < width:
        lowest = np.minimum(lowest[: len(lowest) - (width - span)], lowest[width - span :])
    anchor = (lowest & np.uint64(0xFFFFFFFF)).astype(np.int64)  # by window start; the leftmost of equals
    row = np.repeat(np.arange(len(borders) - 1), np.diff(borders))[: len(anchor)]
    whole = np.arange(len(anchor)) + length <= borders[1:][row]
    first = whole.copy()
    first[1:] &= ~whole[:-1] | (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    starts = np.flatnonzero(first)
    if not len(starts):
        return None
    last = whole.copy()
    last[:-1] &= ~whole[1:] | first[1:]
    counts = np.flatnonzero(last) - starts + 1
    ends = starts + counts - 1 + length
    stretch = mixed((sums[ends] - sums[starts]) * down[starts] + ((anchor[starts] - starts) * 1000003 + counts).astype(np.uint64))
    return row[starts], starts, counts, grams[anchor[starts]], stretch


def anchors(texts: DataFrame, params: SuffixParams) -> DataFrame:
    """(anchor, stretch, doc, place) for (doc, text); place holds the start and the count of windows."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for data, borders, rows, offsets in _pieces(batch, params.piece_bytes, params.length - 1):
                found = _anchored(data, borders, params)
                if found is None:
                    continue
                row, starts, counts, anchor, stretch = found
                at = starts - borders[row] + offsets[row]
                yield pa.record_batch(
                    [pa.array(anchor.view(np.int64)), pa.array(stretch.view(np.int64)), pa.array(ids[rows[row]]), pa.array(at * 128 + counts)],
                    names=["anchor", "stretch", "doc", "place"],
                )

    return texts.mapInArrow(find, "anchor long, stretch long, doc long, place long")


def _start():
    return F.shiftright("place", 7)


def _count():
    return F.col("place").bitwiseAND(127)


def _cut(joined: DataFrame) -> DataFrame:
    """The bytes of each stretch asked for: rows (text, wanted) to (anchor, doc, start, bytes)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = ([], [], [], [])
            for doc, text, wanted in zip(*(batch.column(k).to_pylist() for k in range(3))):
                raw = text.encode()
                for want in wanted:
                    out[0].append(want["anchor"])
                    out[1].append(doc)
                    out[2].append(want["start"])
                    out[3].append(raw[want["start"] : want["end"]])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds)], names=["anchor", "doc", "start", "bytes"])

    return joined.mapInArrow(cut, "anchor long, doc long, start long, bytes binary")


def repeated_in_shard(pieces: list[bytes], docs: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (piece, offset) of strings of ``length`` bytes that also start earlier in the shard."""
    separator = bytes([SEPARATOR])
    text = np.frombuffer(separator.join(pieces) + separator, np.uint8)
    sizes = np.array([len(p) + 1 for p in pieces])
    heads = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    order = suffix_array(text)
    shared = common_prefixes(text, order)
    piece = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
    offset = np.arange(len(text)) - heads[piece]
    whole = offset + length < sizes[piece]
    places = order[whole[order]].astype(np.int64)
    # Equal strings are neighbours; what lies between two of them shares as much.
    group = np.cumsum(shared < length)[whole[order]]
    if not len(places):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc, at = docs[piece[places]], starts[piece[places]] + offset[places]
    by = np.lexsort((at, doc))
    rank = np.empty(len(by), np.int64)
    rank[by] = np.cumsum(np.concatenate([[0], (doc[by][1:] != doc[by][:-1]) | (at[by][1:] != at[by][:-1])]))
    heads_of = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    least = np.repeat(np.minimum.reduceat(rank, heads_of), np.diff(np.concatenate([heads_of, [len(rank)]])))
    found = np.sort(places[rank > least])
    return piece[found].astype(np.int64), offset[found]


def _shards(params: SuffixParams):
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None

        def flush() -> pa.RecordBatch:
            anchors_, docs, starts, pieces = zip(*held)
            docs, starts = np.array(docs), np.array(starts)
            piece, offset = repeated_in_shard(list(pieces), docs, starts, params.length)
            new = np.ones(len(piece), bool)
            new[1:] = (piece[1:] != piece[:-1]) | (offset[1:] != offset[:-1] + 1)
            heads = np.flatnonzero(new)
            tails = np.concatenate([heads[1:], [len(piece)]])[: len(heads)] - 1
            return pa.record_batch(
                [
                    pa.array(docs[piece[heads]], pa.int64()),
                    pa.array(starts[piece[heads]] + offset[heads], pa.int64()),
                    pa.array(starts[piece[heads]] + offset[tails] + params.length, pa.int64()),
                ],
                names=["doc", "start", "end"],
            )

        for batch in batches:
            for item in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if size > params.shard_bytes and item[0] != last:
                    yield flush()
                    held, size = [], 0
                held.append(item)
                size += len(item[3]) + 1
                last = item[0]
        if held:
            yield flush()

    return sort


def _by_hash(cut: DataFrame, length: int) -> DataFrame:
    """Repeated strings among stretches of anchors with very many of them, a row a string."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, borders = utf8(batch.column(3))
            n = np.maximum(np.diff(borders) - length + 1, 0)
            row = np.repeat(np.arange(len(n)), n)
            at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            left = borders[:-1][row] + at
            middle = left + length // 2
            one, two = span_hashes(data, left, middle), span_hashes(data, middle, left + length)
            ids, starts = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
            yield pa.record_batch(
                [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(ids[row]), pa.array(starts[row] + at)],
                names=["one", "two", "doc", "start"],
            )

    rows = cut.mapInArrow(strings, "one long, two long, doc long, start long")
    first = rows.groupBy("one", "two").agg(F.min(F.struct("doc", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
    again = rows.join(first.where("n > 1"), ["one", "two"]).where(F.struct("doc", "start") > F.col("first"))
    return again.select("doc", "start", (F.col("start") + length).alias("end"))


def repeated_spans(texts: DataFrame, params: SuffixParams) -> tuple[DataFrame, DataFrame]:
    """Spans (doc, start, end) of bytes to remove from (doc, text), and the texts dealt by doc."""
    found = anchors(texts, params)
    twice = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    twice = written(twice, "suffix-anchors")
    met = written(found.join(twice, "anchor"), "suffix-places")
    firsts = met.groupBy("anchor", "stretch").agg(F.min(F.struct("doc", "place")).alias("first"))
    firsts = written(firsts, "suffix-firsts")
    later = met.join(firsts, ["anchor", "stretch"]).where(F.struct("doc", "place") > F.col("first"))
    equal = later.select("doc", _start().alias("start"), (_start() + _count() + params.length - 1).alias("end"))
    several = firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ask = firsts.select("anchor", F.col("first.doc").alias("doc"), F.col("first.place").alias("place")).join(several, "anchor")
    many = F.col("n") > params.stretches
    # One exchange of the texts serves this join and the one that removes the spans.
    dealt = texts.where(F.col("doc").isNotNull()).repartition("doc")

    def stretches_of(rows: DataFrame) -> DataFrame:
        want = F.struct("anchor", _start().alias("start"), (_start() + _count() + params.length - 1).alias("end"))
        by_doc = rows.groupBy("doc").agg(F.collect_list(want).alias("wanted"))
        return _cut(dealt.join(by_doc, "doc").select("doc", "text", "wanted"))

    few = stretches_of(ask.where(~many)).repartition("anchor").sortWithinPartitions("anchor")
    spans = equal.union(few.mapInArrow(_shards(params), "doc long, start long, end long"))
    if not several.where(many).isEmpty():
        spans = spans.union(_by_hash(stretches_of(ask.where(many)), params.length))
    return spans, dealt


_RESULT = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"


def _removed(with_text: bool):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, spans in zip(*(batch.column(k).to_pylist() for k in range(3))):
                raw = text.encode()
                merged: list[list[int]] = []
                for span in sorted((s["start"], s["end"]) for s in spans or ()):
                    if merged and span[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], span[1])
                    else:
                        merged.append(list(span))
                at, kept = 0, []
                for start, end in merged:
                    kept.append(raw[at:start])
                    at = end
                kept.append(raw[at:])
                rest = b"".join(kept)
                shown = rest.decode(errors="replace") if with_text else None
                rows.append((doc, len(raw), len(raw) - len(rest), len(merged), hashlib.sha256(rest).hexdigest(), shown))
            columns = list(zip(*rows)) or [()] * 6
            kinds = (pa.int64(),) * 4 + (pa.string(),) * 2
            names = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return remove


def _numbered(docs: DataFrame) -> DataFrame:
    """(doc, doc_id, text) with rows numbered by identifier, null last, then by text."""
    ordered = docs.orderBy(F.col("doc_id").asc_nulls_last(), F.sha2("text", 256))
    schema = T.StructType([T.StructField("doc", T.LongType()), *docs.schema.fields])
    return docs.sparkSession.createDataFrame(ordered.rdd.zipWithIndex().map(lambda x: (x[1], *x[0])), schema)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    params: SuffixParams | None = None,
    with_text: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept_text).

    Null is an empty text; texts shorter than the length lose nothing. Rows that share
    an identifier, or have none, are ordered by their text (rows without one last).
    Where a cut splits a character, ``kept_text`` shows a replacement character; the
    hash is of the bytes. Other columns are ignored.
    """
    params = params or SuffixParams()
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    doubtful = own.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    numbered = not doubtful.isEmpty()
    if numbered:
        keyed = written(_numbered(own), "suffix-numbered")
        texts = keyed.select("doc", "text")
    else:
        texts = own.select(F.col("doc_id").alias("doc"), "text")
    spans, dealt = repeated_spans(texts, params)
    by_doc = spans.groupBy("doc").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    found = dealt.join(by_doc, "doc", "left").select("doc", "text", "spans").mapInArrow(_removed(with_text), _RESULT)
    if numbered:
        found = found.join(keyed.select("doc", "doc_id"), "doc")
    else:
        found = found.withColumnRenamed("doc", "doc_id")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept_text"] * with_text)
