"""What the operators share: reading texts as bytes in Arrow batches, hashing, scratch tables."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.session import scratch_path

#: The white space of the word pattern, for Java's and Python's regular expressions.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

SLICE_BYTES = 1 << 20


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: computed once, safe from lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array end to end, and the len + 1 borders of its rows; null is empty."""
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    borders = np.frombuffer(offsets, np.int64 if wide else np.int32)
    borders = borders[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    flat = np.frombuffer(data, np.uint8)[borders[0] : borders[-1]]
    return flat, borders - borders[0]


def byte_slices(batch: pa.RecordBatch, text: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch with about ``most`` bytes of text each; a longer text is alone."""
    if not batch.num_rows:
        return
    _, borders = utf8(batch.column(text))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(borders, borders[start] + most, "right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))


def words_of(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word; words never cross rows."""
    gap = np.ones(len(data) + 1, bool)
    gap[:-1] = is_space(data)
    inside = ~gap[:-1]
    first = inside.copy()
    first[1:] &= gap[:-2]
    heads = borders[:-1][borders[:-1] < len(data)]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= gap[1:-1]
    tails = borders[1:][borders[1:] > 0] - 1
    last[tails] = inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(borders, starts, "right") - 1


_ODD = np.uint64(0x9E3779B97F4A7C15)
BYTE_CODES = np.random.default_rng(20240501).integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a finaliser with two multiplications)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, 1 << 21)
        inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
        for name, base in (("up", _ODD), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, from running sums, whatever the spans' lengths."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * up[: len(data)], out=sums[1:])
    _, down = powers(len(data) + 1)
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


#: One space between two characters that are neither a space nor the mark that piece models write for one.
_SAFE = re.compile("(?<=[^ ▁]) (?=[^ ▁])")


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Texts cut at single spaces, end to end, and how many pieces each has; an empty text has none.

    No token of a piece model crosses such a space, and the piece behind it begins with the
    mark that the model puts in front of any text. Runs of spaces stay with the word behind them.
    """
    texts = texts.fill_null("")
    odd = pc.match_substring_regex(texts, "^ |  | $|▁")
    parts = pc.split_pattern(texts, " ")
    if pc.any(odd).as_py():
        flags, cut = odd.to_pylist(), parts.to_pylist()
        cut = [_SAFE.split(text) if flag else words for text, words, flag in zip(texts.to_pylist(), cut, flags)]
        parts = pa.array(cut, pa.list_(pa.string()))
    counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    words = parts.flatten()
    empty = pc.equal(pc.binary_length(texts), 0)
    if pc.any(empty).as_py():
        counts[empty.to_numpy(zero_copy_only=False)] = 0
        words = words.filter(pc.not_equal(pc.binary_length(words), 0))
    return words, counts
