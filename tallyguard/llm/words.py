"""Words of a slice of texts as Arrow arrays, cut in whole-array steps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes of ASCII letters and of every character beyond ASCII, and A-Z in lower case.
LETTER = np.zeros(256, bool)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = LETTER[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False


def cut_words(
    data: np.ndarray, borders: np.ndarray, kind: np.ndarray, lower: bool
) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The stretches of bytes of ``kind``, dictionary-encoded, and how many each row has.

    ``data`` and ``borders`` are the bytes of the rows end to end and where rows begin. A
    stretch never crosses rows. No byte of a longer UTF-8 character is an ASCII one, so
    classes of bytes cut at characters.
    """
    inside = kind[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    heads = borders[:-1][np.diff(borders) > 0]
    first[heads] = inside[heads]
    tails = borders[1:][np.diff(borders) > 0] - 1
    last[tails] = inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(starts, borders))
    kept = data[inside]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(offsets), pa.py_buffer(LOWER[kept] if lower else np.ascontiguousarray(kept))
    )
    return words.dictionary_encode(), counts
