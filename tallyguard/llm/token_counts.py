"""Token counts of whole texts, without keeping the tokens.

Texts come in Arrow batches that are cut again by bytes. Each text is split at
boundaries that no token can cross, equal pieces of a batch are encoded once,
and only their lengths travel back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import byte_slices, split_words, utf8

MODEL = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
GROUP_BYTES = 12 << 20
ENCODE_PIECES = 20_000


class PieceCounter:
    """Counts by one model. A piece starts with the space mark that the space before it becomes."""

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        # Safe only if no token has the mark behind another character, and marks are added in front.
        self.splits = not any("▁" in name.lstrip("▁") for name in names) and len(
            self.model.encode("a a")
        ) == 2 * len(self.model.encode("a"))

    def lengths(self, pieces: list[str]) -> np.ndarray:
        out = np.empty(len(pieces), np.int64)
        for at in range(0, len(pieces), ENCODE_PIECES):
            coded = self.model.encode(pieces[at : at + ENCODE_PIECES], num_threads=1)
            out[at : at + len(coded)] = [len(x) for x in coded]
        return out

    def counts(self, texts: pa.Array) -> np.ndarray:
        texts = texts.fill_null("")
        if not self.splits:
            return self.lengths(texts.to_pylist())
        pieces, counts = split_words(texts)
        coded = pieces.dictionary_encode()
        sizes = self.lengths(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        sums = np.concatenate([[0], np.cumsum(sizes)])
        borders = np.concatenate([[0], np.cumsum(counts)])
        return sums[borders[1:]] - sums[borders[:-1]]


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    model: str | None = None,
    limit: int = TOKEN_LIMIT,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    Null and empty texts have no tokens. Identifiers are passed on as they are,
    null and repeated ones too. Other columns are ignored.
    """
    path = model or public_tokenizers.path(MODEL)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(path)
        for batch in batches:
            for part in byte_slices(batch, 1, GROUP_BYTES):
                _, borders = utf8(part.column(1))
                yield pa.record_batch(
                    [part.column(0), pa.array(np.diff(borders)), pa.array(counter.counts(part.column(1)))],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
