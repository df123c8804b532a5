"""Exact de-duplication by sorting contents.

Sampled splitters range-partition the normalised texts, Spark's external sort
places equal texts side by side, and neighbours are compared in full. The sort
key ends with the identifier, so a text of any number of copies may spread over
several tasks; each task reports its runs in lists of bounded length, and runs of
one text that meet at a border are joined by their SHA-256.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import SPACE, whole_text, written

#: Identifiers in one list of a run.
RUN_IDS = 1024
HEAD_CHARS = 32

_RUNS = pa.schema(
    [("part", pa.int64()), ("run", pa.int64()), ("text_sha256", pa.string()), ("ids", pa.list_(pa.int64()))]
)


def normalised(text: str = "text"):
    return F.regexp_replace(whole_text(text), SPACE, " ")


def _neighbour_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours; a run goes on over batches, and is told in lists."""
    part = TaskContext.get().partitionId()
    before, run = None, -1
    for batch in batches:
        texts, ids = batch.column(0), batch.column(1)
        same = pc.equal(texts.slice(1), texts.slice(0, len(texts) - 1)).to_pylist() if len(texts) > 1 else []
        rows: list[tuple[int, str, list]] = []
        shas = batch.column(2)
        for i, doc in enumerate(ids.to_pylist()):
            equal = same[i - 1] if i else (before is not None and texts[0].as_py() == before)
            if equal and rows and len(rows[-1][2]) < RUN_IDS:
                rows[-1][2].append(doc)
            else:
                run += 1
                rows.append((run, shas[i].as_py(), [doc]))
        if len(texts):
            before = texts[-1].as_py()
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.record_batch([pa.array([part] * len(rows), pa.int64()), *map(pa.array, columns[:2], ("int64", "string")), pa.array(columns[2], pa.list_(pa.int64()))], schema=_RUNS)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical once each run of white space is one space; null
    is empty. The smallest identifier stays; a null identifier counts as larger
    than any other. Of rows with equal identifier and text exactly one stays.
    Other columns are ignored. An empty table gives an empty result.
    """
    text = normalised(text_col)
    rows = docs.select(text.alias("norm"), F.col(id_col).cast("long").alias("doc_id"))
    rows = rows.select(
        "norm",
        "doc_id",
        F.sha2("norm", 256).alias("sha"),
        F.substring("norm", 1, HEAD_CHARS).alias("head"),
        F.xxhash64("norm").alias("hash"),
    )
    last = F.col("doc_id").asc_nulls_last()
    placed = rows.repartitionByRange("head", "hash", last)
    placed = placed.sortWithinPartitions("head", "hash", "norm", last)
    runs = placed.select("norm", "doc_id", "sha").mapInArrow(
        _neighbour_runs, "part long, run long, text_sha256 string, ids array<long>"
    )
    runs = written(runs, "exact-runs")
    place = F.struct("part", "run")
    groups = runs.groupBy("text_sha256").agg(
        F.sum(F.size("ids")).cast("long").alias("group_size"),
        F.min(place).alias("first"),
        F.min_by(F.col("ids")[0], place).alias("keep_id"),
    )
    each = runs.join(groups, "text_sha256").select(
        "*", F.posexplode("ids").alias("at", "doc_id"), (F.col("first") == place).alias("opens")
    )
    kept = F.col("opens") & (F.col("at") == 0)
    return each.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    keep = exact_groups(docs, id_col, text_col).where("kept").select("doc_id", F.col("text_sha256").alias("sha"))
    # The rows travel as one column, so no name of theirs can clash.
    rows = docs.select(
        F.sha2(normalised(text_col), 256).alias("sha"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
    ).alias("own")
    keep = keep.alias("keep")
    alike = [F.col(f"own.{name}").eqNullSafe(F.col(f"keep.{name}")) for name in ("sha", "doc_id")]
    # One of several rows with the same identifier and text.
    found = rows.join(keep, alike).select("own.*").dropDuplicates(["sha", "doc_id"])
    return found.select("row.*")
