"""Running values in arrival order, for keys of any size.

A plain window function sends all rows of one key to one task. When a single
account holds a third of the data that task never ends, so hot keys are cut
into chunks of consecutive arrival numbers. Each chunk runs its own window, and
what came before it is a prefix over one summary row per chunk. Rows are
shuffled once, on (key, chunk); cold keys have a single chunk.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.params import ScaleParams
from tallyguard.session import scratch_path

CHUNK = "_chunk"
COLD = -1
FIND = "find"


def find_hot(df: DataFrame, keys: Sequence[str], scale: ScaleParams) -> DataFrame | None:
    """Every key with more than ``scale.chunk_rows`` rows, or None if there are none.

    One counting job over the key columns writes the list to a small table, whose
    size the optimizer knows: it broadcasts the list only where that is small. The
    list steers the work only; results are the same whichever keys it names.
    """
    spark = df.sparkSession
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    path = scratch_path(spark, "hot-keys")
    counts.where(F.col("_n") > scale.chunk_rows).select(*keys).write.parquet(path)
    hot = spark.read.schema(df.select(*keys).schema).parquet(path)
    return None if hot.isEmpty() else hot


def resolve_hot(
    df: DataFrame, keys: Sequence[str], scale: ScaleParams, hot: DataFrame | str | None
) -> DataFrame | None:
    return find_hot(df, keys, scale) if isinstance(hot, str) else hot


def chunk_number(order: str, scale: ScaleParams) -> Column:
    """``order`` is unique within a key, so a chunk holds at most ``chunk_rows`` rows."""
    return F.call_function("div", F.col(order), F.lit(scale.chunk_rows)).cast("long")


def mark_chunks(
    df: DataFrame, keys: Sequence[str], order: str, scale: ScaleParams, hot: DataFrame | None
) -> DataFrame:
    """Add the chunk number: ``COLD`` for whole keys, else the run of arrival numbers."""
    if hot is None:
        return df.withColumn(CHUNK, F.lit(COLD).cast("long"))
    flagged = df.join(hot.withColumn("_hot", F.lit(True)), list(keys), "left")
    number = F.when(F.col("_hot"), chunk_number(order, scale)).otherwise(F.lit(COLD))
    return flagged.withColumn(CHUNK, number.cast("long")).drop("_hot")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    *,
    sums: Mapping[str, Column] | None = None,
    maxima: Mapping[str, Column] | None = None,
    last: Mapping[str, Column] | None = None,
    include_current: bool = False,
    hot: DataFrame | str | None = FIND,
    scale: ScaleParams | None = None,
) -> DataFrame:
    """Add running values over all earlier rows of the same key.

    ``sums`` and ``maxima`` may include the current row; ``last`` is the newest
    non-null value of the rows before it. Sums start at 0, the others at null.
    Nulls are passed over. Hot keys are found unless ``hot`` gives what ``find_hot`` found in these or more rows.
    """
    scale = scale or ScaleParams()
    hot = resolve_hot(df, keys, scale, hot)
    sums, maxima, last = sums or {}, maxima or {}, last or {}
    names = [*sums, *maxima, *last]
    marked = mark_chunks(df, keys, order, scale, hot)
    ordered = Window.partitionBy(*keys, CHUNK).orderBy(order)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    span = ordered.rowsBetween(Window.unboundedPreceding, 0) if include_current else earlier
    inside = marked.select(
        "*",
        *[F.sum(value).over(span).alias(f"_in_{name}") for name, value in sums.items()],
        *[F.max(value).over(span).alias(f"_in_{name}") for name, value in maxima.items()],
        *[F.last(value, True).over(earlier).alias(f"_in_{name}") for name, value in last.items()],
    )
    inner = {name: F.col(f"_in_{name}") for name in names}
    zero = F.lit(0)
    if hot is None:
        results = {n: F.coalesce(inner[n], zero) if n in sums else inner[n] for n in names}
    else:
        hot_rows = df.join(hot, list(keys)).withColumn(
            CHUNK, chunk_number(order, scale)
        )
        before = _before_chunk(hot_rows, keys, order, sums, maxima, last)
        inside = inside.join(before, [*keys, CHUNK], "left")
        outer = {name: F.col(f"_before_{name}") for name in names}
        results = {
            **{n: F.coalesce(inner[n], zero) + F.coalesce(outer[n], zero) for n in sums},
            **{n: F.greatest(inner[n], outer[n]) for n in maxima},
            **{n: F.coalesce(inner[n], outer[n]) for n in last},
        }
    return inside.select(*df.columns, *[value.alias(name) for name, value in results.items()])


def _before_chunk(
    hot_rows: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Mapping[str, Column],
    maxima: Mapping[str, Column],
    last: Mapping[str, Column],
) -> DataFrame:
    """Per chunk of a hot key, the running values when the chunk begins."""
    per_chunk = hot_rows.groupBy(*keys, CHUNK).agg(
        *[F.sum(value).alias(name) for name, value in sums.items()],
        *[F.max(value).alias(name) for name, value in maxima.items()],
        *[
            F.max_by(value, F.when(value.isNotNull(), F.col(order))).alias(name)
            for name, value in last.items()
        ],
    )
    chunks = Window.partitionBy(*keys).orderBy(CHUNK)
    earlier = chunks.rowsBetween(Window.unboundedPreceding, -1)
    return per_chunk.select(
        *keys,
        CHUNK,
        *[F.sum(name).over(earlier).alias(f"_before_{name}") for name in sums],
        *[F.max(name).over(earlier).alias(f"_before_{name}") for name in maxima],
        *[F.last(name, True).over(earlier).alias(f"_before_{name}") for name in last],
    )
