"""Mix sources to target weights by pivotal dependent rounding.

Every document of a source starts with the same fractional number of copies.
Two documents with open fractions are paired, and words are moved at random
between them until one fraction is whole; the words of the pair and every
document's expected copies stay the same. Blocks of documents do this side by
side, each leaves one open document, and these meet in a tree of further blocks
until one open document a source is rounded at random.

Documents of more than 1/``LARGE_PARTS`` of their source's target go first, and what
their rounding adds or lacks changes the rate of the others. A source's words thus
miss its target by less than one of its smaller documents, where it has enough of these.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.llm.common import WORD, whole_text, written

MOST_COPIES = 3
BLOCK_ROWS = 512
FAN_IN = 64
LARGE_PARTS = 20
#: Sources weigh 1, 2, 3 and so on again.
CYCLE = 3
SEED = 17


def numbered_sources(totals: DataFrame) -> DataFrame:
    """``totals`` (source, ...) with each source's weight: 1, 2, 3, repeating, by code point, null last.

    A range sort places the sources; only the number of sources in each range, a row
    a partition, meets in one task.
    """
    order = [F.col("source").isNull(), F.col("source")]
    sorted_ = totals.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(sorted_.withColumn("place", F.monotonically_increasing_id()), "mix-sources")
    # The identifier holds the partition above 33 bits and the row's number in it below.
    placed = placed.withColumn("range", F.shiftright("place", 33)).withColumn("at", F.col("place").bitwiseAND((1 << 33) - 1))
    ranges = placed.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("range")) - F.col("n")
    placed = placed.join(ranges.select("range", before.alias("before")), "range")
    weight = 1 + F.pmod(F.col("before") + F.col("at"), F.lit(CYCLE))
    return placed.withColumn("weight", weight.cast("long")).drop("place", "range", "at", "before")


def _whole_number(column: Column, digits: int) -> Column:
    return column.cast(T.DecimalType(digits, 0))


def with_targets(sources: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """``sources`` (source, size, weight) with target, and the rate of copies as ``whole`` and ``open``.

    Shares go by weight. A source whose share is above ``most`` times its size stops there
    and the excess goes to the others by weight, until none is above. The words left and the
    weights left are whole numbers, so a round is one sum over the table; the share of a unit
    of weight only grows, so the stopped sources of a round include those of the rounds
    before, and as in Newton's method the rounds grow with the logarithm of the sizes.
    """
    all_size, all_weight = sources.agg(
        F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))
    ).first()
    size, weight = _whole_number(F.col("size"), 18), _whole_number(F.col("weight"), 1)
    words, weights = all_size, all_weight
    while True:
        part_words, part_weight = _whole_number(F.lit(words), 18) * weight, _whole_number(F.lit(weights), 12) * size
        above = part_words > part_weight * F.lit(most).cast(T.DecimalType(4, 0))
        stopped = sources.where(above).agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
        left = all_size - most * stopped[0], all_weight - stopped[1]
        if left == (words, weights):
            break
        words, weights = left
    some = ~above & (F.col("size") > 0)
    whole = F.when(above & (F.col("size") > 0), F.lit(most)).when(some, F.floor((part_words - part_words % part_weight) / part_weight))
    rest = F.when(some, (part_words % part_weight).cast("double") / part_weight.cast("double"))
    target = F.when(above, F.col("size") * most).otherwise(part_words.cast("double") / F.lit(max(weights, 1)).cast("double"))
    return sources.select(
        "*",
        target.cast("double").alias("target"),
        F.coalesce(whole.cast("long"), F.lit(0)).cast("long").alias("whole"),
        F.coalesce(rest, F.lit(0.0)).alias("open"),
    )


def _draw(key: int, level: int) -> float:
    """A number in [0, 1) that is the same in every run."""
    x = (key + (level + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return ((x ^ (x >> 31)) >> 11) / 2**53


_TINY = 1e-9


def pivot(open_a: float, size_a: int, open_b: float, size_b: int, draw: float) -> tuple[float, float]:
    """Move words between two open fractions so that one becomes 0 or 1."""
    up = min(size_a * (1 - open_a), size_b * open_b)
    down = min(size_a * open_a, size_b * (1 - open_b))
    move = up if draw * (up + down) < down else -down
    a, b = open_a + move / size_a, open_b - move / size_b
    return (round(a) if min(abs(a), abs(1 - a)) < _TINY else a), (round(b) if min(abs(b), abs(1 - b)) < _TINY else b)


def _rounds(level: int, final: bool):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                place = (row["source"], row["block"])
                if place != at:
                    if held is not None:
                        done.append(_closed(held, level, final))
                    at, held = place, None
                if held is None:
                    held = row
                    continue
                held["open"], row["open"] = pivot(held["open"], held["size"], row["open"], row["size"], _draw(row["key"], level))
                for unit in (held, row):
                    if unit["open"] in (0, 1):
                        unit["copies"] = unit["whole"] + int(unit["open"])
                        done.append(unit)
                still = [unit for unit in (held, row) if unit["copies"] is None]
                held = still[0] if still else None
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=batch.schema)
        if held is not None:
            yield pa.RecordBatch.from_pylist([_closed(held, level, final)], schema=batch.schema)

    return step


def _closed(unit: dict, level: int, final: bool) -> dict:
    if final:
        unit["copies"] = unit["whole"] + int(_draw(unit["key"] ^ 0x5555, level) < unit["open"])
    return unit


def _settled(todo: DataFrame, most: int, fan_in: int, label: str) -> list[DataFrame]:
    """Tables of ``todo``'s units with their copies, one a level of the tree over ``most`` blocks."""
    decided, level = [], 0
    while most:
        # Larger documents first, so that a small one is left open in the end.
        placed = todo.repartition("source", "block").sortWithinPartitions("source", "block", F.desc("size"), "key", "doc_id")
        done = written(placed.mapInArrow(_rounds(level, most == 1), todo.schema), f"{label}-{level}")
        decided.append(done.where(F.col("copies").isNotNull()))
        todo = done.where(F.col("copies").isNull()).withColumn("block", F.floor(F.col("block") / fan_in).cast("long"))
        most = 0 if most == 1 else -(-most // fan_in)
        level += 1
    return decided


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = SEED,
    block_rows: int = BLOCK_ROWS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source, source_size, target, copies, taken, key.

    Sizes are words, none for null or empty texts; such rows are copied as often
    as their source's rate says, rounded down, but never less than once where the
    rate is positive, as they take no words. Null is a source of its own. Rows
    with equal identifier, source and text draw alike only by chance of order, so
    their outcomes may be exchanged among them. Other columns are ignored.
    """
    own = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.regexp_count(whole_text(text_col), F.lit(WORD)).cast("long").alias("size"),
        row_key(id_col, text_col, source_col, seed).alias("key"),
    )
    own = written(own, "mix-sizes")
    totals = own.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    plan = with_targets(numbered_sources(totals)).select(
        F.col("source").alias("_source"),
        F.col("size").alias("source_size"),
        "target",
        "whole",
        "open",
        F.ceil(F.col("rows") / block_rows).cast("long").alias("blocks"),
    )
    plan = written(plan, "mix-plan")
    most = plan.agg(F.coalesce(F.max("blocks"), F.lit(0))).first()[0]
    planned = own.join(plan, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    wordless = F.col("size") == 0
    settled = wordless | (F.col("open") == 0)
    least = F.greatest(F.col("whole"), F.ceil("open").cast("long"))
    units = planned.select(
        "doc_id",
        "key",
        "source",
        "size",
        "source_size",
        "target",
        "whole",
        "open",
        "blocks",
        F.pmod("key", F.col("blocks")).alias("block"),
        F.when(settled, F.when(wordless, F.when(F.col("whole") > 0, F.col("whole")).otherwise(least)).otherwise(F.col("whole"))).alias("copies"),
    )
    large = F.col("size") * LARGE_PARTS > F.col("target")
    open_units = units.where(F.col("copies").isNull())
    first = _settled(open_units.where(large), most, fan_in, "mix-large")
    taken = [part.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("_taken")) for part in first]
    others = open_units.where(~large)
    sums = others.groupBy("source").agg(F.sum("size").alias("_others"))
    for i, part in enumerate(taken):
        sums = sums.join(part.select(F.col("source").alias("_s"), F.col("_taken").alias(f"_taken_{i}")), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    spent = sum((F.coalesce(f"_taken_{i}", F.lit(0)) for i in range(len(taken))), F.lit(0))
    sums = written(sums.select(F.col("source").alias("_source"), "_others", spent.alias("_spent")), "mix-rest")
    rate = F.least(F.greatest((F.col("target") - F.col("_spent")) / F.col("_others"), F.lit(0.0)), F.lit(float(MOST_COPIES)))
    others = others.join(sums, F.col("source").eqNullSafe(F.col("_source"))).withColumn("whole", F.floor(rate))
    others = others.withColumn("open", rate - F.col("whole"))
    others = others.withColumn("copies", F.when(F.col("open") == 0, F.col("whole"))).select(*units.columns)
    decided = [units.where(F.col("copies").isNotNull()), *first, others.where(F.col("copies").isNotNull())]
    decided += _settled(others.where(F.col("copies").isNull()), most, fan_in, "mix-level")
    found = decided[0]
    for more in decided[1:]:
        found = found.unionByName(more)
    return found.select(
        "doc_id", "size", "source", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"), "key"
    )


def row_key(id_col: str, text_col: str, source_col: str, seed: int):
    return F.xxhash64(F.lit(seed), F.col(id_col).cast("long"), F.col(source_col).cast("string"), F.xxhash64(whole_text(text_col)))


def take_mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED
) -> DataFrame:
    """The rows of the mix, each as often as it is copied, with the columns of ``docs``.

    Rows that are alike in identifier, source and text take together what all of them got;
    one of them, any, gives the other columns of these copies.
    """
    mix = mix_sources(docs, id_col, text_col, source_col, seed)
    copies = mix.groupBy("doc_id", "source", "key").agg(F.sum("copies").alias("all")).where("all > 0")
    # The rows travel as one column, so no name of theirs can clash. The hash alone would not tell all documents apart.
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        row_key(id_col, text_col, source_col, seed).alias("key"),
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
    )
    one, got = rows.dropDuplicates(["doc_id", "source", "key"]).alias("one"), copies.alias("got")
    alike = [F.col(f"one.{name}").eqNullSafe(F.col(f"got.{name}")) for name in ("key", "doc_id", "source")]
    repeated = one.join(got, alike).select("row", F.explode(F.sequence(F.lit(1).cast("long"), "all")))
    return repeated.select("row.*")
