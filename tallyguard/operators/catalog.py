"""Queries over the product list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from tallyguard.functions.text import equals_ignore_case


def products_by_category(products: DataFrame, category: str | None = None) -> DataFrame:
    """Products of one category, ignoring case; without a category, all of them."""
    if category is None or not category.strip():
        return products
    return products.where(equals_ignore_case(F.col("category"), F.lit(category)))


def category_summary(products: DataFrame, keys: Sequence[str] = ("category",)) -> DataFrame:
    """Count, total and mean price per group, highest total first.

    Groups with the same total keep the order in which they first appear (by id).
    """
    return (
        products.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            F.sum("price").alias("total_value"),
            F.avg("price").alias("average_price"),
            F.min("id").alias("first_id"),
        )
        .orderBy(F.desc("total_value"), "first_id")
        .drop("first_id")
    )


def inventory_report(products: DataFrame) -> DataFrame:
    """Number of products and value of the stock, both in one pass."""
    return products.agg(
        F.count(F.lit(1)).alias("product_count"),
        F.sum(F.col("price") * F.col("stock")).alias("total_inventory_value"),
    )


def paged_listing(
    rows: DataFrame,
    sort_by: str,
    tie_break: str,
    page: int = 1,
    page_rows: int = 10_000,
    ascending: bool = True,
) -> DataFrame:
    """One page of a sorted listing; pages are counted from 1."""
    first = F.asc(sort_by) if ascending else F.desc(sort_by)
    return rows.orderBy(first, F.asc(tie_break)).offset((page - 1) * page_rows).limit(page_rows)


class PageIndex:
    """A listing in order, written once in ranges, with the number of rows before each range.

    A page is cut out of the ranges that it touches, so its work does not grow with its
    number. ``path`` is a new folder that every executor reaches. Without ``ranges`` Spark
    chooses how many there are by their size.
    """

    def __init__(
        self,
        rows: DataFrame,
        sort_by: str,
        tie_break: str,
        path: str,
        ascending: bool = True,
        ranges: int | None = None,
    ):
        first = F.asc(sort_by) if ascending else F.desc(sort_by)
        self.order = [first, F.asc(tie_break)]
        number = [] if ranges is None else [ranges]
        placed = rows.repartitionByRange(*number, *self.order).sortWithinPartitions(*self.order)
        placed.withColumn(_RANGE, F.spark_partition_id()).write.partitionBy(_RANGE).parquet(path)
        schema = StructType([*rows.schema.fields]).add(_RANGE, IntegerType())
        self.rows = rows.sparkSession.read.schema(schema).parquet(path)
        self.columns = rows.columns
        counts = self.rows.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("n")).collect()
        # One number a range: as many as the shuffle has partitions.
        self.ranges, before = [], 0
        for number, n in sorted((row[_RANGE], row["n"]) for row in counts):
            self.ranges.append((number, before, n))
            before += n
        self.total = before

    def page(self, page: int, page_rows: int = 10_000) -> DataFrame:
        """One page; pages are counted from 1, and there is nothing behind the last one."""
        low, high = (page - 1) * page_rows, page * page_rows
        touched = [r for r in self.ranges if r[1] < high and r[1] + r[2] > low]
        if not touched:
            return self.rows.limit(0).select(self.columns)
        inside = self.rows.where(F.col(_RANGE).isin([number for number, _, _ in touched]))
        skip = low - touched[0][1]
        return inside.orderBy(*self.order).offset(skip).limit(page_rows).select(self.columns)


_RANGE = "_range"


def page_after(
    rows: DataFrame,
    sort_by: str,
    tie_break: str,
    last: tuple | None,
    page_rows: int = 10_000,
    ascending: bool = True,
) -> DataFrame:
    """The page behind the row with the keys ``last`` (sort key, tie break); the first one without.

    The keys become a filter that the scan can use, and each task keeps one page at most.
    Rows without a sort key come first in rising order, last in falling order.
    """
    key, tie = F.col(sort_by), F.col(tie_break)
    behind = F.lit(True)
    if last is not None:
        value, number = last
        same = key.eqNullSafe(F.lit(value)) & (tie > F.lit(number))
        if value is None:
            behind = same | (key.isNotNull() if ascending else F.lit(False))
        else:
            beyond = key > F.lit(value) if ascending else (key < F.lit(value)) | key.isNull()
            behind = same | beyond
    first = key.asc() if ascending else key.desc()
    return rows.where(behind).orderBy(first, tie.asc()).limit(page_rows)
