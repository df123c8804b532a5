"""Exact money arithmetic; amounts are decimal(18,2), compared in whole cents."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_cents(amount: Column) -> Column:
    """decimal(18,2) -> whole cents as a long."""
    return (amount * 100).cast("long")


def from_cents(cents: Column) -> Column:
    """Whole cents -> a decimal of scale 2."""
    return cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))


def mean_half_up(total: Column, count: Column) -> Column:
    """``total / count`` in cents, rounded half up once; null for no rows.

    ``total`` is an exact decimal of cents. Integer division keeps a single
    rounding step for any number of rows.
    """
    twice = F.abs(total) * 2
    whole = F.call_function("div", twice + count, F.nullif(count * 2, F.lit(0)))
    return F.when(total < 0, -whole).otherwise(whole)
