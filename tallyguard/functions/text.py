"""Text helpers built from column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that count as white space when trimming.
WHITESPACE = " \t\n\r\f\x0b"


def strip(value: Column | str) -> Column:
    """Trim every kind of white space, not only blanks."""
    column = F.col(value) if isinstance(value, str) else value
    return F.trim(column, F.lit(WHITESPACE))


def is_blank(value: Column | str) -> Column:
    """True for null, empty and white-space-only text."""
    return F.coalesce(strip(value) == "", F.lit(True))


def equals_ignore_case(left: Column, right: Column) -> Column:
    return F.lower(left) == F.lower(right)


def contains_ignore_case(value: Column, term: str) -> Column:
    """Literal substring test; null counts as empty text, an empty term matches all."""
    return F.coalesce(F.lower(value), F.lit("")).contains(term.lower())


def first_field(row: str, names: Iterable[str]) -> Column:
    """First non-null of several spellings of one field in a map column.

    Only null falls through to the next spelling; empty text and false do not.
    """
    return F.coalesce(*[F.try_element_at(F.col(row), F.lit(name)) for name in names])


def truthy_text(value: Column) -> Column:
    """Text of a JSON value counts as true unless null, empty, false or zero."""
    return F.coalesce(~value.isin("", "false", "0"), F.lit(False))


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
