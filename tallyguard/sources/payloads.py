"""JSON payloads whose shape varies: an array of rows, or an object holding one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows keep every field under its own spelling; unlike struct fields, map keys
# tell Name and name apart. Values are the text of the JSON value.
ROW = "map<string,string>"


def payload_rows(payload: Column) -> Column:
    """The rows of a payload as an array, whichever envelope it uses.

    White space around the payload does not matter. Elements that are no objects
    are null and keep their place; other shapes, broken text and null have no rows.
    """
    is_array = payload.rlike(r"^[\x20\x09-\x0D]*\[")
    as_array = F.from_json(payload, "array<string>")
    as_object = F.from_json(payload, "struct<rows:array<string>>")["rows"]
    elements = F.when(is_array, as_array).otherwise(as_object)
    is_object = r"^[\x20\x09-\x0D]*\{"
    found = F.transform(elements, lambda x: F.when(x.rlike(is_object), F.from_json(x, ROW)))
    return F.coalesce(found, F.array().cast(f"array<{ROW}>"))


def unwrap_rows(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One output row per payload row; ``row_index`` is its place in the payload."""
    others = [name for name in payloads.columns if name != payload]
    rows = payload_rows(F.col(payload))
    # The outer form keeps the optimizer from parsing each payload again in a size filter.
    exploded = payloads.select(*others, F.posexplode_outer(rows).alias("row_index", "row"))
    return exploded.where(F.col("row").isNotNull())
