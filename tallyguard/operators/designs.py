"""Cleaning, filtering and drilling down in loosely shaped design records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.functions.labels import (
    compile_status_group,
    date_or_na,
    version_status_group,
    yes_no,
)
from tallyguard.functions.text import (
    all_of,
    contains_ignore_case,
    first_field,
    is_blank,
    strip,
    truthy_text,
)

# The spellings under which records carry each field, first one wins.
TYPE_NAME = [
    "DocumentDesignName",
    "documentDesignName",
    "DocumentDesignType",
    "documentDesignType",
    "DisplayText",
    "displayText",
    "Name",
    "name",
]
TYPE_ID = [
    "DocumentDesignTypeID",
    "documentDesignTypeId",
    "DocumentDesignTypeId",
    "Id",
    "id",
]
DESIGN_NAME = ["FormDesignName", "DocumentDesignName", "formDesignName"]
FOLDER_NAME = ["FormDesignGroupName", "formDesignGroupName", "FormGroupName", "name"]
FOLDER_ID = ["FormGroupId", "FormGroupID", "id"]
MAPPING_NAME = ["FormDesignName", "DocumentDesignName", "documentDesignName"]
MAPPING_ABBREVIATION = ["Abbreviation", "abbreviation"]
MAPPING_MULTIPLE = ["AllowMultipleInstance", "MultipleInstance", "isMultipleInstance"]
MAPPING_INCLUDED = ["IsIncluded", "Include", "include"]

# Listing columns that can be searched.
GRID_FILTERS = [
    "formName",
    "documentDesignName",
    "versionNumber",
    "effectiveDate",
    "status",
    "addedBy",
    "compiledDate",
    "compiledStatus",
]

# The 13 fields of a listing row and the spelling they arrive under.
GRID_FIELDS = {
    "formID": "FormID",
    "formName": "FormName",
    "displayText": "DisplayText",
    "documentDesignName": "DocumentDesignName",
    "formDesignVersionID": "FormDesignVersionID",
    "versionNumber": "VersionNumber",
    "status": "Status",
    "statusID": "StatusID",
    "compiledStatus": "CompiledStatus",
    "effectiveDate": "EffectiveDate",
    "compiledDate": "CompiledDate",
    "errorMessage": "ErrorMessage",
    "addedBy": "AddedBy",
}


def design_types(rows: DataFrame) -> DataFrame:
    """Unwrapped rows as complete (id, name) pairs; the name is kept untrimmed."""
    pairs = rows.select(
        "pos",
        "row_index",
        first_field("row", TYPE_ID).alias("id"),
        first_field("row", TYPE_NAME).alias("name"),
    )
    return pairs.where(F.col("id").isNotNull() & ~is_blank("name"))


def first_by_key(rows: DataFrame, keys: Sequence[str], position: Sequence[str]) -> DataFrame:
    """The first row per key by position, aggregated before the shuffle."""
    whole = F.struct(*[name for name in rows.columns if name not in keys])
    return (
        rows.groupBy(*keys)
        .agg(F.min_by(whole, F.struct(*position)).alias("first"))
        .select(*keys, "first.*")
    )


def dedup_design_types(rows: DataFrame) -> DataFrame:
    """Complete design types, one per id, the first occurrence."""
    return first_by_key(design_types(rows), ["id"], ["pos", "row_index"])


def distinct_design_names(rows: DataFrame) -> DataFrame:
    """Distinct non-blank design names with the place where each is first seen."""
    names = rows.select(
        first_field("row", DESIGN_NAME).alias("name"), F.struct("pos", "row_index").alias("place")
    ).where(~is_blank("name"))
    return (
        names.groupBy("name")
        .agg(F.min("place").alias("place"))
        .select("name", "place.pos", "place.row_index")
    )


def folders(rows: DataFrame) -> DataFrame:
    """Unwrapped folder rows with one id and one name each."""
    return rows.select(
        "pos",
        "row_index",
        first_field("row", FOLDER_ID).alias("folder_id"),
        F.coalesce(first_field("row", FOLDER_NAME), F.lit("")).alias("folder_name"),
    )


def folder_search(folder_rows: DataFrame, term: str) -> DataFrame:
    """Folders whose name contains the trimmed term, ignoring case; blank shows all."""
    wanted = term.strip()
    if not wanted:
        return folder_rows
    return folder_rows.where(contains_ignore_case(F.col("folder_name"), wanted))


def mappings(rows: DataFrame) -> DataFrame:
    """Unwrapped mapping rows in display form; ``rows`` keeps the master's folder_id."""
    empty = F.lit("")
    return rows.select(
        "folder_id",
        "row_index",
        F.coalesce(first_field("row", MAPPING_NAME), empty).alias("design_name"),
        F.coalesce(first_field("row", MAPPING_ABBREVIATION), empty).alias("abbreviation"),
        yes_no(truthy_text(first_field("row", MAPPING_MULTIPLE))).alias("multiple_instance"),
        yes_no(truthy_text(first_field("row", MAPPING_INCLUDED))).alias("include"),
    )


def folder_mappings(folder_rows: DataFrame, mapping_rows: DataFrame) -> DataFrame:
    """The mappings of every given folder, found by one join instead of look-ups."""
    return folder_rows.select("folder_id", "folder_name").join(
        mappings(mapping_rows), "folder_id"
    )


def type_designs(types: DataFrame, designs: DataFrame, versions: DataFrame) -> DataFrame:
    """Types with their designs and the designs' versions: a chain of two joins."""
    labelled = versions.withColumn("status_group", version_status_group(F.col("status")))
    return types.join(designs, "type_id").join(labelled, "design_id")


def rename_grid(rows: DataFrame) -> DataFrame:
    """Listing rows under their canonical field names; other columns are dropped."""
    return rows.select(*[F.col(source).alias(name) for name, source in GRID_FIELDS.items()])


def grid_filter(grid: DataFrame, filters: Mapping[str, str]) -> DataFrame:
    """Rows that contain every given term in its column, ignoring case.

    Terms are literal text. Only the compile status is trimmed before comparing.
    """
    unknown = set(filters) - set(GRID_FILTERS)
    if unknown:
        raise ValueError(f"no such filter: {sorted(unknown)}")

    def matches(name: str, term: str):
        value = F.col(name).cast("string")
        if name == "compiledStatus":
            return contains_ignore_case(strip(value), term.strip())
        return contains_ignore_case(value, term)

    return grid.where(all_of(matches(name, term) for name, term in filters.items() if term))


def grid_projection(grid: DataFrame) -> DataFrame:
    """The listing as shown: formatted dates, N/A for missing ones, status groups."""
    empty = F.lit("")
    return grid.select(
        "formID",
        F.coalesce("formName", empty).alias("formName"),
        F.coalesce("documentDesignName", empty).alias("documentDesignName"),
        F.coalesce("versionNumber", empty).alias("versionNumber"),
        date_or_na(F.col("effectiveDate")).alias("effectiveDate"),
        F.coalesce("status", empty).alias("status"),
        F.coalesce("addedBy", empty).alias("addedBy"),
        date_or_na(F.col("compiledDate"), "yyyy-MM-dd HH:mm:ss").alias("compiledDate"),
        F.coalesce("compiledStatus", empty).alias("compiledStatus"),
        compile_status_group(F.col("compiledStatus")).alias("compiledGroup"),
        yes_no(F.col("errorMessage").isNotNull()).alias("hasError"),
    )


def select_by_keys(grid: DataFrame, chosen: DataFrame, key: str = "formID") -> DataFrame:
    """Rows whose key is among the chosen ones."""
    return grid.join(chosen.select(key), key, "left_semi")
