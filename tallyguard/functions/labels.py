"""Display forms: yes/no, dates and status groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def yes_no(flag: Column) -> Column:
    """Null counts as false."""
    return F.when(F.coalesce(flag, F.lit(False)), "Yes").otherwise("No")


def date_or_na(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Format an ISO date text with one fixed pattern; absent dates show N/A."""
    parsed = F.try_to_timestamp(F.nullif(text, F.lit("")))
    shown = F.coalesce(F.date_format(parsed, pattern), F.lit("Invalid Date"))
    return F.when(F.coalesce(text, F.lit("")) == "", "N/A").otherwise(shown)


def compile_status_group(status: Column) -> Column:
    """Group of a compile status; the match is case-sensitive, others have none."""
    return (
        F.when(status.isin("Complete", "Finalized"), "success")
        .when(status == "Errored", "error")
        .when(status == "Queued", "pending")
    )


def version_status_group(status: Column) -> Column:
    """Group of a version status, ignoring case."""
    lowered = F.lower(status)
    return F.when(lowered.isin("active", "draft", "deprecated"), lowered).otherwise("other")
