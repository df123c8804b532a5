"""Validation and normalisation of incoming transaction requests."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.functions.text import is_blank
from tallyguard.schemas import TRANSACTION_TYPES

# Fixed value: the smallest amount a request may carry.
SMALLEST_AMOUNT = Decimal("0.01")


def violations() -> Column:
    """The fields a request gets wrong, in a fixed order; empty when it is valid."""
    amount_bad = F.col("amount").isNull() | (F.col("amount") < F.lit(SMALLEST_AMOUNT))
    type_bad = F.col("type").isNull() | ~F.col("type").isin(TRANSACTION_TYPES)
    found = F.array(
        F.when(is_blank("account_id"), F.lit("accountId")),
        F.when(type_bad, F.lit("type")),
        F.when(amount_bad, F.lit("amount")),
    )
    return F.array_compact(found)


def validate_requests(requests: DataFrame) -> DataFrame:
    """Add the violations and whether there are none; works on streams too."""
    return requests.withColumn("violations", violations()).withColumn(
        "is_valid", F.size("violations") == 0
    )


def normalize_requests(requests: DataFrame) -> DataFrame:
    """Valid requests as transactions: a missing id is generated, the time is now.

    ``received_at`` stands in for the present where the input has it, which
    makes a rerun give the same result.
    """
    stamped = (
        F.col("received_at") if "received_at" in requests.columns else F.current_timestamp()
    )
    return (
        validate_requests(requests)
        .where("is_valid")
        .select(
            F.coalesce("transaction_id", F.uuid()).alias("transaction_id"),
            "account_id",
            "type",
            "amount",
            "city",
            F.date_trunc("MILLISECOND", stamped).alias("event_ts"),
        )
    )
