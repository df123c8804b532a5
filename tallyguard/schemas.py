"""Schemas of the records that flow through the library."""

from __future__ import annotations

from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

MONEY = DecimalType(18, 2)

# The domains of the record fields.
TRANSACTION_TYPES = ["DEPOSIT", "WITHDRAW", "TRANSFER"]
ACCOUNT_STATUSES = ["ACTIVE", "FROZEN"]
RULE_TYPES = ["HIGH_VELOCITY", "LARGE_AMOUNT", "SPEND_SPIKE", "GEO_IMPOSSIBLE"]


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


# event_ts is the producer's time, record_ts the broker's; arrival is the offset,
# unique and rising per account.
TRANSACTION = _struct(
    transaction_id=StringType(),
    account_id=StringType(),
    type=StringType(),
    amount=MONEY,
    city=StringType(),
    event_ts=TimestampType(),
    record_ts=TimestampType(),
    arrival=LongType(),
    partition=IntegerType(),
)

REQUEST = _struct(
    transaction_id=StringType(),
    account_id=StringType(),
    type=StringType(),
    amount=MONEY,
    city=StringType(),
)

ACCOUNT = _struct(
    account_id=StringType(),
    holder_name=StringType(),
    balance=MONEY,
    status=StringType(),
    updated_at=TimestampType(),
)

LEDGER = _struct(
    transaction_id=StringType(),
    account_id=StringType(),
    type=StringType(),
    amount=MONEY,
    processed_at=TimestampType(),
)

ALERT = _struct(
    account_id=StringType(),
    transaction_id=StringType(),
    rule_type=StringType(),
    reason=StringType(),
    count=LongType(),
    trigger_arrival=LongType(),
    alert_ts=TimestampType(),
)

DEAD_LETTER = _struct(
    dlt_topic=StringType(),
    key=StringType(),
    orig_topic=StringType(),
    orig_partition=IntegerType(),
    orig_offset=LongType(),
    error_class=StringType(),
    error_message=StringType(),
    payload=StringType(),
)

PRODUCT = _struct(
    id=IntegerType(),
    name=StringType(),
    category=StringType(),
    price=MONEY,
    stock=IntegerType(),
)

AVAILABILITY_RESPONSE = _struct(
    run_id=LongType(),
    retailer=StringType(),
    product=StringType(),
    pincode=StringType(),
    http_status=IntegerType(),
    body=StringType(),
    error=StringType(),
)

# The wire forms on a broker: JSON text or Avro with these names.
ALERT_WIRE = _struct(
    accountId=StringType(),
    transactionId=StringType(),
    ruleType=StringType(),
    reason=StringType(),
    count=LongType(),
    detectedAt=LongType(),
)

TRANSACTION_WIRE = _struct(
    transactionId=StringType(),
    accountId=StringType(),
    type=StringType(),
    amount=MONEY,
    city=StringType(),
    timestamp=LongType(),
)
