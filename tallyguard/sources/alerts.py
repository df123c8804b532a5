"""Where alerts come from: a broker, or files of the same schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.schemas import ALERT, ALERT_WIRE, RULE_TYPES


def _decoded() -> Column:
    """The alert in ``value``; null where it is not JSON, names no account or no known rule."""
    record = F.from_json(F.col("value").cast("string"), ALERT_WIRE)
    return F.when(record["accountId"].isNotNull() & record["ruleType"].isin(RULE_TYPES), record)


def alert_records(raw: DataFrame) -> DataFrame:
    """Broker records of alerts with their decoded payload, null where it is unreadable.

    ``unreadable_dead_letters(records, "alerts")`` takes those that ``decode_alerts`` leaves out.
    """
    return raw.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "partition",
        "offset",
        _decoded().alias("decoded"),
    )


def decode_alerts(raw: DataFrame) -> DataFrame:
    """The readable ones of broker records of JSON alerts, with their own partition and offset.

    A record does not say at which transaction the alert was raised, and offsets of the
    alert topic cannot be compared with those of transactions. So ``trigger_arrival`` is
    null, and the alert freezes for records that the broker took after ``alert_ts``: the
    time of its detection, or of its record where it has none.
    """
    decoded = raw.select("partition", "offset", "timestamp", _decoded().alias("record"))
    return decoded.where(F.col("record").isNotNull()).select(
        F.col("record.accountId").alias("account_id"),
        F.col("record.transactionId").alias("transaction_id"),
        F.col("record.ruleType").alias("rule_type"),
        F.col("record.reason").alias("reason"),
        F.col("record.count").alias("count"),
        F.lit(None).cast("long").alias("trigger_arrival"),
        F.coalesce(F.timestamp_millis("record.detectedAt"), "timestamp").alias("alert_ts"),
        F.col("partition").cast("int").alias("partition"),
        "offset",
    )


def read_alert_files(
    spark: SparkSession, path: str, fmt: str = "parquet", streaming: bool = False
) -> DataFrame:
    """Alerts kept as files; a streaming reader has its own progress, apart from transactions."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(ALERT).format(fmt).load(path)
