"""Rejected records with their reason, the report over them, and their replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.operators.balance import UNKNOWN, UNREADABLE
from tallyguard.schemas import MONEY, TRANSACTION_WIRE



def transaction_payload() -> Column:
    """A transaction in its wire form, as JSON text."""
    return F.to_json(
        F.struct(
            F.col("transaction_id").alias("transactionId"),
            F.col("account_id").alias("accountId"),
            "type",
            "amount",
            "city",
            F.unix_millis("event_ts").alias("timestamp"),
        )
    )


def alert_payload(detected_at: Column | None = None) -> Column:
    """An alert in its wire form, as JSON text; the sink knows when it was detected."""
    stamp = [] if detected_at is None else [F.unix_millis(detected_at).alias("detectedAt")]
    return F.to_json(
        F.struct(
            F.col("account_id").alias("accountId"),
            F.col("transaction_id").alias("transactionId"),
            F.col("rule_type").alias("ruleType"),
            "reason",
            "count",
            *stamp,
        )
    )


def _letters(
    rejects: DataFrame, topic: str, error_class: Column, message: Column, payload: Column
) -> DataFrame:
    return rejects.select(
        F.lit(f"{topic}.DLT").alias("dlt_topic"),
        F.col("account_id").alias("key"),
        F.lit(topic).alias("orig_topic"),
        F.col("partition").cast("int").alias("orig_partition"),
        F.col("arrival").alias("orig_offset"),
        error_class.alias("error_class"),
        message.alias("error_message"),
        payload.alias("payload"),
    )


def transaction_dead_letters(outcomes: DataFrame, topic: str = "transactions") -> DataFrame:
    """Rejected transactions; key, partition and offset stay those of the original."""
    return _letters(
        outcomes.where(F.col("status") == "REJECTED"),
        topic,
        F.col("error_class"),
        F.col("error_message"),
        transaction_payload(),
    )


def alert_dead_letters(rejects: DataFrame, topic: str = "alerts") -> DataFrame:
    """Alerts for unknown accounts, with the partition and offset of their record.

    Alerts that never were in a topic have no partition, and the arrival of the
    transaction that raised them as offset.
    """
    placed = rejects
    if "partition" not in rejects.columns:
        placed = placed.withColumn("partition", F.lit(None).cast("int"))
    if "arrival" not in rejects.columns:
        own = F.col("offset") if "offset" in rejects.columns else F.lit(None).cast("long")
        placed = placed.withColumn("arrival", F.coalesce(own, F.col("trigger_arrival")))
    return _letters(
        placed, topic, F.lit(UNKNOWN), F.col("error_message"), alert_payload()
    )


def unreadable_dead_letters(records: DataFrame, topic: str = "transactions") -> DataFrame:
    """Records whose payload could not be read (``value`` text, ``decoded`` null)."""
    return records.where(F.col("decoded").isNull()).select(
        F.lit(f"{topic}.DLT").alias("dlt_topic"),
        F.col("key"),
        F.lit(topic).alias("orig_topic"),
        F.col("partition").cast("int").alias("orig_partition"),
        F.col("offset").alias("orig_offset"),
        F.lit(UNREADABLE).alias("error_class"),
        F.lit("payload does not match the schema").alias("error_message"),
        F.col("value").alias("payload"),
    )


def rejection_report(letters: DataFrame) -> DataFrame:
    """How many records of each account were refused, why, and between which offsets."""
    return letters.groupBy("error_class", F.col("key").alias("account_id")).agg(
        F.count(F.lit(1)).alias("n_rejected"),
        F.min("orig_offset").alias("first_offset"),
        F.max("orig_offset").alias("last_offset"),
    )


def replay_arrivals(letters: DataFrame, shift: int) -> DataFrame:
    """Dead letters as new transactions that arrive after everything else.

    ``shift`` exceeds the highest offset so far, so that the order among the
    replayed records is kept. The ledger keeps a second replay harmless.
    """
    wire = F.from_json("payload", TRANSACTION_WIRE)
    stamp = F.timestamp_millis("record.timestamp")
    return letters.select("orig_partition", "orig_offset", wire.alias("record")).select(
        F.col("record.transactionId").alias("transaction_id"),
        F.col("record.accountId").alias("account_id"),
        F.col("record.type").alias("type"),
        F.col("record.amount").cast(MONEY).alias("amount"),
        F.col("record.city").alias("city"),
        stamp.alias("event_ts"),
        stamp.alias("record_ts"),
        (F.col("orig_offset") + shift).alias("arrival"),
        F.col("orig_partition").alias("partition"),
    )
