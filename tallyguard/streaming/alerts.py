"""One alert per account, rule and window on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from tallyguard.params import RuleParams
from tallyguard.schemas import ALERT
from tallyguard.streaming.run import start_drain
from tallyguard.streaming.tables import BatchTables, TableSpec

_KEYS = ["account_id", "rule_type", "window_start_ms"]
_FIRST = StructType(
    [*ALERT.fields, StructField("window_start_ms", LongType()), StructField("seen_at", TimestampType())]
)


def first_alert_tables(spark: SparkSession, base: str) -> BatchTables:
    return BatchTables(spark, base, {"first": TableSpec(_FIRST)})


def dedup_alert_stream(
    alerts: DataFrame,
    params: RuleParams,
    tables: BatchTables,
    checkpoint: str,
    ttl_ms: int | None = None,
) -> DataFrame:
    """The first alert per account, rule and tumbling window of the alert's time, of what a stream has now.

    The first is the one with the lowest arrival in the first batch that has any. A batch is
    reduced to one alert a key, and those whose key an earlier batch wrote are dropped. Keys are
    remembered for ever, or for ``ttl_ms`` of processing time, which has to exceed the
    longest delay of an alert behind the first of its window.
    """
    start_drain(alerts, checkpoint, write_first(tables, params, ttl_ms))
    return tables.read("first").select(*ALERT.fieldNames(), "window_start_ms")


def write_first(tables: BatchTables, params: RuleParams, ttl_ms: int | None = None):
    """A foreachBatch function for alerts: those that are the first of their key."""
    millis = F.unix_millis("alert_ts")
    window = millis - F.pmod(millis, F.lit(params.window_seconds * 1000))
    # Alerts of a topic name no arrival; the earliest of them counts, behind those that do.
    order = F.struct(
        F.col("trigger_arrival").isNull(), "trigger_arrival", "alert_ts", "transaction_id", "reason"
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        keyed = batch.select(*ALERT.fieldNames()).withColumn("window_start_ms", window)
        first = keyed.groupBy(*_KEYS).agg(
            F.min_by(F.struct("transaction_id", "reason", "count", "trigger_arrival", "alert_ts"), order).alias("first")
        )
        known = tables.read("first", batch_id)
        if ttl_ms is not None:
            age = F.unix_millis(F.current_timestamp()) - F.unix_millis("seen_at")
            known = known.where(age < ttl_ms)
        known = known.select(*[F.col(name).alias(f"known_{name}") for name in _KEYS])
        same = [F.col(name).eqNullSafe(F.col(f"known_{name}")) for name in _KEYS]
        fresh = first.join(known, same, "left_anti")
        rows = fresh.select(*_KEYS, "first.*", F.current_timestamp().alias("seen_at"))
        tables.write(batch_id, {"first": rows})

    return write
