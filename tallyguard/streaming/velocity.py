"""The velocity rule on streams: built-in windows, and an exact variant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tallyguard.operators.ordered import running
from tallyguard.params import RuleParams, ScaleParams
from tallyguard.schemas import TRANSACTION
from tallyguard.session import scratch_path
from tallyguard.streaming.tables import BatchTables, TableSpec


def windowed_velocity(txns: DataFrame, params: RuleParams) -> DataFrame:
    """Windows above the threshold, with Spark's own watermark.

    In update mode each batch shows the highest count so far, in append mode
    the final one. Spark drops late records by the watermark of the batch
    before, which is one batch more lenient than the exact rule.
    """
    return (
        txns.where(F.col("account_id").isNotNull())
        .withWatermark("record_ts", f"{params.grace_seconds} seconds")
        .groupBy(F.window("record_ts", f"{params.window_seconds} seconds"), "account_id")
        .agg(F.count(F.lit(1)).alias("count"))
        .where(F.col("count") > params.count_threshold)
        .select("account_id", "window", "count")
    )


# --- exact counts ------------------------------------------------------------
#
# Stream time is one per broker partition: the highest broker time seen there, in order
# of arrival. It decides which records are late. A first step adds it to the records of a
# batch, counts each window of each account in order of arrival, and writes both with the
# records; the times of the partitions and the counts of open windows are carried on in
# tables. A second step only has to filter what was written.

_TIMED = StructType(
    [
        *TRANSACTION.fields,
        StructField("stream_ms", LongType()),
        StructField("window_start_ms", LongType()),
        StructField("in_window", LongType()),
    ]
)
_PARTITION_TIME = StructType(
    [StructField("partition", IntegerType()), StructField("stream_ms", LongType())]
)
_WINDOW = ["partition", "account_id", "window_start_ms"]
_OPEN = StructType(
    [
        StructField("partition", IntegerType()),
        StructField("account_id", StringType()),
        StructField("window_start_ms", LongType()),
        StructField("in_window", LongType()),
    ]
)
#: Most rows of one broker partition that are put in order in one task.
TIME_CHUNK_ROWS = 250_000
TIMED = {
    "timed": TableSpec(_TIMED),
    "stream_time": TableSpec(_PARTITION_TIME, ("partition",)),
    "open_windows": TableSpec(_OPEN, whole=True),
}


def timed_tables(spark: SparkSession, base: str) -> BatchTables:
    return BatchTables(spark, base, TIMED)


def write_timed(
    tables: BatchTables, params: RuleParams, scale: ScaleParams | None = None, stored: bool = False
):
    """A foreachBatch function: transactions with stream time and window count at each of them.

    Within a batch both are running values, in chunks where a partition or a window holds
    many rows. Records without an account do not advance the time. ``in_window`` counts the
    records of the account's window up to this one; late records and those without an
    account have none. Windows that the partition's time has closed are not carried on.
    A ``stored`` batch is read from files, others are kept for the time they are read.
    """
    open_ms = (params.window_seconds + params.grace_seconds) * 1000

    def write(batch: DataFrame, batch_id: int) -> None:
        if not stored:
            batch.persist()
        try:
            carried = tables.read("stream_time", batch_id).select(
                "partition", F.col("stream_ms").alias("carried")
            )
            # Written once: times and counts are read from these rows.
            pending = f"{tables.base}/pending"
            rows = add_stream_time(batch, carried, scale)
            rows.write.mode("overwrite").parquet(pending)
            done = tables.spark.read.schema(rows.schema).parquet(pending)
            times = done.groupBy("partition").agg(F.max("stream_ms").alias("stream_ms"))
            now = tables.put("stream_time", batch_id, _merged(times, carried))
            counts = tables.read("open_windows", batch_id)
            counts = counts.select(*_WINDOW, F.col("in_window").alias("counted"))
            # An account's rows of a batch share a file, so readers that take a batch in several
            # steps, oldest files first, still meet every account's rows in order.
            spread = F.coalesce("account_id", F.concat(F.lit("-"), F.col("arrival") % 997))
            timed = _count_windows(done, counts, params, scale).repartition(spread)
            timed = tables.put("timed", batch_id, timed)
            seen = timed.where("in_window IS NOT NULL").select(*_WINDOW, "in_window")
            known = counts.select(*_WINDOW, F.col("counted").alias("in_window"))
            still = (
                seen.unionByName(known)
                .groupBy(*_WINDOW)
                .agg(F.max("in_window").alias("in_window"))
                .join(F.broadcast(now), "partition")
                .where(F.col("window_start_ms") + open_ms > F.col("stream_ms"))
            )
            tables.write(batch_id, {"open_windows": still}, None)
        finally:
            if not stored:
                batch.unpersist()

    return write


def _merged(times: DataFrame, before: DataFrame) -> DataFrame:
    joined = times.join(before, "partition", "full")
    return joined.select("partition", F.greatest("stream_ms", "carried").alias("stream_ms"))


def _window_start(params: RuleParams) -> Column:
    millis = F.unix_millis("record_ts")
    return millis - F.pmod(millis, F.lit(params.window_seconds * 1000))


def _count_windows(
    timed: DataFrame, counts: DataFrame, params: RuleParams, scale: ScaleParams | None
) -> DataFrame:
    """Add ``in_window``; ``counts`` has what earlier batches counted in open windows."""
    open_ms = (params.window_seconds + params.grace_seconds) * 1000
    rows = timed.withColumn("window_start_ms", _window_start(params))
    on_time = F.coalesce(
        F.col("account_id").isNotNull() & (F.col("window_start_ms") + open_ms > F.col("stream_ms")),
        F.lit(False),
    )
    counted = running(
        rows.where(on_time), _WINDOW, "arrival", sums={"_own": F.lit(1)}, include_current=True, scale=scale
    )
    before = F.coalesce("counted", F.lit(0).cast("long"))
    counted = counted.join(counts, _WINDOW, "left").withColumn("in_window", F.col("_own") + before)
    return counted.select(*rows.columns, "in_window").unionByName(
        rows.where(~on_time).withColumn("in_window", F.lit(None).cast("long"))
    )


def add_stream_time(
    txns: DataFrame, carried: DataFrame, scale: ScaleParams | None = None
) -> DataFrame:
    """``txns`` with ``stream_ms``, the highest broker time of the partition up to each record.

    A topic has few partitions, so they are cut into smaller runs than accounts are: else no
    more tasks than partitions would put a batch in order.
    """
    rows = min((scale or ScaleParams()).chunk_rows, TIME_CHUNK_ROWS)
    scale = ScaleParams(chunk_rows=rows)
    time = F.when(F.col("account_id").isNotNull(), F.unix_millis("record_ts"))
    timed = running(
        txns, ["partition"], "arrival", maxima={"_own": time}, include_current=True, scale=scale
    )
    joined = timed.join(carried, "partition", "left")
    return joined.withColumn("stream_ms", F.greatest("_own", "carried")).select(
        *txns.columns, "stream_ms"
    )


def counted_velocity(timed: DataFrame, params: RuleParams) -> DataFrame:
    """Alert rows of the velocity rule among timed records, one for every record above the threshold."""
    reason = F.concat(
        F.lit("Too many transactions: "),
        F.col("in_window").cast("string"),
        F.lit(f" in {params.window_seconds}s"),
    )
    return timed.where(F.col("in_window") > params.count_threshold).select(
        "account_id",
        F.lit(None).cast("string").alias("transaction_id"),
        F.lit("HIGH_VELOCITY").alias("rule_type"),
        reason.alias("reason"),
        F.col("in_window").alias("count"),
        F.col("arrival").alias("trigger_arrival"),
        F.date_trunc("MILLISECOND", "event_ts").alias("alert_ts"),
    )


def read_timed(spark: SparkSession, base: str, batches_per_trigger: int = 1000) -> DataFrame:
    """The timed records as a stream; started only while nothing writes them."""
    reader = spark.readStream.schema(_TIMED).option("maxFilesPerTrigger", batches_per_trigger)
    return reader.parquet(f"{base}/timed").select(*_TIMED.fieldNames())


def time_records(
    txns: DataFrame, params: RuleParams, base: str, checkpoint: str, scale: ScaleParams | None = None
) -> BatchTables:
    """Add stream time and counts to all records that a stream has now, and write them below ``base``."""
    tables = timed_tables(txns.sparkSession, base)
    writer = txns.writeStream.foreachBatch(write_timed(tables, params, scale))
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return tables


def exact_velocity(txns: DataFrame, params: RuleParams, scale: ScaleParams | None = None) -> DataFrame:
    """Alerts of the velocity rule: what the stream has now is timed and counted, and is a stream again."""
    base = scratch_path(txns.sparkSession, "velocity")
    time_records(txns, params, base, f"{base}/time-checkpoint", scale)
    return counted_velocity(read_timed(txns.sparkSession, base), params)
