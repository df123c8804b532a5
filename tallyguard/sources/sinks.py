"""Where results go: topics or files in account order, reports, and alert state."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.functions.text import strip
from tallyguard.operators.dead_letters import alert_payload, transaction_payload


def keyed_messages(txns: DataFrame) -> DataFrame:
    """Transactions as key and value; the key keeps an account's records in one partition."""
    return txns.select(F.col("account_id").alias("key"), transaction_payload().alias("value"))


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Alerts as key and value, stamped with the time they leave; works on streams too."""
    return alerts.select(
        F.col("account_id").alias("key"), alert_payload(F.current_timestamp()).alias("value")
    )


#: How often a stream that runs on commits, unless its caller says otherwise.
COMMIT_INTERVAL = "1 second"


def start_topic_sink(
    messages: DataFrame, servers: str, topic: str, checkpoint: str, interval: str = COMMIT_INTERVAL
):
    """Write a stream of key and value to a topic; needs the Kafka connector."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=interval)
        .start()
    )


def publish_to_broker(txns: DataFrame, servers: str, topic: str) -> None:
    """Write a batch to a topic, in arrival order per account; needs the Kafka connector.

    A topic keeps the order of one writer only, so each account has one writer.
    """
    ordered = txns.repartition("account_id").sortWithinPartitions("account_id", "arrival")
    (
        keyed_messages(ordered)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def publish_to_files(txns: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a batch as files, sorted by account and arrival.

    Range partitioning also splits one very busy account, by arrival.
    """
    (
        txns.repartitionByRange("account_id", "arrival")
        .sortWithinPartitions("account_id", "arrival")
        .write.mode("append")
        .format(fmt)
        .save(path)
    )


def start_alert_sink(
    alerts: DataFrame,
    path: str,
    checkpoint: str,
    once: bool = False,
    interval: str = COMMIT_INTERVAL,
):
    """Write an alert stream to files exactly once; the sink stamps the detection time.

    It commits every ``interval``, or with ``once`` takes what is there and ends.
    """
    writer = (
        alerts.withColumn("detected_at", F.current_timestamp())
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    cadence = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**cadence).start()


def write_report(results: DataFrame, path: str) -> None:
    """The availability report as CSV with a header, replacing the one before."""
    (
        results.select("retailer", "product", "pincode", "status")
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )


def read_alert_state(spark: SparkSession, base: str) -> DataFrame:
    """The keys of the newest saved run; trimmed, blanks dropped, none if never saved."""
    try:
        lines = spark.read.schema("value string, run_id long").text(base)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "alert_key string")
    newest = lines.select(F.max("run_id")).scalar()
    key = strip("value").alias("alert_key")
    return lines.where(F.col("run_id") == newest).select(key).where("alert_key <> ''").distinct()


def write_alert_state(state: DataFrame, base: str, run_id: int) -> None:
    """Save a run's keys, sorted, beside the earlier ones, which stay readable meanwhile.

    A blank line is always written, so that a run without hits leaves a state too.
    """
    blank = state.sparkSession.range(1).select(F.lit("").alias("alert_key"))
    (
        state.select("alert_key")
        .unionByName(blank)
        .repartitionByRange("alert_key")
        .sortWithinPartitions("alert_key")
        .write.mode("overwrite")
        .text(f"{base}/run_id={run_id}")
    )
