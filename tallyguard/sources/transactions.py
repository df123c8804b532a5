"""Where transactions come from: a broker, or files of the same schema."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.schemas import MONEY, TRANSACTION, TRANSACTION_WIRE, TRANSACTION_TYPES

# The wire record of a transaction.
TRANSACTION_AVRO = json.dumps(
    {
        "type": "record",
        "name": "Transaction",
        "fields": [
            {"name": "transactionId", "type": "string"},
            {"name": "accountId", "type": "string"},
            {
                "name": "type",
                "type": {"type": "enum", "name": "TransactionType", "symbols": TRANSACTION_TYPES},
            },
            {
                "name": "amount",
                "type": {"type": "bytes", "logicalType": "decimal", "precision": 18, "scale": 2},
            },
            {"name": "city", "type": ["null", "string"], "default": None},
            {"name": "timestamp", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        ],
    }
)

# Fixed value: bytes before the record when a schema registry wrote it (marker, schema id).
REGISTRY_HEADER = 5


def read_broker(
    spark: SparkSession, servers: str, topic: str, streaming: bool = True, **options: str
) -> DataFrame:
    """Raw records of a topic from the earliest offset; needs the Kafka connector.

    ``maxOffsetsPerTrigger`` bounds a batch, and with it what one busy account
    can bring into a single task.
    """
    reader = spark.readStream if streaming else spark.read
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        **({"maxOffsetsPerTrigger": "10000000"} if streaming else {}),
        **options,
    }
    return reader.format("kafka").options(**settings).load()


def decode_records(raw: DataFrame, value_format: str = "json") -> DataFrame:
    """Broker records with their decoded payload; an unreadable one decodes to null.

    ``raw`` has key, value, partition, offset and timestamp. Formats are
    ``json``, ``avro``, and ``avro-registry`` for values with a registry header.
    """
    if value_format == "json":
        parsed = F.from_json(F.col("value").cast("string"), TRANSACTION_WIRE)
        complete = F.expr("parsed.transactionId IS NOT NULL AND parsed.accountId IS NOT NULL")
        known = F.col("parsed.type").isin(TRANSACTION_TYPES)
        whole = F.expr("parsed.amount IS NOT NULL AND parsed.timestamp IS NOT NULL")
        decoded = F.when(complete & known & whole, F.col("parsed"))
    else:
        from pyspark.sql.avro.functions import from_avro

        value = F.col("value")
        if value_format == "avro-registry":
            value = F.expr(f"substring(value, {REGISTRY_HEADER + 1})")
        parsed = from_avro(value, TRANSACTION_AVRO, {"mode": "PERMISSIVE"})
        decoded = F.col("parsed")
    # Parsed in a step of its own: in one with the checks, each of them parses the value again.
    return raw.select("*", parsed.alias("parsed")).select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "partition",
        "offset",
        F.col("timestamp").alias("record_ts"),
        decoded.alias("decoded"),
    )


def decoded_transactions(records: DataFrame) -> DataFrame:
    """The readable records as transactions; arrival is the offset in the partition."""
    stamp = F.col("decoded.timestamp")
    as_long = dict(records.select("decoded.*").dtypes)["timestamp"] == "bigint"
    return records.where(F.col("decoded").isNotNull()).select(
        F.col("decoded.transactionId").alias("transaction_id"),
        F.col("decoded.accountId").alias("account_id"),
        F.col("decoded.type").alias("type"),
        F.col("decoded.amount").cast(MONEY).alias("amount"),
        F.col("decoded.city").alias("city"),
        (F.timestamp_millis(stamp) if as_long else stamp).alias("event_ts"),
        "record_ts",
        F.col("offset").alias("arrival"),
        F.col("partition").cast("int").alias("partition"),
    )


def read_files(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    streaming: bool = False,
    files_per_trigger: int = 1000,
) -> DataFrame:
    """Transactions kept as files of the canonical schema."""
    if streaming:
        reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
    else:
        reader = spark.read
    return reader.schema(TRANSACTION).format(fmt).load(path)
