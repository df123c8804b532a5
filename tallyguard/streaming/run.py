"""Running a streaming query over what its source holds now."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyguard.session import ROCKSDB_PROVIDER, scratch_path


def drain(stream: DataFrame, label: str) -> DataFrame:
    """Process everything available, write it exactly once, and return the written table."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    base = scratch_path(spark, label)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def start_drain(stream: DataFrame, checkpoint: str, write) -> None:
    """Process everything available through a foreachBatch function."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
