"""The closed loop on streams: records, rules, alerts, freezes and settlement, in cycles.

Each step is a streaming query of its own, and durable tables lie between them:

1. records of the transaction topic are decoded, get their partition's stream time and the
   count of their window, and are written with them; unreadable ones become letters;
2. the rules read these transactions and append alerts, batch by batch with a commit;
3. settlement reads the transactions and the alerts, keeps balances and freezes, and
   writes outcomes, ledger, balances and letters, batch by batch with a commit.

A cycle runs the steps one after the other over what is there. So alerts are known before
the transactions that follow their triggers are settled, and the result is that of the
batch loop, however the input is cut into cycles: a freeze counts for arrivals behind the
trigger. A cycle that fails is run again; every query goes on from its own checkpoint.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.operators.dead_letters import transaction_payload, unreadable_dead_letters
from tallyguard.params import RuleParams, ScaleParams
from tallyguard.schemas import ALERT, DEAD_LETTER
from tallyguard.session import ROCKSDB_PROVIDER
from tallyguard.sources.transactions import decode_records, decoded_transactions
from tallyguard.streaming.account_rules import account_rule_tables, write_account_alerts
from tallyguard.streaming.run import start_drain
from tallyguard.streaming.settlement import batch_settlement_tables, settle_batches
from tallyguard.streaming.tables import BatchTables, TableSpec
from tallyguard.streaming.velocity import (
    TIMED,
    counted_velocity,
    read_timed,
    write_timed,
)


@dataclass(frozen=True)
class StreamingLoop:
    """``records`` is a stream of broker records (key, value, partition, offset, timestamp)."""

    records: DataFrame
    accounts: DataFrame
    ledger: DataFrame
    params: RuleParams
    base: str
    value_format: str = "json"
    scale: ScaleParams | None = None
    batches_per_trigger: int = 1000

    @property
    def spark(self) -> SparkSession:
        return self.records.sparkSession

    @property
    def decoded(self) -> BatchTables:
        letters = {"letters": TableSpec(DEAD_LETTER)}
        return BatchTables(self.spark, f"{self.base}/decoded", {**TIMED, **letters})

    @property
    def raised(self) -> BatchTables:
        return account_rule_tables(self.spark, f"{self.base}/raised")

    @property
    def settled(self) -> BatchTables:
        return batch_settlement_tables(self.spark, f"{self.base}/settled")

    def cycle(self) -> None:
        """Take in all records that are there now, and settle them."""
        self.spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        self.take_in()
        self.raise_alerts()
        self.settle()

    def take_in(self) -> None:
        decoded = self.decoded
        write = write_timed(decoded, self.params, self.scale, stored=True)
        unreadable = F.col("decoded").isNull()

        def write_both(batch: DataFrame, batch_id: int) -> None:
            # Written once, as each reader would decode the values again; letters alone need the text.
            records = decode_records(batch, self.value_format)
            records = records.withColumns({n: F.when(unreadable, F.col(n)) for n in ("key", "value")})
            path = f"{decoded.base}/taken"
            records.write.mode("overwrite").parquet(path)
            records = self.spark.read.schema(records.schema).parquet(path)
            letters = unreadable_dead_letters(records)
            letters.write.mode("overwrite").parquet(f"{decoded.base}/letters/batch_id={batch_id}")
            write(decoded_transactions(records), batch_id)

        start_drain(self.records, f"{self.base}/checkpoints/take-in", write_both)

    def raise_alerts(self) -> None:
        """All rules in one query, as they read the same transactions."""
        rules = write_account_alerts(
            self.raised, self.params, self.scale, lambda batch: counted_velocity(batch, self.params)
        )
        start_drain(self._transactions(), f"{self.base}/checkpoints/alerts", rules)

    def settle(self) -> None:
        # All alerts come with the first batch; transactions may take several.
        settle_batches(
            self._transactions(),
            self.accounts,
            self.ledger,
            self.alert_stream(),
            self.settled,
            f"{self.base}/checkpoints/settle",
            self.scale,
        )

    def alert_stream(self) -> DataFrame:
        """The alerts as a stream; started only while nothing writes them."""
        alerts = self.spark.readStream.schema(ALERT).parquet(f"{self.raised.base}/alerts")
        return alerts.select(*ALERT.fieldNames())

    def alerts(self) -> DataFrame:
        """All alerts so far."""
        return self.raised.read("alerts").select(*ALERT.fieldNames())

    def dead_letters(self) -> DataFrame:
        """Letters of unreadable records, of refused transactions and of alerts without an account."""
        columns = DEAD_LETTER.fieldNames()
        return self.decoded.read("letters").select(*columns).unionByName(
            self.settled.read("dead_letters").select(*columns)
        )

    def _transactions(self) -> DataFrame:
        return read_timed(self.spark, self.decoded.base, self.batches_per_trigger)


def as_records(txns: DataFrame) -> DataFrame:
    """Transactions as the records of a topic that carries them as JSON; arrivals are offsets."""
    return txns.select(
        F.col("account_id").alias("key"),
        transaction_payload().alias("value"),
        "partition",
        F.col("arrival").alias("offset"),
        F.col("record_ts").alias("timestamp"),
    )
