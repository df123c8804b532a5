"""Balances on a stream: one state machine per account, and its transactional sink.

Transactions and alerts of an account meet in one stateful operator. It gives three kinds
of rows, told apart by ``tag``: the outcome of each transaction, the new state of each
account that changed, a freeze without any transaction too, and a letter for each alert
that names an unknown account.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tallyguard.functions.money import from_cents, to_cents
from tallyguard.operators.balance import (
    APPLIED,
    DUPLICATE,
    FROZEN,
    INSUFFICIENT,
    REJECTIONS,
    UNKNOWN,
    UNREADABLE,
    reject_message,
)
from tallyguard.operators.dead_letters import alert_dead_letters, transaction_dead_letters
from tallyguard.operators.ledger import ledger_rows, unknown_account_message
from tallyguard.schemas import DEAD_LETTER, LEDGER, MONEY
from tallyguard.streaming.tables import BatchTables, TableSpec

OUTCOME, ACCOUNT, LETTER = "OUTCOME", "ACCOUNT", "LETTER"
_FIELDS = (
    "transaction_id string, account_id string, type string, cents long, city string, "
    "event_ms long, record_ms long, arrival long, partition int, rule_type string, reason string, "
    "count long, freeze_after long"
)
SETTLED = f"tag string, {_FIELDS}, outcome string, balance_cents long, frozen boolean"
_CARRIED = [field.split()[0] for field in _FIELDS.split(", ")]
# Before every arrival and broker time: an account that was frozen from the start.
_ALWAYS = -(1 << 62)


class Balances(StatefulProcessor):
    """Per account: balance, whether and from where on it is frozen, and the ids applied.

    Rows with a ``rule_type`` are alerts. One with ``freeze_after`` freezes for arrivals
    behind that one; one from a topic, whose offsets say nothing about transactions,
    freezes for records that the broker took later. So alerts count from the same
    transaction on, whether they come before it or in its batch. The first batch loads
    accounts and ledger.
    """

    def __init__(self, id_ttl_ms: int | None = None):
        self.id_ttl_ms = id_ttl_ms

    def init(self, handle) -> None:
        account = StructType(
            [
                StructField("cents", LongType()),
                StructField("frozen", BooleanType()),
                StructField("after", LongType()),
                StructField("after_ms", LongType()),
            ]
        )
        ident = StructType([StructField("id", StringType())])
        mark = StructType([StructField("in_ledger", BooleanType())])
        self.account = handle.getValueState("account", account)
        self.applied = handle.getMapState("applied", ident, mark, self.id_ttl_ms)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        if initialState.transaction_id is not None:
            self.applied.updateValue((initialState.transaction_id,), (True,))
        else:
            after = _ALWAYS if initialState.frozen else None
            self.account.update((initialState.cents, bool(initialState.frozen), after, None))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.account.get()
        state = list(known) if known is not None else [None, False, None, None]
        transactions = []
        for row in rows:
            if row.rule_type is None:
                transactions.append(row)
            elif known is None:
                yield self._row(LETTER, row, UNKNOWN, state)
            else:
                self._freeze(row, state)
        # As many rows of one account as the source lets into a batch.
        transactions.sort(key=lambda r: r.arrival)
        for row in transactions:
            outcome = self._outcome(row, state)
            if outcome == APPLIED:
                state[0] += row.cents if row.type == "DEPOSIT" else -row.cents
                self.applied.updateValue((row.transaction_id,), (False,))
            yield self._row(OUTCOME, row, outcome, state)
        if known is not None and state != list(known):
            self.account.update(tuple(state))
            blank = dict.fromkeys(_CARRIED) | {"account_id": key[0]}
            yield self._row(ACCOUNT, Row(**blank), None, state)

    @staticmethod
    def _row(tag: str, row: Row, outcome: str | None, state: list) -> Row:
        fields = {name: row[name] for name in _CARRIED}
        return Row(tag=tag, **fields, outcome=outcome, balance_cents=state[0], frozen=state[1])

    @staticmethod
    def _freeze(row: Row, state: list) -> None:
        """The earliest alert counts; an account that is frozen already stays so."""
        state[1] = True
        at, value = (2, row.freeze_after) if row.freeze_after is not None else (3, row.record_ms)
        state[at] = value if state[at] is None else min(state[at], value)

    def _outcome(self, row: Row, state: list) -> str:
        seen = self.applied.getValue((row.transaction_id,)) if row.transaction_id is not None else None
        readable = row.cents is not None and row.type is not None
        if seen is not None and (seen[0] or readable):
            return DUPLICATE
        balance, _, after, after_ms = state
        if balance is None:
            return UNKNOWN
        if not readable:
            return UNREADABLE
        if row.type == "DEPOSIT":
            return APPLIED
        late = after_ms is not None and row.record_ms is not None and row.record_ms > after_ms
        if late or (after is not None and row.arrival > after):
            return FROZEN
        return APPLIED if balance >= row.cents else INSUFFICIENT


def settle(
    txns: DataFrame,
    accounts: DataFrame,
    ledger: DataFrame,
    alerts: DataFrame | None = None,
    id_ttl_ms: int | None = None,
) -> DataFrame:
    """Tagged rows of a stream of transactions and one of alerts.

    ``accounts`` and ``ledger`` are static tables read once, when the query first starts;
    from then on the checkpoint holds the truth. Alerts that were decoded from a topic have
    no ``trigger_arrival``, but their own ``partition`` and ``offset``. Ids are kept for
    ever unless ``id_ttl_ms`` says how long.

    Every record asks the state about its id, which suits small batches that have to be
    quick. ``settlement.settle_batches`` gives the same for batches of any size.
    """
    rows = settlement_rows(txns, alerts)
    start = accounts.select(
        "account_id",
        F.lit(None).cast("string").alias("transaction_id"),
        to_cents(F.col("balance")).alias("cents"),
        (F.col("status") == "FROZEN").alias("frozen"),
    ).unionByName(
        ledger.select(
            "account_id",
            "transaction_id",
            F.lit(None).cast("long").alias("cents"),
            F.lit(None).cast("boolean").alias("frozen"),
        )
    )
    mode = "None" if id_ttl_ms is None else "ProcessingTime"
    settled = (
        rows.where("account_id IS NOT NULL")
        .groupBy("account_id")
        .transformWithState(
            Balances(id_ttl_ms), SETTLED, "Append", mode, initialState=start.groupBy("account_id")
        )
    )
    # Records without an account need no state, and would all meet in one task.
    nameless = rows.where("account_id IS NULL").select(
        F.when(F.col("rule_type").isNull(), OUTCOME).otherwise(LETTER).alias("tag"),
        *_CARRIED,
        F.lit(UNKNOWN).alias("outcome"),
        F.lit(None).cast("long").alias("balance_cents"),
        F.lit(False).alias("frozen"),
    )
    return settled.unionByName(nameless)


def settlement_rows(txns: DataFrame, alerts: DataFrame | None = None) -> DataFrame:
    """Transactions and alerts as rows of one shape; alerts have a ``rule_type``."""
    rows = txns.select(
        "transaction_id",
        "account_id",
        "type",
        to_cents(F.col("amount")).alias("cents"),
        "city",
        F.unix_millis("event_ts").alias("event_ms"),
        F.unix_millis("record_ts").alias("record_ms"),
        "arrival",
        F.col("partition").cast("int").alias("partition"),
        *[F.lit(None).cast(kind).alias(name) for name, kind in _ALERT_ONLY],
    )
    return rows if alerts is None else rows.unionByName(_alert_rows(alerts))


_ALERT_ONLY = [("rule_type", "string"), ("reason", "string"), ("count", "long"), ("freeze_after", "long")]


def _alert_rows(alerts: DataFrame) -> DataFrame:
    """Alerts in the shape of the operator's rows; a topic's offset is kept for letters only."""
    has = set(alerts.columns)
    own = F.col("offset") if "offset" in has else F.lit(None).cast("long")
    place = F.col("partition") if "partition" in has else F.lit(None)
    return alerts.select(
        "transaction_id",
        "account_id",
        *[F.lit(None).cast(kind).alias(name) for name, kind in (("type", "string"), ("cents", "long"), ("city", "string"))],
        F.lit(None).cast("long").alias("event_ms"),
        F.unix_millis("alert_ts").alias("record_ms"),
        F.coalesce(own, "trigger_arrival").alias("arrival"),
        place.cast("int").alias("partition"),
        "rule_type",
        "reason",
        "count",
        F.col("trigger_arrival").alias("freeze_after"),
    )


def outcome_rows(settled: DataFrame) -> DataFrame:
    """The outcomes of transactions, in the shape of the batch result."""
    outcome = F.col("outcome")
    rejected = outcome.isin(REJECTIONS)
    return settled.where(F.col("tag") == OUTCOME).select(
        "transaction_id",
        "account_id",
        "type",
        from_cents(F.col("cents")).cast(MONEY).alias("amount"),
        "city",
        F.timestamp_millis("event_ms").alias("event_ts"),
        "arrival",
        "partition",
        F.when(rejected, "REJECTED").otherwise(outcome).alias("status"),
        F.when(rejected, outcome).alias("error_class"),
        reject_message(outcome).alias("error_message"),
        F.when(outcome == APPLIED, F.col("balance_cents")).alias("balance_after_cents"),
    )


def account_rows(settled: DataFrame) -> DataFrame:
    """The accounts that a batch changed, one row each, with the time of the change."""
    return settled.where(F.col("tag") == ACCOUNT).select(
        "account_id",
        F.col("balance_cents").alias("cents"),
        "frozen",
        F.current_timestamp().alias("updated_at"),
    )


def alert_letter_rows(settled: DataFrame) -> DataFrame:
    """Dead letters of alerts for unknown accounts, with the partition and offset of the alert."""
    rejects = settled.where(F.col("tag") == LETTER).withColumn(
        "error_message", unknown_account_message()
    )
    return alert_dead_letters(rejects)


def stream_outcomes(
    txns: DataFrame, accounts: DataFrame, ledger: DataFrame, alerts: DataFrame | None = None
) -> DataFrame:
    """The outcome of every streamed transaction."""
    return outcome_rows(settle(txns, accounts, ledger, alerts))


def _columns(**kinds) -> StructType:
    return StructType([StructField(name, kind) for name, kind in kinds.items()])


_STATE = _columns(
    account_id=StringType(), cents=LongType(), frozen=BooleanType(), updated_at=TimestampType()
)
_OUTCOMES = _columns(
    transaction_id=StringType(),
    account_id=StringType(),
    type=StringType(),
    amount=MONEY,
    city=StringType(),
    event_ts=TimestampType(),
    arrival=LongType(),
    partition=IntegerType(),
    status=StringType(),
    error_class=StringType(),
    error_message=StringType(),
    balance_after_cents=LongType(),
)
SETTLEMENT = {
    "outcomes": TableSpec(_OUTCOMES),
    "ledger": TableSpec(LEDGER),
    "balances": TableSpec(_STATE, ("account_id",)),
    "dead_letters": TableSpec(DEAD_LETTER),
}


def settlement_tables(spark: SparkSession, base: str) -> BatchTables:
    return BatchTables(spark, base, SETTLEMENT)


def write_settlement(tables: BatchTables):
    """A foreachBatch function for tagged rows: all tables of one batch and its commit."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # One batch is bounded by the source's trigger limits; all tables read it.
        batch.persist()
        try:
            outcomes = outcome_rows(batch)
            letters = transaction_dead_letters(outcomes).unionByName(alert_letter_rows(batch))
            rows = {
                "outcomes": outcomes,
                "ledger": ledger_rows(outcomes),
                "balances": account_rows(batch),
                "dead_letters": letters,
            }
            tables.write(batch_id, rows, outcomes.count())
        finally:
            batch.unpersist()

    return write


def current_balances(accounts: DataFrame, changes: DataFrame) -> DataFrame:
    """Accounts with the newest state among ``changes``, one row an account, as the tables give them."""
    now = changes.select("account_id", "cents", "frozen", F.col("updated_at").alias("changed_at"))
    return accounts.join(now, "account_id", "left").select(
        "account_id",
        "holder_name",
        F.coalesce(from_cents(F.col("cents")).cast(MONEY), F.col("balance")).alias("balance"),
        F.when(F.col("frozen"), "FROZEN").otherwise(F.col("status")).alias("status"),
        F.coalesce("changed_at", "updated_at").alias("updated_at"),
    )
