"""Account look-ups, freezing, and the de-duplication of transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.schemas import MONEY


def new_transactions(txns: DataFrame, ledger: DataFrame) -> DataFrame:
    """Transactions that their account's ledger does not have; checked before any account look-up.

    An id counts within its account, here as in ``apply_transactions`` and on streams.
    """
    keys = ["transaction_id", "account_id"]
    return txns.join(ledger.select(*keys), keys, "left_anti").select(txns.columns)


def unknown_account_rejects(txns: DataFrame, accounts: DataFrame) -> DataFrame:
    """Transactions of accounts that do not exist, with the reason."""
    strangers = txns.join(accounts.select("account_id"), "account_id", "left_anti")
    return strangers.withColumn("error_message", unknown_account_message())


def unknown_account_message() -> Column:
    return F.concat(F.lit("Unknown account: "), F.coalesce("account_id", F.lit("null")))


def _firsts(alerts: DataFrame) -> DataFrame:
    time = F.col("alert_ts") if "alert_ts" in alerts.columns else F.lit(None).cast("timestamp")
    return alerts.groupBy("account_id").agg(
        F.min("trigger_arrival").alias("first_arrival"),
        F.min_by("rule_type", F.struct("trigger_arrival", "rule_type")).alias("rule_type"),
        F.count(F.lit(1)).alias("n_alerts"),
        F.min(F.when(F.col("trigger_arrival").isNull(), time)).alias("freeze_ts"),
    )


def first_alerts(alerts: DataFrame) -> DataFrame:
    """The alert that comes first per account; later ones change nothing."""
    return _firsts(alerts).drop("freeze_ts")


def freezes_from_alerts(alerts: DataFrame, accounts: DataFrame, action_lag: int = 0) -> DataFrame:
    """Accounts that alerts turn from active to frozen, and after which arrival.

    The freeze takes effect strictly after the triggering transaction, delayed
    by ``action_lag`` arrivals if the reaction is slower. Alerts decoded from a topic
    name no arrival; they freeze for records that the broker took after the alert
    (``freeze_ts``). Offsets of two topics are never compared.
    """
    active = accounts.where(F.col("status") == "ACTIVE").select("account_id")
    return (
        _firsts(alerts)
        .join(active, "account_id")
        .select(
            "account_id",
            (F.col("first_arrival") + action_lag).alias("freeze_arrival"),
            "freeze_ts",
            "rule_type",
            "n_alerts",
        )
    )


def is_frozen(at_start: Column, record_ts: Column) -> Column:
    """Whether the account of a record with ``arrival``, ``freeze_arrival`` and ``freeze_ts`` is frozen then."""
    by_arrival = F.coalesce(F.col("arrival") > F.col("freeze_arrival"), F.lit(False))
    return at_start | by_arrival | F.coalesce(record_ts > F.col("freeze_ts"), F.lit(False))


def freeze_times(freezes: DataFrame | None, accounts: DataFrame) -> DataFrame:
    """``freezes`` with both of its times; those that it lacks are null."""
    if freezes is None:
        freezes = accounts.select("account_id").where(F.lit(False))
    kinds = {"freeze_arrival": "long", "freeze_ts": "timestamp"}
    missing = {n: F.lit(None).cast(k) for n, k in kinds.items() if n not in freezes.columns}
    return freezes.withColumns(missing).select("account_id", *kinds)


def alert_rejects(alerts: DataFrame, accounts: DataFrame) -> DataFrame:
    """Alerts that name an account nobody knows; they go to the alerts' dead letters."""
    strangers = alerts.join(accounts.select("account_id"), "account_id", "left_anti")
    return strangers.withColumn("error_message", unknown_account_message())


def freeze_accounts(accounts: DataFrame, freezes: DataFrame) -> DataFrame:
    """The accounts table after freezing; already frozen accounts stay as they are."""
    frozen = freezes.select("account_id", F.lit(True).alias("froze"))
    status = F.when(F.col("froze"), "FROZEN").otherwise(F.col("status"))
    return accounts.join(frozen, "account_id", "left").withColumn("status", status).drop("froze")


def frozen_rejects(txns: DataFrame, accounts: DataFrame, freezes: DataFrame) -> DataFrame:
    """Money-out transactions that meet a frozen account, judged by arrival."""
    standing = accounts.select("account_id", (F.col("status") == "FROZEN").alias("at_start")).join(
        freeze_times(freezes, accounts), "account_id", "left"
    )
    freezing = F.col("freeze_arrival").isNotNull() | F.col("freeze_ts").isNotNull()
    concerned = standing.where(F.col("at_start") | freezing)
    frozen = is_frozen(F.col("at_start"), F.col("record_ts"))
    return (
        txns.where(F.col("type") != "DEPOSIT")
        .join(concerned, "account_id")
        .where(frozen)
        .drop("at_start", "freeze_arrival", "freeze_ts")
        .withColumn(
            "error_message",
            F.concat(
                F.lit("Account frozen: "),
                F.col("account_id"),
                F.lit(" — "),
                F.col("type"),
                F.lit(" rejected pending fraud review"),
            ),
        )
    )


def ledger_rows(outcomes: DataFrame) -> DataFrame:
    """What applied transactions add to the ledger."""
    return outcomes.where(F.col("status") == "APPLIED").select(
        "transaction_id",
        "account_id",
        "type",
        F.col("amount").cast(MONEY).alias("amount"),
        F.col("event_ts").alias("processed_at"),
    )
