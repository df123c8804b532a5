"""The whole loop: rules raise alerts, alerts freeze accounts, and frozen
accounts refuse later debits while transactions are applied to balances."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.operators.balance import account_balances, apply_transactions
from tallyguard.operators.dead_letters import replay_arrivals, transaction_dead_letters
from tallyguard.operators.ledger import freezes_from_alerts, ledger_rows
from tallyguard.operators.ordered import find_hot
from tallyguard.operators.rules import all_alerts
from tallyguard.params import RuleParams, ScaleParams
from tallyguard.session import checkpoint_root


@dataclass(frozen=True)
class LoopResult:
    alerts: DataFrame
    freezes: DataFrame
    outcomes: DataFrame
    balances: DataFrame


def closed_loop(
    txns: DataFrame,
    accounts: DataFrame,
    ledger: DataFrame,
    params: RuleParams,
    scale: ScaleParams | None = None,
) -> LoopResult:
    """Alerts depend on the raw records alone, so the loop has no cycle to iterate.

    The freezes, one row per account at most, are written to the checkpoint
    folder: the rules then run once, however often balances read the freezes.
    """
    checkpoint_root(txns.sparkSession)
    keyed = txns.where(F.col("account_id").isNotNull())
    hot = find_hot(keyed, ["account_id"], scale or ScaleParams())
    alerts = all_alerts(txns, params, scale, hot)
    # The rules name the arrival behind which to freeze, so no freeze goes by time.
    freezes = freezes_from_alerts(alerts, accounts).drop("freeze_ts").checkpoint()
    outcomes = apply_transactions(txns, accounts, ledger, freezes, scale, hot)
    return LoopResult(alerts, freezes, outcomes, account_balances(accounts, outcomes, freezes))


def replay_rejects(
    txns: DataFrame,
    accounts: DataFrame,
    ledger: DataFrame,
    freezes: DataFrame,
    shift: int,
    scale: ScaleParams | None = None,
) -> DataFrame:
    """Outcomes of the dead letters when they arrive once more after the run.

    The second run starts from the first one's balances and ledger, so the
    first outcomes are written to the checkpoint folder and read three times.
    So are the freezes: both runs read them, and the rules behind them run once.
    Accounts frozen in between stay frozen.
    """
    checkpoint_root(txns.sparkSession)
    freezes = freezes.checkpoint()
    first = apply_transactions(txns, accounts, ledger, freezes, scale).checkpoint()
    keys = ["account_id", "transaction_id"]
    known = ledger.select(*keys).unionByName(ledger_rows(first).select(*keys))
    again = replay_arrivals(transaction_dead_letters(first), shift)
    after = account_balances(accounts, first, freezes)
    outcomes = apply_transactions(again, after, known, None, scale)
    return outcomes.withColumn("arrival", F.col("arrival") - shift)
