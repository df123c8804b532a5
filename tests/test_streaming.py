import time

import cases
import pytest
from pyspark.sql import functions as F

from tallyguard.operators import balance, rules
from tallyguard.params import RuleParams
from tallyguard.plans import derived
from tallyguard.sources.sinks import start_alert_sink
from tallyguard.sources.transactions import read_files
from tallyguard.streaming.account_rules import account_alerts
from tallyguard.streaming.balances import (
    current_balances,
    settle,
    settlement_tables,
    stream_outcomes,
    write_settlement,
)
from tallyguard.streaming.velocity import exact_velocity, windowed_velocity

PARAMS = RuleParams()
SMALL = "/root/testdata/sf0.001"


def write_files(txns, path, pieces):
    """One file per run of arrivals, with rising modification times."""
    top = txns.agg(F.max("arrival")).first()[0]
    for n in range(pieces):
        low, high = n * (top + 1) // pieces, (n + 1) * (top + 1) // pieces
        part = txns.where((F.col("arrival") >= low) & (F.col("arrival") < high))
        part.coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.2)


def run(stream, path, mode="append"):
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", f"{path}/out")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.parquet(f"{path}/out")


@pytest.fixture(scope="module")
def literal(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("literal"))
    write_files(cases.transactions(spark), path, 3)
    return path


def stream_of(spark, path):
    return read_files(spark, path, streaming=True, files_per_trigger=1)


def test_literal_cases_over_micro_batches(spark, literal, tmp_path):
    fast = run(exact_velocity(stream_of(spark, literal), PARAMS), str(tmp_path / "velocity"))
    rest = run(account_alerts(stream_of(spark, literal), PARAMS), str(tmp_path / "rest"))
    assert cases.summary(fast.unionByName(rest)) == cases.expected()


def test_large_amount_is_the_batch_rule_with_its_sink(spark, literal, tmp_path):
    alerts = rules.large_amount(stream_of(spark, literal), PARAMS)
    out, checkpoint = str(tmp_path / "alerts"), str(tmp_path / "checkpoint")
    for _ in range(2):
        start_alert_sink(alerts, out, checkpoint, once=True).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert [(r.account_id, r.detected_at is not None) for r in rows] == [("B1", True)]


def test_built_in_windows_agree_on_ordered_input(spark, tmp_path):
    txns = cases.transactions(spark).where("account_id IN ('A1', 'A1x', 'A2', 'A2x', 'E3')")
    ordered = txns.withColumn("arrival", F.row_number().over(_by_time()))
    closing = ordered.where("account_id = 'E3'").limit(1).select(
        *[
            (F.col("record_ts") + F.expr("INTERVAL 1 HOUR")).alias(name)
            if name == "record_ts"
            else F.col(name)
            for name in ordered.columns
        ]
    ).withColumn("arrival", F.lit(1000).cast("long"))
    path = str(tmp_path / "in")
    write_files(ordered.withColumn("arrival", F.col("arrival").cast("long")), path, 2)
    closing.coalesce(1).write.mode("append").parquet(path)
    got = run(windowed_velocity(stream_of(spark, path), PARAMS), str(tmp_path / "built-in"))
    final = rules.high_velocity_final(ordered, PARAMS)
    assert {(r.account_id, r["count"]) for r in got.collect()} == {
        (r.account_id, r["count"]) for r in final.collect()
    } == {("A2", 6), ("E3", 8)}


def _by_time():
    from pyspark.sql import Window

    return Window.orderBy("record_ts", "arrival")


def test_balances_restart_from_the_checkpoint(spark, tmp_path):
    """Half the files, stop, the rest: the same as one batch run over all."""
    txns = derived.with_replays(derived.transactions(spark, SMALL)).cache()
    accounts, ledger = derived.accounts(spark, SMALL), derived.ledger(spark, SMALL)
    alerts = rules.large_amount(txns, RuleParams(large_amount=200))
    source, base, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    half = txns.where("arrival < 1000")
    for part in (half, txns.where("arrival >= 1000")):
        write_files(part, source, 2)
        outcomes = settle(stream_of(spark, source), accounts, ledger)
        tables = settlement_tables(spark, base)
        query = (
            outcomes.writeStream.foreachBatch(write_settlement(tables))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    assert alerts.count() > 0

    batch = balance.apply_transactions(txns, accounts, ledger).cache()
    applied = batch.where("status = 'APPLIED'").select("transaction_id", "account_id", "amount")
    written = tables.read("ledger").select("transaction_id", "account_id", "amount")
    assert written.exceptAll(applied).isEmpty() and applied.exceptAll(written).isEmpty()

    letters = tables.read("dead_letters")
    assert letters.count() == batch.where("status = 'REJECTED'").count()
    commits = spark.read.parquet(f"{base}/commits")
    assert commits.agg(F.sum("n_records")).first()[0] == txns.count()

    now = current_balances(accounts, tables.read("balances"))
    then = balance.account_balances(accounts, batch)
    columns = ["account_id", "balance", "status"]
    assert now.select(columns).exceptAll(then.select(columns)).isEmpty()


def test_settlement_of_a_repeated_batch_leaves_one_copy(spark, tmp_path):
    txns = derived.transactions(spark, SMALL)
    accounts, ledger = derived.accounts(spark, SMALL), derived.ledger(spark, SMALL)
    write_files(txns, str(tmp_path / "in"), 1)
    tagged = run(settle(stream_of(spark, str(tmp_path / "in")), accounts, ledger), str(tmp_path / "run")).cache()
    tables = settlement_tables(spark, str(tmp_path / "settled"))
    for _ in range(2):
        write_settlement(tables)(tagged, 0)
    applied = balance.apply_transactions(txns, accounts, ledger).where("status = 'APPLIED'").count()
    assert tables.read("ledger").count() == applied > 0


def test_streamed_alerts_freeze_later_debits(spark, tmp_path):
    txns = derived.transactions(spark, SMALL).where("account_id IN ('1', '2')")
    accounts = derived.accounts(spark, SMALL)
    ledger = derived.ledger(spark, SMALL).limit(0)
    alerts = rules.spend_spike(txns, RuleParams(spike_multiplier=1.5))
    write_files(txns, str(tmp_path / "in"), 2)
    alerts.coalesce(1).write.parquet(str(tmp_path / "alerts"))
    alert_stream = spark.readStream.schema(alerts.schema).parquet(str(tmp_path / "alerts"))
    # All files in one batch, so that alerts and transactions meet in arrival order.
    stream = read_files(spark, str(tmp_path / "in"), streaming=True)
    got = run(stream_outcomes(stream, accounts, ledger, alert_stream), str(tmp_path / "run"))

    from tallyguard.operators.ledger import freezes_from_alerts

    freezes = freezes_from_alerts(alerts, accounts)
    batch = balance.apply_transactions(txns, accounts, ledger, freezes)
    columns = ["transaction_id", "status", "error_class", "balance_after_cents"]
    assert freezes.count() > 0
    assert got.select(columns).exceptAll(batch.select(columns)).isEmpty()
    assert got.count() == batch.count()
