"""Streams with durable tables between them: commits, freezes, letters, windows and the loop."""

from datetime import UTC, datetime, timedelta
from decimal import Decimal

import cases
import pytest
from pyspark.sql import functions as F
from test_streaming import run, stream_of, write_files

from tallyguard.operators import balance, dead_letters, ledger, rules
from tallyguard.params import RuleParams, ScaleParams
from tallyguard.plans import derived
from tallyguard.plans.closed_loop import closed_loop
from tallyguard.schemas import ALERT, TRANSACTION
from tallyguard.sources.alerts import decode_alerts
from tallyguard.streaming.balances import (
    current_balances,
    outcome_rows,
    settle,
    settlement_tables,
    write_settlement,
)
from tallyguard.streaming.loop import StreamingLoop, as_records
from tallyguard.streaming.tables import BatchTables, TableSpec
from tallyguard.streaming.velocity import add_stream_time, exact_velocity

SMALL = "/root/testdata/sf0.001"
RULES = RuleParams(window_seconds=86_400, grace_seconds=600, count_threshold=5, large_amount=Decimal("200"))
NOW = datetime(2026, 1, 1, 10, 0, 0, tzinfo=UTC)
RECORDS = "key string, value string, partition int, offset long, timestamp timestamp"


def numbers(spark, *values):
    return spark.createDataFrame([(v, v % 2) for v in values], "n long, k long")


def tables_of(spark, path):
    schema = numbers(spark, 1).schema
    return BatchTables(spark, str(path), {"all": TableSpec(schema), "last": TableSpec(schema, ("k",))})


def values(tables, name):
    return sorted(r.n for r in tables.read(name).collect())


def test_a_batch_counts_once_it_is_committed(spark, tmp_path):
    tables = tables_of(spark, tmp_path)
    assert values(tables, "all") == [] and tables.compact() is None and tables.remove_folded() == 0
    tables.write(0, {"all": numbers(spark, 1, 2), "last": numbers(spark, 1, 2)}, 2)
    # A batch that fails before its commit leaves folders that nobody reads.
    numbers(spark, 7).write.parquet(f"{tmp_path}/all/batch_id=1")
    assert values(tables, "all") == [1, 2]
    for _ in range(2):
        tables.write(1, {"all": numbers(spark, 3), "last": numbers(spark, 3)}, 1)
    assert values(tables, "all") == [1, 2, 3] and values(tables, "last") == [2, 3]


def test_compaction_between_two_reads_changes_nothing(spark, tmp_path):
    tables = tables_of(spark, tmp_path)
    for n in range(4):
        tables.write(n, {"all": numbers(spark, n), "last": numbers(spark, n)}, 1)
    before = tables.read("all")
    assert tables.compact() == 3 and tables.committed() == []
    # A reader of the state before still finds its folders.
    assert sorted(r.n for r in before.collect()) == values(tables, "all") == [0, 1, 2, 3]
    assert values(tables, "last") == [2, 3]
    assert tables.remove_folded() > 0 and values(tables, "all") == [0, 1, 2, 3]
    tables.write(4, {"all": numbers(spark, 4), "last": numbers(spark, 4)}, 1)
    # A batch that is repeated after it was folded counts once.
    tables.write(3, {"all": numbers(spark, 3), "last": numbers(spark, 3)}, 1)
    assert values(tables, "all") == [0, 1, 2, 3, 4] and values(tables, "last") == [3, 4]
    # A compaction that fails before its entry counts for nothing.
    numbers(spark, 99).write.parquet(f"{tmp_path}/all-compacted/upto=4")
    assert values(tables, "all") == [0, 1, 2, 3, 4]
    assert tables.compact() == 4 and tables.remove_folded() > 0 and values(tables, "all") == [0, 1, 2, 3, 4]


def txn_rows(spark, rows):
    """rows of (id, account, type, amount, arrival, seconds)"""
    full = [
        (i, a, t, None if v is None else Decimal(v).quantize(Decimal("0.01")), None, NOW, NOW + timedelta(seconds=s), n, 0)
        for i, a, t, v, n, s in rows
    ]
    return spark.createDataFrame(full, TRANSACTION)


def settled_of(spark, tmp_path, txns, alerts, accounts, applied):
    tables = settlement_tables(spark, str(tmp_path / "settled"))
    write_files(txns, str(tmp_path / "in"), 1)
    alerts.coalesce(1).write.parquet(str(tmp_path / "alerts"))
    stream = spark.readStream.schema(alerts.schema).parquet(str(tmp_path / "alerts"))
    rows = settle(stream_of(spark, str(tmp_path / "in")), accounts, applied, stream)
    query = rows.writeStream.foreachBatch(write_settlement(tables))
    query.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return tables


def test_freezes_letters_and_incomplete_records(spark, tmp_path):
    """What the batch gives, and a freeze is recorded though no transaction follows it."""
    accounts = derived.accounts(spark, SMALL).limit(0).unionByName(
        spark.createDataFrame(
            [(a, f"Holder {a}", Decimal("10.00"), s, NOW) for a, s in (("S", "ACTIVE"), ("Q", "ACTIVE"), ("Z", "FROZEN"))],
            derived.accounts(spark, SMALL).schema,
        )
    )
    applied = spark.createDataFrame([("OLD", "S", "DEPOSIT", Decimal("1.00"), NOW)], derived.ledger(spark, SMALL).schema)
    txns = txn_rows(
        spark,
        [
            ("T1", "S", "WITHDRAW", "1", 1, 0),
            ("T2", "S", "WITHDRAW", "1", 2, 1),
            ("T3", "S", "DEPOSIT", "5", 3, 2),
            ("T3", "S", "DEPOSIT", "5", 4, 2),
            ("OLD", "S", None, None, 5, 2),
            ("T5", "S", None, "5", 6, 2),
            ("T6", "nobody", "DEPOSIT", None, 7, 2),
            ("T7", None, "DEPOSIT", "1", 8, 2),
            ("T3", "Z", "DEPOSIT", "1", 9, 2),
            ("T9", "Z", "WITHDRAW", "1", 10, 2),
            ("OLD", "Z", "DEPOSIT", "1", 11, 2),
        ],
    )
    alerts = spark.createDataFrame(
        [
            ("S", "T1", "LARGE_AMOUNT", "r", 1, 1, NOW),
            ("Q", "T1", "LARGE_AMOUNT", "r", 1, 1, NOW),
            ("nobody", "T6", "LARGE_AMOUNT", "r", 1, 7, NOW),
            (None, "T7", "LARGE_AMOUNT", "r", 1, 8, NOW),
            ("Z", "T8", "LARGE_AMOUNT", "r", 1, 9, NOW),
        ],
        ALERT,
    )
    tables = settled_of(spark, tmp_path, txns, alerts, accounts, applied)
    freezes = ledger.freezes_from_alerts(alerts, accounts)
    batch = balance.apply_transactions(txns, accounts, applied, freezes).cache()
    columns = ["transaction_id", "account_id", "arrival", "status", "error_class", "error_message", "balance_after_cents"]
    assert sorted(map(str, tables.read("outcomes").select(columns).collect())) == sorted(map(str, batch.select(columns).collect()))

    now = {r.account_id: r for r in current_balances(accounts, tables.read("balances")).collect()}
    then = {r.account_id: r for r in balance.account_balances(accounts, batch, freezes).collect()}
    assert {a: (r.balance, r.status) for a, r in now.items()} == {a: (r.balance, r.status) for a, r in then.items()}
    assert now["Q"].status == "FROZEN" and now["Q"].updated_at > NOW.replace(tzinfo=None)
    assert {a for a, r in then.items() if r.updated_at != NOW.replace(tzinfo=None)} == {"S", "Q", "Z"}

    strangers = ledger.alert_rejects(alerts, accounts)
    letters = dead_letters.transaction_dead_letters(batch).unionByName(dead_letters.alert_dead_letters(strangers))
    written = tables.read("dead_letters").select(letters.columns)
    assert sorted(map(str, written.collect())) == sorted(map(str, letters.collect()))


def test_decoded_alerts_agree_in_batch_and_stream(spark, tmp_path):
    """A topic's alerts freeze by the broker's time; their letters keep partition and offset."""
    accounts = derived.accounts(spark, SMALL).where("account_id IN ('1', '2')")
    applied = derived.ledger(spark, SMALL).limit(0)
    txns = derived.transactions(spark, SMALL).where("account_id IN ('1', '2')")
    middle = txns.agg(F.expr("percentile_approx(record_ts, 0.4)")).first()[0]
    wire = '{{"accountId": "{}", "ruleType": "HIGH_VELOCITY", "reason": "r", "count": 6}}'
    raw = spark.createDataFrame(
        [("k", wire.format(a), 2, 10**12 + n, middle) for n, a in enumerate(["1", "nobody"])], RECORDS
    )
    alerts = decode_alerts(raw)
    tables = settled_of(spark, tmp_path, txns, alerts, accounts, applied)
    freezes = ledger.freezes_from_alerts(alerts, accounts)
    batch = balance.apply_transactions(txns, accounts, applied, freezes)
    columns = ["transaction_id", "status", "error_class", "balance_after_cents"]
    written = tables.read("outcomes").select(columns)
    assert sorted(map(str, written.collect())) == sorted(map(str, batch.select(columns).collect()))
    assert written.where("error_class = 'ACCOUNT_FROZEN'").count() > 0
    letters = tables.read("dead_letters").where("orig_topic = 'alerts'").collect()
    assert [(r.key, r.orig_partition, r.orig_offset) for r in letters] == [("nobody", 2, 10**12 + 1)]


@pytest.mark.parametrize("scale", [None, ScaleParams(chunk_rows=7)])
def test_velocity_over_batches_equals_the_batch_rule(spark, tmp_path, scale):
    txns = derived.transactions(spark, SMALL).cache()
    write_files(txns, str(tmp_path / "in"), 4)
    got = run(exact_velocity(stream_of(spark, str(tmp_path / "in")), RULES, scale), str(tmp_path / "run"))
    want = rules.high_velocity(txns, RULES)
    assert cases.summary(got) == cases.summary(want) and got.count() == want.count() > 0


def test_stream_time_is_carried(spark):
    rows = txn_rows(spark, [(f"T{n}", "S" if n != 2 else None, "DEPOSIT", "1", n, s) for n, s in enumerate([5, 3, 99, 8])])
    carried = spark.createDataFrame([(0, int((NOW + timedelta(seconds=6)).timestamp() * 1000))], "partition int, carried long")
    got = sorted((r.arrival, r.stream_ms) for r in add_stream_time(rows, carried).collect())
    base = int(NOW.timestamp() * 1000)
    assert got == [(n, base + s * 1000) for n, s in enumerate([6, 6, 6, 8])]


def loop_of(spark, source, base):
    records = spark.readStream.schema(RECORDS).option("maxFilesPerTrigger", 1).parquet(source)
    return StreamingLoop(records, derived.accounts(spark, SMALL), derived.ledger(spark, SMALL), RULES, base, batches_per_trigger=2)


def test_loop_over_cycles_and_a_restart_equals_the_batch_loop(spark, tmp_path):
    txns = derived.with_replays(derived.transactions(spark, SMALL)).cache()
    accounts = derived.accounts(spark, SMALL)
    source, base = str(tmp_path / "in"), str(tmp_path / "loop")
    bad = spark.createDataFrame([("k", "not JSON", 0, 10**9, NOW)], RECORDS)
    for part in (txns.where("arrival < 900"), txns.where("arrival >= 900")):
        as_records(part).unionByName(bad).coalesce(1).write.mode("append").parquet(source)
        loop = loop_of(spark, source, base)
        loop.take_in()
        # A crash here: a new loop on the same folders goes on.
        loop_of(spark, source, base).cycle()
    loop = loop_of(spark, source, base)
    want = closed_loop(txns, accounts, derived.ledger(spark, SMALL), RULES)
    columns = ["transaction_id", "account_id", "arrival", "status", "error_class", "balance_after_cents"]
    outcomes = loop.settled.read("outcomes")
    assert sorted(map(str, outcomes.select(columns).collect())) == sorted(map(str, want.outcomes.select(columns).collect()))
    assert cases.summary(loop.alerts()) == cases.summary(want.alerts)
    now = current_balances(accounts, loop.settled.read("balances")).select("account_id", "balance", "status")
    then = want.balances.select("account_id", "balance", "status")
    assert now.exceptAll(then).isEmpty() and then.exceptAll(now).isEmpty()
    letters = loop.dead_letters()
    unread = letters.where("error_class = 'DESERIALIZATION'").collect()
    assert [(r.key, r.orig_offset, r.payload) for r in unread] == [("k", 10**9, "not JSON")] * 2
    strangers = ledger.alert_rejects(want.alerts, accounts)
    assert letters.where("orig_topic = 'alerts'").count() == strangers.count() > 0
    assert outcome_rows is not None and loop.settled.compact() is not None
    assert loop.settled.read("outcomes").count() == txns.count()
