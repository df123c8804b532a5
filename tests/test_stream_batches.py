"""Streams settled, counted and de-duplicated batch by batch, with what batches carry in tables."""

from datetime import timedelta
from decimal import Decimal

import pytest
from test_stream_loop import NOW, RULES, SMALL, loop_of, numbers, tables_of, txn_rows

from tallyguard.operators import balance, rules
from tallyguard.operators.ledger import freezes_from_alerts
from tallyguard.operators.ordered import running
from tallyguard.params import ScaleParams
from tallyguard.plans import derived
from tallyguard.schemas import ALERT
from tallyguard.sources.transactions import decode_records
from tallyguard.streaming import velocity
from tallyguard.streaming.account_rules import account_rule_tables, write_account_alerts
from tallyguard.streaming.alerts import first_alert_tables, write_first
from tallyguard.streaming.balances import settlement_rows
from tallyguard.streaming.loop import as_records
from tallyguard.streaming.settlement import batch_settlement_tables, write_batch
from tallyguard.streaming.velocity import counted_velocity, timed_tables, write_timed

COLUMNS = ["transaction_id", "account_id", "arrival", "status", "error_class", "error_message", "balance_after_cents"]


def texts(rows):
    return sorted(map(str, rows.collect()))


def test_a_repeated_batch_finds_what_it_found_the_first_time(spark, tmp_path):
    tables = tables_of(spark, tmp_path)
    for n in (1, 3):
        tables.write(n, {"all": numbers(spark, n), "last": numbers(spark, n)}, 1)
    # The newest row of the key is that of the batch to be repeated; it must not hide the one before.
    assert [r.n for r in tables.read("last", 3).collect()] == [1]
    assert tables.read("all", 1).isEmpty()


@pytest.mark.parametrize("scale", [None, ScaleParams(chunk_rows=40)])
def test_settled_batches_equal_the_batch_run(spark, tmp_path, scale):
    txns = derived.with_replays(derived.transactions(spark, SMALL)).cache()
    accounts, ledger = derived.accounts(spark, SMALL), derived.ledger(spark, SMALL)
    alerts = rules.all_alerts(txns, RULES).select(*ALERT.fieldNames()).cache()
    tables = batch_settlement_tables(spark, str(tmp_path))
    write = write_batch(tables, accounts, ledger, scale)
    for n, (low, high) in enumerate([(0, 700), (700, 1400), (1400, 10**6)]):
        part = f"{{0}} >= {low} AND {{0}} < {high}"
        rows = settlement_rows(
            txns.where(part.format("arrival")), alerts.where(part.format("trigger_arrival"))
        )
        # The second batch fails after its commit and is repeated.
        for _ in range(2 if n == 1 else 1):
            write(rows, n)
    freezes = freezes_from_alerts(alerts, accounts)
    batch = balance.apply_transactions(txns, accounts, ledger, freezes).cache()
    assert texts(tables.read("outcomes").select(COLUMNS)) == texts(batch.select(COLUMNS))
    then = balance.account_balances(accounts, batch, freezes)
    want = {r.account_id: (r.balance, r.status) for r in then.collect()}
    for row in tables.read("balances").collect():
        status = "FROZEN" if row.frozen else "ACTIVE"
        assert (Decimal(row.cents) / 100, status) == want[row.account_id]


def test_unreadable_copies_do_not_depend_on_the_cut(spark, tmp_path):
    """An id applied in the stream makes copies of readable records only, in whichever batch."""
    accounts = spark.createDataFrame(
        [("S", "Holder", Decimal("10.00"), "ACTIVE", NOW)], derived.accounts(spark, SMALL).schema
    )
    ledger = derived.ledger(spark, SMALL).limit(0)
    rows = [
        ("T1", "S", "DEPOSIT", "5", 1, 0),
        ("T1", "S", None, None, 2, 1),
        ("T1", "S", "DEPOSIT", "5", 3, 2),
        ("T2", "nobody", None, None, 4, 2),
        ("T3", None, "DEPOSIT", "1", 5, 2),
    ]
    found = []
    for cut in (5, 1):
        tables = batch_settlement_tables(spark, str(tmp_path / str(cut)))
        write = write_batch(tables, accounts, ledger)
        for n, part in enumerate([rows[:cut], rows[cut:]]):
            if part:
                write(settlement_rows(txn_rows(spark, part)), n)
        outcomes = tables.read("outcomes").orderBy("arrival").collect()
        found.append([r.error_class or r.status for r in outcomes])
    assert found[0] == found[1] == ["APPLIED", "DESERIALIZATION", "DUPLICATE", "UNKNOWN_ACCOUNT", "UNKNOWN_ACCOUNT"]


def test_window_counts_are_carried_and_closed(spark, tmp_path):
    txns = derived.transactions(spark, SMALL).cache()
    tables = timed_tables(spark, str(tmp_path))
    write = write_timed(tables, RULES)
    for n, (low, high) in enumerate([(0, 700), (700, 1400), (1400, 10**6)]):
        for _ in range(2 if n == 1 else 1):
            write(txns.where(f"arrival >= {low} AND arrival < {high}"), n)
    got = counted_velocity(tables.read("timed"), RULES).select("account_id", "count", "trigger_arrival")
    want = rules.high_velocity(txns, RULES).select("account_id", "count", "trigger_arrival")
    assert texts(got) == texts(want) != []
    # Only windows that a record can still reach are kept.
    day = 86_400_000
    times = {r.partition: r.stream_ms for r in tables.read("stream_time").collect()}
    kept = tables.read("open_windows").collect()
    assert kept and all(r.window_start_ms + day + 600_000 > times[r.partition] for r in kept)


def test_first_alerts_over_batches(spark, tmp_path):
    """Null accounts and alerts without an arrival are keys and alerts like others."""
    def alerts(*rows):
        return spark.createDataFrame(
            [(a, "T", "LARGE_AMOUNT", r, 1, n, NOW + timedelta(hours=h)) for a, r, n, h in rows], ALERT
        )

    tables = first_alert_tables(spark, str(tmp_path))
    write = write_first(tables, RULES)
    write(alerts(("S", "b", 2, 0), ("S", "a", 1, 0), (None, "c", None, 1), (None, "d", None, 0)), 0)
    for _ in range(2):
        write(alerts(("S", "e", 0, 0), (None, "f", 5, 0), ("S", "g", 9, 48), ("Q", "h", None, 0)), 1)
    assert sorted(r.reason for r in tables.read("first").collect()) == ["a", "d", "g", "h"]
    forgetful = write_first(tables, RULES, ttl_ms=0)
    forgetful(alerts(("S", "i", 0, 0)), 2)
    assert "i" in {r.reason for r in tables.read("first").collect()}


@pytest.mark.parametrize("scale", [None, ScaleParams(chunk_rows=40)])
def test_account_alerts_over_batches_equal_the_batch_rules(spark, tmp_path, scale):
    """Histories and places are carried, also past a batch without the account or its city."""
    txns = derived.transactions(spark, SMALL).cache()
    nameless = txn_rows(spark, [("N", None, "DEPOSIT", "900", 10**7, 0)])
    tables = account_rule_tables(spark, str(tmp_path))
    write = write_account_alerts(tables, RULES, scale)
    for n, (low, high) in enumerate([(0, 700), (700, 720), (720, 1400), (1400, 10**6)]):
        part = txns.where(f"arrival >= {low} AND arrival < {high}")
        # The third batch fails after its commit and is repeated.
        for _ in range(2 if n == 2 else 1):
            write(part.unionByName(nameless) if n == 3 else part, n)
    want = rules.account_alerts(txns, RULES).unionByName(rules.large_amount(nameless, RULES))
    got = tables.read("alerts").select(*ALERT.fieldNames())
    assert texts(got) == texts(want.select(*ALERT.fieldNames()))
    assert {r.rule_type for r in got.collect()} == {"LARGE_AMOUNT", "SPEND_SPIKE", "GEO_IMPOSSIBLE"}


def test_the_loop_raises_alerts_without_a_state_per_account(spark, tmp_path):
    """A stateful operator in Python took most of the loop's time at 60 times sf0.1."""
    txns = derived.transactions(spark, SMALL)
    as_records(txns).coalesce(1).write.parquet(str(tmp_path / "in"))
    loop = loop_of(spark, str(tmp_path / "in"), str(tmp_path / "loop"))
    loop.cycle()
    assert not list((tmp_path / "loop" / "checkpoints").glob("*/state"))
    assert loop.alerts().count() == rules.all_alerts(txns, RULES).count() > 0


def test_a_value_is_parsed_once(spark):
    records = as_records(derived.transactions(spark, SMALL)).limit(5).localCheckpoint()
    plan = decode_records(records)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_stream_time_in_small_runs(spark, monkeypatch):
    """Three partitions in runs of 100 arrivals, with a time carried past all of one of them."""
    txns = derived.transactions(spark, SMALL).cache()
    carried = spark.createDataFrame([(0, 10**13), (1, 0)], "partition int, carried long")
    whole = texts(velocity.add_stream_time(txns, carried))
    found = []
    monkeypatch.setattr(velocity, "TIME_CHUNK_ROWS", 100)
    monkeypatch.setattr(velocity, "running", lambda *a, **k: found.append(k["scale"]) or running(*a, **k))
    assert texts(velocity.add_stream_time(txns, carried)) == whole
    assert [s.chunk_rows for s in found] == [100]
