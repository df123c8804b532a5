import math
import random
from datetime import UTC, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyguard.operators import balance, dead_letters, ledger
from tallyguard.params import RuleParams, ScaleParams
from tallyguard.plans.closed_loop import closed_loop, replay_rejects
from tallyguard.schemas import ACCOUNT, LEDGER, TRANSACTION

NOW = datetime(2026, 1, 1, 10, 0, 0, tzinfo=UTC)


def money(value):
    return Decimal(value).quantize(Decimal("0.01"))


def txns_of(spark, rows):
    """rows of (id, account, type, amount, arrival)"""
    full = [(i, a, t, money(v), None, NOW, NOW, n, 0) for i, a, t, v, n in rows]
    return spark.createDataFrame(full, TRANSACTION)


def accounts_of(spark, rows):
    full = [(a, f"Holder {a}", money(b), s, NOW) for a, b, s in rows]
    return spark.createDataFrame(full, ACCOUNT)


def ledger_of(spark, ids):
    """ids of (id, account)"""
    return spark.createDataFrame(
        [(i, a, "DEPOSIT", money(1), NOW) for i, a in ids], LEDGER
    )


def freezes_of(spark, rows):
    return spark.createDataFrame(rows, "account_id string, freeze_arrival long")


def outcome_map(df):
    return {r.arrival: (r.status, r.error_class, r.balance_after_cents) for r in df.collect()}


def test_literal_cases(spark):
    accounts = accounts_of(
        spark,
        [(f"S{n}", "1000", "ACTIVE") for n in range(6)] + [("Z", "1000", "FROZEN")],
    )
    txns = txns_of(
        spark,
        [
            ("T1", "S0", "DEPOSIT", "250", 1),
            ("T2", "S1", "WITHDRAW", "300", 2),
            ("T3", "S2", "WITHDRAW", "5000", 3),
            ("T4", "MISSING", "DEPOSIT", "5", 4),
            ("OLD", "S3", "DEPOSIT", "5", 5),
            ("T5", "S4", "TRANSFER", "200", 6),
            ("T6", "Z", "WITHDRAW", "100", 7),
            ("T7", "Z", "DEPOSIT", "100", 8),
            ("X", "S5", "WITHDRAW", "1500", 9),
            ("Y", "S5", "DEPOSIT", "700", 10),
            ("X", "S5", "WITHDRAW", "1500", 11),
            ("X", "S5", "WITHDRAW", "1500", 12),
            ("W", "S5", "WITHDRAW", "200", 13),
        ],
    )
    result = balance.apply_transactions(txns, accounts, ledger_of(spark, [("OLD", "S3")]))
    assert outcome_map(result) == {
        1: ("APPLIED", None, 125000),
        2: ("APPLIED", None, 70000),
        3: ("REJECTED", "INSUFFICIENT_FUNDS", None),
        4: ("REJECTED", "UNKNOWN_ACCOUNT", None),
        5: ("DUPLICATE", None, None),
        6: ("APPLIED", None, 80000),
        7: ("REJECTED", "ACCOUNT_FROZEN", None),
        8: ("APPLIED", None, 110000),
        9: ("REJECTED", "INSUFFICIENT_FUNDS", None),
        10: ("APPLIED", None, 170000),
        11: ("APPLIED", None, 20000),
        12: ("DUPLICATE", None, None),
        13: ("APPLIED", None, 0),
    }
    messages = {r.arrival: r.error_message for r in result.collect()}
    assert messages[3] == "Insufficient funds for S2"
    assert messages[4] == "Unknown account: MISSING"
    assert messages[7] == "Account frozen: Z — WITHDRAW rejected pending fraud review"

    after = {r.account_id: r.balance for r in balance.account_balances(accounts, result).collect()}
    assert after["S0"] == money(1250) and after["S5"] == money(0) and after["S2"] == money(1000)


def test_record_without_account_is_unknown(spark):
    txns = txns_of(spark, [("T", None, "DEPOSIT", "1", 1)])
    result = balance.apply_transactions(
        txns, accounts_of(spark, [("S", "1", "ACTIVE")]), ledger_of(spark, [])
    ).collect()
    assert result[0].error_message == "Unknown account: null"


def random_run(seed, n=1500):
    """Many short balances, repeated ids, a frozen and a hot account, unknown ones."""
    draw = random.Random(seed)
    names = [f"A{k}" for k in range(12)]
    opening = {a: draw.randrange(-2000, 30000) for a in names[:-1]}
    status = {a: "FROZEN" if k == 3 else "ACTIVE" for k, a in enumerate(names[:-1])}
    rows = []
    for arrival in range(n):
        account = "A0" if draw.random() < 0.4 else draw.choice(names)
        earlier = [r for r in rows[-400:] if r[1] == account]
        if earlier and draw.random() < 0.15:
            ident, _, kind, cents, _ = draw.choice(earlier)
        else:
            kind = draw.choice(["DEPOSIT", "WITHDRAW", "WITHDRAW", "TRANSFER"])
            ident, cents = f"T{arrival}", draw.randrange(1, 9000)
        rows.append((ident, account, kind, cents, arrival))
    freezes = {"A0": int(n * 0.8), "A5": n // 3}
    done = {(r[0], r[1]) for r in rows if draw.random() < 0.03}
    return rows, opening, status, freezes, done


def fold(rows, opening, status, freezes, done):
    balances, applied, result = dict(opening), set(), {}
    for ident, account, kind, cents, arrival in rows:
        if (ident, account) in done or (account, ident) in applied:
            outcome = ("DUPLICATE", None, None)
        elif account not in balances:
            outcome = ("REJECTED", "UNKNOWN_ACCOUNT", None)
        elif kind != "DEPOSIT" and (
            status[account] == "FROZEN" or arrival > freezes.get(account, arrival)
        ):
            outcome = ("REJECTED", "ACCOUNT_FROZEN", None)
        elif kind != "DEPOSIT" and balances[account] < cents:
            outcome = ("REJECTED", "INSUFFICIENT_FUNDS", None)
        else:
            balances[account] += cents if kind == "DEPOSIT" else -cents
            applied.add((account, ident))
            outcome = ("APPLIED", None, balances[account])
        result[arrival] = outcome
    return result


@pytest.mark.parametrize(
    ("seed", "scale"),
    [
        (1, ScaleParams()),
        (2, ScaleParams(chunk_rows=250)),
        (3, ScaleParams(chunk_rows=90)),
    ],
)
def test_equals_one_by_one_application(spark, monkeypatch, seed, scale):
    levels = []
    plan_runs = balance._plan_runs
    monkeypatch.setattr(
        balance, "_plan_runs", lambda chunks, level: levels.append(level) or plan_runs(chunks, level)
    )
    rows, opening, status, freezes, done = random_run(seed)
    txns = txns_of(
        spark, [(i, a, k, Decimal(c) / 100, n) for i, a, k, c, n in rows]
    ).cache()
    accounts = accounts_of(
        spark, [(a, Decimal(c) / 100, status[a]) for a, c in opening.items()]
    ).cache()
    result = balance.apply_transactions(
        txns, accounts, ledger_of(spark, done), freezes_of(spark, list(freezes.items())), scale
    ).cache()
    expected = fold(rows, opening, status, freezes, done)
    assert outcome_map(result) == expected
    # Three rounds of single chunks, then doubling runs until one covers them all.
    assert len(levels) <= 4 + math.ceil(math.log2(max(2, len(rows) / scale.chunk_rows)))

    kinds = {r.status: r["count"] for r in result.groupBy("status").count().collect()}
    assert sum(kinds.values()) == len(rows)
    moved = balance.account_balances(accounts, result).collect()
    last = dict(opening)
    for _, account, _, _, arrival in rows:
        if expected[arrival][0] == "APPLIED":
            last[account] = expected[arrival][2]
    assert {r.account_id: int(r.balance * 100) for r in moved} == last


def test_freeze_is_idempotent_and_unknown_alerts_are_rejected(spark):
    accounts = accounts_of(spark, [("A", "1", "ACTIVE"), ("B", "1", "FROZEN"), ("C", "1", "ACTIVE")])
    alerts = spark.createDataFrame(
        [("A", "t1", "LARGE_AMOUNT", 7), ("A", "t0", "SPEND_SPIKE", 3), ("B", "t2", "LARGE_AMOUNT", 1),
         ("GHOST", "t3", "LARGE_AMOUNT", 2)],
        "account_id string, transaction_id string, rule_type string, trigger_arrival long",
    )
    freezes = ledger.freezes_from_alerts(alerts, accounts).collect()
    assert [(f.account_id, f.freeze_arrival, f.n_alerts) for f in freezes] == [("A", 3, 2)]
    frozen = ledger.freeze_accounts(accounts, ledger.freezes_from_alerts(alerts, accounts))
    assert {r.account_id: r.status for r in frozen.collect()} == {
        "A": "FROZEN",
        "B": "FROZEN",
        "C": "ACTIVE",
    }
    rejects = ledger.alert_rejects(alerts, accounts).collect()
    assert [r.error_message for r in rejects] == ["Unknown account: GHOST"]


def test_dead_letters_keep_place_and_payload(spark):
    txns = txns_of(spark, [("T4", "MISSING", "DEPOSIT", "5", 4)])
    result = balance.apply_transactions(
        txns, accounts_of(spark, [("S", "1", "ACTIVE")]), ledger_of(spark, [])
    )
    letter = dead_letters.transaction_dead_letters(result).collect()[0]
    assert (letter.dlt_topic, letter.key, letter.orig_topic) == (
        "transactions.DLT",
        "MISSING",
        "transactions",
    )
    assert (letter.orig_partition, letter.orig_offset) == (0, 4)
    assert letter.payload == (
        '{"transactionId":"T4","accountId":"MISSING","type":"DEPOSIT","amount":5.00,'
        f'"timestamp":{int(NOW.timestamp() * 1000)}}}'
    )


def test_replayed_reject_can_succeed(spark):
    txns = txns_of(
        spark, [("X", "S", "WITHDRAW", "50", 1), ("Y", "S", "DEPOSIT", "60", 2)]
    )
    accounts = accounts_of(spark, [("S", "0", "ACTIVE")])
    again = replay_rejects(
        txns, accounts, ledger_of(spark, []), freezes_of(spark, []), shift=1000
    ).collect()
    assert [(r.transaction_id, r.status, r.balance_after_cents) for r in again] == [
        ("X", "APPLIED", 1000)
    ]


def test_closed_loop_freezes_after_the_trigger(spark):
    txns = txns_of(
        spark,
        [
            ("T1", "S", "DEPOSIT", "500000", 1),
            ("T2", "S", "WITHDRAW", "10", 2),
            ("T3", "S", "DEPOSIT", "10", 3),
        ],
    )
    loop = closed_loop(
        txns, accounts_of(spark, [("S", "0", "ACTIVE")]), ledger_of(spark, []), RuleParams()
    )
    assert outcome_map(loop.outcomes) == {
        1: ("APPLIED", None, 50000000),
        2: ("REJECTED", "ACCOUNT_FROZEN", None),
        3: ("APPLIED", None, 50001000),
    }
    assert [(b.balance, b.status) for b in loop.balances.collect()] == [
        (money("500010"), "FROZEN")
    ]


def test_ledger_rows_are_the_applied_ones(spark):
    txns = txns_of(spark, [("T", "S", "DEPOSIT", "5", 1), ("U", "S", "WITHDRAW", "50", 2)])
    result = balance.apply_transactions(
        txns, accounts_of(spark, [("S", "0", "ACTIVE")]), ledger_of(spark, [])
    )
    assert [r.transaction_id for r in ledger.ledger_rows(result).collect()] == ["T"]
    assert ledger.new_transactions(txns, ledger.ledger_rows(result)).select(
        F.collect_list("transaction_id")
    ).first()[0] == ["U"]


def test_incomplete_records_are_refused_not_applied(spark):
    txns = txns_of(spark, [("T", "S", "DEPOSIT", "5", 1), ("U", "S", "DEPOSIT", "5", 2)])
    hollow = txns.withColumn("amount", F.when(F.col("arrival") == 2, F.col("amount")))
    result = balance.apply_transactions(
        hollow, accounts_of(spark, [("S", "0", "ACTIVE")]), ledger_of(spark, [])
    )
    assert outcome_map(result) == {
        1: ("REJECTED", "DESERIALIZATION", None),
        2: ("APPLIED", None, 500),
    }


def test_a_constant_error_of_the_estimate_needs_no_second_fold(spark, monkeypatch):
    """One early refusal shifts every later chunk; their decisions stay the same."""
    rows = [("X", "S", "WITHDRAW", "900", 0), ("Y", "S", "DEPOSIT", "5000", 1)]
    rows += [(f"T{n}", "S", "WITHDRAW", "1", n) for n in range(2, 60)]
    folds = []
    fold_rows = balance._fold

    def counted(due):
        folds.append(due.count())
        return fold_rows(due)

    monkeypatch.setattr(balance, "_fold", counted)
    result = balance.apply_transactions(
        txns_of(spark, rows),
        accounts_of(spark, [("S", "100", "ACTIVE")]),
        ledger_of(spark, []),
        scale=ScaleParams(chunk_rows=10),
    )
    got = outcome_map(result)
    assert got[0] == ("REJECTED", "INSUFFICIENT_FUNDS", None)
    assert got[59] == ("APPLIED", None, 510000 - 58 * 100)
    # The cold path folds nothing; the first round folds all chunks, and no round follows.
    assert folds == [0, 60]


def test_an_id_counts_within_its_account(spark):
    """In the ledger and among the rows alike; a record without an id is a copy of none."""
    accounts = accounts_of(spark, [("S", "0", "ACTIVE"), ("U", "0", "ACTIVE")])
    rows = [("X", "S", "DEPOSIT", "1", 1), ("X", "U", "DEPOSIT", "2", 2), ("X", "U", "DEPOSIT", "2", 3)]
    rows += [("L", "S", "DEPOSIT", "4", 4), ("L", "U", "DEPOSIT", "8", 5)]
    rows += [(None, "U", "DEPOSIT", "16", 6), (None, "U", "DEPOSIT", "16", 7)]
    for scale in (ScaleParams(), ScaleParams(chunk_rows=2)):
        result = balance.apply_transactions(
            txns_of(spark, rows), accounts, ledger_of(spark, [("L", "S"), (None, "U")]), scale=scale
        )
        got = {n: status for n, (status, _, _) in outcome_map(result).items()}
        assert got == dict(enumerate(["APPLIED", "APPLIED", "DUPLICATE", "DUPLICATE"] + ["APPLIED"] * 3, 1))


def test_alerts_from_a_topic_freeze_by_the_time_of_the_broker(spark):
    accounts = accounts_of(spark, [("S", "10", "ACTIVE")])
    alert = [("S", None, "HIGH_VELOCITY", "r", 6, None, NOW, 0, 3)]
    alerts = spark.createDataFrame(
        alert,
        "account_id string, transaction_id string, rule_type string, reason string, count long, "
        "trigger_arrival long, alert_ts timestamp, partition int, offset long",
    )
    freezes = ledger.freezes_from_alerts(alerts, accounts)
    # The second record came to the broker after the alert, the third one before it.
    later = F.when(F.col("arrival") == 2, F.expr("INTERVAL 1 SECOND")).otherwise(F.expr("INTERVAL 0 SECOND"))
    txns = txns_of(spark, [(f"T{n}", "S", "WITHDRAW", "1", n) for n in (1, 2, 3)])
    txns = txns.withColumn("record_ts", F.col("record_ts") + later)
    result = outcome_map(balance.apply_transactions(txns, accounts, ledger_of(spark, []), freezes))
    assert [result[n][0] for n in (1, 2, 3)] == ["APPLIED", "REJECTED", "APPLIED"]
    rejects = ledger.frozen_rejects(txns, accounts, freezes).collect()
    assert [r.transaction_id for r in rejects] == ["T2"]
    letters = dead_letters.alert_dead_letters(ledger.alert_rejects(alerts, accounts.where("false"))).collect()
    assert [(r.orig_partition, r.orig_offset) for r in letters] == [(0, 3)]


def test_balances_need_one_full_shuffle_and_three_windows(spark, monkeypatch):
    """The written running table serves every path; nothing sorts or shuffles the rows twice."""
    written = []
    kept = balance._all_apply
    monkeypatch.setattr(balance, "_all_apply", lambda rows: written.append(kept(rows)) or written[-1])
    txns = txns_of(spark, [(f"T{n}", f"S{n % 3}", "WITHDRAW", "1", n) for n in range(9)])
    accounts = accounts_of(spark, [("S0", "10", "ACTIVE"), ("S1", "1", "ACTIVE")])
    balance.apply_transactions(txns, accounts, ledger_of(spark, [("T1", "S1")])).count()
    (running,) = written
    plan = running._jdf.queryExecution().executedPlan().toString()
    # The initial and the final plan may both be shown; one of them is counted.
    plan = plan.split("Initial Plan")[0]
    assert sum(line.strip(" :+-*()0123456789").startswith("Window") for line in plan.splitlines()) == 3
    assert plan.count("REPARTITION_BY_COL") == 1
