from collections import Counter
from datetime import timedelta

import cases
import pytest
from pyspark.sql import functions as F

from tallyguard.operators import rules
from tallyguard.params import RuleParams, ScaleParams
from tallyguard.schemas import TRANSACTION

PARAMS = RuleParams()
SPLIT = ScaleParams(chunk_rows=2)


@pytest.fixture(scope="module")
def txns(spark):
    return cases.transactions(spark).cache()


def test_every_literal_case(txns):
    alerts = rules.all_alerts(txns, PARAMS)
    assert cases.summary(alerts) == cases.expected()
    assert alerts.count() == len(cases.expected())


def test_same_alerts_when_every_key_is_split_into_chunks(txns):
    assert cases.summary(rules.all_alerts(txns, PARAMS, SPLIT)) == cases.expected()


def test_reasons_and_ids(txns):
    by_account = {
        (a.account_id, a["count"]): a for a in rules.all_alerts(txns, PARAMS).collect()
    }
    assert by_account["A2", 6].reason == "Too many transactions: 6 in 60s"
    assert by_account["A2", 6].transaction_id is None
    assert by_account["B1", 1].reason == "Large transaction: 200000.00 exceeds 100000"
    assert by_account["C1", 1].reason == "Spike: 10000.00 > 5.0x rolling avg 100.00"
    assert by_account["C7", 1].reason == "Spike: 0.06 > 5.0x rolling avg 0.01"
    travel = by_account["D1", 1].reason
    assert travel.startswith("Impossible travel: Mumbai -> London (7")
    assert travel.endswith(" km/h")


def test_final_form_has_one_row_per_window(txns):
    final = {
        (r.account_id, r["count"]) for r in rules.high_velocity_final(txns, PARAMS).collect()
    }
    assert ("E3", 8) in final and ("A2", 6) in final and ("A1", 5) not in final


def test_late_records_are_those_past_grace(txns):
    late = {r.account_id for r in rules.late_records(txns, PARAMS).collect()}
    # D8's second record is 50 s behind, beyond its window and grace as well.
    assert late == {"D8", "E2"}


def test_records_without_account_only_reach_the_amount_rule(spark, txns):
    orphan = txns.where("account_id = 'B1'").withColumn("account_id", F.lit(None).cast("string"))
    many = orphan.unionByName(orphan.withColumn("arrival", F.col("arrival") + 100_000))
    kinds = Counter(a.rule_type for a in rules.all_alerts(many, PARAMS).collect())
    assert kinds == {"LARGE_AMOUNT": 2}


def test_dedup_keeps_the_first_alert_of_a_window(txns):
    alerts = rules.high_velocity(txns, PARAMS)
    first = {
        (a.account_id, a["count"], a.n_alerts)
        for a in rules.dedup_alerts(alerts, PARAMS).collect()
    }
    assert ("E3", 6, 3) in first


def test_union_keeps_several_alerts_of_one_transaction(spark, txns):
    both = txns.where("account_id = 'C1'").withColumn(
        "amount", F.when(F.col("amount") > 1000, F.lit(200000).cast("decimal(18,2)"))
        .otherwise(F.col("amount"))
    )
    kinds = {a.rule_type for a in rules.all_alerts(both, PARAMS).collect()}
    assert kinds == {"LARGE_AMOUNT", "SPEND_SPIKE"}


def test_sliding_counts_do_not_depend_on_chunks(txns):
    def counts(scale=None):
        found = rules.velocity_sliding(txns, PARAMS, scale).collect()
        return {(r.account_id, r.arrival, r["count"]) for r in found}

    busy = {(account, n) for account, _, n in counts()}
    assert ("E3", 8) in busy and ("A2", 6) in busy
    assert counts() == counts(ScaleParams(chunk_rows=3))


def test_sessions_end_after_a_pause_longer_than_the_gap(spark):
    """The gap itself still joins; a pause within a grid cell of that width never parts."""
    seconds = [0, 60, 119, 180, 241, 300, -61, -30, 1000]
    rows = [
        (f"T{n}", "S" if n < 9 else None, "DEPOSIT", None, None, at, at, n, 0)
        for n, at in enumerate(cases.BASE + timedelta(seconds=s) for s in [*seconds, 5])
    ]
    txns = spark.createDataFrame(rows, TRANSACTION)
    got = rules.velocity_session(txns, RuleParams(count_threshold=0), gap_seconds=60)
    start = int(cases.BASE.timestamp())
    assert sorted((r.start_ms // 1000 - start, r.end_ms // 1000 - start, r["count"]) for r in got.collect()) == [
        (-61, 119, 5),
        (180, 180, 1),
        (241, 300, 2),
        (1000, 1000, 1),
    ]
