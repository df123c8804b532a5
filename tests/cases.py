"""Literal transactions with the alerts they must raise, one partition per case."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta
from decimal import Decimal

from tallyguard.schemas import TRANSACTION

BASE = datetime(2026, 1, 1, 10, 0, 0, tzinfo=UTC)


@dataclass
class Case:
    name: str
    # account, amount, city, seconds after base
    rows: list[tuple[str, str | None, str | None, float]]
    # account, rule, count, index of the triggering row
    alerts: list[tuple[str, str, int, int]] = field(default_factory=list)


M = "Mumbai"
CASES = [
    Case("at threshold", [("A1", "100", M, i) for i in range(5)] + [("A1x", "1", M, 65)]),
    Case(
        "above threshold",
        [("A2", "50", M, i) for i in range(6)] + [("A2x", "1", M, 65)],
        [("A2", "HIGH_VELOCITY", 6, 5)],
    ),
    Case("large", [("B1", "200000", M, 0)], [("B1", "LARGE_AMOUNT", 1, 0)]),
    Case("equal to large", [("B2", "100000.00", M, 0)]),
    Case(
        "spike",
        [("C1", "100", M, i) for i in range(3)] + [("C1", "10000", M, 10)],
        [("C1", "SPEND_SPIKE", 1, 3)],
    ),
    Case("mild", [("C2", "100", M, i) for i in range(3)] + [("C2", "200", M, 10)]),
    Case("exactly five times", [("C3", "100", M, i) for i in range(3)] + [("C3", "500", M, 9)]),
    Case(
        "just over five times",
        [("C4", "100", M, i) for i in range(3)] + [("C4", "500.01", M, 9)],
        [("C4", "SPEND_SPIKE", 1, 3)],
    ),
    Case("short history", [("C5", "100", M, 0), ("C5", "100", M, 1), ("C5", "10000", M, 2)]),
    Case(
        "spike raises its baseline",
        [("C6", "100", M, i) for i in range(3)] + [("C6", "10000", M, 9), ("C6", "10000", M, 10)],
        [("C6", "SPEND_SPIKE", 1, 3)],
    ),
    Case(
        "mean rounds down",
        [("C7", a, M, i) for i, a in enumerate(["0.01", "0.01", "0.02", "0.06"])],
        [("C7", "SPEND_SPIKE", 1, 3)],
    ),
    Case(
        "mean rounds half up",
        [("C8", a, M, i) for i, a in enumerate(["0.01", "0.02", "0.01", "0.02", "0.09"])],
    ),
    Case(
        "impossible travel",
        [("D1", "10", M, 0), ("D1", "10", "London", 600)],
        [("D1", "GEO_IMPOSSIBLE", 1, 1)],
    ),
    Case("plausible travel", [("D2", "10", M, 0), ("D2", "10", "Pune", 7200)]),
    Case("unknown city", [("D3", "10", "Gotham", 0), ("D3", "10", "London", 60)]),
    Case(
        "unknown city breaks the chain",
        [("D4", "10", M, 0), ("D4", "10", "Gotham", 60), ("D4", "10", "London", 120)],
    ),
    Case(
        "missing city keeps the chain",
        [("D5", "10", M, 0), ("D5", "10", None, 60), ("D5", "10", "London", 120)],
        [("D5", "GEO_IMPOSSIBLE", 1, 2)],
    ),
    Case("same city in capitals", [("D6", "10", M, 0), ("D6", "10", "MUMBAI", 1)]),
    Case("two names for a place", [("D7", "10", "Bangalore", 0), ("D7", "10", "Bengaluru", 1)]),
    Case(
        "out of order",
        [("D8", "10", M, 100), ("D8", "10", "London", 50)],
        [("D8", "GEO_IMPOSSIBLE", 1, 1)],
    ),
    Case(
        "late within grace",
        [("E1", "10", M, i) for i in range(5)] + [("E1x", "10", M, 65), ("E1", "10", M, 30)],
        [("E1", "HIGH_VELOCITY", 6, 6)],
    ),
    Case(
        "late past grace",
        [("E2", "10", M, i) for i in range(5)] + [("E2x", "10", M, 70), ("E2", "10", M, 30)],
    ),
    Case(
        "repeat alerts",
        [("E3", "10", M, i) for i in range(8)],
        [("E3", "HIGH_VELOCITY", n, n - 1) for n in (6, 7, 8)],
    ),
    Case("no amount", [("F1", None, M, i) for i in range(4)]),
]


def transactions(spark):
    """All cases in one DataFrame, each in a partition of its own."""
    rows, arrival = [], 0
    for number, case in enumerate(CASES):
        for account, amount, city, seconds in case.rows:
            moment = BASE + timedelta(seconds=seconds)
            value = None if amount is None else Decimal(amount).quantize(Decimal("0.01"))
            rows.append(
                (f"T{arrival}", account, "WITHDRAW", value, city, moment, moment, arrival, number)
            )
            arrival += 1
    return spark.createDataFrame(rows, TRANSACTION)


def expected():
    """(account, rule, count, arrival) of every alert."""
    found, arrival = set(), 0
    for case in CASES:
        for account, rule, count, index in case.alerts:
            found.add((account, rule, count, arrival + index))
        arrival += len(case.rows)
    return found


def summary(alerts):
    return {
        (a.account_id, a.rule_type, a["count"], a.trigger_arrival) for a in alerts.collect()
    }
