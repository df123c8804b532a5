from datetime import UTC, datetime
from decimal import Decimal

from tallyguard.operators.requests import normalize_requests, validate_requests
from tallyguard.schemas import REQUEST


def requests_of(spark, rows):
    full = [(i, a, t, None if m is None else Decimal(m), c) for i, a, t, m, c in rows]
    return spark.createDataFrame(full, REQUEST)


def test_violations(spark):
    checked = validate_requests(
        requests_of(
            spark,
            [
                ("ok", "ACC1001", "DEPOSIT", "250.00", "Mumbai"),
                ("two", None, "DEPOSIT", "-50.00", None),
                ("least", "A", "TRANSFER", "0.01", None),
                ("zero", "A", "TRANSFER", "0.00", None),
                ("blank", " \t ", "WITHDRAW", "1.00", None),
                ("type", "A", "REFUND", "1.00", None),
                ("all", "", None, None, None),
            ],
        )
    )
    found = {r.transaction_id: (r.violations, r.is_valid) for r in checked.collect()}
    assert found == {
        "ok": ([], True),
        "two": (["accountId", "amount"], False),
        "least": ([], True),
        "zero": (["amount"], False),
        "blank": (["accountId"], False),
        "type": (["type"], False),
        "all": (["accountId", "type", "amount"], False),
    }


def test_normalised_requests_get_an_id_and_a_time(spark):
    rows = normalize_requests(
        requests_of(
            spark,
            [
                ("mine", "A", "DEPOSIT", "1.00", "Pune"),
                (None, "B", "DEPOSIT", "2.00", None),
                (None, "B", "DEPOSIT", "0.00", None),
            ],
        )
    ).collect()
    by_account = {r.account_id: r for r in rows}
    assert len(rows) == 2
    assert by_account["A"].transaction_id == "mine" and by_account["A"].city == "Pune"
    assert len(by_account["B"].transaction_id) == 36
    age = datetime.now(UTC).timestamp() - by_account["B"].event_ts.timestamp()
    assert -5 < age < 3600
