import json

from pyspark.sql import functions as F

from tallyguard.operators.dead_letters import unreadable_dead_letters
from tallyguard.sources import sinks
from tallyguard.sources import transactions as src

RAW = "key binary, value binary, partition int, offset long, timestamp timestamp"


def raw_records(spark):
    good = {
        "transactionId": "T1",
        "accountId": "A",
        "type": "DEPOSIT",
        "amount": 12.3,
        "city": None,
        "timestamp": 1767261600123,
    }
    values = [json.dumps(good), "not json", json.dumps({**good, "type": "REFUND"})]
    rows = [(b"A", v.encode(), 2, 100 + n, None) for n, v in enumerate(values)]
    return spark.createDataFrame(rows, RAW)


def test_records_are_decoded_or_dead_lettered(spark):
    records = src.decode_records(raw_records(spark))
    txn = src.decoded_transactions(records).collect()
    assert [(t.transaction_id, str(t.amount), t.arrival, t.partition) for t in txn] == [
        ("T1", "12.30", 100, 2)
    ]
    assert int(txn[0].event_ts.timestamp() * 1000) == 1767261600123
    letters = unreadable_dead_letters(records).collect()
    assert {(letter.orig_offset, letter.error_class) for letter in letters} == {
        (101, "DESERIALIZATION"),
        (102, "DESERIALIZATION"),
    }
    assert letters[0].payload == "not json" and letters[0].dlt_topic == "transactions.DLT"


def test_wire_schema_names_every_field():
    fields = {f["name"] for f in json.loads(src.TRANSACTION_AVRO)["fields"]}
    assert fields == {"transactionId", "accountId", "type", "amount", "city", "timestamp"}


def test_messages_are_keyed_by_account_and_read_back(spark):
    import cases

    txns = cases.transactions(spark).where("amount IS NOT NULL")
    messages = sinks.keyed_messages(txns).select(
        F.encode("key", "utf-8").alias("key"),
        F.encode("value", "utf-8").alias("value"),
        F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
    back = src.decoded_transactions(src.decode_records(messages))
    columns = ["transaction_id", "account_id", "type", "amount", "city", "event_ts"]
    assert back.select(columns).exceptAll(txns.select(columns)).isEmpty()
    assert back.count() == txns.count()


def test_files_keep_account_order(spark, tmp_path):
    import cases

    path = str(tmp_path / "topic")
    txns = cases.transactions(spark)
    sinks.publish_to_files(txns, path)
    files = (
        src.read_files(spark, path)
        .select("*", F.input_file_name().alias("file"))
        .withColumn("place", F.monotonically_increasing_id())
        .collect()
    )
    assert len(files) == txns.count()
    seen = {}
    for row in sorted(files, key=lambda r: (r.file, r.place)):
        last = seen.get((row.file, row.account_id), -1)
        assert row.arrival > last
        seen[row.file, row.account_id] = row.arrival


def test_alerts_travel_as_messages(spark):
    import cases

    from tallyguard.operators import rules
    from tallyguard.params import RuleParams
    from tallyguard.sources.alerts import decode_alerts

    alerts = rules.large_amount(cases.transactions(spark), RuleParams())
    bad = spark.createDataFrame([("k", "{}"), ("k", "no")], "key string, value string")
    records = sinks.alert_messages(alerts).unionByName(bad).select(
        "*",
        F.lit(1).alias("partition"),
        F.lit(7).cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
    back = decode_alerts(records).collect()
    assert [(a.account_id, a.rule_type, a["count"], a.partition, a.offset) for a in back] == [
        ("B1", "LARGE_AMOUNT", 1, 1, 7)
    ]
    # The offset is one of the alert topic, so it says nothing about transactions.
    assert back[0].trigger_arrival is None
    assert back[0].alert_ts is not None


def test_unreadable_alerts_become_dead_letters(spark):
    from tallyguard.sources.alerts import alert_records, decode_alerts

    good = '{"accountId": "A1", "ruleType": "LARGE_AMOUNT"}'
    values = [good, "no", "{}", None, '{"accountId": "A1", "ruleType": "OTHER"}', '{"ruleType": "LARGE_AMOUNT"}']
    raw = spark.createDataFrame(
        [("k", v, 2, n) for n, v in enumerate(values)], "key string, value string, partition int, offset long"
    ).withColumn("timestamp", F.timestamp_millis(F.lit(5)))
    letters = unreadable_dead_letters(alert_records(raw), "alerts").collect()
    assert {(r.dlt_topic, r.orig_partition, r.orig_offset, r.payload) for r in letters} == {
        ("alerts.DLT", 2, n, values[n]) for n in range(1, 6)
    }
    # Without a time of its own an alert counts from its record's.
    assert [(r.offset, r.alert_ts.timestamp()) for r in decode_alerts(raw).collect()] == [(0, 0.005)]


def test_alert_files_are_read_back(spark, tmp_path):
    import cases

    from tallyguard.operators import rules
    from tallyguard.params import RuleParams
    from tallyguard.sources.alerts import read_alert_files

    alerts = rules.large_amount(cases.transactions(spark), RuleParams())
    alerts.write.parquet(str(tmp_path / "alerts"))
    assert [a.account_id for a in read_alert_files(spark, str(tmp_path / "alerts")).collect()] == ["B1"]


def test_payload_rows_survive_odd_elements_and_white_space(spark):
    from tallyguard.sources.payloads import unwrap_rows

    payloads = ['\n\t[{"id":1},5,{"id":"3"},null]', ' {"rows":[{"id":4},[1]]}', "no rows", None, "[]", '{"rows":5}']
    frame = spark.createDataFrame(list(enumerate(payloads)), "i int, payload string")
    got = sorted((r.i, r.row_index, r.row["id"]) for r in unwrap_rows(frame).collect())
    assert got == [(0, 0, "1"), (0, 2, "3"), (1, 0, "4")]
