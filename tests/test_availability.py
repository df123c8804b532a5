import pytest

from tallyguard.operators import availability as av
from tallyguard.schemas import AVAILABILITY_RESPONSE
from tallyguard.sources.sinks import read_alert_state, write_alert_state, write_report

CROMA = [
    (503, "{}", "ERROR: HTTP 503"),
    (200, "<html>", "ERROR: bad JSON"),
    (200, '{"m":"Not Serviceable","pinCodeDetails":{"a":1}}', "OUT OF STOCK"),
    (200, '{"m":"out of stock"}', "OUT OF STOCK"),
    (200, '{"pinCodeDetails":{"a":1}}', "IN STOCK"),
    (200, '{"pinCodeDetails":{ },"promiseDetails":[ ]}', "OUT OF STOCK"),
    (200, '{"promiseDetails":"0"}', "IN STOCK"),
    (200, '{"promiseDetails":0,"pinCodeDetails":""}', "OUT OF STOCK"),
    (200, '{"promiseDetails":false,"pinCodeDetails":null}', "OUT OF STOCK"),
    (200, '{"x":{"eddMessage":"soon"}}', "IN STOCK"),
    (200, "{}", "OUT OF STOCK"),
]
RELIANCE = [
    (404, "{}", "ERROR: HTTP 404"),
    (200, "", "ERROR: bad JSON"),
    (200, '{"data":{"serviceable" :  true}}', "IN STOCK"),
    (200, '{"data":{"Serviceable":true}}', "IN STOCK"),
    (200, '{"data":{"isServiceable":true}}', "OUT OF STOCK"),
    (200, '{"serviceable":"true"}', "OUT OF STOCK"),
    (200, '{"serviceable":false}', "OUT OF STOCK"),
]


def responses_of(spark, rows):
    return spark.createDataFrame(rows, AVAILABILITY_RESPONSE)


def test_classification(spark):
    cases = [("Croma", *c) for c in CROMA] + [("Reliance Digital", *c) for c in RELIANCE]
    cases.append(("Croma", None, None, "ERROR: ReadTimeout"))
    rows = [
        (1, r, "p", str(n), code, body, None if code else "ReadTimeout")
        for n, (r, code, body, _) in enumerate(cases)
    ]
    got = {r.pincode: r.status for r in av.classify_availability(responses_of(spark, rows)).collect()}
    assert got == {str(n): case[-1] for n, case in enumerate(cases)}


def test_sweep_covers_every_place_and_product(spark):
    grid = av.sweep_grid(av.pincodes(spark))
    assert grid.count() == 73 * 5
    assert grid.select("pincode", "retailer", "product").distinct().count() == 365
    assert av.products(spark).count() == 5


@pytest.fixture(scope="module")
def history(spark):
    """Three runs of four keys: always, never, gone in run 2, in error in run 2."""
    live, gone = '{"pinCodeDetails":1}', "{}"
    rows = []
    for run in (10, 20, 35):
        middle = run == 20
        rows += [
            (run, "Croma", "p", "always", 200, live, None),
            (run, "Croma", "p", "never", 200, gone, None),
            (run, "Croma", "p", "returns", 200, gone if middle else live, None),
            (run, "Croma", "p", "error", 500 if middle else 200, live, None),
        ]
    return av.classify_availability(responses_of(spark, rows)).cache()


def test_totals(history):
    got = {r.run_id: (r.n_checks, r.n_hits, r.n_errors) for r in av.sweep_totals(history).collect()}
    assert got == {10: (4, 3, 0), 20: (4, 1, 1), 35: (4, 3, 0)}


def test_transitions_over_the_whole_history(history):
    got = {(r.run_id, r.pincode) for r in av.restock_transitions(history).collect()}
    assert got == {
        (10, "always"),
        (10, "returns"),
        (10, "error"),
        (35, "returns"),
        (35, "error"),
    }


def test_state_from_run_to_run(spark, history, tmp_path):
    base = str(tmp_path / "state")
    alerted = []
    for run in (10, 20, 35):
        current = history.where(f"run_id = {run}")
        fresh = av.new_hits(current, read_alert_state(spark, base))
        alerted.append({r.pincode for r in fresh.collect()})
        write_alert_state(av.next_state(current), base, run)
    assert alerted == [{"always", "returns", "error"}, set(), {"returns", "error"}]


def test_run_without_hits_clears_the_state(spark, history, tmp_path):
    base = str(tmp_path / "state")
    write_alert_state(av.next_state(history.where("run_id = 10")), base, 1)
    write_alert_state(av.next_state(history.where("pincode = 'never'")), base, 2)
    assert read_alert_state(spark, base).count() == 0


def test_report_has_the_header(spark, history, tmp_path):
    path = str(tmp_path / "report")
    for _ in range(2):
        write_report(history.where("run_id = 10"), path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines.count("retailer,product,pincode,status") >= 1
    assert "Croma,p,never,OUT OF STOCK" in lines
    assert spark.read.option("header", True).csv(path).count() == 4
