"""All queries by name, over the given tables. Money is shown in whole cents,
times in epoch milliseconds, so that results compare exactly."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.functions.money import mean_half_up, to_cents
from tallyguard.operators import availability as av
from tallyguard.operators import balance, catalog, dead_letters, designs, ledger, rules
from tallyguard.operators import requests as reqs
from tallyguard.params import RuleParams
from tallyguard.plans import closed_loop, derived
from tallyguard.schemas import ALERT
from tallyguard.session import scratch_path
from tallyguard.sources.alerts import read_alert_files
from tallyguard.sources.payloads import unwrap_rows
from tallyguard.streaming.account_rules import account_rule_tables, write_account_alerts
from tallyguard.streaming.alerts import dedup_alert_stream, first_alert_tables
from tallyguard.streaming.balances import current_balances
from tallyguard.streaming.loop import StreamingLoop, as_records
from tallyguard.streaming.run import drain, start_drain
from tallyguard.streaming.settlement import batch_settlement_tables, settle_batches
from tallyguard.streaming.velocity import exact_velocity

Query = Callable[[SparkSession, str], DataFrame]

# Thresholds that suit the given tables, where accounts act a few times a day.
EVENT_RULES = RuleParams(
    window_seconds=86_400, grace_seconds=600, count_threshold=5, large_amount=Decimal("200")
)
ORDER_RULES = RuleParams(large_amount=Decimal("400000"), spike_multiplier=2.5)
# Above every arrival number of the given tables.
REPLAY_SHIFT = 1_000_000_000_000

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _cents(name: str = "amount") -> F.Column:
    return to_cents(F.col(name)).alias("cents")


def _alerts(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        "account_id",
        "transaction_id",
        "rule_type",
        "reason",
        F.col("count").alias("alert_count"),
        "trigger_arrival",
        F.unix_millis("alert_ts").alias("alert_ms"),
    )


def _windows(counts: DataFrame) -> DataFrame:
    return counts.select(
        "account_id",
        F.unix_millis("window.start").alias("window_start_ms"),
        F.unix_millis("window.end").alias("window_end_ms"),
        F.col("count").alias("n"),
    )


def _outcomes(outcomes: DataFrame) -> DataFrame:
    return outcomes.select(
        "transaction_id",
        "account_id",
        "arrival",
        "status",
        "error_class",
        "error_message",
        "balance_after_cents",
    )


def _replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.with_replays(derived.transactions(spark, sf_dir))


def _all_freezes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freezes from the alerts of every rule."""
    alerts = rules.all_alerts(_replayed(spark, sf_dir), EVENT_RULES)
    return ledger.freezes_from_alerts(alerts, derived.accounts(spark, sf_dir))


def _applied(spark: SparkSession, sf_dir: str, freezes: DataFrame | None = None) -> DataFrame:
    return balance.apply_transactions(
        _replayed(spark, sf_dir),
        derived.accounts(spark, sf_dir),
        derived.ledger(spark, sf_dir),
        freezes,
    )


# --- sources and requests ----------------------------------------------------


@query
def src_transactions(spark, sf_dir):
    return derived.transactions(spark, sf_dir).select(
        "transaction_id",
        "account_id",
        "type",
        _cents(),
        "city",
        F.unix_millis("event_ts").alias("event_ms"),
        F.unix_millis("record_ts").alias("record_ms"),
        "arrival",
        F.col("partition").cast("long").alias("partition"),
    )


@query
def validate_requests(spark, sf_dir):
    return reqs.validate_requests(derived.requests(spark, sf_dir)).select(
        "transaction_id",
        F.concat_ws(",", "violations").alias("violations"),
        "is_valid",
    )


@query
def normalize_requests(spark, sf_dir):
    return reqs.normalize_requests(derived.requests(spark, sf_dir)).select(
        "transaction_id",
        "account_id",
        "type",
        _cents(),
        "city",
        F.unix_millis("event_ts").alias("event_ms"),
    )


# --- fraud rules -------------------------------------------------------------


@query
def rule_large_amount(spark, sf_dir):
    return _alerts(rules.large_amount(derived.transactions(spark, sf_dir), EVENT_RULES))


@query
def rule_large_amount_orders(spark, sf_dir):
    return _alerts(rules.large_amount(derived.order_transactions(spark, sf_dir), ORDER_RULES))


@query
def velocity_counts(spark, sf_dir):
    return _windows(rules.velocity_counts(derived.transactions(spark, sf_dir), EVENT_RULES))


@query
def rule_high_velocity_final(spark, sf_dir):
    return _windows(rules.high_velocity_final(derived.transactions(spark, sf_dir), EVENT_RULES))


@query
def rule_high_velocity_changelog(spark, sf_dir):
    txns = derived.transactions(spark, sf_dir)
    return _alerts(rules.high_velocity(txns, EVENT_RULES, with_grace=False))


@query
def late_records(spark, sf_dir):
    return rules.late_records(derived.transactions(spark, sf_dir), EVENT_RULES).select(
        "transaction_id",
        "account_id",
        "arrival",
        F.col("partition").cast("long").alias("partition"),
        "window_start_ms",
        "stream_ms",
    )


@query
def velocity_with_grace(spark, sf_dir):
    return _alerts(rules.high_velocity(derived.transactions(spark, sf_dir), EVENT_RULES))


@query
def rolling_stats(spark, sf_dir):
    return rules.rolling_stats(derived.transactions(spark, sf_dir)).select(
        "transaction_id",
        "account_id",
        F.col("prior_cents").cast("long").alias("prior_cents"),
        "prior_count",
        "prior_mean_cents",
    )


@query
def rule_spend_spike(spark, sf_dir):
    return _alerts(rules.spend_spike(derived.transactions(spark, sf_dir), EVENT_RULES))


@query
def rule_spend_spike_orders(spark, sf_dir):
    return _alerts(rules.spend_spike(derived.order_transactions(spark, sf_dir), ORDER_RULES))


@query
def rule_geo_impossible(spark, sf_dir):
    return _alerts(rules.geo_impossible(derived.transactions(spark, sf_dir), EVENT_RULES))


@query
def all_alerts(spark, sf_dir):
    return _alerts(rules.all_alerts(derived.transactions(spark, sf_dir), EVENT_RULES))


@query
def dedup_alerts(spark, sf_dir):
    alerts = rules.all_alerts(derived.transactions(spark, sf_dir), EVENT_RULES)
    return rules.dedup_alerts(alerts, EVENT_RULES).select(
        "account_id", "transaction_id", "rule_type", "trigger_arrival", "window_start_ms", "n_alerts"
    )


@query
def rule_backfill(spark, sf_dir):
    """A changed rule run over the whole history: alerts per account under new thresholds."""
    stricter = RuleParams(spike_multiplier=3.0, spike_min_history=5)
    alerts = rules.spend_spike(derived.transactions(spark, sf_dir), stricter)
    return alerts.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("n_alerts"), F.min("trigger_arrival").alias("first_arrival")
    )


@query
def velocity_hopping(spark, sf_dir):
    txns = derived.transactions(spark, sf_dir)
    return _windows(rules.velocity_hopping(txns, EVENT_RULES, slide_seconds=21_600))


@query
def velocity_sliding(spark, sf_dir):
    """Transactions that see more than the threshold in the day up to themselves."""
    txns = derived.transactions(spark, sf_dir)
    return rules.velocity_sliding(txns, EVENT_RULES).select(
        "transaction_id", "account_id", "arrival", F.col("count").alias("n")
    )


@query
def velocity_session(spark, sf_dir):
    """Sessions without a pause of more than six hours that hold more than the threshold."""
    txns = derived.transactions(spark, sf_dir)
    return rules.velocity_session(txns, EVENT_RULES, gap_seconds=21_600).select(
        "account_id", "start_ms", "end_ms", F.col("count").alias("n")
    )


# --- accounts and balances ---------------------------------------------------


@query
def unknown_account_rejects(spark, sf_dir):
    return ledger.unknown_account_rejects(
        derived.transactions(spark, sf_dir), derived.accounts(spark, sf_dir)
    ).select("transaction_id", "account_id", "error_message")


@query
def new_transactions(spark, sf_dir):
    return ledger.new_transactions(
        _replayed(spark, sf_dir), derived.ledger(spark, sf_dir)
    ).select("transaction_id", "account_id", "arrival", _cents())


@query
def dedup_transactions(spark, sf_dir):
    """The records skipped because their id was applied before, then or now."""
    return (
        _applied(spark, sf_dir)
        .where(F.col("status") == "DUPLICATE")
        .select("transaction_id", "account_id", "arrival")
    )


@query
def freeze_accounts(spark, sf_dir):
    accounts = derived.accounts(spark, sf_dir)
    return ledger.freeze_accounts(accounts, _all_freezes(spark, sf_dir)).select(
        "account_id", "holder_name", _cents("balance"), "status"
    )


@query
def first_alerts(spark, sf_dir):
    alerts = rules.all_alerts(derived.transactions(spark, sf_dir), EVENT_RULES)
    return ledger.first_alerts(alerts)


@query
def alert_rejects(spark, sf_dir):
    alerts = rules.all_alerts(derived.transactions(spark, sf_dir), EVENT_RULES)
    return ledger.alert_rejects(alerts, derived.accounts(spark, sf_dir)).select(
        "account_id", "transaction_id", "rule_type", "error_message"
    )


@query
def frozen_rejects(spark, sf_dir):
    return ledger.frozen_rejects(
        _replayed(spark, sf_dir), derived.accounts(spark, sf_dir), _all_freezes(spark, sf_dir)
    ).select("transaction_id", "account_id", "arrival", "error_message")


@query
def apply_transactions(spark, sf_dir):
    return _outcomes(_applied(spark, sf_dir))


@query
def account_balances(spark, sf_dir):
    return balance.account_balances(
        derived.accounts(spark, sf_dir), _applied(spark, sf_dir)
    ).select("account_id", "holder_name", _cents("balance"), "status", "n_applied")


@query
def ledger_append(spark, sf_dir):
    return ledger.ledger_rows(_applied(spark, sf_dir)).select(
        "transaction_id",
        "account_id",
        "type",
        _cents(),
        F.unix_millis("processed_at").alias("processed_ms"),
    )


@query
def dead_letters_all(spark, sf_dir):
    """Refused transactions in their dead-letter form."""
    outcomes = _applied(spark, sf_dir, _all_freezes(spark, sf_dir))
    return dead_letters.transaction_dead_letters(outcomes).select(
        "dlt_topic",
        "key",
        "orig_topic",
        F.col("orig_partition").cast("long").alias("orig_partition"),
        "orig_offset",
        "error_class",
        "error_message",
        "payload",
    )


QUERIES["dead_letters"] = QUERIES.pop("dead_letters_all")


@query
def rejection_report(spark, sf_dir):
    outcomes = _applied(spark, sf_dir, _all_freezes(spark, sf_dir))
    return dead_letters.rejection_report(dead_letters.transaction_dead_letters(outcomes))


@query
def replay_rejects(spark, sf_dir):
    """Refused withdrawals arrive again after the run; some succeed the second time."""
    return _outcomes(
        closed_loop.replay_rejects(
            _replayed(spark, sf_dir),
            derived.accounts(spark, sf_dir),
            derived.ledger(spark, sf_dir),
            _all_freezes(spark, sf_dir),
            shift=REPLAY_SHIFT,
        )
    )


@query
def flagship(spark, sf_dir):
    """The closed loop: four rules, freezes, then every transaction's outcome."""
    return _outcomes(
        closed_loop.closed_loop(
            _replayed(spark, sf_dir),
            derived.accounts(spark, sf_dir),
            derived.ledger(spark, sf_dir),
            EVENT_RULES,
        ).outcomes
    )


@query
def flagship_balances(spark, sf_dir):
    """The accounts after the closed loop."""
    return closed_loop.closed_loop(
        _replayed(spark, sf_dir),
        derived.accounts(spark, sf_dir),
        derived.ledger(spark, sf_dir),
        EVENT_RULES,
    ).balances.select("account_id", _cents("balance"), "status", "n_applied")


# --- the same on streams -----------------------------------------------------


@query
def stream_large_amount(spark, sf_dir):
    """The very rule of the batch, on a stream."""
    stream = derived.transaction_stream(spark, sf_dir)
    return _alerts(drain(rules.large_amount(stream, EVENT_RULES), "stream-large"))


@query
def stream_velocity(spark, sf_dir):
    stream = derived.transaction_stream(spark, sf_dir)
    return _alerts(drain(exact_velocity(stream, EVENT_RULES), "stream-velocity"))


@query
def stream_account_alerts(spark, sf_dir):
    base = scratch_path(spark, "stream-alerts")
    tables = account_rule_tables(spark, base)
    stream = derived.transaction_stream(spark, sf_dir)
    start_drain(stream, f"{base}/checkpoint", write_account_alerts(tables, EVENT_RULES))
    return _alerts(tables.read("alerts"))


def _written_alerts(spark, sf_dir, txns):
    """The alerts of all rules as a stream over a durable table."""
    path = scratch_path(spark, "alerts")
    alerts = rules.all_alerts(txns, EVENT_RULES).select(*ALERT.fieldNames())
    alerts.write.parquet(path)
    return read_alert_files(spark, path, streaming=True)


def _settled(spark, sf_dir):
    """The tables of repeated transactions and the alerts of all rules, settled on a stream."""
    base = scratch_path(spark, "stream-settled")
    tables = batch_settlement_tables(spark, base)
    settle_batches(
        derived.with_replays(derived.transaction_stream(spark, sf_dir)),
        derived.accounts(spark, sf_dir),
        derived.ledger(spark, sf_dir),
        _written_alerts(spark, sf_dir, _replayed(spark, sf_dir)),
        tables,
        f"{base}/checkpoint",
    )
    return tables


@query
def stream_balances(spark, sf_dir):
    return _outcomes(_settled(spark, sf_dir).read("outcomes"))


@query
def stream_freezes(spark, sf_dir):
    """The last state of every account that changed, frozen ones without a transaction too."""
    changes = _settled(spark, sf_dir).read("balances")
    now = current_balances(derived.accounts(spark, sf_dir), changes)
    return now.select("account_id", _cents("balance"), "status")


@query
def stream_alert_rejects(spark, sf_dir):
    """Alerts for unknown accounts, dead-lettered by the step that freezes the others."""
    letters = _settled(spark, sf_dir).read("dead_letters").where(F.col("orig_topic") == "alerts")
    return letters.select(
        "dlt_topic", "key", "orig_topic", "orig_offset", "error_class", "error_message"
    )


@query
def stream_dedup_alerts(spark, sf_dir):
    alerts = _written_alerts(spark, sf_dir, derived.transactions(spark, sf_dir))
    base = scratch_path(spark, "stream-dedup")
    tables = first_alert_tables(spark, base)
    return dedup_alert_stream(alerts, EVENT_RULES, tables, f"{base}/checkpoint").select(
        "account_id", "transaction_id", "rule_type", "trigger_arrival", "window_start_ms"
    )


def _streaming_loop(spark, sf_dir):
    txns = derived.with_replays(derived.transaction_stream(spark, sf_dir))
    loop = StreamingLoop(
        as_records(txns),
        derived.accounts(spark, sf_dir),
        derived.ledger(spark, sf_dir),
        EVENT_RULES,
        scratch_path(spark, "stream-loop"),
    )
    loop.cycle()
    return loop


@query
def stream_flagship(spark, sf_dir):
    """The closed loop on streams: decode, rules, alerts, freezes and settlement."""
    return _outcomes(_streaming_loop(spark, sf_dir).settled.read("outcomes"))


@query
def stream_dead_letters(spark, sf_dir):
    """The letters of the streaming loop: refused transactions, and alerts without an account."""
    return _streaming_loop(spark, sf_dir).dead_letters().select(
        "dlt_topic", "key", "orig_offset", "error_class", "error_message"
    )


# --- products ----------------------------------------------------------------


@query
def paged_index(spark, sf_dir):
    """The third and the last page of the products by name, out of the written order."""
    rows = derived.products(spark, sf_dir).select("id", "name", "category")
    index = catalog.PageIndex(rows, "name", "id", scratch_path(spark, "page-index"))
    last = -(-index.total // 50)
    pages = index.page(3, 50).withColumn("page", F.lit(3).cast("long"))
    return pages.unionByName(index.page(last, 50).withColumn("page", F.lit(last).cast("long")))


@query
def paged_seek(spark, sf_dir):
    """The page behind the product with the highest number, by falling name."""
    rows = derived.products(spark, sf_dir).select("id", "name", "category")
    last = rows.orderBy(F.desc("id")).limit(1).select("name", "id").first()
    return catalog.page_after(rows, "name", "id", tuple(last) if last else None, 50, ascending=False)



@query
def products_by_category(spark, sf_dir):
    return catalog.products_by_category(derived.products(spark, sf_dir), "pRoMo").select(
        "id", "name", "category", _cents("price")
    )


def _summary(spark, sf_dir, keys):
    return catalog.category_summary(derived.products(spark, sf_dir), keys).select(
        *keys,
        "product_count",
        to_cents(F.col("total_value")).alias("total_cents"),
        mean_half_up(
            to_cents(F.col("total_value")).cast("decimal(38,0)"), F.col("product_count")
        ).alias("average_cents"),
    )


@query
def category_summary(spark, sf_dir):
    return _summary(spark, sf_dir, ["category"])


@query
def category_brand_summary(spark, sf_dir):
    return _summary(spark, sf_dir, ["category", "brand"])


@query
def inventory_report(spark, sf_dir):
    return catalog.inventory_report(derived.products(spark, sf_dir)).select(
        "product_count",
        to_cents(F.col("total_inventory_value")).alias("total_inventory_cents"),
    )


@query
def paged_listing(spark, sf_dir):
    """Third page of the products by name."""
    return catalog.paged_listing(
        derived.products(spark, sf_dir), "name", "id", page=3, page_rows=50
    ).select("id", "name", "category")


# --- designs -----------------------------------------------------------------


def _type_rows(spark, sf_dir):
    return unwrap_rows(derived.type_payloads(spark, sf_dir))


def _folder_rows(spark, sf_dir):
    return designs.folders(unwrap_rows(derived.folder_payloads(spark, sf_dir)))


@query
def unwrap_payload_rows(spark, sf_dir):
    return _type_rows(spark, sf_dir).select(
        "pos",
        F.col("row_index").cast("long").alias("row_index"),
        designs.first_field("row", designs.TYPE_ID).alias("id"),
        designs.first_field("row", designs.TYPE_NAME).alias("name"),
    )


QUERIES["unwrap_rows"] = QUERIES.pop("unwrap_payload_rows")


@query
def dedup_design_types(spark, sf_dir):
    return designs.dedup_design_types(_type_rows(spark, sf_dir)).select(
        "id", "name", "pos", F.col("row_index").cast("long").alias("row_index")
    )


@query
def distinct_design_names(spark, sf_dir):
    return designs.distinct_design_names(_type_rows(spark, sf_dir)).select(
        "name", "pos", F.col("row_index").cast("long").alias("row_index")
    )


@query
def folder_search(spark, sf_dir):
    return designs.folder_search(_folder_rows(spark, sf_dir), "  gROUP ").select(
        "folder_id", "folder_name"
    )


@query
def folder_mappings(spark, sf_dir):
    details = unwrap_rows(derived.mapping_payloads(spark, sf_dir))
    return designs.folder_mappings(_folder_rows(spark, sf_dir), details).select(
        "folder_id", "folder_name", "design_name", "abbreviation", "multiple_instance", "include"
    )


@query
def type_designs(spark, sf_dir):
    """Regions, nations and suppliers as types, designs and versions."""
    types = derived.table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("type_id"), F.col("r_name").alias("type_name")
    )
    design = derived.table(spark, sf_dir, "nation").select(
        F.col("n_regionkey").alias("type_id"),
        F.col("n_nationkey").alias("design_id"),
        F.col("n_name").alias("design_name"),
    )
    states = F.array(*[F.lit(s) for s in ("Active", "DRAFT", "deprecated", "Retired")])
    version = derived.table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("design_id"),
        F.col("s_name").alias("version"),
        F.element_at(states, (F.col("s_suppkey") % 4 + 1).cast("int")).alias("status"),
    )
    return designs.type_designs(types, design, version).select(
        "type_name", "design_name", "version", "status_group"
    )


@query
def grid_projection(spark, sf_dir):
    return designs.grid_projection(designs.rename_grid(derived.grid_rows(spark, sf_dir)))


@query
def grid_filter(spark, sf_dir):
    grid = designs.rename_grid(derived.grid_rows(spark, sf_dir))
    terms = {
        "formName": "URG",
        "documentDesignName": "_1",
        "status": "",
        "addedBy": "clerk",
        "compiledDate": "t23",
        "compiledStatus": "  COMPLETE",
    }
    return designs.grid_filter(grid, terms).select(
        "formID", "formName", "documentDesignName", "compiledStatus"
    )


@query
def select_by_keys(spark, sf_dir):
    """Listing rows of the orders that some returned line item names."""
    grid = designs.rename_grid(derived.grid_rows(spark, sf_dir))
    chosen = (
        derived.table(spark, sf_dir, "lineitem")
        .where(F.col("l_returnflag") == "R")
        .select(F.col("l_orderkey").alias("formID"))
    )
    return designs.select_by_keys(grid, chosen).select("formID", "displayText")


# --- availability ------------------------------------------------------------


@query
def sweep_grid(spark, sf_dir):
    return av.sweep_grid(derived.places(spark, sf_dir)).select(
        "pincode", "retailer", "product", "code"
    )


@query
def classify_availability(spark, sf_dir):
    return av.classify_availability(derived.responses(spark, sf_dir))


@query
def sweep_totals(spark, sf_dir):
    return av.sweep_totals(av.classify_availability(derived.responses(spark, sf_dir)))


def _run(spark, sf_dir, number):
    responses = derived.responses(spark, sf_dir).where(F.col("run_id") == number)
    return av.classify_availability(responses)


@query
def new_hits(spark, sf_dir):
    """The last run's hits that the run before did not leave in the alert state."""
    state = av.next_state(_run(spark, sf_dir, derived.RUNS - 1))
    return av.new_hits(_run(spark, sf_dir, derived.RUNS), state).select(
        "alert_key", "retailer", "product", "pincode"
    )


@query
def alert_state(spark, sf_dir):
    return av.next_state(_run(spark, sf_dir, derived.RUNS))


@query
def restock_transitions(spark, sf_dir):
    results = av.classify_availability(derived.responses(spark, sf_dir))
    return av.restock_transitions(results).select("run_id", "retailer", "product", "pincode")
