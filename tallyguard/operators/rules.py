"""The four fraud rules. Each is a function from transactions to alerts.

Rules read transactions as they arrive, before any de-duplication or account
lookup. Alerts carry the arrival and event time of the record that raised them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.functions.geo import city_table, haversine_km, round_half_up
from tallyguard.functions.money import from_cents, mean_half_up, to_cents
from tallyguard.operators.ordered import FIND, find_hot, running
from tallyguard.params import RuleParams, ScaleParams

ALERT_COLUMNS = [
    "account_id",
    "transaction_id",
    "rule_type",
    "reason",
    "count",
    "trigger_arrival",
    "alert_ts",
]


def _alert(
    df: DataFrame,
    rule: str | Column,
    reason: Column,
    count: Column | None = None,
    transaction_id: Column | None = None,
) -> DataFrame:
    return df.select(
        "account_id",
        (F.col("transaction_id") if transaction_id is None else transaction_id).alias(
            "transaction_id"
        ),
        (F.lit(rule) if isinstance(rule, str) else rule).alias("rule_type"),
        reason.alias("reason"),
        (F.lit(1) if count is None else count).cast("long").alias("count"),
        F.col("arrival").alias("trigger_arrival"),
        F.col("event_ts").alias("alert_ts"),
    )


# --- HIGH_VELOCITY -----------------------------------------------------------


def with_window_start(txns: DataFrame, params: RuleParams) -> DataFrame:
    """Add the start (epoch ms) of the tumbling window of the broker time."""
    size = params.window_seconds * 1000
    millis = F.unix_millis("record_ts")
    return txns.withColumn("window_start_ms", millis - F.pmod(millis, F.lit(size)))


def with_stream_time(
    txns: DataFrame, params: RuleParams, scale: ScaleParams | None = None
) -> DataFrame:
    """Add the window, the partition's stream time, and whether the record is too late.

    Stream time is the highest broker time of the partition so far, the record
    itself included. A record is late once its window's end plus the grace
    period is not after that time.
    """
    scale = scale or ScaleParams()
    keyed = with_window_start(txns.where(F.col("account_id").isNotNull()), params)
    timed = running(
        keyed,
        ["partition"],
        "arrival",
        maxima={"stream_ms": F.unix_millis("record_ts")},
        include_current=True,
        hot=find_hot(keyed, ["partition"], scale),
        scale=scale,
    )
    closes = F.col("window_start_ms") + (params.window_seconds + params.grace_seconds) * 1000
    return timed.withColumn("is_late", closes <= F.col("stream_ms"))


def late_records(
    txns: DataFrame, params: RuleParams, scale: ScaleParams | None = None
) -> DataFrame:
    """Records the velocity rule drops because their window has closed."""
    return with_stream_time(txns, params, scale).where("is_late")


def on_time_records(
    txns: DataFrame, params: RuleParams, scale: ScaleParams | None = None
) -> DataFrame:
    return with_stream_time(txns, params, scale).where("NOT is_late").drop("stream_ms", "is_late")


def velocity_counts(txns: DataFrame, params: RuleParams) -> DataFrame:
    """Transactions per account and tumbling window, late records included."""
    width = f"{params.window_seconds} seconds"
    return (
        txns.where(F.col("account_id").isNotNull())
        .groupBy("account_id", F.window("record_ts", width).alias("window"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select("account_id", "window", "count")
    )


def high_velocity_final(txns: DataFrame, params: RuleParams) -> DataFrame:
    """One row per window that ends above the threshold, with its final count."""
    return velocity_counts(txns, params).where(F.col("count") > params.count_threshold)


def high_velocity(
    txns: DataFrame,
    params: RuleParams,
    scale: ScaleParams | None = None,
    with_grace: bool = True,
) -> DataFrame:
    """An alert for every record that lifts its window above the threshold."""
    scale = scale or ScaleParams()
    keys = ["account_id", "window_start_ms"]
    windowed = with_window_start(txns.where(F.col("account_id").isNotNull()), params)
    counted = running(
        on_time_records(txns, params, scale) if with_grace else windowed,
        keys,
        "arrival",
        sums={"n": F.lit(1)},
        include_current=True,
        hot=find_hot(windowed, keys, scale),
        scale=scale,
    ).where(F.col("n") > params.count_threshold)
    # Fixed value: the wording of this alert.
    reason = F.concat(
        F.lit("Too many transactions: "),
        F.col("n").cast("string"),
        F.lit(f" in {params.window_seconds}s"),
    )
    return _alert(
        counted, "HIGH_VELOCITY", reason, F.col("n"), transaction_id=F.lit(None).cast("string")
    )


# --- LARGE_AMOUNT ------------------------------------------------------------


def _is_large(params: RuleParams) -> Column:
    return F.col("amount") > F.lit(params.large_amount)


def _large_reason(params: RuleParams) -> Column:
    # Fixed value: the wording of this alert.
    return F.concat(
        F.lit("Large transaction: "),
        F.col("amount").cast("string"),
        F.lit(f" exceeds {params.large_amount}"),
    )


def large_amount(txns: DataFrame, params: RuleParams) -> DataFrame:
    """An alert for every single amount above the threshold; also runs on streams."""
    return _alert(txns.where(_is_large(params)), "LARGE_AMOUNT", _large_reason(params))


# --- SPEND_SPIKE -------------------------------------------------------------


def history_sums() -> dict[str, Column]:
    """What the running history adds up; transactions without amount do not count."""
    cents = to_cents(F.col("amount")).cast("decimal(20,0)")
    return {
        "prior_cents": cents,
        "prior_count": F.when(F.col("amount").isNotNull(), 1).otherwise(0).cast("long"),
    }


def _with_mean(history: DataFrame) -> DataFrame:
    mean = mean_half_up(F.col("prior_cents"), F.col("prior_count"))
    return history.withColumn("prior_mean_cents", F.coalesce(mean, F.lit(0).cast("long")))


def _is_spike(params: RuleParams) -> Column:
    # An exact decimal product: a double would misjudge amounts right at the limit.
    multiplier = F.lit(str(params.spike_multiplier)).cast("decimal(18,6)")
    mean = F.col("prior_mean_cents").cast("decimal(20,0)")
    return (F.col("prior_count") >= params.spike_min_history) & (
        F.col("amount") * 100 > mean * multiplier
    )


def _spike_reason(params: RuleParams) -> Column:
    # Fixed value: the wording of this alert.
    return F.concat(
        F.lit("Spike: "),
        F.col("amount").cast("string"),
        F.lit(f" > {params.spike_multiplier}x rolling avg "),
        from_cents(F.col("prior_mean_cents")).cast("string"),
    )


def rolling_stats(
    txns: DataFrame, scale: ScaleParams | None = None, hot: DataFrame | str | None = FIND
) -> DataFrame:
    """Each transaction with the count and mean (cents) of its account's earlier ones."""
    usable = txns.where(F.col("account_id").isNotNull() & F.col("amount").isNotNull())
    history = running(
        usable, ["account_id"], "arrival", sums=history_sums(), hot=hot, scale=scale
    )
    return _with_mean(history)


def spend_spike(
    txns: DataFrame,
    params: RuleParams,
    scale: ScaleParams | None = None,
    hot: DataFrame | str | None = FIND,
) -> DataFrame:
    """An alert when an amount exceeds a multiple of the account's earlier mean.

    The transaction joins the history afterwards, whether it alerted or not.
    """
    spikes = rolling_stats(txns, scale, hot).where(_is_spike(params))
    return _alert(spikes, "SPEND_SPIKE", _spike_reason(params))


# --- GEO_IMPOSSIBLE ----------------------------------------------------------


def last_place() -> dict[str, Column]:
    """The newest place of earlier records; those without city or time are passed over."""
    place = F.struct("city", F.unix_millis("event_ts").alias("ms"))
    return {"previous": F.when(F.col("city").isNotNull() & F.col("event_ts").isNotNull(), place)}


def _with_trip(located: DataFrame) -> DataFrame:
    """Add distance and speed from the previous place; null if a city is unknown.

    The 19 known cities are broadcast.
    """
    cities = city_table(located.sparkSession)
    origin = F.broadcast(cities.toDF("_from", "_from_lat", "_from_lon"))
    target = F.broadcast(cities.toDF("_to", "_to_lat", "_to_lon"))
    elapsed = F.greatest(F.unix_millis("event_ts") - F.col("previous.ms"), F.lit(1))
    distance = haversine_km(
        F.col("_from_lat"), F.col("_from_lon"), F.col("_to_lat"), F.col("_to_lon")
    )
    return (
        located.join(origin, F.lower("previous.city") == F.col("_from"), "left")
        .join(target, F.lower("city") == F.col("_to"), "left")
        .withColumn("km", F.when(F.col("_from") != F.col("_to"), distance))
        .withColumn("kmh", F.col("km") / (elapsed / F.lit(3_600_000.0)))
        .drop("_from", "_from_lat", "_from_lon", "_to", "_to_lat", "_to_lon")
    )


def _travel_reason() -> Column:
    # Fixed value: the wording of this alert.
    return F.concat(
        F.lit("Impossible travel: "),
        F.col("previous.city"),
        F.lit(" -> "),
        F.col("city"),
        F.lit(" ("),
        round_half_up(F.col("km")).cast("string"),
        F.lit(" km) would require "),
        round_half_up(F.col("kmh")).cast("string"),
        F.lit(" km/h"),
    )


def geo_impossible(
    txns: DataFrame,
    params: RuleParams,
    scale: ScaleParams | None = None,
    hot: DataFrame | str | None = FIND,
) -> DataFrame:
    """An alert when two transactions in a row need travel faster than the limit.

    Records without city or time are passed over. An unknown city raises
    nothing but is remembered, so it breaks the chain.
    """
    located = txns.where(
        F.col("account_id").isNotNull()
        & F.col("city").isNotNull()
        & F.col("event_ts").isNotNull()
    )
    chained = running(
        located, ["account_id"], "arrival", last=last_place(), hot=hot, scale=scale
    )
    moved = chained.where(F.lower("previous.city") != F.lower("city"))
    fast = _with_trip(moved).where(F.col("kmh") > params.geo_max_kmh)
    return _alert(fast, "GEO_IMPOSSIBLE", _travel_reason())


# --- all rules ---------------------------------------------------------------


def account_alerts(
    txns: DataFrame,
    params: RuleParams,
    scale: ScaleParams | None = None,
    hot: DataFrame | str | None = FIND,
) -> DataFrame:
    """The amount, spike and travel rules in one pass: one shuffle and sort for all three."""
    keyed = txns.where(F.col("account_id").isNotNull())
    history = running(
        keyed,
        ["account_id"],
        "arrival",
        sums=history_sums(),
        last=last_place(),
        hot=hot,
        scale=scale,
    )
    return judged_by_history(history, params)


def judged_by_history(history: DataFrame, params: RuleParams) -> DataFrame:
    """Alerts of the three rules for records with ``prior_cents``, ``prior_count`` and ``previous``."""
    raised = [
        ("LARGE_AMOUNT", _is_large(params), _large_reason(params)),
        ("SPEND_SPIKE", _is_spike(params), _spike_reason(params)),
        ("GEO_IMPOSSIBLE", F.col("kmh") > params.geo_max_kmh, _travel_reason()),
    ]
    found = F.array_compact(
        F.array(
            *[
                F.when(fires, F.struct(F.lit(rule).alias("rule"), reason.alias("reason")))
                for rule, fires, reason in raised
            ]
        )
    )
    # The outer form keeps the optimizer from judging each record again in a size filter.
    judged = _with_trip(_with_mean(history)).select(
        "account_id", "transaction_id", "arrival", "event_ts", F.explode_outer(found).alias("alert")
    ).where(F.col("alert").isNotNull())
    return _alert(judged, F.col("alert.rule"), F.col("alert.reason"))


def all_alerts(
    txns: DataFrame,
    params: RuleParams,
    scale: ScaleParams | None = None,
    hot: DataFrame | str | None = FIND,
) -> DataFrame:
    """Every alert of every rule; one transaction may raise several.

    Only the amount rule looks at records without an account.
    """
    return (
        high_velocity(txns, params, scale)
        .unionByName(account_alerts(txns, params, scale, hot))
        .unionByName(large_amount(txns.where(F.col("account_id").isNull()), params))
    )


def dedup_alerts(alerts: DataFrame, params: RuleParams) -> DataFrame:
    """The first alert per account, rule and tumbling window of the alert's time."""
    size = params.window_seconds * 1000
    millis = F.unix_millis("alert_ts")
    first = F.min_by(F.struct(*alerts.columns), F.col("trigger_arrival"))
    return (
        alerts.withColumn("window_start_ms", millis - F.pmod(millis, F.lit(size)))
        .groupBy("account_id", "rule_type", "window_start_ms")
        .agg(first.alias("first"), F.count(F.lit(1)).alias("n_alerts"))
        .select("first.*", "window_start_ms", "n_alerts")
    )


# --- other window shapes -----------------------------------------------------


def velocity_hopping(txns: DataFrame, params: RuleParams, slide_seconds: int) -> DataFrame:
    """Counts per overlapping window, above the threshold."""
    window = F.window("record_ts", f"{params.window_seconds} seconds", f"{slide_seconds} seconds")
    return (
        txns.where(F.col("account_id").isNotNull())
        .groupBy("account_id", window.alias("window"))
        .agg(F.count(F.lit(1)).alias("count"))
        .where(F.col("count") > params.count_threshold)
    )


def velocity_sliding(
    txns: DataFrame, params: RuleParams, scale: ScaleParams | None = None
) -> DataFrame:
    """Records that see more than the threshold in the window that ends with them.

    Each record counts from its own time until it leaves the window, so the
    count at any moment is a running sum of arrivals and departures. Those are
    added up per account and millisecond first; no window of rows is ever held.
    """
    size = params.window_seconds * 1000
    timed = txns.where(F.col("account_id").isNotNull()).withColumn(
        "_ms", F.unix_millis("record_ts")
    )
    steps = F.inline(
        F.array(
            F.struct(F.col("_ms").alias("moment"), F.lit(1).cast("long").alias("step")),
            F.struct((F.col("_ms") + size).alias("moment"), F.lit(-1).cast("long").alias("step")),
        )
    )
    changes = (
        timed.select("account_id", steps)
        .groupBy("account_id", "moment")
        .agg(F.sum("step").alias("step"))
    )
    crowded = running(
        changes,
        ["account_id"],
        "moment",
        sums={"count": F.col("step")},
        include_current=True,
        scale=scale,
    ).where(F.col("count") > params.count_threshold)
    moments = crowded.select("account_id", F.col("moment").alias("_ms"), "count")
    return timed.join(moments, ["account_id", "_ms"]).drop("_ms")


def velocity_session(txns: DataFrame, params: RuleParams, gap_seconds: int) -> DataFrame:
    """Sessions of an account, parted by more than ``gap_seconds`` without a record, above the threshold.

    Records in one cell of a grid as wide as the gap are in one session, so they are added
    up to one row per account and cell before the shuffle. Only these rows are put in
    order: an account has at most as many as the time span has gaps, however many records
    it has.
    """
    gap = gap_seconds * 1000
    place = F.col("_ms") - F.pmod(F.col("_ms"), F.lit(gap))
    pieces = (
        txns.where(F.col("account_id").isNotNull() & F.col("record_ts").isNotNull())
        .withColumn("_ms", F.unix_millis("record_ts"))
        .groupBy("account_id", place.alias("place"))
        .agg(
            F.min("_ms").alias("first_ms"),
            F.max("_ms").alias("last_ms"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    in_order = Window.partitionBy("account_id").orderBy("place")
    parted = F.col("first_ms") - F.lag("last_ms").over(in_order) > gap
    number = F.count_if(F.coalesce(parted, F.lit(True))).over(in_order)
    return (
        pieces.withColumn("session", number)
        .groupBy("account_id", "session")
        .agg(
            F.min("first_ms").alias("start_ms"),
            F.max("last_ms").alias("end_ms"),
            F.sum("n").alias("count"),
        )
        .where(F.col("count") > params.count_threshold)
        .drop("session")
    )
