"""Large amounts, spending spikes and impossible travel on a stream.

``write_account_alerts`` judges a batch as a whole, by running values, and carries one small
row per account in a table. ``account_alerts`` is the same as one stateful operator, which
asks its state once per account of a batch and walks the records in Python: for small
batches only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType

from tallyguard.functions.geo import CITIES, EARTH_RADIUS_KM
from tallyguard.functions.money import to_cents
from tallyguard.operators.ordered import running
from tallyguard.operators.rules import history_sums, judged_by_history, large_amount, last_place
from tallyguard.params import RuleParams, ScaleParams
from tallyguard.schemas import ALERT
from tallyguard.streaming.tables import BatchTables, TableSpec

ALERT_OUTPUT = (
    "account_id string, transaction_id string, rule_type string, reason string, "
    "count long, trigger_arrival long, event_ms long"
)


def money_text(cents: int) -> str:
    return f"{'-' if cents < 0 else ''}{abs(cents) // 100}.{abs(cents) % 100:02d}"


def half_up_mean(total: int, count: int) -> int:
    magnitude = (2 * abs(total) + count) // (2 * count)
    return -magnitude if total < 0 else magnitude


def distance_km(origin: tuple[float, float], target: tuple[float, float]) -> float:
    half_lat = math.sin(math.radians(target[0] - origin[0]) / 2)
    half_lon = math.sin(math.radians(target[1] - origin[1]) / 2)
    chord = half_lat * half_lat + (
        math.cos(math.radians(origin[0])) * math.cos(math.radians(target[0])) * half_lon * half_lon
    )
    return math.asin(math.sqrt(chord)) * (2 * EARTH_RADIUS_KM)


class AccountRules(StatefulProcessor):
    """Per account: total and count of amounts, and the last place and time."""

    def __init__(self, params: RuleParams):
        self.params = params
        # Compared in millionths of a cent, which keeps the multiplier exact.
        self.multiplier = round(params.spike_multiplier * 1_000_000)
        self.large_cents = params.large_amount * 100
        self.places = {city: (lat, lon) for city, lat, lon in CITIES}

    def init(self, handle) -> None:
        stats = StructType(
            [StructField("total_cents", LongType()), StructField("n", LongType())]
        )
        place = StructType([StructField("city", StringType()), StructField("ms", LongType())])
        self.stats = handle.getValueState("stats", stats)
        self.place = handle.getValueState("place", place)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        stats = self.stats.get()
        total, n = stats if stats is not None else (0, 0)
        place = self.place.get()
        for row in sorted(rows, key=lambda r: r.arrival):
            if row.cents is not None:
                if row.cents > self.large_cents:
                    yield self._alert(row, "LARGE_AMOUNT", self._large_reason(row))
                if n >= self.params.spike_min_history:
                    mean = half_up_mean(total, n)
                    if row.cents * 1_000_000 > mean * self.multiplier:
                        yield self._alert(row, "SPEND_SPIKE", self._spike_reason(row, mean))
                total, n = total + row.cents, n + 1
            if row.city is not None and row.event_ms is not None:
                reason = self._travel_reason(place, row) if place is not None else None
                if reason is not None:
                    yield self._alert(row, "GEO_IMPOSSIBLE", reason)
                place = (row.city, row.event_ms)
        if n:
            self.stats.update((total, n))
        if place is not None:
            self.place.update(tuple(place))

    def _alert(self, row: Row, rule: str, reason: str) -> Row:
        return Row(
            account_id=row.account_id,
            transaction_id=row.transaction_id,
            rule_type=rule,
            reason=reason,
            count=1,
            trigger_arrival=row.arrival,
            event_ms=row.event_ms,
        )

    def _large_reason(self, row: Row) -> str:
        return f"Large transaction: {money_text(row.cents)} exceeds {self.params.large_amount}"

    def _spike_reason(self, row: Row, mean: int) -> str:
        times = self.params.spike_multiplier
        return f"Spike: {money_text(row.cents)} > {times}x rolling avg {money_text(mean)}"

    def _travel_reason(self, place, row: Row) -> str | None:
        """Why the trip from the remembered place is impossible, or None if it is not."""
        city, since = place
        if city.lower() == row.city.lower():
            return None
        origin, target = self.places.get(city.lower()), self.places.get(row.city.lower())
        if origin is None or target is None:
            return None
        km = distance_km(origin, target)
        kmh = km / (max(row.event_ms - since, 1) / 3_600_000.0)
        if kmh <= self.params.geo_max_kmh:
            return None
        return (
            f"Impossible travel: {city} -> {row.city} ({math.floor(km + 0.5)} km) "
            f"would require {math.floor(kmh + 0.5)} km/h"
        )


def account_alerts(txns: DataFrame, params: RuleParams) -> DataFrame:
    """Alerts of the three per-account rules, for a streaming DataFrame."""
    slim = txns.where(F.col("account_id").isNotNull()).select(
        "account_id",
        "transaction_id",
        to_cents(F.col("amount")).alias("cents"),
        "city",
        F.unix_millis("event_ts").alias("event_ms"),
        "arrival",
    )
    raised = slim.groupBy("account_id").transformWithState(
        AccountRules(params), ALERT_OUTPUT, "Append", "None"
    )
    return raised.select(
        "account_id",
        "transaction_id",
        "rule_type",
        "reason",
        "count",
        "trigger_arrival",
        F.timestamp_millis("event_ms").alias("alert_ts"),
    )


# --- whole batches -----------------------------------------------------------

_TOTAL = DecimalType(30, 0)
_PLACE = StructType([StructField("city", StringType()), StructField("ms", LongType())])
_HISTORY = StructType(
    [
        StructField("account_id", StringType()),
        StructField("total_cents", _TOTAL),
        StructField("n", LongType()),
        StructField("place", _PLACE),
    ]
)
ACCOUNT_RULES = {"alerts": TableSpec(ALERT), "history": TableSpec(_HISTORY, whole=True)}
#: Before every arrival: the row that carries an account's history into a batch.
_CARRIED = -(1 << 62)


def account_rule_tables(spark: SparkSession, base: str) -> BatchTables:
    return BatchTables(spark, base, ACCOUNT_RULES)


def write_account_alerts(
    tables: BatchTables,
    params: RuleParams,
    scale: ScaleParams | None = None,
    also: Callable[[DataFrame], DataFrame] | None = None,
):
    """A foreachBatch function for transactions: alerts of the three rules, and those of ``also``.

    What an account did in earlier batches is a row of its own that comes before its records, so
    running values go on from there, in chunks where an account is hot. Records without an
    account are judged by the amount rule alone, as in the batch.
    """
    cents, count = history_sums().values()
    place = last_place()["previous"]

    def write(batch: DataFrame, batch_id: int) -> None:
        before = tables.read("history", batch_id)
        records = batch.where(F.col("account_id").isNotNull()).select(
            "account_id",
            "transaction_id",
            "amount",
            "city",
            "event_ts",
            "arrival",
            cents.cast(_TOTAL).alias("total_cents"),
            count.alias("n"),
            place.cast(_PLACE).alias("place"),
        )
        carried = before.select(*_HISTORY.fieldNames(), F.lit(_CARRIED).alias("arrival"))
        rows = records.unionByName(carried, allowMissingColumns=True)
        sums = {"prior_cents": F.col("total_cents"), "prior_count": F.col("n")}
        history = running(
            rows, ["account_id"], "arrival", sums=sums, last={"previous": F.col("place")}, scale=scale
        ).withColumn("prior_cents", F.col("prior_cents").cast(_TOTAL))
        found = judged_by_history(history.where(F.col("arrival") > _CARRIED), params).unionByName(
            large_amount(batch.where(F.col("account_id").isNull()), params)
        )
        if also is not None:
            found = found.unionByName(also(batch))
        tables.put("alerts", batch_id, found.withColumn("alert_ts", F.date_trunc("MILLISECOND", "alert_ts")))
        after = rows.groupBy("account_id").agg(
            F.sum("total_cents").cast(_TOTAL).alias("total_cents"),
            F.sum("n").alias("n"),
            F.max_by("place", F.when(F.col("place").isNotNull(), F.col("arrival"))).alias("place"),
        )
        tables.write(batch_id, {"history": after})

    return write
