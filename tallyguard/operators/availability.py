"""Availability sweeps: classify responses, count them, report only new hits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyguard.session import scratch_path

IN_STOCK = "IN STOCK"
OUT_OF_STOCK = "OUT OF STOCK"

# The two retailers, and the products with their codes at each.
DETAIL_RETAILER = "Croma"
SERVICE_RETAILER = "Reliance Digital"
PRODUCTS = [
    ("Croma", "PS5 Slim Disc", "305919"),
    ("Croma", "PS5 Slim Digital", "305920"),
    ("Croma", "PS5 Pro", "312292"),
    ("Reliance Digital", "PS5 Slim Disc", "493177787"),
    ("Reliance Digital", "PS5 Slim Digital", "493177788"),
]

# The city's postcodes, one dense range and the surrounding ones.
PINCODE_RANGE = (411001, 411063)
EXTRA_PINCODES = [
    "410501",
    "410506",
    "410507",
    "412105",
    "412107",
    "412114",
    "412201",
    "412207",
    "412208",
    "412307",
    "412308",
]

# Fixed value: a true "serviceable" field, or the same words inside some text.
SERVICEABLE = (
    r'"serviceable"\s*:\s*true'
    r"|'serviceable': true"
    r'|\\"(is)?serviceable\\": true'
)

KEY = ["retailer", "product", "pincode"]


def pincodes(spark: SparkSession) -> DataFrame:
    """All 73 postcodes of the sweep."""
    dense = spark.range(*PINCODE_RANGE).select(F.col("id").cast("string").alias("pincode"))
    extra = spark.createDataFrame([(code,) for code in EXTRA_PINCODES], "pincode string")
    return dense.unionByName(extra)


def products(spark: SparkSession) -> DataFrame:
    """The five retailer and product pairs."""
    return spark.createDataFrame(PRODUCTS, "retailer string, product string, code string")


def sweep_grid(places: DataFrame, pairs: Sequence[tuple[str, str, str]] = PRODUCTS) -> DataFrame:
    """Every place with every retailer's products.

    The products are a fixed list, so each place simply expands in its own
    task; nothing is joined or shuffled.
    """
    choices = F.array(
        *[
            F.struct(
                F.lit(retailer).alias("retailer"),
                F.lit(product).alias("product"),
                F.lit(code).alias("code"),
            )
            for retailer, product, code in pairs
        ]
    )
    return places.select("*", F.inline(choices))


def _truthy(value: Column) -> Column:
    """A JSON value counts unless it is absent, null, false, zero or empty."""
    text = F.to_json(value)
    falsy = text.isin("null", "false", "0", "0.0", "-0.0", "[]", "{}", '""')
    return F.coalesce(~falsy, F.lit(False))


def classify(retailer: Column, http_status: Column, body: Column, error: Column) -> Column:
    """IN STOCK, OUT OF STOCK or ERROR for one captured response.

    ``error`` names what went wrong when no response came at all.
    """
    text = F.lower(body)
    parsed = F.try_parse_json(body)
    refused = text.contains("not serviceable") | text.contains("out of stock")
    promised = (
        _truthy(F.try_variant_get(parsed, "$.pinCodeDetails", "variant"))
        | _truthy(F.try_variant_get(parsed, "$.promiseDetails", "variant"))
        | text.contains("eddmessage")
    )
    serviceable = text.rlike(SERVICEABLE)
    by_detail = F.when(refused, OUT_OF_STOCK).when(promised, IN_STOCK).otherwise(OUT_OF_STOCK)
    by_service = F.when(serviceable, IN_STOCK).otherwise(OUT_OF_STOCK)
    return (
        F.when(error.isNotNull(), F.concat(F.lit("ERROR: "), error))
        .when(http_status != 200, F.concat(F.lit("ERROR: HTTP "), http_status.cast("string")))
        .when(parsed.isNull(), "ERROR: bad JSON")
        .when(retailer == DETAIL_RETAILER, by_detail)
        .otherwise(by_service)
    )


def classify_availability(responses: DataFrame) -> DataFrame:
    """Responses with their status, ready for the report."""
    status = classify(*[F.col(name) for name in ("retailer", "http_status", "body", "error")])
    return responses.select("run_id", *KEY, status.alias("status"))


def hits(results: DataFrame) -> DataFrame:
    return results.where(F.col("status") == IN_STOCK)


def sweep_totals(results: DataFrame) -> DataFrame:
    """Checks, hits and errors per run."""
    return results.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if(F.col("status") == IN_STOCK).alias("n_hits"),
        F.count_if(F.startswith("status", F.lit("ERROR"))).alias("n_errors"),
    )


def alert_key() -> Column:
    """The state's text form of a hit."""
    return F.concat_ws("|", *KEY)


def new_hits(current: DataFrame, alerted: DataFrame) -> DataFrame:
    """Hits of this run whose key is not in the alert state yet."""
    keyed = hits(current).withColumn("alert_key", alert_key())
    return keyed.join(alerted.select("alert_key"), "alert_key", "left_anti")


def next_state(current: DataFrame) -> DataFrame:
    """The keys to remember: exactly this run's hits, so that a restock alerts again."""
    return hits(current).select(alert_key().alias("alert_key")).distinct()


def restock_transitions(results: DataFrame) -> DataFrame:
    """For a history of runs: hits that the run before did not have.

    One pass over the results gives the distinct hits and a mark for each run. A hit is
    new if the last hit of its key was not in the run before.
    """
    key = F.struct(*KEY)
    marks = F.array(F.when(F.col("status") == IN_STOCK, key), F.lit(None))
    seen = results.select("run_id", F.explode(marks).alias("hit")).distinct()
    # Written, so that the results are read and classified once for both uses.
    path = scratch_path(results.sparkSession, "sweep-hits")
    seen.write.parquet(path)
    seen = results.sparkSession.read.schema(seen.schema).parquet(path)
    # One row a run, whatever the runs found.
    numbers = seen.select("run_id").distinct().withColumn(
        "number", F.dense_rank().over(Window.orderBy("run_id"))
    )
    of_key = Window.partitionBy("hit").orderBy("number")
    return (
        seen.where(F.col("hit").isNotNull())
        .join(numbers, "run_id")
        .withColumn("since", F.col("number") - F.lag("number").over(of_key))
        .where(F.coalesce(F.col("since") > 1, F.lit(True)))
        .select("run_id", "hit.*")
    )
