"""The given tables, read as transactions, accounts, products and payloads.

Everything is a projection or join of the given tables, so the work grows with
them. ``oracles.py`` states the same derivations in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.functions.geo import CITIES
from tallyguard.schemas import MONEY

FILES_PER_BATCH = 200
UNKNOWN_CITIES = ["gotham", "atlantis", "el dorado"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table; times without zone are read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _millisecond_ts(value: Column) -> Column:
    return F.date_trunc("MILLISECOND", value.cast("timestamp"))


_NAMES = ", ".join(f"'{name}'" for name in [city for city, _, _ in CITIES] + UNKNOWN_CITIES)
EVENT_CITY = f"""
CASE WHEN event_id % 7 = 0
     THEN upper(try_element_at(array({_NAMES}), int((event_id * 5 + user_id) % 23) + 1))
     ELSE try_element_at(array({_NAMES}), int((event_id * 5 + user_id) % 23) + 1) END
"""
EVENT_TYPE = """
CASE WHEN event_type IN ('signup', 'view') THEN 'DEPOSIT'
     WHEN event_type = 'error' THEN 'TRANSFER' ELSE 'WITHDRAW' END
"""


def event_transactions(events: DataFrame) -> DataFrame:
    """Events as transactions: event id is the arrival, every tenth is two hours late."""
    late = "CASE WHEN event_id % 10 = 3 THEN ts - INTERVAL 2 HOURS ELSE ts END"
    return events.selectExpr(
        "string(event_id) AS transaction_id",
        "string(user_id) AS account_id",
        f"{EVENT_TYPE} AS type",
        "CAST(value AS DECIMAL(18,2)) AS amount",
        f"{EVENT_CITY} AS city",
        "date_trunc('MILLISECOND', timestamp(ts)) AS event_ts",
        f"date_trunc('MILLISECOND', timestamp({late})) AS record_ts",
        "event_id * 2 AS arrival",
        "int(user_id % 3) AS partition",
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_transactions(table(spark, sf_dir, "events"))


def transaction_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same transactions as a stream over the file or files of the events table.

    A file source takes a single file only by pattern, hence the brackets. The limit bounds
    a batch where the table has many files, and with it the rows of one account in a task.
    """
    schema = table(spark, sf_dir, "events").schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_BATCH)
    return event_transactions(reader.parquet(f"{sf_dir}/event[s].parquet"))


def with_replays(txns: DataFrame) -> DataFrame:
    """Every fiftieth transaction arrives again 500 events later, under the same id."""
    again = txns.where(F.col("transaction_id").cast("long") % 50 == 0)
    return txns.unionByName(again.withColumn("arrival", F.col("arrival") + 1001))


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a second set of transactions, without cities."""
    ts = _millisecond_ts(F.col("o_orderdate"))
    kind = F.when(F.col("o_orderstatus") == "F", "DEPOSIT").otherwise("WITHDRAW")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("account_id"),
        kind.alias("type"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        F.lit(None).cast("string").alias("city"),
        ts.alias("event_ts"),
        ts.alias("record_ts"),
        F.col("o_orderkey").alias("arrival"),
        (F.col("o_custkey") % 3).cast("int").alias("partition"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as accounts: some frozen from the start, some missing."""
    return (
        table(spark, sf_dir, "customer")
        .where(F.col("c_custkey") % 17 != 0)
        .select(
            F.col("c_custkey").cast("string").alias("account_id"),
            F.col("c_name").alias("holder_name"),
            F.col("c_acctbal").cast(MONEY).alias("balance"),
            F.when(F.col("c_custkey") % 29 == 0, "FROZEN").otherwise("ACTIVE").alias("status"),
            F.lit("2024-01-01 00:00:00").cast("timestamp").alias("updated_at"),
        )
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions that an earlier run applied already."""
    return (
        transactions(spark, sf_dir)
        .where(F.col("transaction_id").cast("long") % 97 == 5)
        .select(
            "transaction_id",
            "account_id",
            "type",
            "amount",
            F.col("event_ts").alias("processed_at"),
        )
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as incoming requests, some of them faulty in one or more ways."""
    event_id = F.col("event_id")
    account = (
        F.when(event_id % 11 == 0, F.lit(None).cast("string"))
        .when(event_id % 11 == 1, F.lit("  "))
        .otherwise(F.col("user_id").cast("string"))
    )
    kind = (
        F.when(event_id % 13 == 0, F.lit(None).cast("string"))
        .when(event_id % 13 == 1, F.lit("REFUND"))
        .when(F.col("event_type").isin("signup", "view"), "DEPOSIT")
        .when(F.col("event_type") == "error", "TRANSFER")
        .otherwise("WITHDRAW")
    )
    value = F.col("value").cast(MONEY)
    amount = (
        F.when(event_id % 5 == 0, F.lit(None).cast(MONEY))
        .when(event_id % 5 == 1, -value)
        .when(event_id % 35 == 2, F.lit("0.01").cast(MONEY))
        .otherwise(value)
    )
    return table(spark, sf_dir, "events").select(
        event_id.cast("string").alias("transaction_id"),
        account.alias("account_id"),
        kind.alias("type"),
        amount.alias("amount"),
        F.expr(EVENT_CITY).alias("city"),
        _millisecond_ts(F.col("ts")).alias("received_at"),
    )


# --- products ----------------------------------------------------------------


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as products: the part type is the category, the size is the stock."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast(MONEY).alias("price"),
        F.col("p_size").alias("stock"),
    )


# --- JSON payloads -----------------------------------------------------------
# Plain SQL text that means the same in Spark and in the oracle's engine.

TYPE_PAYLOAD = """
CASE WHEN p_partkey % 41 = 0 THEN '{broken'
     WHEN p_partkey % 37 = 0 THEN '{"other":1}'
     WHEN p_partkey % 2 = 0 THEN '[' || {first} || ',' || {second} || ']'
     ELSE '{"total":2,"rows":[' || {first} || ',' || {second} || ']}' END
"""
TYPE_FIRST = """
(CASE p_partkey % 5
   WHEN 0 THEN '{"DocumentDesignTypeID":' || CAST(p_partkey % 700 AS VARCHAR(20))
               || ',"DocumentDesignName":"' || p_name || '"}'
   WHEN 1 THEN '{"documentDesignTypeId":"' || CAST(p_partkey % 700 AS VARCHAR(20))
               || '","displayText":"' || p_name || ' ' || p_type || '"}'
   WHEN 2 THEN '{"Id":' || CAST(p_partkey % 700 AS VARCHAR(20))
               || ',"Name":"","name":"' || p_name || '"}'
   WHEN 3 THEN '{"DocumentDesignTypeId":' || CAST(p_partkey % 700 AS VARCHAR(20))
               || ',"DocumentDesignType":" ' || p_brand || ' "}'
   ELSE '{"name":"' || p_name || '"}' END)
"""
TYPE_SECOND = """
(CASE p_partkey % 3
   WHEN 0 THEN '{"id":' || CAST(p_size AS VARCHAR(20)) || ',"DisplayText":"' || p_type || '"}'
   WHEN 1 THEN '{"id":' || CAST(p_size AS VARCHAR(20)) || ',"name":"   "}'
   ELSE '{"FormDesignName":"' || p_brand || '","id":null}' END)
"""
FOLDER_PAYLOAD = """
CASE WHEN s_suppkey % 2 = 0 THEN '[' || {row} || ']' ELSE '{"rows":[' || {row} || ']}' END
"""
FOLDER_ROW = """
(CASE s_suppkey % 4
   WHEN 0 THEN '{"FormGroupId":' || CAST(s_suppkey AS VARCHAR(20))
               || ',"FormDesignGroupName":"' || s_name || '"}'
   WHEN 1 THEN '{"FormGroupID":' || CAST(s_suppkey AS VARCHAR(20))
               || ',"formDesignGroupName":"' || s_name || '"}'
   WHEN 2 THEN '{"id":' || CAST(s_suppkey AS VARCHAR(20))
               || ',"FormGroupName":"Group ' || s_name || '"}'
   ELSE '{"id":' || CAST(s_suppkey AS VARCHAR(20)) || '}' END)
"""
MAPPING_PAYLOAD = """
CASE WHEN l_linenumber % 2 = 0 THEN '[' || {row} || ']' ELSE '{"rows":[' || {row} || ']}' END
"""
MAPPING_ROW = """
(CASE l_partkey % 3
   WHEN 0 THEN '{"FormDesignName":"Part ' || CAST(l_partkey AS VARCHAR(20))
               || '","Abbreviation":"' || l_returnflag || '","AllowMultipleInstance":true}'
   WHEN 1 THEN '{"DocumentDesignName":"Part ' || CAST(l_partkey AS VARCHAR(20))
               || '","abbreviation":"' || l_linestatus
               || '","AllowMultipleInstance":false,"MultipleInstance":true,"Include":true}'
   ELSE '{"isMultipleInstance":true,"IsIncluded":null,"include":true}' END)
"""


def fill(template: str, **parts: str) -> str:
    for name, text in parts.items():
        template = template.replace("{" + name + "}", text.strip())
    return template


TYPE_PAYLOAD_SQL = fill(TYPE_PAYLOAD, first=TYPE_FIRST, second=TYPE_SECOND)
FOLDER_PAYLOAD_SQL = fill(FOLDER_PAYLOAD, row=FOLDER_ROW)
MAPPING_PAYLOAD_SQL = fill(MAPPING_PAYLOAD, row=MAPPING_ROW)


def type_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload per part with up to two design types in varying spellings."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("pos"), F.expr(TYPE_PAYLOAD_SQL).alias("payload")
    )


def folder_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("pos"), F.expr(FOLDER_PAYLOAD_SQL).alias("payload")
    )


def mapping_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One mapping payload per line item, belonging to the folder of its supplier."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("folder_id"),
        F.expr(MAPPING_PAYLOAD_SQL).alias("payload"),
    )


GRID_SQL = {
    "FormID": "o_orderkey",
    "FormName": "CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE 'Form ' || o_orderpriority END",
    "DisplayText": "'Order ' || CAST(o_orderkey AS VARCHAR(20))",
    "DocumentDesignName": "'Design_' || CAST(o_custkey % 100 AS VARCHAR(20)) || '%'",
    "FormDesignVersionID": "o_orderkey * 10",
    "VersionNumber": "'v' || CAST(o_custkey % 4 AS VARCHAR(20)) || '.0'",
    "Status": "CASE o_orderstatus WHEN 'F' THEN 'Finalized' WHEN 'O' THEN 'Draft' END",
    "StatusID": "o_custkey % 3",
    "CompiledStatus": (
        "CASE o_orderkey % 6 WHEN 0 THEN 'Complete' WHEN 1 THEN ' Complete ' WHEN 2 THEN 'Queued' "
        "WHEN 3 THEN 'Errored' WHEN 4 THEN 'Finalized' END"
    ),
    "EffectiveDate": (
        "CASE WHEN o_orderkey % 7 <> 0 THEN "
        "substring(CAST(o_orderdate AS VARCHAR(40)), 1, 10) || 'T08:30:00' END"
    ),
    "CompiledDate": (
        "CASE WHEN o_orderkey % 4 = 0 THEN "
        "substring(CAST(o_orderdate AS VARCHAR(40)), 1, 10) || 'T23:05:09' "
        "WHEN o_orderkey % 4 = 1 THEN '' END"
    ),
    "ErrorMessage": "CASE WHEN o_orderkey % 6 = 3 THEN 'compile failed' END",
    "AddedBy": "'Clerk' || CAST(o_custkey % 10 AS VARCHAR(20))",
}


def grid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as listing rows in the spelling they arrive under."""
    return table(spark, sf_dir, "orders").select(
        *[F.expr(text).alias(name) for name, text in GRID_SQL.items()]
    )


# --- availability ------------------------------------------------------------

RUNS = 6
RESPONSE_SLOT = "(s_suppkey * 7 + ordinal * 5 + run_id * 11 + s_suppkey * run_id) % 17"
RESPONSE_BODY = """
CASE slot
  WHEN 0 THEN '{"message":"Not Serviceable","pinCodeDetails":[1]}'
  WHEN 1 THEN '{"status":"OUT OF STOCK"}'
  WHEN 2 THEN '{"pinCodeDetails":{"city":"X"}}'
  WHEN 3 THEN '{"pinCodeDetails":[],"promiseDetails":{}}'
  WHEN 4 THEN '{"promiseDetails":"0"}'
  WHEN 5 THEN '{"promiseDetails":false,"pinCodeDetails":0}'
  WHEN 6 THEN '{"item":{"eddMessage":"soon"}}'
  WHEN 7 THEN '{"pinCodeDetails":null}'
  WHEN 8 THEN 'oops {'
  WHEN 9 THEN '{"data":{"Serviceable":true}}'
  WHEN 10 THEN '{"data":{"serviceable" : true}}'
  WHEN 11 THEN '{"data":{"isServiceable":true}}'
  WHEN 12 THEN '{"serviceable":"true"}'
  WHEN 13 THEN '{"serviceable":false}'
  WHEN 14 THEN '{"pinCodeDetails":1,"serviceable":true}'
  WHEN 15 THEN NULL
  ELSE '{"promiseDetails":{"x":1},"serviceable":true}' END
"""


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six sweeps over all suppliers as places, every retailer and product."""
    from tallyguard.operators.availability import PRODUCTS

    pairs = F.array(
        *[
            F.struct(
                F.lit(retailer).alias("retailer"),
                F.lit(product).alias("product"),
                F.lit(number).alias("ordinal"),
            )
            for number, (retailer, product, _) in enumerate(PRODUCTS)
        ]
    )
    grid = (
        table(spark, sf_dir, "supplier")
        .select("s_suppkey", F.inline(pairs))
        .select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(RUNS))).alias("run_id"))
        .withColumn("slot", F.expr(RESPONSE_SLOT))
    )
    return grid.select(
        "run_id",
        "retailer",
        "product",
        (F.col("s_suppkey") + 411001).cast("string").alias("pincode"),
        F.when(F.col("slot") == 7, 503).when(F.col("slot") != 15, 200).alias("http_status"),
        F.expr(RESPONSE_BODY).alias("body"),
        F.when(F.col("slot") == 15, "ConnectTimeout").alias("error"),
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' places as the postcodes of a sweep."""
    return table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 411001).cast("string").alias("pincode")
    )
