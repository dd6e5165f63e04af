"""Test tables, and how they stand in for the change logs of the models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.constants import EMITTED_AT

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries by name with their SQL."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None, name: str | None = None):
        def register(query: Query) -> Query:
            key = name or query.__name__
            self.queries[key] = query
            if sql is not None:
                self.sql[key] = sql
            return query

        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- change logs from the test tables, in both languages --------------------


# Keys have several records, told apart by their age in days: what a record of age 1
# says was corrected a day later.


def aged(df: DataFrame, twice: Column) -> DataFrame:
    """Each row with ``age`` 0, and with ``age`` 1 where ``twice`` holds."""
    ages = F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("age", F.explode(ages))


AGES = "(VALUES (0), (1)) ages(age)"


def orders_log(spark: SparkSession, d: str) -> DataFrame:
    """Orders that are no longer open were open a day earlier."""
    o = aged(table(spark, d, "orders"), F.col("o_orderstatus") != "O")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("age") == 1, "O").otherwise(F.col("o_orderstatus")).alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.expr("o_orderdate - make_dt_interval(age)").alias(EMITTED_AT),
    )


ORDERS_LOG = f"""
SELECT o_orderkey AS order_id,
       o_custkey AS customer_id,
       CASE WHEN age = 1 THEN 'O' ELSE o_orderstatus END AS order_status,
       o_orderdate AS order_purchase_timestamp,
       o_orderdate - to_days(age) AS {EMITTED_AT}
FROM orders JOIN {AGES} ON age = 0 OR o_orderstatus <> 'O'"""


def customers_log(spark: SparkSession, d: str) -> DataFrame:
    """Every customer was known by the segment a day earlier."""
    c = aged(table(spark, d, "customer"), F.lit(True))
    name = F.when(F.col("age") == 1, F.col("c_mktsegment")).otherwise(F.col("c_name"))
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        name.alias("customer_unique_id"),
        F.expr("TIMESTAMP_NTZ '1995-01-01' - make_dt_interval(age)").alias(EMITTED_AT),
    )


CUSTOMERS_LOG = f"""
SELECT c_custkey AS customer_id,
       CASE WHEN age = 1 THEN c_mktsegment ELSE c_name END AS customer_unique_id,
       TIMESTAMP '1995-01-01' - to_days(age) AS {EMITTED_AT}
FROM customer CROSS JOIN {AGES}"""


def items_log(spark: SparkSession, d: str) -> DataFrame:
    line = table(spark, d, "lineitem")
    return line.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("bigint").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_tax").alias("freight_value"),
        F.col("l_shipdate").alias(EMITTED_AT),
    )


ITEMS_LOG = f"""
SELECT l_orderkey AS order_id,
       CAST(l_linenumber AS BIGINT) AS order_item_id,
       l_partkey AS product_id,
       l_suppkey AS seller_id,
       l_shipdate AS shipping_limit_date,
       l_extendedprice AS price,
       l_tax AS freight_value,
       l_shipdate AS {EMITTED_AT}
FROM lineitem"""


def latest_sql(log: str, keys: str, ties: str, order: str = EMITTED_AT) -> str:
    """Latest row per key of a log given as SQL."""
    return f"""
SELECT * FROM ({log}) AS log
QUALIFY row_number() OVER (
  PARTITION BY {keys} ORDER BY {order} DESC NULLS FIRST, {ties}) = 1"""


def descending(*names: str) -> str:
    return ", ".join(f"{n} DESC NULLS LAST" for n in names)


ITEMS_LATEST = latest_sql(
    ITEMS_LOG,
    "order_id, order_item_id",
    descending("product_id", "seller_id", "shipping_limit_date", "price", "freight_value"),
)

ORDERS_LATEST = f"""
SELECT o.order_id, o.customer_id, c.customer_unique_id, o.order_status,
       o.order_purchase_timestamp, o.{EMITTED_AT}
FROM ({latest_sql(
    ORDERS_LOG, "order_id",
    descending("customer_id", "order_status", "order_purchase_timestamp"))}) o
LEFT JOIN ({latest_sql(
    CUSTOMERS_LOG, "customer_id", descending("customer_unique_id"))}) c
  ON o.customer_id = c.customer_id"""


def payments_log(spark: SparkSession, d: str) -> DataFrame:
    """Orders that are no longer open were not paid a day earlier."""
    o = aged(table(spark, d, "orders"), F.col("o_orderstatus") != "O")
    early = F.col("age") == 1
    installments = F.when(early, 0).otherwise(F.col("o_orderkey") % 12)
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.lit(1).cast("bigint").alias("payment_sequential"),
        F.when(early, "UNPAID").otherwise(F.col("o_orderpriority")).alias("payment_type"),
        installments.alias("payment_installments"),
        F.col("o_totalprice").alias("payment_value"),
        F.expr("o_orderdate - make_dt_interval(age)").alias(EMITTED_AT),
    )


PAYMENTS_LATEST = latest_sql(
    f"""
SELECT o_orderkey AS order_id,
       CAST(1 AS BIGINT) AS payment_sequential,
       CASE WHEN age = 1 THEN 'UNPAID' ELSE o_orderpriority END AS payment_type,
       CASE WHEN age = 1 THEN 0 ELSE o_orderkey % 12 END AS payment_installments,
       o_totalprice AS payment_value,
       o_orderdate - to_days(age) AS {EMITTED_AT}
FROM orders JOIN {AGES} ON age = 0 OR o_orderstatus <> 'O'""",
    "order_id, payment_sequential",
    descending("payment_type", "payment_installments", "payment_value"),
)


def reviews_log(spark: SparkSession, d: str) -> DataFrame:
    """Several versions of a review: one per event of a user and type."""
    e = table(spark, d, "events")
    return e.select(
        F.concat_ws("-", "user_id", "event_type").alias("review_id"),
        F.col("user_id").alias("order_id"),
        (F.col("event_id") % 5 + 1).alias("review_score"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias(
            "review_comment_title"
        ),
        F.when(F.col("value") > 20, F.col("props")).alias("review_comment_message"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("review_creation_date"),
        F.expr("ts + make_dt_interval(0, event_id % 97)").alias(
            "review_answer_timestamp"
        ),
        F.col("ts").alias(EMITTED_AT),
    )


REVIEWS_LOG = f"""
SELECT concat_ws('-', user_id, event_type) AS review_id,
       user_id AS order_id,
       event_id % 5 + 1 AS review_score,
       CASE WHEN event_type <> 'error' THEN event_type END AS review_comment_title,
       CASE WHEN value > 20 THEN props END AS review_comment_message,
       date_trunc('day', ts)::TIMESTAMP AS review_creation_date,
       ts + to_hours(event_id % 97) AS review_answer_timestamp,
       ts AS {EMITTED_AT}
FROM events"""

REVIEWS_LATEST = latest_sql(
    REVIEWS_LOG,
    "review_id",
    descending(
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    ),
)

KEY_NULL_SQL = "'_dbt_utils_surrogate_key_null_'"


def key_sql(*names: str) -> str:
    """The surrogate key in SQL."""
    parts = [f"coalesce(CAST({n} AS VARCHAR), {KEY_NULL_SQL})" for n in names]
    return "md5(" + " || '-' || ".join(parts) + ")"
