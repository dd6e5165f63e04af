"""Star schema: facts and dimensions from the conformed tables.

Facts join their new rows with all orders, which have one row per key. ``hot``
lists the orders that hold a large share of those rows (see ``hot_keys``); they
are spread over several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.constants import EMITTED_AT, UNKNOWN_DATE_ID, VALID_FROM
from tidemart.functions.calendar import date_id, date_id_text, hours_between_dates
from tidemart.functions.keys import surrogate_key
from tidemart.functions.scalar import is_present
from tidemart.operators.generate import calendar
from tidemart.operators.history import closed_end, dimension_increment, is_current
from tidemart.operators.reshape import distinct_values
from tidemart.operators.skew import salted_join

ORDER = ["order_id"]

# Key columns of the facts and dimensions that are kept by upsert. The sales
# fact has one row per order line.
SALES_KEY = ["order_id", "order_item_id"]
PAYMENT_FACT_KEY = ["order_id", "payment_sequential"]
FEEDBACK_KEY = ["feedback_id"]
CUSTOMER_DIM_KEY = ["customer_key"]
SELLER_DIM_KEY = ["customer_pk"]


def fact_sales(
    items: DataFrame, orders: DataFrame, hot: Sequence[int] = ()
) -> DataFrame:
    orders = orders.select(
        "order_id", "order_status", "customer_unique_id", "order_purchase_timestamp"
    )
    return salted_join(items, orders, ORDER, hot=hot).select(
        "order_id",
        "order_item_id",
        "order_status",
        "customer_unique_id",
        "seller_id",
        "product_id",
        date_id_text("order_purchase_timestamp").alias("purchase_date_id"),
        "price",
        "freight_value",
        EMITTED_AT,
    )


def fact_payment(
    payments: DataFrame, orders: DataFrame, hot: Sequence[int] = ()
) -> DataFrame:
    orders = orders.select(
        "order_id", "order_status", "customer_unique_id", "order_purchase_timestamp"
    )
    return salted_join(payments, orders, ORDER, hot=hot).select(
        "order_id",
        "payment_sequential",
        "customer_unique_id",
        date_id("order_purchase_timestamp", UNKNOWN_DATE_ID).alias("payment_date_id"),
        surrogate_key(["payment_type", "order_status"]).alias("attribute_id"),
        "payment_installments",
        "payment_value",
        EMITTED_AT,
    )


def fact_reviews(
    reviews: DataFrame, orders: DataFrame, hot: Sequence[int] = ()
) -> DataFrame:
    orders = orders.select("order_id", "customer_unique_id")
    return salted_join(reviews, orders, ORDER, hot=hot).select(
        "review_id",
        "order_id",
        "customer_unique_id",
        date_id("review_creation_date").alias("review_creation_date_id"),
        surrogate_key(["review_id", "order_id"]).alias("feedback_id"),
        "review_score",
        hours_between_dates("review_creation_date", "review_answer_timestamp").alias(
            "hours_to_answer"
        ),
        EMITTED_AT,
    )


def dim_feedback_profile(
    reviews: DataFrame, orders: DataFrame, hot: Sequence[int] = ()
) -> DataFrame:
    orders = orders.select("order_id")
    return salted_join(reviews, orders, ORDER, hot=hot).select(
        surrogate_key(["review_id", "order_id"]).alias("feedback_id"),
        "review_comment_title",
        "review_comment_message",
        is_present("review_comment_title", "review_comment_message").alias(
            "has_comment"
        ),
        EMITTED_AT,
    )


def dim_order_attribute(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Every payment type with every order status.

    The product is the result asked for; both sides are reduced to their
    distinct values first, a handful each.
    """
    types = distinct_values(payments, "payment_type")
    statuses = distinct_values(orders, "order_status")
    return types.crossJoin(statuses).select(
        surrogate_key(["payment_type", "order_status"]).alias("attribute_id"),
        "payment_type",
        "order_status",
    )


def dim_customer(history: DataFrame, mark=None) -> DataFrame:
    """Customer versions; with a mark only those opened or closed after it."""
    return dimension_increment(history, mark).select(
        surrogate_key(["customer_id", version_text()]).alias("customer_key"),
        "customer_unique_id",
        "customer_id",
        "customer_zip_code_prefix",
        VALID_FROM,
        closed_end(),
        is_current(),
    )


def dim_seller(history: DataFrame, mark=None) -> DataFrame:
    """Seller versions; with a mark only those opened or closed after it."""
    return dimension_increment(history, mark).select(
        surrogate_key(["seller_id", version_text()]).alias("customer_pk"),
        "seller_id",
        "seller_zip_code_prefix",
        VALID_FROM,
        closed_end(),
    )


def version_text():
    """Start of a version as text, always with milliseconds."""
    return F.date_format(VALID_FROM, "yyyy-MM-dd HH:mm:ss.SSS")


def dim_product(products: DataFrame) -> DataFrame:
    return products


def dim_geolocation(geolocation: DataFrame) -> DataFrame:
    return geolocation


def dim_date(spark: SparkSession) -> DataFrame:
    return calendar(spark)
