"""Conformed tables: typed change logs reduced to one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.constants import EMITTED_AT
from tidemart.functions.scalar import (
    installment_level,
    installment_value,
    not_blank,
)
from tidemart.operators.fuzzy import best_city_match
from tidemart.operators.latest import latest_per_key
from tidemart.operators.skew import hot_keys, salted_join
from tidemart.operators.small import reduced_to_keys

# Key columns of the conformed tables.
ORDER_KEY = ["order_id"]
ORDER_ITEM_KEY = ["order_id", "order_item_id"]
PAYMENT_KEY = ["order_id", "payment_sequential"]
REVIEW_KEY = ["review_id"]
PRODUCT_KEY = ["product_id"]


def orders_silver(
    orders: DataFrame, customers: DataFrame, increment: bool = False
) -> DataFrame:
    """Latest state of each order with the person behind its customer id.

    Both logs are reduced before they are joined, so several versions of a
    customer neither multiply orders nor pick a random one. ``increment`` says
    that ``orders`` is a part of its log: if that part names few customers, the
    others are dropped before their log is shuffled.
    """
    if increment:
        customers = reduced_to_keys(customers, orders, ["customer_id"])
    people = latest_per_key(
        customers.select("customer_id", "customer_unique_id", EMITTED_AT),
        ["customer_id"],
        EMITTED_AT,
    ).drop(EMITTED_AT)
    latest = latest_per_key(orders, ORDER_KEY, EMITTED_AT)
    hot = hot_keys(orders, ["customer_id"])
    joined = salted_join(latest, people, ["customer_id"], "left", hot=hot)
    return joined.select(
        "order_id",
        "customer_id",
        "customer_unique_id",
        *[c for c in orders.columns if c not in ("order_id", "customer_id", EMITTED_AT)],
        EMITTED_AT,
    )


def order_items_silver(items: DataFrame) -> DataFrame:
    return latest_per_key(items, ORDER_ITEM_KEY, EMITTED_AT)


def order_payments_silver(payments: DataFrame) -> DataFrame:
    """Latest payments with the installment band and the value per installment."""
    latest = latest_per_key(payments, PAYMENT_KEY, EMITTED_AT)
    return latest.select(
        *[c for c in payments.columns if c != EMITTED_AT],
        installment_level("payment_installments").alias("level_of_installment"),
        installment_value("payment_value", "payment_installments").alias(
            "installment_monthly_value"
        ),
        EMITTED_AT,
    )


def order_reviews_silver(
    reviews: DataFrame, keys: Sequence[str] = tuple(REVIEW_KEY)
) -> DataFrame:
    """Latest reviews, one per ``review_id``.

    The source key is (review_id, order_id): pass both as ``keys`` to keep a
    review that was given for several orders.
    """
    return latest_per_key(reviews, list(keys), EMITTED_AT)


# Misspelt source columns and their conformed names.
PRODUCT_RENAMES = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}


def product_silver(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Latest products with the English category where there is one."""
    latest = latest_per_key(products, PRODUCT_KEY, EMITTED_AT)
    latest = latest.withColumnsRenamed(PRODUCT_RENAMES)
    names = latest.columns
    # No forced broadcast: Spark sends the list to the executors if its measured
    # size allows, and splits a dominant category otherwise.
    english = translation.select(
        F.col("product_category_name").alias("__category"),
        F.col("product_category_name_english").alias("__english"),
    )
    joined = latest.join(
        english, latest["product_category_name"] == english["__category"], "left"
    )
    category = F.coalesce("__english", "product_category_name")
    return joined.withColumn("product_category_name", category).select(*names)


def geolocation_points(
    geolocation: DataFrame, cities: DataFrame, threshold: float = 80.0
) -> DataFrame:
    """One row per (zip prefix, latitude, longitude) with its official city.

    Names are matched once per distinct (city, state); the best match of a
    coordinate is the best one among the names it was recorded with.
    """
    rows = geolocation.filter(not_blank("geolocation_zip_code_prefix")).select(
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        F.lower("geolocation_city").alias("city"),
        F.upper("geolocation_state").alias("state"),
    )
    matches = best_city_match(rows.select("city", "state"), cities, threshold)
    # A large city holds a large share of the rows.
    matched = salted_join(rows, matches, ["city", "state"])
    return latest_per_key(
        matched.drop("city", "state"),
        ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"],
        F.col("match_score").desc(),
        [
            F.col("standardized_city").asc(),
            F.col("standardized_state_code").asc(),
            F.col("full_state_name").asc(),
        ],
    )


GEO_GROUP = [
    "geolocation_zip_code_prefix",
    "standardized_city",
    "standardized_state_code",
    "full_state_name",
]


def geolocation_silver(points: DataFrame) -> DataFrame:
    """Centroid and number of coordinates of each zip prefix and city.

    One row per place, however many coordinates it has: these stay the rows of
    ``points``, since an array of them would have no bound.
    """
    return points.groupBy(*GEO_GROUP).agg(
        F.avg("geolocation_lat").alias("centroid_lat"),
        F.avg("geolocation_lng").alias("centroid_lng"),
        F.count(F.lit(1)).alias("n_coordinates"),
    )


# Versioned tables: key and the columns whose change opens a new version. The
# seller's city is not among them, its key is.
CUSTOMER_SNAPSHOT = (
    "customer_id",
    ["customer_city", "customer_state", "customer_zip_code_prefix"],
)
SELLER_SNAPSHOT = ("seller_id", ["seller_id", "seller_state", "seller_zip_code_prefix"])


def snapshot_batch(log: DataFrame, key: str) -> DataFrame:
    """One row per key for a snapshot run."""
    return latest_per_key(log, [key], EMITTED_AT)
