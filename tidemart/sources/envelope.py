"""Change-record envelopes: typed columns out of the nested payload."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemart.constants import EMITTED_AT, PAYLOAD, RECORD_ID
from tidemart.functions.calendar import clock_time

# Payload columns and types of each change log.
_TEXT, _NUMBER, _FLOAT, _TIME = "string", "bigint", "double", "timestamp_ntz"
BRONZE_TABLES: dict[str, dict[str, str]] = {
    "orders": {
        "order_id": _TEXT,
        "customer_id": _TEXT,
        "order_status": _TEXT,
        "order_purchase_timestamp": _TIME,
        "order_approved_at": _TIME,
        "order_delivered_carrier_date": _TIME,
        "order_delivered_customer_date": _TIME,
        "order_estimated_delivery_date": _TIME,
    },
    "order_items": {
        "order_id": _TEXT,
        "order_item_id": _NUMBER,
        "product_id": _TEXT,
        "seller_id": _TEXT,
        "shipping_limit_date": _TIME,
        "price": _FLOAT,
        "freight_value": _FLOAT,
    },
    "order_payments": {
        "order_id": _TEXT,
        "payment_sequential": _NUMBER,
        "payment_type": _TEXT,
        "payment_installments": _NUMBER,
        "payment_value": _FLOAT,
    },
    "order_reviews": {
        "review_id": _TEXT,
        "order_id": _TEXT,
        "review_score": _NUMBER,
        "review_comment_title": _TEXT,
        "review_comment_message": _TEXT,
        "review_creation_date": _TIME,
        "review_answer_timestamp": _TIME,
    },
    "customers": {
        "customer_id": _TEXT,
        "customer_unique_id": _TEXT,
        "customer_zip_code_prefix": _TEXT,
        "customer_city": _TEXT,
        "customer_state": _TEXT,
    },
    "products": {
        "product_id": _TEXT,
        "product_category_name": _TEXT,
        "product_name_lenght": _NUMBER,
        "product_description_lenght": _NUMBER,
        "product_photos_qty": _NUMBER,
        "product_weight_g": _NUMBER,
        "product_length_cm": _NUMBER,
        "product_height_cm": _NUMBER,
        "product_width_cm": _NUMBER,
    },
    "sellers": {
        "seller_id": _TEXT,
        "seller_zip_code_prefix": _TEXT,
        "seller_city": _TEXT,
        "seller_state": _TEXT,
    },
    "geolocation": {
        "geolocation_zip_code_prefix": _TEXT,
        "geolocation_lat": _FLOAT,
        "geolocation_lng": _FLOAT,
        "geolocation_city": _TEXT,
        "geolocation_state": _TEXT,
    },
    "product_category_name_translation": {
        "product_category_name": _TEXT,
        "product_category_name_english": _TEXT,
    },
}

# Columns and types of the official city list.
CITY_LIST_SCHEMA = "UF string, City string, State string, ID_IBGE int"


# How a payload field of each type is stored: times are text, numbers are not.
STORED_AS = {_TEXT: _TEXT, _NUMBER: _NUMBER, _FLOAT: _FLOAT, _TIME: _TEXT}


def envelope_schema(
    payload: Mapping[str, str], raw: Mapping[str, str] | None = None
) -> StructType:
    """Schema of an envelope file; fields a file lacks are read as NULL.

    ``raw`` names the payload fields that are stored with another type.
    """
    raw = raw or {}
    kind = ", ".join(f"`{c}` {raw.get(c, STORED_AS[t])}" for c, t in payload.items())
    return StructType(
        [
            StructField(RECORD_ID, StringType()),
            StructField(EMITTED_AT, StringType()),
            StructField(PAYLOAD, StructType.fromDDL(kind)),
        ]
    )


def extract(
    records: DataFrame, payload: Mapping[str, str], since: datetime | None = None
) -> DataFrame:
    """Emission time and typed payload columns of envelope records.

    A value that does not fit its type becomes NULL, as does a field that the
    records lack. The emission time is text ``YYYY-MM-DD HH:MM:SS.mmm+00:00``;
    its offset is dropped, the clock time is kept whatever the session time
    zone. With ``since`` only later records are returned; the text is compared
    by its date first, a day early, because that comparison is pushed into the
    Parquet scan and the cast is not.
    """
    emitted = F.col(EMITTED_AT)
    if since is not None and dict(records.dtypes)[EMITTED_AT] == _TEXT:
        day_before = (since - timedelta(days=1)).date().isoformat()
        records = records.filter(emitted >= F.lit(day_before))
    stored = {f.name for f in records.schema[PAYLOAD].dataType.fields}

    def field(name: str) -> Column:
        return F.col(f"{PAYLOAD}.`{name}`") if name in stored else F.lit(None)

    typed = records.select(
        *[field(c).try_cast(t).alias(c) for c, t in payload.items()],
        emitted.try_cast(_TIME).alias(EMITTED_AT),
    )
    return typed if since is None else typed.filter(F.col(EMITTED_AT) > clock_time(since))


def read_bronze(
    spark: SparkSession,
    root: str,
    table: str,
    since: datetime | None = None,
    raw: Mapping[str, str] | None = None,
    infer: bool = False,
) -> DataFrame:
    """One change log below ``root``; the scan reads only the columns in use.

    The stored types are declared; with ``infer`` they are merged from the
    footers of all files instead, which costs a pass over the footers.
    """
    payload, path = BRONZE_TABLES[table], f"{root}/{table}"
    if infer:
        records = spark.read.option("mergeSchema", "true").parquet(path)
    else:
        records = spark.read.schema(envelope_schema(payload, raw)).parquet(path)
    return extract(records, payload, since)


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """The official city list, a typed CSV with a header."""
    return spark.read.schema(CITY_LIST_SCHEMA).csv(path, header=True)
