"""One run of the warehouse: change logs to conformed tables to star schema.

Tables live at ``{root}/{layer}/{table}``. A run reads only records newer than
what each table holds, upserts them, and reports the declared checks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.constants import EMITTED_AT
from tidemart.operators.report import quality_report
from tidemart.operators.skew import hot_keys
from tidemart.operators.small import fits_broadcast
from tidemart.operators.upsert import newer_than
from tidemart.plans import gold, silver
from tidemart.plans.checks import GOLD_CHECKS, SILVER_CHECKS
from tidemart.sources.envelope import read_bronze, read_cities
from tidemart.sources.tables import FullTable, KeyedTable, SnapshotTable


@dataclass(frozen=True)
class Warehouse:
    """Where the change logs are, and where the tables go."""

    spark: SparkSession
    bronze: str
    root: str
    city_list: str
    # Files of a run that holds a whole table; by default as many as Spark finds right.
    buckets: int | None = None
    # Upsert keys that can be chosen: a sales fact by ``order_id`` alone refuses
    # orders with several lines; (review_id, order_id) keeps every review.
    sales_key: Sequence[str] = tuple(gold.SALES_KEY)
    review_key: Sequence[str] = tuple(silver.REVIEW_KEY)

    def _path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def keyed(self, layer: str, table: str, keys: Sequence[str]) -> KeyedTable:
        return KeyedTable(self.spark, self._path(layer, table), keys, self.buckets)

    def full(self, layer: str, table: str) -> FullTable:
        return FullTable(self.spark, self._path(layer, table))

    def snapshot(self, table: str, key: str, check: Sequence[str]) -> SnapshotTable:
        path = self._path("SILVER", table)
        # Runs come in the order of their times.
        return SnapshotTable(self.spark, path, key, check, self.buckets, any_order=False)

    def log(self, table: str, since: datetime | None = None) -> DataFrame:
        return read_bronze(self.spark, self.bronze, table, since)


def _increment(
    table: KeyedTable, batch: Callable[[datetime | None], DataFrame]
) -> DataFrame:
    """Upsert what is newer than the table; a missing or empty one takes all."""
    rows = batch(table.watermark(EMITTED_AT))
    table.upsert(rows, unique=True)
    return _current(table, rows)


def _current(table: KeyedTable, batch: DataFrame) -> DataFrame:
    """Rows of the table; none, with the right columns, before its first row."""
    rows = table.read()
    return batch.limit(0) if rows is None else rows


def build_silver(w: Warehouse, run_time: datetime) -> dict[str, DataFrame]:
    """Conformed tables and snapshots; returns their current rows."""
    t: dict[str, DataFrame] = {}
    t["orders_silver"] = _increment(
        w.keyed("SILVER", "orders_silver", silver.ORDER_KEY),
        lambda m: silver.orders_silver(
            w.log("orders", m), w.log("customers"), increment=m is not None
        ),
    )
    t["orders_items_silver"] = _increment(
        w.keyed("SILVER", "orders_items_silver", silver.ORDER_ITEM_KEY),
        lambda m: silver.order_items_silver(w.log("order_items", m)),
    )
    t["order_payments_silver"] = _increment(
        w.keyed("SILVER", "order_payments_silver", silver.PAYMENT_KEY),
        lambda m: silver.order_payments_silver(w.log("order_payments", m)),
    )
    t["order_reviews_silver"] = _increment(
        w.keyed("SILVER", "order_reviews_silver", w.review_key),
        lambda m: silver.order_reviews_silver(
            w.log("order_reviews", m), w.review_key
        ),
    )
    products = w.keyed("SILVER", "product_silver", silver.PRODUCT_KEY)
    translation = w.log("product_category_name_translation").drop(EMITTED_AT)
    # A category listed twice would give a product twice.
    rows = silver.product_silver(
        w.log("products", products.watermark(EMITTED_AT)), translation
    )
    products.upsert(rows)
    t["product_silver"] = _current(products, rows)

    # Matched once and read twice.
    points = w.full("SILVER", "geolocation_points")
    points.replace(
        silver.geolocation_points(
            w.log("geolocation"), read_cities(w.spark, w.city_list)
        )
    )
    geolocation = w.full("SILVER", "geolocation_silver")
    geolocation.replace(silver.geolocation_silver(points.read()))
    t["geolocation_silver"] = geolocation.read()

    for name, log, (key, check) in [
        ("customers_snapshot", "customers", silver.CUSTOMER_SNAPSHOT),
        ("sellers_snapshot", "sellers", silver.SELLER_SNAPSHOT),
    ]:
        history = w.snapshot(name, key, check)
        history.apply(silver.snapshot_batch(w.log(log), key), run_time)
        t[name] = history.read()
    return t


def build_gold(w: Warehouse, t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Facts and dimensions from the conformed tables; their current rows."""
    g: dict[str, DataFrame] = {}
    orders = t["orders_silver"]

    for name, model, source, keys in [
        ("fact_sales", gold.fact_sales, "orders_items_silver", w.sales_key),
        (
            "fact_payment",
            gold.fact_payment,
            "order_payments_silver",
            gold.PAYMENT_FACT_KEY,
        ),
        ("fact_reviews", gold.fact_reviews, "order_reviews_silver", w.review_key),
        (
            "dim_feedback_profile",
            gold.dim_feedback_profile,
            "order_reviews_silver",
            gold.FEEDBACK_KEY,
        ),
    ]:
        table = w.keyed("GOLD", name, keys)
        new = newer_than(t[source], EMITTED_AT, table.watermark(EMITTED_AT))
        if fits_broadcast(new):
            rows = model(F.broadcast(new), orders)
        else:
            rows = model(new, orders, hot_keys(new, gold.ORDER))
        whole_key = name != "fact_sales" or set(keys) == set(gold.SALES_KEY)
        table.upsert(rows, unique=whole_key)
        g[name] = _current(table, rows)

    for name, model, source, snapshot, keys in [
        ("dim_customer", gold.dim_customer, "customers_snapshot", silver.CUSTOMER_SNAPSHOT, gold.CUSTOMER_DIM_KEY),
        ("dim_seller", gold.dim_seller, "sellers_snapshot", silver.SELLER_SNAPSHOT, gold.SELLER_DIM_KEY),
    ]:
        table = w.keyed("GOLD", name, keys)
        # Runs come in the order of their times, so no version is ever taken back.
        version, rows, _ = w.snapshot(source, *snapshot).changes(table.property("history"))
        rows = model(t[source].limit(0) if rows is None else rows)
        table.upsert(rows, unique=True, properties={"history": version})
        g[name] = _current(table, rows)

    for name, rows in [
        ("dim_product", gold.dim_product(t["product_silver"])),
        ("dim_geolocation", gold.dim_geolocation(t["geolocation_silver"])),
        ("dim_date", gold.dim_date(w.spark)),
        (
            "dim_order_attribute",
            gold.dim_order_attribute(t["order_payments_silver"], orders),
        ),
    ]:
        table = w.full("GOLD", name)
        table.replace(rows)
        g[name] = table.read()
    return g


class ChecksFailed(Exception):
    """Checks of the conformed tables failed, so the star schema was not built."""


def run_once(w: Warehouse, run_time: datetime, stop: bool = True) -> DataFrame:
    """Build both layers and return the report of all checks.

    The conformed tables are checked before anything is built from them. A failed
    check raises ``ChecksFailed`` there; with ``stop=False`` it is only reported.
    """
    conformed = build_silver(w, run_time)
    checked = quality_report(conformed, SILVER_CHECKS)
    # One row per declared check.
    rows = checked.collect()
    failed = [f"{r.check_name}: {r.failures}" for r in rows if not r.passed]
    if failed and stop:
        raise ChecksFailed(", ".join(failed))
    star = build_gold(w, conformed)
    report = w.spark.createDataFrame(rows, checked.schema)
    report = report.withColumn("layer", F.lit("SILVER")).unionByName(
        quality_report({**conformed, **star}, GOLD_CHECKS).withColumn(
            "layer", F.lit("GOLD")
        )
    )
    return report.select("layer", "check_name", "failures", "status", "passed")
