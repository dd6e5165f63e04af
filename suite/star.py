"""Conformed tables, facts and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite import common as c
from suite.common import Registry, table
from tidemart.constants import EMITTED_AT, VALID_FROM, VALID_TO
from tidemart.functions import calendar_columns, date_id
from tidemart.operators.history import apply_snapshot, open_versions
from tidemart.operators.latest import latest_per_key
from tidemart.operators.skew import hot_keys
from tidemart.operators.upsert import newer_than, upsert
from tidemart.plans import gold, silver
from tidemart.sources.tables import FullTable, KeyedTable, SnapshotTable
from tidemart.sources.workspace import new_folder

star = Registry()


def orders_silver(spark: SparkSession, d: str) -> DataFrame:
    return silver.orders_silver(c.orders_log(spark, d), c.customers_log(spark, d))


@star.add(
    f"""
SELECT o.order_id, i.order_item_id, o.order_status, o.customer_unique_id, i.seller_id,
       i.product_id, strftime(o.order_purchase_timestamp, '%Y%m%d') AS purchase_date_id,
       i.price, i.freight_value, i.{EMITTED_AT}
FROM ({c.ITEMS_LATEST}) i JOIN ({c.ORDERS_LATEST}) o ON o.order_id = i.order_id"""
)
def fact_sales(spark, d):
    items = silver.order_items_silver(c.items_log(spark, d))
    hot = hot_keys(c.items_log(spark, d), gold.ORDER)
    return gold.fact_sales(items, orders_silver(spark, d), hot)


@star.add(c.ORDERS_LATEST)
def orders_conformed(spark, d):
    return orders_silver(spark, d)


@star.add(c.ITEMS_LATEST)
def order_items_conformed(spark, d):
    return silver.order_items_silver(c.items_log(spark, d))


PAYMENTS = f"""
SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value,
       CASE WHEN payment_installments = 1 THEN 'LOW'
            WHEN payment_installments < 4 THEN 'MEDIUM' ELSE 'HIGH' END
         AS level_of_installment,
       CASE WHEN payment_installments > 0 THEN payment_value / payment_installments
            ELSE payment_value END AS installment_monthly_value,
       {EMITTED_AT}
FROM ({c.PAYMENTS_LATEST}) p"""


@star.add(
    f"""SELECT * REPLACE (round(installment_monthly_value, 6) AS
        installment_monthly_value) FROM ({PAYMENTS}) q"""
)
def payments_conformed(spark, d):
    rows = silver.order_payments_silver(c.payments_log(spark, d))
    return rows.withColumn(
        "installment_monthly_value", F.round("installment_monthly_value", 6)
    )


@star.add(c.REVIEWS_LATEST)
def reviews_conformed(spark, d):
    return silver.order_reviews_silver(c.reviews_log(spark, d))


@star.add(
    f"""
SELECT p.order_id, p.payment_sequential, o.customer_unique_id,
       CAST(strftime(o.order_purchase_timestamp, '%Y%m%d') AS INT) AS payment_date_id,
       {c.key_sql('payment_type', 'order_status')} AS attribute_id,
       p.payment_installments, p.payment_value, p.{EMITTED_AT}
FROM ({PAYMENTS}) p JOIN ({c.ORDERS_LATEST}) o ON p.order_id = o.order_id"""
)
def fact_payment(spark, d):
    payments = silver.order_payments_silver(c.payments_log(spark, d))
    hot = hot_keys(c.payments_log(spark, d), gold.ORDER)
    return gold.fact_payment(payments, orders_silver(spark, d), hot)


@star.add(
    f"""
SELECT r.review_id, r.order_id, o.customer_unique_id,
       CAST(strftime(r.review_creation_date, '%Y%m%d') AS INT) AS review_creation_date_id,
       {c.key_sql('r.review_id', 'r.order_id')} AS feedback_id,
       r.review_score,
       CAST(date_diff('hour', CAST(r.review_creation_date AS DATE),
                      CAST(r.review_answer_timestamp AS DATE)) AS INT)
         AS hours_to_answer,
       r.{EMITTED_AT}
FROM ({c.REVIEWS_LATEST}) r JOIN ({c.ORDERS_LATEST}) o ON r.order_id = o.order_id"""
)
def fact_reviews(spark, d):
    reviews = silver.order_reviews_silver(c.reviews_log(spark, d))
    hot = hot_keys(c.reviews_log(spark, d), gold.ORDER)
    return gold.fact_reviews(reviews, orders_silver(spark, d), hot)


@star.add(
    f"""
SELECT {c.key_sql('r.review_id', 'r.order_id')} AS feedback_id,
       review_comment_title, review_comment_message,
       review_comment_title IS NOT NULL OR review_comment_message IS NOT NULL
         AS has_comment,
       r.{EMITTED_AT}
FROM ({c.REVIEWS_LATEST}) r JOIN ({c.ORDERS_LATEST}) o ON r.order_id = o.order_id"""
)
def feedback_profile(spark, d):
    reviews = silver.order_reviews_silver(c.reviews_log(spark, d))
    hot = hot_keys(c.reviews_log(spark, d), gold.ORDER)
    return gold.dim_feedback_profile(reviews, orders_silver(spark, d), hot)


@star.add(
    f"""
SELECT {c.key_sql('payment_type', 'order_status')} AS attribute_id,
       payment_type, order_status
FROM (SELECT DISTINCT o_orderpriority AS payment_type FROM orders
      WHERE o_orderpriority IS NOT NULL) p
CROSS JOIN (SELECT DISTINCT o_orderstatus AS order_status FROM orders
            WHERE o_orderstatus IS NOT NULL) s"""
)
def order_attribute_dim(spark, d):
    payments = silver.order_payments_silver(c.payments_log(spark, d))
    orders = latest_per_key(c.orders_log(spark, d), silver.ORDER_KEY, EMITTED_AT)
    return gold.dim_order_attribute(payments, orders)


# Translation of a few categories; the others keep their name.
TRANSLATION = [("ECONOMY", "budget"), ("PROMO", "promotion"), ("SMALL", "compact")]


def products_log(spark, d):
    """Every product was listed without a name, under its brand, a day earlier."""
    p = c.aged(table(spark, d, "part"), F.lit(True))
    early = F.col("age") == 1
    category = F.when(early, F.col("p_brand")).otherwise(F.col("p_type"))
    length = F.when(early, 0).otherwise(F.length("p_name"))
    return p.select(
        F.col("p_partkey").alias("product_id"),
        category.alias("product_category_name"),
        length.cast("bigint").alias("product_name_lenght"),
        F.col("p_size").cast("bigint").alias("product_description_lenght"),
        F.col("p_retailprice").alias("product_weight_g"),
        F.expr("TIMESTAMP_NTZ '2024-01-01' - make_dt_interval(age)").alias(EMITTED_AT),
    )


@star.add(
    f"""
SELECT p_partkey AS product_id,
       coalesce(t.english, p_type) AS product_category_name,
       CAST(length(p_name) AS BIGINT) AS product_name_length,
       CAST(p_size AS BIGINT) AS product_description_length,
       p_retailprice AS product_weight_g,
       TIMESTAMP '2024-01-01' AS {EMITTED_AT}
FROM part LEFT JOIN (VALUES ('ECONOMY', 'budget'), ('PROMO', 'promotion'),
                            ('SMALL', 'compact')) t(name, english) ON p_type = t.name"""
)
def product_dim(spark, d):
    translation = spark.createDataFrame(
        TRANSLATION,
        "product_category_name string, product_category_name_english string",
    )
    return gold.dim_product(silver.product_silver(products_log(spark, d), translation))


CALENDAR_SQL = """
day AS date_actual, CAST(strftime(day, '%Y%m%d') AS INT) AS date_id,
CAST(year(day) AS INT) AS year_number, 'CY ' || year(day) AS year_code,
CAST(quarter(day) AS INT) AS quarter_number, 'Q' || quarter(day) AS quarter_code,
year(day) || '-Q' || quarter(day) AS year_quarter_code,
CAST(month(day) AS INT) AS month_number, monthname(day) AS month_name,
strftime(day, '%b') AS month_name_short, strftime(day, '%Y-%m') AS year_month_code,
CAST(weekofyear(day) AS INT) AS week_of_year,
CAST(date_trunc('week', day) AS DATE) AS week_start_date,
CAST(day(day) AS INT) AS day_of_month, CAST(dayofweek(day) AS INT) AS day_of_week_number,
dayname(day) AS day_name, strftime(day, '%a') AS day_name_short,
dayofweek(day) IN (0, 6) AS is_weekend"""


@star.add(
    f"""
WITH days AS (SELECT CAST(range AS DATE) AS day
              FROM range(DATE '2015-01-01', DATE '2035-01-01', INTERVAL 1 DAY)),
     n AS (SELECT CAST(strftime(ts, '%Y%m%d') AS INT) AS date_id, count(*) AS n_events
           FROM events GROUP BY 1)
SELECT dim.*, coalesce(n.n_events, 0) AS n_events
FROM (SELECT {CALENDAR_SQL} FROM days) dim LEFT JOIN n ON dim.date_id = n.date_id"""
)
def dim_date_activity(spark, d):
    """The whole date dimension with the number of events of each day."""
    events = table(spark, d, "events").groupBy(date_id("ts").alias("date_id"))
    n = events.agg(F.count(F.lit(1)).alias("n_events"))
    return (
        gold.dim_date(spark).join(n, "date_id", "left").fillna(0, subset=["n_events"])
    )


@star.add(
    f"""
SELECT {CALENDAR_SQL}, n_orders
FROM (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n_orders
      FROM orders GROUP BY 1) o"""
)
def calendar_parts(spark, d):
    """Calendar parts of every order date."""
    days = (
        table(spark, d, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("day"))
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )
    return days.select(*calendar_columns("day"), "n_orders")


# --- version history --------------------------------------------------------

# Run times of the snapshots; a run sees the orders before it that
# no earlier run saw.
RUNS = ["1997-01-01 00:00:00", "1999-01-01 00:00:00", "2002-01-01 00:00:00"]


def history_sql(log: str, key: str, check: list[str], rest: list[str]) -> str:
    """Version history of a log with the columns ``key``, ..., ``seen_at`` in SQL."""
    case = " ".join(
        f"WHEN seen_at < TIMESTAMP '{t}' THEN TIMESTAMP '{t}'" for t in RUNS
    )
    previous = ", ".join(f"lag({x}) OVER w AS old_{x}" for x in check)
    changed = " OR ".join(f"{x} IS DISTINCT FROM old_{x}" for x in check)
    names = ", ".join([key, *check, *rest])
    return f"""
WITH log AS (SELECT *, CASE {case} END AS run FROM ({log}) l),
seen AS (SELECT * FROM log QUALIFY row_number() OVER (
           PARTITION BY {key}, run
           ORDER BY seen_at DESC NULLS FIRST, {descending_all(check + rest)}) = 1),
steps AS (SELECT *, {previous}, lag(run) OVER w AS old_run FROM seen
          WINDOW w AS (PARTITION BY {key} ORDER BY run)),
opened AS (SELECT * FROM steps WHERE old_run IS NULL OR {changed})
SELECT {names}, run AS {VALID_FROM},
       lead(run) OVER (PARTITION BY {key} ORDER BY run) AS {VALID_TO}
FROM opened"""


def descending_all(names: list[str]) -> str:
    return c.descending(*names)


def batches(log: DataFrame, key: str):
    """The log cut at the run times, one row per key in each part."""
    before = None
    for t in RUNS:
        part = F.col("seen_at") < F.lit(t).cast("timestamp_ntz")
        if before is not None:
            part = part & (F.col("seen_at") >= F.lit(before).cast("timestamp_ntz"))
        yield latest_per_key(log.filter(part), [key], "seen_at").drop("seen_at"), t
        before = t


def customer_versions(spark, d):
    """Each order states its customer's region codes anew."""
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("customer_city"),
        F.col("o_orderpriority").alias("customer_state"),
        F.lit("Z").alias("customer_zip_code_prefix"),
        F.col("o_orderkey").alias("customer_unique_id"),
        F.col("o_orderdate").alias("seen_at"),
    )


CUSTOMER_HISTORY = history_sql(
    """SELECT o_custkey AS customer_id, o_orderstatus AS customer_city,
              o_orderpriority AS customer_state, 'Z' AS customer_zip_code_prefix,
              o_orderkey AS customer_unique_id, o_orderdate AS seen_at
       FROM orders""",
    "customer_id",
    ["customer_city", "customer_state", "customer_zip_code_prefix"],
    ["customer_unique_id"],
)


def customer_history(spark, d):
    key, check = silver.CUSTOMER_SNAPSHOT
    history = None
    for batch, t in batches(customer_versions(spark, d), key):
        if history is None:
            history = open_versions(batch, t)
        else:
            history = apply_snapshot(history, batch, key, check, t)
    return history


@star.add(CUSTOMER_HISTORY)
def scd2_customers(spark, d):
    return customer_history(spark, d)


SELLER_HISTORY = history_sql(
    """SELECT l_suppkey AS seller_id, l_returnflag AS seller_state,
              CAST(l_linenumber AS VARCHAR) AS seller_zip_code_prefix,
              l_linestatus AS seller_city, l_shipdate AS seen_at
       FROM lineitem""",
    "seller_id",
    ["seller_state", "seller_zip_code_prefix"],
    ["seller_city"],
)


def seller_table(spark, d) -> SnapshotTable:
    """Seller history kept in a table, one run per batch."""
    log = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_returnflag").alias("seller_state"),
        F.col("l_linenumber").cast("string").alias("seller_zip_code_prefix"),
        F.col("l_linestatus").alias("seller_city"),
        F.col("l_shipdate").alias("seen_at"),
    )
    key, check = silver.SELLER_SNAPSHOT
    history = SnapshotTable(spark, new_folder(spark, "sellers"), key, check, any_order=False)
    for batch, t in batches(log, key):
        history.apply(batch, t)
    return history


@star.add(SELLER_HISTORY)
def scd2_sellers(spark, d):
    return seller_table(spark, d).read()


VERSION_TEXT = f"strftime({VALID_FROM}, '%Y-%m-%d %H:%M:%S') || '.000'"
CUSTOMER_DIM = f"""
SELECT {c.key_sql('customer_id', VERSION_TEXT)} AS customer_key, customer_unique_id,
       customer_id, customer_zip_code_prefix, {VALID_FROM},
       coalesce({VALID_TO}, TIMESTAMP '9999-12-31') AS {VALID_TO},
       {VALID_TO} IS NULL AS is_current
FROM ({CUSTOMER_HISTORY}) h"""


@star.add(CUSTOMER_DIM)
def dim_customer(spark, d):
    return gold.dim_customer(customer_history(spark, d))


@star.add(
    f"""{CUSTOMER_DIM}
WHERE {VALID_FROM} > TIMESTAMP '{RUNS[1]}' OR h.{VALID_TO} > TIMESTAMP '{RUNS[1]}'"""
)
def dim_customer_increment(spark, d):
    """What a rerun takes when the dimension holds the first two runs."""
    return gold.dim_customer(customer_history(spark, d), RUNS[1])


@star.add(
    f"""
SELECT {c.key_sql('seller_id', VERSION_TEXT)} AS customer_pk, seller_id,
       seller_zip_code_prefix, {VALID_FROM},
       coalesce({VALID_TO}, TIMESTAMP '9999-12-31') AS {VALID_TO}
FROM ({SELLER_HISTORY}) h"""
)
def dim_seller(spark, d):
    return gold.dim_seller(seller_table(spark, d).read())


# --- incremental tables -----------------------------------------------------

# Fixed value: the first load stops here.
FIRST_LOAD_END = "1998-06-01"


def _two_loads(log: DataFrame):
    end = F.lit(FIRST_LOAD_END).cast("timestamp_ntz")
    return log.filter(F.col(EMITTED_AT) <= end), log.filter(F.col(EMITTED_AT) > end)


@star.add(
    f"""
SELECT * FROM ({c.ITEMS_LATEST}) i"""
)
def upsert_composite(spark, d):
    """Two loads of order lines into a table with a composite key."""
    items = KeyedTable(spark, new_folder(spark, "items"), silver.ORDER_ITEM_KEY)
    for load in _two_loads(c.items_log(spark, d)):
        items.upsert(silver.order_items_silver(load), unique=True)
    return items.read()


LAST_SHIPMENT = f"SELECT order_id, product_id, price, {EMITTED_AT} FROM ({c.ITEMS_LOG}) x"


@star.add(
    c.latest_sql(LAST_SHIPMENT, "order_id", c.descending("product_id", "price"))
)
def upsert_single(spark, d):
    """Last shipped line per order, merged from two loads without a table."""
    log = c.items_log(spark, d).select("order_id", "product_id", "price", EMITTED_AT)
    first, second = (
        latest_per_key(load, ["order_id"], EMITTED_AT) for load in _two_loads(log)
    )
    return upsert(first, second, ["order_id"])


@star.add(
    f"""
WITH log AS ({c.ITEMS_LOG}),
first AS ({c.latest_sql(
        f"SELECT * FROM log WHERE {EMITTED_AT} <= TIMESTAMP '{FIRST_LOAD_END}'"
        " AND price > 20000",
        "order_id, order_item_id",
        c.descending("product_id", "seller_id", "shipping_limit_date", "price",
                     "freight_value"))}),
second AS ({c.latest_sql(
        f"SELECT * FROM log WHERE {EMITTED_AT} > (SELECT max({EMITTED_AT}) FROM first)",
        "order_id, order_item_id",
        c.descending("product_id", "seller_id", "shipping_limit_date", "price",
                     "freight_value"))})
SELECT * FROM second
UNION ALL
SELECT f.* FROM first f ANTI JOIN second s
  ON f.order_id = s.order_id AND f.order_item_id = s.order_item_id"""
)
def incremental_watermark(spark, d):
    """A rerun over the whole log takes only records after the watermark.

    Cheap lines arrive late: those up to the watermark are left out for good.
    """
    log = c.items_log(spark, d)
    first, _ = _two_loads(log)
    items = KeyedTable(spark, new_folder(spark, "items"), silver.ORDER_ITEM_KEY)
    items.upsert(silver.order_items_silver(first.filter("price > 20000")), unique=True)
    rerun = newer_than(log, EMITTED_AT, items.watermark(EMITTED_AT))
    items.upsert(silver.order_items_silver(rerun), unique=True)
    return items.read()


@star.add(
    """SELECT p_partkey AS product_id, p_type AS product_category_name,
              p_retailprice AS product_weight_g FROM part"""
)
def full_refresh(spark, d):
    """A table replaced while its former content is being read."""
    products = FullTable(spark, new_folder(spark, "products"))
    latest = latest_per_key(products_log(spark, d), silver.PRODUCT_KEY, EMITTED_AT)
    rows = latest.select("product_id", "product_category_name", "product_weight_g")
    products.replace(rows)
    products.replace(products.read())
    return products.read()


# --- places -----------------------------------------------------------------

# A place is a customer; its city is the market segment with one letter left
# out, so its spelling has to be matched against the segment names of the state.
CUSTOMER_PLACES = """
SELECT CAST(c_custkey % 50 AS VARCHAR) AS zip,
       floor(c_acctbal) / 130 AS lat, CAST(c_nationkey AS DOUBLE) AS lng,
       substr(c_mktsegment, 1, CAST(c_custkey % 9 AS INT))
         || substr(c_mktsegment, CAST(c_custkey % 9 AS INT) + 2) AS city,
       CAST(c_nationkey AS VARCHAR) AS state
FROM customer"""
OFFICIAL = """
SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS UF, c_mktsegment AS City,
       'NATION_' || c_nationkey AS State FROM customer"""


def places(spark, d):
    cut = (F.col("c_custkey") % 9).cast("int")
    segment = F.col("c_mktsegment")
    return table(spark, d, "customer").select(
        (F.col("c_custkey") % 50).cast("string").alias("geolocation_zip_code_prefix"),
        (F.floor("c_acctbal") / 130).alias("geolocation_lat"),
        F.col("c_nationkey").cast("double").alias("geolocation_lng"),
        F.concat(
            F.substr(segment, F.lit(1), cut), F.substr(segment, cut + 2)
        ).alias("geolocation_city"),
        F.col("c_nationkey").cast("string").alias("geolocation_state"),
    )


def official_cities(spark, d):
    return (
        table(spark, d, "customer")
        .select(
            F.col("c_nationkey").cast("string").alias("UF"),
            F.col("c_mktsegment").alias("City"),
            F.concat(F.lit("NATION_"), "c_nationkey").alias("State"),
        )
        .distinct()
    )


POINTS = f"""
SELECT zip AS geolocation_zip_code_prefix, lat AS geolocation_lat,
       lng AS geolocation_lng, lower(b.City) AS standardized_city,
       upper(b.UF) AS standardized_state_code, b.State AS full_state_name,
       jaro_winkler_similarity(lower(a.city), lower(b.City)) * 100 AS match_score
FROM ({CUSTOMER_PLACES}) a JOIN ({OFFICIAL}) b
  ON upper(a.state) = upper(b.UF)
 AND jaro_winkler_similarity(lower(a.city), lower(b.City)) * 100 >= 80
WHERE length(trim(zip)) > 0
QUALIFY row_number() OVER (
  PARTITION BY zip, lat, lng
  ORDER BY match_score DESC, lower(b.City), upper(b.UF), b.State) = 1"""


@star.add(f"SELECT * REPLACE (round(match_score, 6) AS match_score) FROM ({POINTS}) p")
def geo_match(spark, d):
    points = silver.geolocation_points(places(spark, d), official_cities(spark, d))
    return points.withColumn("match_score", F.round("match_score", 6))


CENTROIDS = f"""
SELECT geolocation_zip_code_prefix, standardized_city, standardized_state_code,
       full_state_name, round(avg(geolocation_lat), 6) AS centroid_lat,
       round(avg(geolocation_lng), 6) AS centroid_lng, count(*) AS n_coordinates
FROM ({POINTS}) p GROUP BY ALL"""


def _rounded(places_: DataFrame) -> DataFrame:
    return places_.withColumns(
        {x: F.round(x, 6) for x in ("centroid_lat", "centroid_lng")}
    )


@star.add(CENTROIDS)
def geo_centroid(spark, d):
    """One row per zip prefix and city, from the written table of coordinates."""
    table_ = FullTable(spark, new_folder(spark, "points"))
    table_.replace(
        silver.geolocation_points(places(spark, d), official_cities(spark, d))
    )
    return _rounded(silver.geolocation_silver(table_.read()))


@star.add(CENTROIDS)
def dim_geolocation(spark, d):
    points = silver.geolocation_points(places(spark, d), official_cities(spark, d))
    return _rounded(gold.dim_geolocation(silver.geolocation_silver(points)))


