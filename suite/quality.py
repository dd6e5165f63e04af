"""Checks, each giving the rows that break its rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.common import Registry, table
from suite.star import star
from tidemart.operators import quality as q
from tidemart.operators.report import (
    RowCheck,
    TableCheck,
    Threshold,
    quality_report,
    sum_of,
    unique_combination_check,
)
from tidemart.plans.checks import GOLD_CHECKS, SILVER_CHECKS

quality = Registry()


@quality.add(
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE NOT l_quantity >= 5 OR NOT l_quantity <= 45"""
)
def chk_accepted_range(spark, d):
    line = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return q.accepted_range(line, "l_quantity", 5, 45)


@quality.add(
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE NOT l_quantity > 1"""
)
def chk_accepted_range_exclusive(spark, d):
    line = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return q.accepted_range(line, "l_quantity", 1, inclusive=False)


@quality.add(
    """SELECT l_suppkey, l_linenumber, count(CASE WHEN l_tax > 0.07 THEN 1 END)
         AS filler_column FROM lineitem GROUP BY ALL HAVING filler_column = 0"""
)
def chk_at_least_one(spark, d):
    high = F.when(F.col("l_tax") > 0.07, 1)
    line = table(spark, d, "lineitem").withColumn("high", high)
    return q.at_least_one(line, "high", ["l_suppkey", "l_linenumber"])


@quality.add(
    """SELECT count(CASE WHEN value < 0 THEN 1 END) AS filler_column FROM events
       HAVING filler_column = 0"""
)
def chk_at_least_one_of_all(spark, d):
    negative = F.when(F.col("value") < 0, 1)
    return q.at_least_one(table(spark, d, "events").withColumn("n", negative), "n")


@quality.add(
    """WITH a AS (SELECT o_custkey AS k, count(*) AS num_rows FROM orders GROUP BY 1),
            b AS (SELECT user_id AS k, count(*) AS num_rows FROM events GROUP BY 1)
       SELECT k AS o_custkey, num_rows FROM (
         (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL
         (SELECT * FROM b EXCEPT SELECT * FROM a)) u"""
)
def chk_cardinality_equality(spark, d):
    return q.cardinality_equality(
        table(spark, d, "orders"), "o_custkey", table(spark, d, "events"), "user_id"
    )


PAIRED = """
WITH a AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1),
     b AS (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1)
SELECT a.k AS nation_a, b.k AS nation_b, {columns} FROM a FULL JOIN b ON a.k = b.k"""


def _nations(spark, d):
    return (
        table(spark, d, "customer").withColumnRenamed("c_nationkey", "nation"),
        table(spark, d, "supplier").withColumnRenamed("s_nationkey", "nation"),
    )


@quality.add(
    PAIRED.format(
        columns="a.n AS count_a, b.n AS count_b, abs(a.n - b.n) AS diff_count"
    )
)
def chk_equal_rowcount(spark, d):
    customer, supplier = _nations(spark, d)
    return q.equal_rowcount(customer, supplier, ["nation"])


@quality.add(
    PAIRED.format(
        columns="""a.n AS count_our_model, b.n AS count_comparison_model,
                   CASE WHEN a.n > b.n THEN a.n - b.n WHEN a.n = b.n THEN 1 ELSE 0 END
                     AS row_count_delta"""
    )
)
def chk_fewer_rows_than(spark, d):
    customer, supplier = _nations(spark, d)
    return q.fewer_rows_than(customer, supplier, ["nation"])


@quality.add(
    """SELECT (SELECT count(*) FROM customer) AS count_our_model,
              (SELECT count(*) FROM orders) AS count_comparison_model,
              CAST(0 AS BIGINT) AS row_count_delta"""
)
def chk_fewer_rows_in_all(spark, d):
    return q.fewer_rows_than(table(spark, d, "customer"), table(spark, d, "orders"))


SHIFTED = """(SELECT c_custkey, c_nationkey, CASE WHEN c_mktsegment = 'BUILDING'
                 THEN c_acctbal + 0.001 ELSE c_acctbal + 0.0000001 END AS c_acctbal
              FROM customer) s"""


@quality.add(
    f"""WITH a AS (SELECT c_custkey, c_nationkey, round(c_acctbal, 2) AS c_acctbal
                   FROM customer WHERE c_nationkey <> 3),
             b AS (SELECT c_custkey, c_nationkey, round(c_acctbal, 2) AS c_acctbal
                   FROM {SHIFTED} WHERE c_acctbal < 9000)
        SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
        UNION ALL
        SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)"""
)
def chk_equality(spark, d):
    """Two versions of the customers, equal up to two decimals."""
    customer = table(spark, d, "customer")
    shift = F.when(F.col("c_mktsegment") == "BUILDING", 0.001).otherwise(0.0000001)
    shifted = customer.withColumn("c_acctbal", F.col("c_acctbal") + shift)
    return q.equality(
        customer.filter("c_nationkey <> 3"),
        shifted.filter("c_acctbal < 9000"),
        exclude_columns=["C_NAME", "c_mktsegment"],
        precision=2,
    )


@quality.add(
    """SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem
       WHERE l_returnflag = 'A' AND NOT (l_discount + l_tax <= 0.15)"""
)
def chk_expression_is_true(spark, d):
    line = table(spark, d, "lineitem")
    return q.expression_is_true(
        line, "+ l_tax <= 0.15", "l_discount", where="l_returnflag = 'A'"
    ).select("l_orderkey", "l_linenumber", "l_discount", "l_tax")


def _ranges_sql(source: str, gaps: str, length: str, partition: str, words) -> str:
    """The rule in SQL. Which of several equal last ranges counts as the last is
    left open by two windows of opposite order; here both mean the same row."""
    part = "partition_by_col, " if partition else ""
    by = "PARTITION BY partition_by_col " if partition else ""
    return f"""
WITH w AS (SELECT {part}lower_bound, upper_bound,
    lead(lower_bound) OVER ({by}ORDER BY lower_bound, upper_bound) AS next_lower_bound,
    lead(1) OVER ({by}ORDER BY lower_bound, upper_bound) IS NULL AS is_last_record
  FROM ({source}) s),
c AS (SELECT *,
    coalesce(lower_bound {length} upper_bound, false)
      AS lower_bound_{words[0]}_upper_bound,
    coalesce(upper_bound {gaps} next_lower_bound, is_last_record, false)
      AS upper_bound_{words[1]}_next_lower_bound FROM w)
SELECT * FROM c WHERE NOT (lower_bound_{words[0]}_upper_bound
                           AND upper_bound_{words[1]}_next_lower_bound)"""


@quality.add(
    _ranges_sql(
        """SELECT o_custkey AS partition_by_col, o_orderdate AS lower_bound,
                  o_orderdate + INTERVAL 60 DAY AS upper_bound FROM orders""",
        "<=",
        "<",
        "custkey",
        ("less_than", "less_than_or_equal_to"),
    )
)
def chk_mutually_exclusive_ranges(spark, d):
    """Orders of a customer less than 60 days apart."""
    return q.mutually_exclusive_ranges(
        table(spark, d, "orders"),
        "o_orderdate",
        F.date_add("o_orderdate", 60).cast("timestamp_ntz"),
        partition_by="o_custkey",
    )


@quality.add(
    _ranges_sql(
        """SELECT l_shipdate AS lower_bound, l_shipdate
             + CASE WHEN l_linenumber > 3 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END
             AS upper_bound FROM lineitem""",
        "=",
        "<=",
        "",
        ("less_than_or_equal_to", "equal_to"),
    )
)
def chk_ranges_without_gaps(spark, d):
    """Shipping days as one gapless sequence over all lines, which they are not."""
    days = F.when(F.col("l_linenumber") > 3, 1).otherwise(0)
    return q.mutually_exclusive_ranges(
        table(spark, d, "lineitem"),
        "l_shipdate",
        F.date_add("l_shipdate", days).cast("timestamp_ntz"),
        gaps="not_allowed",
        zero_length_range_allowed=True,
    )


@quality.add(
    """SELECT DISTINCT c_mktsegment AS value_field FROM customer
       WHERE c_mktsegment IN ('BUILDING', 'SPACE')"""
)
def chk_not_accepted_values(spark, d):
    return q.not_accepted_values(
        table(spark, d, "customer"), "c_mktsegment", ["BUILDING", "SPACE"]
    )


@quality.add(
    """SELECT o_custkey, count(DISTINCT o_orderstatus) AS filler_column FROM orders
       GROUP BY 1 HAVING count(DISTINCT o_orderstatus) = 1"""
)
def chk_not_constant(spark, d):
    return q.not_constant(table(spark, d, "orders"), "o_orderstatus", ["o_custkey"])


@quality.add(
    """SELECT trim(first) AS first FROM (
         SELECT split_part(html, '<title>', 1) AS first FROM pages
         UNION ALL SELECT split_part(url, 'http://', 1) FROM pages) p
       WHERE trim(first) = ''"""
)
def chk_not_empty_string(spark, d):
    pages = table(spark, d, "pages")
    pieces = pages.select(F.split_part("html", F.lit("<title>"), F.lit(1)).alias("first"))
    pieces = pieces.unionAll(
        pages.select(F.split_part("url", F.lit("http://"), F.lit(1)))
    )
    return q.not_empty_string(pieces, "first")


@quality.add(
    """SELECT * FROM (SELECT l_suppkey, round(count(CASE WHEN l_discount > 0.02 THEN 1 END)
                        / count(*), 6) AS not_null_proportion FROM lineitem GROUP BY 1)
       WHERE not_null_proportion < 0.7 OR not_null_proportion > 0.75"""
)
def chk_not_null_proportion(spark, d):
    big = F.when(F.col("l_discount") > 0.02, 1)
    line = table(spark, d, "lineitem").withColumn("big", big)
    found = q.not_null_proportion(line, "big", 0.7, 0.75, ["l_suppkey"])
    return found.withColumn("not_null_proportion", F.round("not_null_proportion", 6))


@quality.add(
    """SELECT * FROM (SELECT user_id, CAST(max(ts) AS DATE) AS most_recent,
                             DATE '2024-01-29' AS threshold FROM events GROUP BY 1)
       WHERE most_recent < threshold"""
)
def chk_recency(spark, d):
    """Users without an event in the two days up to a given time."""
    return q.recency(
        table(spark, d, "events"),
        "ts",
        "day",
        2,
        now="2024-01-31 12:00:00",
        ignore_time_component=True,
        group_by=["user_id"],
    )


@quality.add(
    """SELECT l_orderkey AS id FROM lineitem WHERE l_returnflag = 'R'
         AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"""
)
def chk_relationships_where(spark, d):
    return q.relationships_where(
        table(spark, d, "lineitem"),
        "l_orderkey",
        table(spark, d, "orders"),
        "o_orderkey",
        from_condition="l_returnflag = 'R'",
        to_condition="o_orderstatus = 'F'",
    )


@quality.add(
    """SELECT * FROM (SELECT l_suppkey, l_linenumber, lag(l_linenumber) OVER (
         PARTITION BY l_suppkey ORDER BY l_linenumber) AS previous_l_linenumber
         FROM lineitem) w WHERE NOT (l_linenumber = previous_l_linenumber + 1)"""
)
def chk_sequential_values(spark, d):
    """Line numbers per supplier; nearly every row repeats its predecessor."""
    return q.sequential_values(
        table(spark, d, "lineitem"), "l_linenumber", group_by=["l_suppkey"]
    )


@quality.add(
    """SELECT * FROM (SELECT day, lag(day) OVER (ORDER BY day) AS previous_day
         FROM (SELECT DISTINCT o_orderdate AS day FROM orders) x) w
       WHERE NOT (day = previous_day + INTERVAL 1 DAY)"""
)
def chk_sequential_days(spark, d):
    """Gaps between order dates, over all orders."""
    days = table(spark, d, "orders").select(F.col("o_orderdate").alias("day")).distinct()
    return q.sequential_values(days, "day", 1, part="day")


@quality.add(
    """SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1"""
)
def chk_unique_combination(spark, d):
    return q.unique_combination_of_columns(
        table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@quality.add(
    """SELECT l_orderkey AS unique_field, count(*) AS n_records FROM lineitem
       GROUP BY 1 HAVING count(*) > 1"""
)
def chk_unique(spark, d):
    return q.unique(table(spark, d, "lineitem"), "l_orderkey")


@quality.add(
    """SELECT event_id, value, kind FROM (SELECT *, CASE WHEN event_type <> 'error'
         THEN event_type END AS kind FROM events) e WHERE kind IS NULL"""
)
def chk_not_null(spark, d):
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    events = table(spark, d, "events").select("event_id", "value", kind.alias("kind"))
    return q.not_null(events, "kind")


@quality.add(
    """SELECT o_orderpriority AS value_field, count(*) AS n_records FROM orders
       WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1"""
)
def chk_accepted_values(spark, d):
    return q.accepted_values(
        table(spark, d, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"]
    )


@quality.add(
    """SELECT c_custkey AS from_field FROM customer
       WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)"""
)
def chk_relationships(spark, d):
    return q.relationships(
        table(spark, d, "customer"), "c_custkey", table(spark, d, "events"), "user_id"
    )


@quality.add(
    """SELECT l_orderkey AS order_id, o_orderdate AS order_purchase_timestamp,
              l_shipdate AS order_delivered_customer_date
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       WHERE l_shipdate < o_orderdate"""
)
def chk_delivery_after_purchase(spark, d):
    line, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    shipped = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.col("l_shipdate").alias("order_delivered_customer_date"),
    )
    return q.delivered_before_purchase(shipped)


@quality.add(
    """SELECT l_orderkey AS order_id FROM lineitem LEFT JOIN
         (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW') o ON l_orderkey = o_orderkey
       WHERE o_orderkey IS NULL"""
)
def chk_fact_sales_orders_exist(spark, d):
    orders = table(spark, d, "orders").filter("o_orderpriority <> '5-LOW'")
    return q.sales_without_order(
        table(spark, d, "lineitem").select(F.col("l_orderkey").alias("order_id")),
        orders.select(F.col("o_orderkey").alias("order_id")),
    )


@quality.add(
    """SELECT event_id AS review_id, ts AS review_creation_date,
              ts + to_minutes(event_id % 7 - 1) AS review_answer_timestamp
       FROM events WHERE ts + to_minutes(event_id % 7 - 1) < ts"""
)
def chk_answer_after_creation(spark, d):
    reviews = table(spark, d, "events").select(
        F.col("event_id").alias("review_id"),
        F.col("ts").alias("review_creation_date"),
        F.expr("ts + make_dt_interval(0, 0, event_id % 7 - 1)").alias(
            "review_answer_timestamp"
        ),
    )
    return q.answered_before_creation(reviews)


@quality.add(
    """SELECT l_orderkey, l_linenumber, flag, l_returnflag FROM (
         SELECT *, CASE WHEN l_linestatus = 'O' THEN 'A' END AS flag FROM lineitem) l
       WHERE flag <> l_returnflag"""
)
def chk_rows_equal(spark, d):
    flag = F.when(F.col("l_linestatus") == "O", "A").alias("flag")
    line = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", flag, "l_returnflag"
    )
    return q.rows_not_equal(line, "flag", "l_returnflag")


@quality.add(
    """WITH f AS (
         SELECT 'quantity.range' AS check_name, count(*) AS failures FROM lineitem
           WHERE NOT l_quantity <= 40
         UNION ALL SELECT 'flag.not_null', count(*) FROM lineitem WHERE l_returnflag IS NULL
         UNION ALL SELECT 'discount.rule', count(*) FROM lineitem
           WHERE NOT (l_discount + l_tax <= 0.15)
         UNION ALL SELECT 'balance.range', count(*) FROM customer WHERE NOT c_acctbal >= 0
         UNION ALL SELECT 'lineitem.l_orderkey_l_linenumber.unique_combination', count(*)
           FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber
                 HAVING count(*) > 1) x
         UNION ALL SELECT 'customers.fewer_rows_than_orders', CASE
           WHEN (SELECT count(*) FROM customer) < (SELECT count(*) FROM orders) THEN 0
           ELSE 1 END)
       SELECT check_name, failures,
              CASE WHEN check_name = 'discount.rule'
                     THEN CASE WHEN failures < 1 THEN 'error' ELSE 'pass' END
                   WHEN check_name = 'balance.range'
                     THEN CASE WHEN failures > 1000000000 THEN 'error'
                               WHEN failures > 0 THEN 'warn' ELSE 'pass' END
                   WHEN failures > 0 THEN 'error' ELSE 'pass' END AS status,
              status <> 'error' AS passed
       FROM f"""
)
def quality_summary(spark, d):
    """A report over several tables; rules on rows share one scan per table."""
    tables = {n: table(spark, d, n) for n in ("lineitem", "customer", "orders")}
    checks = [
        RowCheck("quantity.range", "lineitem", lambda: q.range_violation("l_quantity", None, 40)),
        RowCheck("flag.not_null", "lineitem", lambda: q.null_violation("l_returnflag")),
        RowCheck(
            "discount.rule",
            "lineitem",
            lambda: q.expression_violation("l_discount + l_tax <= 0.15"),
        ),
        RowCheck("balance.range", "customer", lambda: q.range_violation("c_acctbal", 0)),
        unique_combination_check("lineitem", "l_orderkey", "l_linenumber"),
        TableCheck(
            "customers.fewer_rows_than_orders",
            lambda t: q.fewer_rows_than(t["customer"], t["orders"]),
            sum_of("row_count_delta"),
        ),
    ]
    thresholds = {
        "discount.rule": Threshold(expect_failures=True),
        "balance.range": Threshold(error_above=1_000_000_000),
    }
    return quality_report(tables, checks, thresholds)


# The declared checks, over the tables of the star schema.
SILVER_TABLES = {
    "orders_silver": "orders_conformed",
    "orders_items_silver": "order_items_conformed",
    "order_payments_silver": "payments_conformed",
    "order_reviews_silver": "reviews_conformed",
    "product_silver": "product_dim",
    "geolocation_silver": "geo_centroid",
}
GOLD_TABLES = {
    "dim_customer": "dim_customer",
    "dim_seller": "dim_seller",
    "dim_product": "product_dim",
    "dim_date": "dim_date_activity",
    "dim_order_attribute": "order_attribute_dim",
    "dim_feedback_profile": "feedback_profile",
    "dim_geolocation": "dim_geolocation",
    "fact_sales": "fact_sales",
    "fact_payment": "fact_payment",
    "fact_reviews": "fact_reviews",
}


def _check_sql(check) -> str:
    """A check as a query of its own, by what its name says."""
    t, rule = check.table, check.name.split(".")[-1]
    names = ", ".join(getattr(check, "columns", ())) or check.name.split(".")[1]
    rows = {
        "not_null": f"{t} WHERE {names} IS NULL",
        "accepted_range": f"{t} WHERE {names} < 0",
        "unique": f"(SELECT {names} FROM {t} WHERE {names} IS NOT NULL GROUP BY ALL HAVING count(*) > 1)",
        "unique_combination": f"(SELECT {names} FROM {t} GROUP BY ALL HAVING count(*) > 1)",
        "delivery_after_purchase": f"{t} WHERE order_delivered_customer_date < order_purchase_timestamp",
        "answer_after_creation": f"{t} WHERE review_answer_timestamp < review_creation_date",
    }
    if rule == "accepted_values":
        listed = ", ".join(repr(v) for v in check.accepted)
        rows[rule] = f"(SELECT DISTINCT {names} FROM {t} WHERE {names} NOT IN ({listed}))"
    if rule in ("relationships", "orders_exist"):
        null = "TRUE" if rule == "orders_exist" else f"c.{names} IS NOT NULL"
        rows[rule] = f"{t} c ANTI JOIN {check.to} p ON c.{names} = p.{check.field} WHERE {null}"
    return f"SELECT '{check.name}' AS check_name, count(*) AS failures FROM {rows[rule]}"


DELIVERED = "order_purchase_timestamp + to_days(CAST(order_id % 9 - 1 AS INT))"
DECLARED = f"""
WITH {", ".join(
    f"{t} AS ({star.sql[name]})" for t, name in (SILVER_TABLES | GOLD_TABLES).items() if t != "orders_silver"
)}, orders_silver AS (SELECT *, {DELIVERED} AS order_delivered_customer_date FROM ({star.sql["orders_conformed"]}))
SELECT check_name, failures, CASE WHEN failures > 0 THEN 'error' ELSE 'pass' END AS status,
       failures = 0 AS passed
FROM ({" UNION ALL ".join(_check_sql(c) for c in [*SILVER_CHECKS, *GOLD_CHECKS])})"""


@quality.add(DECLARED)
def declared_checks(spark, d):
    """All declared checks of the conformed tables and the star schema, in shared scans."""
    tables = {t: star.queries[name](spark, d) for t, name in (SILVER_TABLES | GOLD_TABLES).items()}
    delivered = F.expr("order_purchase_timestamp + make_dt_interval(order_id % 9 - 1)")
    tables["orders_silver"] = tables["orders_silver"].withColumn("order_delivered_customer_date", delivered)
    return quality_report(tables, [*SILVER_CHECKS, *GOLD_CHECKS])
