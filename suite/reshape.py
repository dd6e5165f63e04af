"""Selecting, pivoting, uniting, generating rows; scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.common import Registry, key_sql, table
from tidemart import functions as fn
from tidemart.operators import generate as g
from tidemart.operators import reshape as r
from tidemart.operators.latest import latest_per_key
from tidemart.sources.filesystem import child_names

reshape = Registry()


# --- columns ----------------------------------------------------------------


@reshape.add(
    """SELECT c_custkey AS in_c_custkey_x, c_name AS in_c_name_x,
              c_nationkey AS in_c_nationkey_x FROM customer"""
)
def star_except(spark, d):
    customer = table(spark, d, "customer").alias("c")
    return customer.select(
        *r.star(customer, ["C_ACCTBAL", "c_mktsegment"], "in_", "_x", "c")
    )


@reshape.add(
    """SELECT turn, nullif(role, '') AS role,
              nullif(CASE WHEN turn = 1 THEN '' ELSE text END, '') AS text
       FROM conversations"""
)
def nullcheck(spark, d):
    talk = table(spark, d, "conversations").select(
        "turn", "role", F.when(F.col("turn") == 1, "").otherwise(F.col("text")).alias("text")
    )
    return r.nullcheck(talk)


@reshape.add(
    """SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(
                lower(source || ' - ' || text), '[ -]+', '_', 'g'),
                '[^a-z0-9_]+', '', 'g'), '^([0-9])', '_\\1') AS slug
       FROM documents"""
)
def slugify(spark, d):
    name = F.concat_ws(" - ", "source", "text")
    return table(spark, d, "documents").select("doc_id", fn.slugify(name).alias("slug"))


# --- reshaping --------------------------------------------------------------

# The priorities of an order.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@reshape.add(
    "SELECT o_orderstatus, "
    + ", ".join(
        f"""CAST(sum(CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END) AS BIGINT)
              AS "{p}" """
        for p in PRIORITIES
    )
    + "FROM orders GROUP BY o_orderstatus"
)
def pivot(spark, d):
    columns = r.pivot_columns("o_orderpriority", PRIORITIES)
    return table(spark, d, "orders").groupBy("o_orderstatus").agg(*columns)


@reshape.add(
    """SELECT l_returnflag,
              max(CASE WHEN l_quantity >= 10 THEN l_extendedprice ELSE 0 END) AS from_10,
              max(CASE WHEN l_quantity >= 25 THEN l_extendedprice ELSE 0 END) AS from_25,
              count(DISTINCT CASE WHEN l_linestatus = 'O' THEN l_suppkey END) AS n_o,
              count(DISTINCT CASE WHEN l_linestatus = 'F' THEN l_suppkey END) AS n_f
       FROM lineitem GROUP BY l_returnflag"""
)
def pivot_compared(spark, d):
    columns = r.pivot_columns(
        "l_quantity",
        [10, 25],
        agg="max",
        cmp=">=",
        prefix="from ",
        then_value="l_extendedprice",
        quote_identifiers=False,
    )
    columns += r.pivot_columns(
        "l_linestatus",
        ["O", "F"],
        agg="count",
        prefix="n-",
        then_value="l_suppkey",
        else_value=None,
        quote_identifiers=False,
        distinct=True,
    )
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(*columns)


@reshape.add(
    " UNION ALL ".join(
        f"""SELECT o_orderkey, o_orderdate, '{c}' AS prop, CAST({c} AS VARCHAR) AS val
            FROM (SELECT *, o_totalprice > 200000 AS is_large,
                         nullif(o_orderstatus, 'P') AS final_status FROM orders) o"""
        for c in ["o_orderstatus", "o_orderpriority", "is_large", "final_status"]
    )
)
def unpivot(spark, d):
    orders = table(spark, d, "orders").withColumns(
        {
            "is_large": F.col("o_totalprice") > 200000,
            "final_status": F.nullif("o_orderstatus", F.lit("P")),
        }
    )
    return r.unpivot(
        orders,
        exclude=["o_orderkey", "o_orderdate"],
        remove=["o_custkey", "o_totalprice"],
        field_name="prop",
        value_name="val",
    )


@reshape.add(
    """SELECT 'customer' AS _dbt_source_relation, c_custkey AS key, c_name AS name,
              CAST(c_nationkey AS BIGINT) AS nation, c_mktsegment AS segment,
              NULL AS supplies FROM customer WHERE c_acctbal > 0
       UNION ALL
       SELECT 'supplier', s_suppkey, s_name, CAST(s_nationkey AS BIGINT), NULL, 'yes'
       FROM supplier WHERE s_acctbal > 0"""
)
def union_superset(spark, d):
    customer = table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )
    supplier = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("key"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
        F.lit("yes").alias("supplies"),
        F.col("s_acctbal").alias("balance"),
    )
    return r.union_relations(
        {"customer": customer, "supplier": supplier},
        column_override={"nation": "bigint"},
        exclude=["BALANCE"],
        where="balance > 0",
    )


@reshape.add(
    """SELECT 'conversations' AS origin, text, NULL AS c_name FROM conversations
       UNION ALL SELECT 'customer', NULL, c_name FROM customer"""
)
def union_by_prefix(spark, d):
    """Union of all tables whose name starts with ``c``."""
    names = [n.removesuffix(".parquet") for n in child_names(spark, d)]
    found = r.matching_tables(names, "C%", exclude="%x%")
    return r.union_relations(
        {n: table(spark, d, n) for n in found},
        include=["text", "c_name"],
        source_column_name="origin",
    )


EARLY, LATE = "o_orderdate < TIMESTAMP '1998-01-01'", "o_orderdate >= TIMESTAMP '1998-01-01'"


@reshape.add(
    f"""SELECT 'a_minus_b' AS which_diff, * FROM (
          SELECT o_custkey, o_orderpriority FROM orders WHERE {EARLY}
          EXCEPT SELECT o_custkey, o_orderpriority FROM orders WHERE {LATE})
        UNION ALL
        SELECT 'b_minus_a', * FROM (
          SELECT o_custkey, o_orderpriority FROM orders WHERE {LATE}
          EXCEPT SELECT o_custkey, o_orderpriority FROM orders WHERE {EARLY})"""
)
def except_both(spark, d):
    orders = table(spark, d, "orders")
    early = orders.filter("o_orderdate < timestamp_ntz'1998-01-01'")
    late = orders.filter("o_orderdate >= timestamp_ntz'1998-01-01'")
    return r.difference(early, late, ["o_custkey", "o_orderpriority"])


@reshape.add(
    """SELECT c_custkey FROM customer
       EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'"""
)
def except_one(spark, d):
    orders = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'")
    return r.except_rows(
        table(spark, d, "customer").select("c_custkey"),
        orders.select(F.col("o_custkey").alias("c_custkey")),
    )


PROFILED = """(SELECT *, CASE WHEN event_type <> 'error' THEN event_type END AS kind
               FROM events) e"""


@reshape.add(f"SELECT kind AS value, count(*) AS n_rows FROM {PROFILED} GROUP BY 1")
def value_profile(spark, d):
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    return r.value_profile(table(spark, d, "events").withColumn("kind", kind), "kind")


@reshape.add(
    """SELECT user_id AS value, count(*) AS n_rows FROM events WHERE value > 10
       GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""
)
def value_profile_top(spark, d):
    return r.value_profile(
        table(spark, d, "events"), "user_id", max_records=10, where="value > 10"
    )


@reshape.add(
    """SELECT l_returnflag, l_linestatus, l_suppkey, count(*) AS n,
              round(sum(l_extendedprice), 2) AS price
       FROM lineitem GROUP BY ALL"""
)
def group_by_first(spark, d):
    line = table(spark, d, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_suppkey", "l_extendedprice"
    )
    return r.group_by_first(line, 3).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("price")
    )


@reshape.add("SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey IS NOT NULL")
def distinct_values(spark, d):
    return r.distinct_values(table(spark, d, "lineitem"), "l_partkey")


@reshape.add(
    """SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (
         PARTITION BY user_id, event_type ORDER BY value, event_id) = 1"""
)
def deduplicate(spark, d):
    """Cheapest event of each user and type: an order given as columns."""
    events = table(spark, d, "events").select("user_id", "event_type", "event_id", "value")
    return latest_per_key(
        events, ["user_id", "event_type"], F.col("value").asc(), [F.col("event_id").asc()]
    )


# --- generated rows ---------------------------------------------------------


@reshape.add(
    """SELECT s.n AS generated_number, count(l.l_orderkey) AS n_lines
       FROM range(1, (SELECT max(l_orderkey) FROM lineitem) + 1) s(n)
       LEFT JOIN lineitem l ON l.l_orderkey = s.n GROUP BY 1"""
)
def series(spark, d):
    """Lines of every order number from 1 up to the largest, 0 in the gaps."""
    line = table(spark, d, "lineitem")
    numbers = g.generate_series(spark, line.agg(F.max("l_orderkey")).first()[0])
    n = line.groupBy(F.col("l_orderkey").alias("generated_number")).agg(
        F.count(F.lit(1)).alias("n_lines")
    )
    return numbers.join(n, "generated_number", "left").fillna(0, ["n_lines"])


def _spine(part: str, sql_part: str):
    @reshape.add(
        f"""WITH b AS (SELECT date_trunc('day', min(ts))::TIMESTAMP AS lo,
                              date_trunc('day', max(ts))::TIMESTAMP AS hi FROM events),
             spine AS (SELECT unnest(range(lo, hi, INTERVAL 1 {sql_part})) AS t FROM b)
        SELECT t AS date_{part}, count(event_id) AS n_events
        FROM spine LEFT JOIN events ON date_trunc('{part}', ts)
          = date_trunc('{part}', t) GROUP BY 1""",
        name=f"spine_{part}",
    )
    def spine(spark, d):
        events = table(spark, d, "events")
        day = F.date_trunc("day", "ts")
        lo, hi = events.agg(F.min(day).cast("string"), F.max(day).cast("string")).first()
        rows = g.date_spine(spark, part, lo, hi)
        n = events.groupBy(
            F.date_trunc(part, "ts").cast("timestamp_ntz").alias("t")
        ).agg(F.count(F.lit(1)).alias("n_events"))
        first_of = F.date_trunc(part, f"date_{part}").cast("timestamp_ntz")
        return (
            rows.join(n, first_of == n["t"], "left")
            .drop("t")
            .fillna(0, ["n_events"])
        )


_spine("day", "DAY")
_spine("hour", "HOUR")


# --- scalar functions -------------------------------------------------------

DISCOUNTED = """(SELECT *, CASE WHEN l_discount > 0 THEN l_discount END AS d,
                        CASE WHEN l_tax > 0 THEN l_tax END AS t FROM lineitem) l"""


@reshape.add(
    f"""SELECT l_orderkey, l_linenumber, l_partkey,
               round(coalesce(d, 0) + coalesce(t, 0) + l_quantity, 6) AS added,
               round(l_quantity - coalesce(d, 0) - coalesce(t, 0), 6) AS subtracted,
               round(l_extendedprice / nullif(l_tax, 0), 4) AS divided
        FROM {DISCOUNTED}"""
)
def safe_math(spark, d):
    line = table(spark, d, "lineitem")
    off = F.when(F.col("l_discount") > 0, F.col("l_discount"))
    tax = F.when(F.col("l_tax") > 0, F.col("l_tax"))
    return line.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(fn.safe_add([off, tax, "l_quantity"]), 6).alias("added"),
        F.round(fn.safe_subtract(["l_quantity", off, tax]), 6).alias("subtracted"),
        F.round(fn.safe_divide("l_extendedprice", "l_tax"), 4).alias("divided"),
    )


@reshape.add(
    """SELECT bucket, count(*) AS n, min(l_extendedprice) AS low FROM (
         SELECT l_extendedprice, CASE WHEN l_extendedprice < 10000 THEN 0
                  WHEN l_extendedprice >= 90000 THEN 9
                  ELSE CAST(floor((l_extendedprice - 10000) / 10000) AS BIGINT) + 1 END
                AS bucket FROM lineitem) b GROUP BY 1"""
)
def width_bucket(spark, d):
    bucket = fn.width_bucket("l_extendedprice", 10000, 90000, 8)
    return (
        table(spark, d, "lineitem")
        .groupBy(bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("l_extendedprice").alias("low"))
    )


def _haversine_sql(rate: float) -> str:
    return f"""round(2 * 3961 * asin(sqrt(least(1,
        power(sin(radians((lat2 - lat1) / 2)), 2) + cos(radians(lat1))
        * cos(radians(lat2)) * power(sin(radians((lon2 - lon1) / 2)), 2)))) * {rate}, 4)"""


@reshape.add(
    f"""SELECT o_orderkey, {_haversine_sql(1)} AS miles, {_haversine_sql(1.60934)} AS km,
               round(radians(lat1), 9) AS radians
        FROM (SELECT o_orderkey, c_acctbal / 120 AS lat1, o_totalprice / 3000 AS lon1,
                     c_nationkey * 3 - 40.0 AS lat2, c_nationkey * 7 - 80.0 AS lon2
              FROM orders JOIN customer ON o_custkey = c_custkey) p"""
)
def haversine(spark, d):
    joined = table(spark, d, "orders").join(
        table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    points = [
        F.col("c_acctbal") / 120,
        F.col("o_totalprice") / 3000,
        F.col("c_nationkey") * 3 - 40.0,
        F.col("c_nationkey") * 7 - 80.0,
    ]
    return joined.select(
        "o_orderkey",
        F.round(fn.haversine_distance(*points), 4).alias("miles"),
        F.round(fn.haversine_distance(*points, unit="km"), 4).alias("km"),
        F.round(fn.degrees_to_radians(points[0]), 9).alias("radians"),
    )


@reshape.add(
    """WITH u AS (SELECT page_id, url, replace(replace(url, 'http://', ''), 'https://', '')
                    AS bare FROM pages),
            v AS (SELECT *, CASE WHEN instr(bare, '/') > 0 THEN instr(bare, '/')
                                 ELSE instr(bare, '?') - 1 END AS cut FROM u)
       SELECT page_id,
              split_part(split_part(replace(bare, 'android-app://', ''), '/', 1), '?', 1)
                AS host,
              split_part(substr(bare, cut + 1), '?', 1) AS path,
              nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') AS ref,
              nullif(split_part(split_part(url, 'utm_source=', 2), '&', 1), '') AS source
       FROM v"""
)
def url_parts(spark, d):
    return table(spark, d, "pages").select(
        "page_id",
        fn.url_host("url").alias("host"),
        fn.url_path("url").alias("path"),
        fn.url_parameter("url", "ref").alias("ref"),
        fn.url_parameter("url", "utm_source").alias("source"),
    )


NULLABLE_EVENT = """(SELECT event_id, event_type, CASE WHEN value > 10 THEN props END AS p
                    FROM events) e"""


@reshape.add(
    f"""SELECT event_id, {key_sql('event_id', 'event_type', 'p')} AS key,
               md5(event_id || '-' || coalesce(p, '')) AS legacy_key
        FROM {NULLABLE_EVENT}"""
)
def surrogate_keys(spark, d):
    p = F.when(F.col("value") > 10, F.col("props"))
    return table(spark, d, "events").select(
        "event_id",
        fn.surrogate_key(["event_id", "event_type", p]).alias("key"),
        fn.surrogate_key(["event_id", p], nulls_as_empty=True).alias("legacy_key"),
    )


PARTS = ["minute", "hour", "day", "week", "month", "quarter", "year"]


@reshape.add(
    "SELECT event_id, "
    + ", ".join(
        f"date_diff('{p}', TIMESTAMP '2023-11-30 22:30:15', ts) AS {p}s"
        for p in PARTS
        if p != "week"
    )
    + """, date_diff('day', date_trunc('week', TIMESTAMP '2023-11-30'),
                     date_trunc('week', ts)) // 7 AS weeks"""
    + ", ts + INTERVAL 5 HOUR AS later, ts - INTERVAL 2 MONTH AS before FROM events"
)
def date_arithmetic(spark, d):
    start = F.lit("2023-11-30 22:30:15").cast("timestamp_ntz")
    return table(spark, d, "events").select(
        "event_id",
        *[fn.date_diff(p, start, "ts").alias(f"{p}s") for p in PARTS],
        fn.date_add("hour", 5, "ts").alias("later"),
        fn.date_add("month", -2, "ts").alias("before"),
    )


@reshape.add(
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k,
              split_part(event_type, 'c', 1) AS before_c, substr(event_type, 2, 3) AS piece
       FROM events"""
)
def json_extract(spark, d):
    """A typed value out of a JSON payload, and pieces of a text."""
    return table(spark, d, "events").select(
        "event_id",
        F.try_variant_get(F.try_parse_json("props"), "$.k", "int").alias("k"),
        F.split_part("event_type", F.lit("c"), F.lit(1)).alias("before_c"),
        F.substring("event_type", 2, 3).alias("piece"),
    )

