"""File sources: the tables written in another format and read back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from suite.common import Registry, table
from tidemart.constants import EMITTED_AT, FILE_NAME, FILE_ROW_NUMBER, PAYLOAD, RECORD_ID
from tidemart.sources.catalog import (
    ListedPartition,
    add_partitions,
    create_statement,
    key_value,
    stage,
)
from tidemart.sources.envelope import envelope_schema, extract, read_cities
from tidemart.sources.files import FileColumn, FilePartition, FileSource, load
from tidemart.sources.filesystem import child_names
from tidemart.sources.workspace import new_folder, shared_folder
from tidemart.streaming.ingest import ingest_files, read_ingested

sources = Registry()

CUSTOMER_COLUMNS = [
    FileColumn("c_custkey", "bigint"),
    FileColumn("c_name", "string"),
    FileColumn("c_nationkey", "int"),
    FileColumn("c_acctbal", "double"),
    FileColumn("c_mktsegment", "string"),
]
ORDER_COLUMNS = [
    FileColumn("o_orderkey", "bigint"),
    FileColumn("o_custkey", "bigint"),
    FileColumn("o_totalprice", "double"),
    FileColumn("o_orderdate", "timestamp_ntz"),
]
HEADER = {"header": "true"}


def _customer(spark, d):
    return table(spark, d, "customer")


def _orders(spark, d):
    return table(spark, d, "orders").select(
        *[c.name for c in ORDER_COLUMNS], "o_orderstatus", "o_orderpriority"
    )


def _database(spark, name):
    """A database whose own folder is shared as well."""
    folder = f"{shared_folder(spark)}/{name}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{folder}'")


@sources.add("SELECT * FROM customer")
def src_csv(spark, d):
    """CSV with a header of other names: columns are taken by position."""
    path = new_folder(spark, "csv")
    other = _customer(spark, d).toDF("a", "b", "c", "d", "e")
    other.write.csv(path, header=True)
    return load(
        spark, FileSource("shop", "customer", path, "csv", CUSTOMER_COLUMNS, options=HEADER)
    )


@sources.add("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def src_json(spark, d):
    path = new_folder(spark, "json")
    _orders(spark, d).write.json(path)
    return load(spark, FileSource("shop", "orders", path, "json", ORDER_COLUMNS))


def _write_objects(df, path):
    """Pretty-printed objects back to back."""
    text = F.to_json(F.struct("*"), {"pretty": "true"})
    df.select(text.alias("value")).write.text(path)


@sources.add("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def src_json_objects(spark, d):
    path = new_folder(spark, "objects")
    _write_objects(_orders(spark, d).drop("o_orderstatus", "o_orderpriority"), path)
    spec = FileSource(
        "shop", "orders", path, "json", ORDER_COLUMNS, json_layout="objects"
    )
    return load(spark, spec)


@sources.add(
    """SELECT CAST(c_custkey AS BIGINT) AS C_CUSTKEY, c_name AS C_NAME,
              c_mktsegment AS C_MKTSEGMENT FROM customer"""
)
def src_parquet_inferred(spark, d):
    """Names and types come from the files."""
    path = new_folder(spark, "inferred")
    upper = _customer(spark, d).select("c_custkey", "c_name", "c_mktsegment")
    upper.toDF(*[c.upper() for c in upper.columns]).write.parquet(path)
    return load(spark, FileSource("shop", "c", path, "parquet", infer_schema=True))


@sources.add("SELECT *, NULL AS c_phone FROM customer")
def src_parquet_any_case(spark, d):
    """Declared names in another case than the files, and one they lack."""
    path = new_folder(spark, "upper")
    customer = _customer(spark, d)
    customer.toDF(*[c.upper() for c in customer.columns]).write.parquet(path)
    columns = [*CUSTOMER_COLUMNS, FileColumn("c_phone")]
    return load(
        spark, FileSource("shop", "c", path, "parquet", columns, ignore_case=True)
    )


@sources.add("SELECT * FROM customer")
def src_partitioned(spark, d):
    """Partition values from directories ``name=value``."""
    path = new_folder(spark, "hive")
    _customer(spark, d).write.partitionBy("c_mktsegment").csv(path, header=True)
    spec = FileSource(
        "shop",
        "c",
        path,
        "csv",
        CUSTOMER_COLUMNS[:4],
        [FilePartition("c_mktsegment")],
        options=HEADER,
    )
    return load(spark, spec)


@sources.add(
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderstatus AS status,
              substr(o_orderpriority, 1, 1) AS urgency FROM orders
       WHERE o_orderstatus = 'F'"""
)
def src_path_partition(spark, d):
    """Partition values computed from the path; the filter skips other files."""
    path = new_folder(spark, "paths")
    marked = _orders(spark, d).withColumns(
        {"section": F.col("o_orderstatus"), "p": F.substring("o_orderpriority", 1, 1)}
    )
    marked.drop("o_orderstatus", "o_orderpriority").write.partitionBy("section", "p").json(
        path
    )
    spec = FileSource(
        "shop",
        "orders",
        path,
        "json",
        ORDER_COLUMNS,
        [
            FilePartition(
                "status", "string", "substr(split_part(filename, 'section=', 2), 1, 1)"
            ),
            FilePartition(
                "urgency", "string", "split_part(split_part(filename, '/p=', 2), '/', 1)"
            ),
        ],
    )
    return load(spark, spec).filter("status = 'F'")


@sources.add(
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderstatus,
              o_orderpriority FROM orders WHERE o_orderstatus <> 'P'"""
)
def src_listed_partitions(spark, d):
    """A table whose partitions are listed: every status with every priority."""
    path = new_folder(spark, "listed")
    _orders(spark, d).write.partitionBy("o_orderstatus", "o_orderpriority").csv(path)
    name = path.rsplit("-", 1)[1]
    spec = FileSource(
        "listed",
        f"t_{name}",
        path,
        "csv",
        ORDER_COLUMNS,
        [FilePartition("o_orderstatus"), FilePartition("o_orderpriority")],
    )
    _database(spark, "listed")
    table_name = f"`listed`.`t_{name}`"
    spark.sql(create_statement(spec, table_name))
    priorities = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    add_partitions(
        spark,
        table_name,
        path,
        [
            ListedPartition("o_orderstatus", ["F", "O"], key_value),
            ListedPartition("o_orderpriority", priorities, key_value),
        ],
    )
    return spark.table(table_name)


@sources.add("SELECT * FROM customer")
def src_uris(spark, d):
    """An explicit list of files."""
    path = new_folder(spark, "uris")
    _customer(spark, d).repartition(3, "c_custkey").write.csv(path, header=True)
    files = [f"{path}/{n}" for n in child_names(spark, path) if n.endswith(".csv")]
    return load(
        spark, FileSource("shop", "c", files, "csv", CUSTOMER_COLUMNS, options=HEADER)
    )


@sources.add("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def src_pattern(spark, d):
    """Only the files whose path matches, out of a mixed directory."""
    path = new_folder(spark, "mixed")
    _orders(spark, d).write.json(path)
    _customer(spark, d).write.mode("append").csv(path)
    spec = FileSource(
        "shop", "orders", path, "json", ORDER_COLUMNS, pattern=r".*[.]json$"
    )
    return load(spark, spec)


@sources.add(
    """SELECT c_custkey, CASE WHEN c_acctbal >= 1000 THEN c_mktsegment END AS segment,
              split_part(c_name, '#', 2) AS number, c_nationkey * 2 AS twice
       FROM customer"""
)
def src_null_text_alias_expression(spark, d):
    """The text null is NULL; columns renamed or computed from the raw ones."""
    path = new_folder(spark, "nulls")
    segment = F.when(F.col("c_acctbal") >= 1000, F.col("c_mktsegment")).otherwise("NuLL")
    _customer(spark, d).select(
        "c_custkey", "c_name", "c_nationkey", segment.alias("s")
    ).write.json(path)
    spec = FileSource(
        "shop",
        "c",
        path,
        "json",
        [
            FileColumn("c_custkey", "bigint"),
            FileColumn("s", "string", alias="segment"),
            FileColumn("c_name", "string", alias="number", expression=None),
            FileColumn("c_nationkey", "int"),
            FileColumn("n", "string", expression="split_part(c_name, '#', 2)"),
            FileColumn("twice", "int", expression="int(c_nationkey) * 2"),
        ],
    )
    return load(spark, spec).select("c_custkey", "segment", F.col("n").alias("number"), "twice")


BROKEN = """SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING'"""


def _broken(spark, d, on_error):
    """Balances of one segment are no numbers."""
    path = new_folder(spark, "broken")
    bad = F.col("c_mktsegment") == "BUILDING"
    balance = F.when(bad, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string"))
    _customer(spark, d).select("c_custkey", balance.alias("c_acctbal")).write.csv(path)
    columns = [CUSTOMER_COLUMNS[0], CUSTOMER_COLUMNS[3]]
    return load(spark, FileSource("shop", "c", path, "csv", columns, on_error=on_error))


@sources.add(BROKEN)
def src_bad_rows_skipped(spark, d):
    return _broken(spark, d, "skip")


@sources.add(
    """SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END
         AS c_acctbal FROM customer"""
)
def src_bad_rows_kept(spark, d):
    return _broken(spark, d, "null")


@sources.add("SELECT c_custkey, c_name FROM customer")
def src_whole_row(spark, d):
    """Without declared columns a row is one variant."""
    path = new_folder(spark, "variant")
    _customer(spark, d).write.json(path)
    rows = load(spark, FileSource("shop", "c", path, "json"))
    return rows.select(
        F.variant_get("value", "$.c_custkey", "bigint").alias("c_custkey"),
        F.variant_get("value", "$.c_name", "string").alias("c_name"),
    )


@sources.add(
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderstatus AS order_status,
               CAST(o_totalprice AS DOUBLE) AS total, o_orderdate AS order_date,
               CAST(NULL AS TIMESTAMP) AS carrier_date, o_orderdate AS {EMITTED_AT}
        FROM orders WHERE o_orderdate > TIMESTAMP '1997-06-01'"""
)
def src_envelope(spark, d):
    """Typed columns out of change records, only those after a point in time."""
    path = new_folder(spark, "envelope")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSS")
    payload = F.struct(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderdate").cast("string").alias("order_date"),
    )
    _orders(spark, d).select(
        F.col("o_orderkey").cast("string").alias(RECORD_ID),
        F.concat(stamp, F.lit("+00:00")).alias(EMITTED_AT),
        payload.alias(PAYLOAD),
    ).write.parquet(path)
    columns = {
        "order_id": "string",
        "order_status": "string",
        "total": "double",
        "order_date": "timestamp_ntz",
        "carrier_date": "timestamp_ntz",
    }
    records = spark.read.schema(envelope_schema(columns)).parquet(path)
    return extract(records, columns, since=datetime(1997, 6, 1))


@sources.add(
    """SELECT o_orderkey, 'NATION_' || c_nationkey AS State, c_nationkey AS ID_IBGE
       FROM orders JOIN customer ON o_custkey = c_custkey"""
)
def src_seed(spark, d):
    """A typed CSV lookup joined to the orders."""
    path = new_folder(spark, "seed")
    key = F.col("c_nationkey")
    _customer(spark, d).select(
        F.col("c_custkey").cast("string").alias("UF"),
        F.col("c_name").alias("City"),
        F.concat(F.lit("NATION_"), key).alias("State"),
        key.alias("ID_IBGE"),
    ).write.csv(path, header=True)
    seed = read_cities(spark, path)
    orders = table(spark, d, "orders")
    same = F.col("o_custkey").cast("string") == F.col("UF")
    return orders.join(seed, same).select("o_orderkey", "State", "ID_IBGE")


@sources.add(
    """SELECT c_custkey, c_name AS customer, split_part(c_name, '#', 2) AS number,
              CASE WHEN c_acctbal < 0 THEN 'debt' ELSE 'credit' END AS side
       FROM customer WHERE c_mktsegment <> 'BUILDING'"""
)
def src_staged_view(spark, d):
    """A catalog view over two locations: alias, expression, partition of the path, bad rows left out."""
    path = new_folder(spark, "staged")
    key = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("none"))
    rows = _customer(spark, d).withColumn("c_custkey", F.coalesce(key, F.col("c_custkey").cast("string")))
    for side, chosen in (("debt", F.col("c_acctbal") < 0), ("credit", F.col("c_acctbal") >= 0)):
        rows.filter(chosen).select("c_custkey", "c_name").write.csv(f"{path}/{side}", header=True)
    spec = FileSource(
        "staged",
        "v_" + path.rsplit("-", 1)[1],
        [f"{path}/debt", f"{path}/credit"],
        "csv",
        [
            FileColumn("c_custkey", "bigint"),
            FileColumn("c_name", alias="customer"),
            FileColumn("number", expression="split_part(c_name, '#', 2)"),
        ],
        [FilePartition("side", "string", "element_at(split(filename, '/'), -2)")],
        options=HEADER,
        on_error="skip",
    )
    _database(spark, "staged")
    stage(spark, [spec], full_refresh=True)
    return spark.table(f"staged.{spec.name}")


@sources.add("SELECT * FROM customer")
def src_catalog_refresh(spark, d):
    """A catalog table that sees files and partitions added after it was made."""
    path = new_folder(spark, "staged")
    name = "t_" + path.rsplit("-", 1)[1]
    spec = FileSource(
        "staged",
        name,
        path,
        "csv",
        CUSTOMER_COLUMNS[:4],
        [FilePartition("c_mktsegment")],
        options=HEADER,
    )
    _database(spark, "staged")
    customer = _customer(spark, d)
    in_debt = F.col("c_acctbal") < 0
    writer = customer.filter(in_debt).write.partitionBy("c_mktsegment")
    writer.csv(path, header=True)
    stage(spark, [spec], select=f"staged.{name}")
    late = customer.filter(~in_debt).write.mode("append").partitionBy("c_mktsegment")
    late.csv(path, header=True)
    stage(spark, [spec], select="staged")
    return spark.table(f"staged.{name}")


@sources.add(
    """SELECT *, true AS numbered FROM (SELECT c_custkey, c_name,
         nullif(CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END, '') AS c_mktsegment
       FROM customer) c"""
)
def src_ingest(spark, d):
    """New files only, with file name and row number; empty text is NULL."""
    path, work = new_folder(spark, "inbox"), new_folder(spark, "ingest")
    segment = F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_mktsegment"))
    customer = _customer(spark, d).select(
        "c_custkey", "c_name", segment.alias("c_mktsegment"), "c_acctbal"
    )
    spec = FileSource(
        "shop",
        "c",
        path,
        "json",
        [FileColumn("c_custkey", "bigint"), FileColumn("c_name"), FileColumn("c_mktsegment")],
    )
    rich = F.col("c_acctbal") > 5000
    for part in (customer.filter(rich), customer.filter(~rich)):
        part.drop("c_acctbal").write.mode("append").json(path)
        ingest_files(spark, spec, f"{work}/rows", f"{work}/checkpoint")
    # Loaded files are not loaded again.
    ingest_files(spark, spec, f"{work}/rows", f"{work}/checkpoint")
    rows = read_ingested(spark, f"{work}/rows")
    files = rows.groupBy(FILE_NAME).agg(
        (
            (F.count(F.lit(1)) == F.max(FILE_ROW_NUMBER))
            & (F.count_distinct(FILE_ROW_NUMBER) == F.max(FILE_ROW_NUMBER))
        ).alias("numbered")
    )
    return rows.join(files, FILE_NAME).select(
        "c_custkey", "c_name", "c_mktsegment", "numbered"
    )
