"""What the operators of this package share."""

from __future__ import annotations

import ctypes
import shutil
import tempfile
from contextlib import suppress
from functools import reduce
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.sources.workspace import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Sends this library to the Python workers, once in an application.

    Workers that have it installed lose nothing; others could not unpickle the
    functions of this package.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[1]
        name = f"{tempfile.mkdtemp(prefix='ship-')}/{root.name}"
        context.addPyFile(shutil.make_archive(name, "zip", root.parent, root.name))
        _shipped.add(context.applicationId)


_shipped: set[str] = set()


#: Bytes of rows, about, that a Python worker is sent at once, and the setting that says so.
BATCH_BYTES, BATCH_SETTING = 2 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Has whole texts sent to the Python workers in batches of few bytes.

    Spark sends up to 10,000 rows or 64 MB at once, and both the executor and the worker
    hold a batch several times over. The rows stay the same; a bound that the session
    has set itself stays too.
    """
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


#: The parameter of ``mallopt``, and the bytes from which on a buffer is a mapping of its own.
_MMAP_THRESHOLD, _LARGE = -3, 4 << 20


def give_back() -> None:
    """Returns a Python worker's freed memory to the system.

    Workers are used again, and Spark counts what they hold; the allocators of Arrow
    and of the C library keep what a task has freed. Buffers as large as a batch of
    texts, which is freed after its task's last line, go back by themselves from then on.
    """
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only glibc has the calls
        c = ctypes.CDLL(None)
        c.mallopt(_MMAP_THRESHOLD, _LARGE)
        c.malloc_trim(0)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared folder and read back.

    Cuts the lineage: what follows reads files that every machine sees, so a lost
    executor costs the rereading of its splits and nothing before them.
    """
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold_of(doc_id: str = "doc_id") -> Column:
    """crc32 of the id's decimal digits, modulo 4; NULL for a NULL id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the rows that no classifier may learn labels from."""
    return F.coalesce(fold_of(doc_id) == 2, F.lit(False))


def matched(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
    """Rows of both sides where all named columns agree, NULL with NULL; named ones once."""
    left, right = left.alias("l"), right.alias("r")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in names]
    rest = [F.col(f"r.{c}") for c in right.columns if c not in names]
    return left.join(right, reduce(Column.__and__, same)).select("l.*", *rest)


def running(
    rows: DataFrame, by: list[str], order: list[Column], amount: Column, name: str
) -> DataFrame:
    """Adds the sum of ``amount`` over a group's earlier rows, and over all of them.

    The columns are called ``name`` and ``name_total``; ``by`` names the group, NULL
    being one. No task holds a group: the rows are cut into sorted ranges, rows of
    equal order too, each range is summed on its own and shifted by the ranges before
    it, of which there are as many as shuffle partitions. Rows of equal order come in
    the order of their partition.
    """
    parts = parallelism(rows.sparkSession)
    tied = rows.withColumns({"__amount": amount.cast("bigint"), "__tie": F.monotonically_increasing_id()})
    order = [*order, F.col("__tie")]
    ranged = tied.repartitionByRange(parts, *[F.col(c) for c in by], *order)
    ranged = written(ranged.withColumn("__part", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy("__part", *by).agg(F.sum("__amount").alias("__sum"))
    group = Window.partitionBy(*by)
    earlier = (Window.unboundedPreceding, -1)
    shifts = sums.select(
        "__part",
        *by,
        F.sum("__sum").over(group.orderBy("__part").rowsBetween(*earlier)).alias("__before"),
        F.sum("__sum").over(group).alias(f"{name}_total"),
    )
    inside = Window.partitionBy("__part", *by).orderBy(*order).rowsBetween(*earlier)
    summed = ranged.withColumn("__inside", F.coalesce(F.sum("__amount").over(inside), F.lit(0)))
    place = F.coalesce("__before", F.lit(0)) + F.col("__inside")
    return matched(summed, shifts, ["__part", *by]).select(
        *rows.columns, place.alias(name), f"{name}_total"
    )


def first_by_hash(rows: DataFrame, group: str, id_col: str, n: int) -> DataFrame:
    """The ``n`` rows of each group whose ids have the smallest hashes.

    A histogram of the hashes, of at most ``2 ** 16`` bins a group, tells below which
    bin they all lie; only the rows below it are ordered.
    """
    placed = rows.withColumn("__hash", F.xxhash64(id_col))
    placed = placed.withColumn("__bin", F.shiftright("__hash", 48))
    bins = placed.groupBy(group, "__bin").agg(F.count(F.lit(1)).alias("__n"))
    upward = Window.partitionBy(group).orderBy("__bin")
    reached = F.when(F.sum("__n").over(upward) >= n, F.col("__bin"))
    bins = bins.withColumn("__reached", reached).groupBy(group)
    ends = bins.agg(F.coalesce(F.min("__reached"), F.max("__bin")).alias("__end"))
    # One row a class: a classifier holds far more for each of its classes.
    few = placed.join(F.broadcast(ends), group).where(F.col("__bin") <= F.col("__end"))
    first = Window.partitionBy(group).orderBy("__hash", id_col)
    few = few.withColumn("__place", F.row_number().over(first))
    return few.where(F.col("__place") <= n).select(*rows.columns)
