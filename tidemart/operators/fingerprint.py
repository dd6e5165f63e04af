"""Large tables compared by order-free fingerprints of buckets of their rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

#: Groups into which the rows are dealt; a task sends at most so many on.
BUCKETS = 4096
_BUCKET, _SIGN = "__bucket", "__sign"
_LOW = 0xFFFFFFFF


def _halves(value: Column) -> list[Column]:
    """A 64-bit hash as two numbers whose sums over many rows cannot overflow."""
    return [value.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(value, 32)]


def unequal_rows(both: DataFrame, names: Sequence[str], ours: Column) -> DataFrame:
    """The rows of two tables, one below the other, that lie in unequal buckets.

    ``ours`` tells which table a row is from. Rows are dealt into ``BUCKETS`` by a hash
    of the named columns. Where both tables have the same number of rows in a bucket
    and the same four sums of hashes, 128 bits together, the bucket's rows are taken as
    the same with the same multiplicity and left out. What is left has all rows in
    which the tables differ, and rows of the same buckets, to be compared one by one.

    One pass over both tables that shuffles a row for each task and bucket; at most
    ``BUCKETS`` numbers come to the driver. Equal tables leave no row, so nothing else
    is shuffled for them. Tables with a nested column among the named ones are returned
    whole, as hashes pass over the NULLs inside it.
    """
    if any(isinstance(both.schema[n].dataType, (ArrayType, MapType, StructType)) for n in names):
        return both
    columns = [F.col("`" + n.replace("`", "``") + "`") for n in names]
    # A hash passes over NULLs: where they are is hashed too.
    columns += [c.isNull() for c in columns]
    one, two = F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)
    bucket = F.pmod(one, F.lit(BUCKETS)).cast("int")
    parts = {f"__h{i}": h for i, h in enumerate([*_halves(one), *_halves(two)])}
    hashed = both.select(
        F.when(ours, F.lit(1)).otherwise(F.lit(-1)).cast("bigint").alias(_SIGN),
        bucket.alias(_BUCKET),
        *[h.alias(name) for name, h in parts.items()],
    )
    sums = [F.sum(_SIGN).alias("__n")]
    sums += [F.sum(F.col(_SIGN) * F.col(name)).alias(name) for name in parts]
    differing = F.lit(False)
    for name in ("__n", *parts):
        differing = differing | (F.col(name) != 0)
    found = hashed.groupBy(_BUCKET).agg(*sums).filter(differing).select(_BUCKET)
    buckets = [r[0] for r in found.collect()]
    if len(buckets) == BUCKETS:
        return both
    return both.filter(bucket.isin(buckets) if buckets else F.lit(False))
