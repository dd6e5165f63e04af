"""Previous and next value over any number of rows, also in one huge group.

A window over the whole table, or over one group with a third of it, runs in a
single task. Here the distinct values are cut into sorted ranges first, each
range is ranked by its own task, and only the ends of the ranges meet again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANGE, _EDGE, _PLACE, _BLOCK = "__range", "__edge", "__place", "__block"
COPIES = "__copies"

# Rows made per array while repeating a row; bounds the memory of a task.
REPEAT_BLOCK = 65_536


def with_neighbour(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    direction: int,
    keep: Callable[[Column], Column],
    ranges: int | None = None,
) -> DataFrame:
    """Distinct (groups, order) rows with the neighbouring ``value`` as ``out``.

    ``direction`` is +1 for the next row and -1 for the previous one, in
    ascending order with NULL last. Equal rows are united first and counted in
    ``COPIES``: between copies the neighbour is the row itself. ``out`` is a
    struct, NULL where there is no neighbour. Only rows for which ``keep(out)``
    holds are returned.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [*groups, *order]
    step = F.lead if direction > 0 else F.lag

    def ascending() -> list[Column]:
        return [F.col(c).asc_nulls_last() for c in order]

    units = df.groupBy(*names).agg(F.count(F.lit(1)).alias(COPIES))
    # An explicit number keeps the ranges from being merged back into one.
    ranged = units.repartitionByRange(
        ranges, *[F.col(c).asc_nulls_last() for c in names]
    ).withColumn(_RANGE, F.spark_partition_id())

    inside = Window.partitionBy(_RANGE, *groups).orderBy(*ascending())
    # A pair of neighbours: presence is told apart from a NULL value.
    near = ranged.select(
        "*",
        step(F.struct(F.col(value))).over(inside).alias(out),
        F.lag(F.lit(1)).over(inside).isNull().alias("__first"),
        F.lead(F.lit(1)).over(inside).isNull().alias("__last"),
    ).withColumn(_EDGE, F.col("__first") | F.col("__last"))

    # Rows inside a range know their neighbour; those not wanted stop here.
    near = near.filter(F.col(_EDGE) | keep(F.col(out)))

    # Second meeting: the two ends of each range together per group, all other
    # rows stay spread over their ranges.
    place = F.when(F.col(_EDGE), F.lit(-1)).otherwise(F.col(_RANGE))
    across = Window.partitionBy(*groups, _EDGE, _PLACE).orderBy(_RANGE, *ascending())
    waiting = F.col("__last") if direction > 0 else F.col("__first")
    return (
        near.withColumn(_PLACE, place)
        .withColumn("__far", step(F.struct(F.col(value))).over(across))
        .withColumn(
            out,
            F.when(F.col(_EDGE) & waiting, F.col("__far")).otherwise(F.col(out)),
        )
        .filter(keep(F.col(out)))
        .drop("__far", "__first", "__last", _RANGE, _EDGE, _PLACE)
    )


def repeat_rows(df: DataFrame, times: Column) -> DataFrame:
    """Each row ``times`` times, built block by block.

    The blocks of a row are spread over the tasks before they are filled.
    """
    names = df.columns
    blocks = F.sequence(F.lit(0), F.floor((times - 1) / REPEAT_BLOCK).cast("int"))
    in_block = F.least(
        F.lit(REPEAT_BLOCK).cast("bigint"),
        times - F.col(_BLOCK).cast("bigint") * REPEAT_BLOCK,
    ).cast("int")
    return (
        df.filter(times > 0)
        .withColumn(_BLOCK, F.explode(blocks))
        .repartition(*[F.col(f"`{c}`") for c in names], _BLOCK)
        .withColumn(_BLOCK, F.explode(F.array_repeat(F.lit(True), in_block)))
        .drop(_BLOCK)
    )
