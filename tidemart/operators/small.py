"""Joins with a side that was counted and found small.

Spark decides on a broadcast by itself, but for a filtered or computed side only
after both sides have been shuffled. An increment is small next to its table, so
its rows and bytes are counted first, and the table then stays where it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Most rows, and most bytes of them as text, that are sent to every executor.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 << 20
# What a value takes besides its text.
_VALUE_BYTES = 8


def _row_bytes(df: DataFrame) -> Column:
    size = F.lit(_VALUE_BYTES)
    for name in df.columns:
        quoted = "`" + name.replace("`", "``") + "`"
        text = F.octet_length(F.col(quoted).cast("string"))
        size = size + F.coalesce(text, F.lit(0)) + F.lit(_VALUE_BYTES)
    return size


def fits_broadcast(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """Whether the table has at most ``max_rows`` rows of ``max_bytes`` together.

    Every task counts its own rows, and one row of each meets the others.
    """
    rows, size = df.agg(F.count(F.lit(1)), F.sum(_row_bytes(df))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """The table, marked for a broadcast if it has few enough rows and bytes."""
    return F.broadcast(df) if fits_broadcast(df) else df


def reduced_to_keys(df: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is wanted, if the wanted keys are few; else all rows.

    For use in front of an operator that only looks at wanted keys anyway.
    """
    wanted = wanted.select(*keys).distinct()
    if not fits_broadcast(wanted):
        return df
    return df.join(F.broadcast(wanted), list(keys), "left_semi")
