"""Keyed upsert and the high-watermark filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tidemart.functions.calendar import clock_time


class DuplicateKeys(ValueError):
    """The batch holds more than one row for a key."""


def require_unique(batch: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key occurs twice; looks at one offending key at most."""
    twice = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    row = twice.limit(1).first()
    if row is not None:
        raise DuplicateKeys(f"key {row.asDict()} is not unique in the batch")


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    batch_keys: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``batch`` replace the target rows with the same key.

    The batch has one row per key, so the key list needs no DISTINCT. It may be
    given as ``batch_keys``, for example marked for a broadcast.
    """
    replaced = batch.select(*keys) if batch_keys is None else batch_keys
    kept = target.join(replaced, list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(batch)


def high_watermark(target: DataFrame | None, name: str):
    """Largest value of a column, None for a missing or empty table."""
    return None if target is None else target.agg(F.max(name)).first()[0]


def newer_than(df: DataFrame, name: str, mark) -> DataFrame:
    """Rows strictly after the mark; all rows when there is none.

    The mark is a literal, so the filter reaches the file scan. Rows at or
    before it are left out for good, late ones too.
    """
    if mark is None:
        return df
    zoneless = df.schema[name].dataType == TimestampNTZType()
    return df.filter(F.col(name) > (clock_time(mark) if zoneless else F.lit(mark)))
