"""Latest row per key, the reduction behind every change-log table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from tidemart.functions.scalar import ColumnOrName

_RANK = "__rank"


def _sortable(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _sortable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_sortable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (MapType, VariantType))


def _tie_breakers(df: DataFrame, used: set[str]) -> list[Column]:
    """Every remaining sortable column, so equal times still give one answer."""
    return [
        F.col(f"`{f.name}`").desc_nulls_last()
        for f in df.schema.fields
        if f.name not in used and _sortable(f.dataType)
    ]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: ColumnOrName | Sequence[ColumnOrName],
    tie_breakers: Sequence[ColumnOrName] | None = None,
) -> DataFrame:
    """Keep one row per key: the first one in ``order_by``.

    A plain name means descending with NULL first, the order of the source
    warehouse; pass a Column for any other order. Rows equal in ``order_by`` are
    told apart by ``tie_breakers``, by default all other columns.

    Spark plans a group limit before the exchange, so a task ships at most one
    row per key and a key with very many versions does not load one reducer.
    """
    if isinstance(order_by, (str, Column)):
        order_by = [order_by]
    order = [
        F.col(c).desc_nulls_first() if isinstance(c, str) else c for c in order_by
    ]
    if tie_breakers is None:
        used = {*keys, *(c for c in order_by if isinstance(c, str))}
        order += _tie_breakers(df, used)
    else:
        order += [
            F.col(c).desc_nulls_last() if isinstance(c, str) else c
            for c in tie_breakers
        ]
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)
