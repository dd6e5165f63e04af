"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemart.constants import KEY_NULL
from tidemart.functions.scalar import ColumnOrName, column


def surrogate_key(
    fields: Sequence[ColumnOrName], nulls_as_empty: bool = False
) -> Column:
    """MD5 over the text of the fields joined by ``-``; NULL has its own text."""
    null_text = F.lit("" if nulls_as_empty else KEY_NULL)
    parts = [F.coalesce(column(f).cast("string"), null_text) for f in fields]
    return F.md5(F.concat_ws("-", *parts))
