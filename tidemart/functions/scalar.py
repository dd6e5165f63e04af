"""Null-safe arithmetic, banding and small predicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_, sub

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _zero_if_null(fields: Sequence[ColumnOrName]) -> list[Column]:
    if isinstance(fields, str) or not fields:
        raise ValueError("expected a non-empty list of columns")
    return [F.coalesce(column(f), F.lit(0)) for f in fields]


def safe_add(fields: Sequence[ColumnOrName]) -> Column:
    """Sum of the fields, NULL counted as 0."""
    return reduce(add, _zero_if_null(fields))


def safe_subtract(fields: Sequence[ColumnOrName]) -> Column:
    """First field minus the others from left to right, NULL counted as 0."""
    return reduce(sub, _zero_if_null(fields))


def safe_divide(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """Quotient; NULL where the denominator is 0 or NULL."""
    return F.try_divide(column(numerator), column(denominator))


def width_bucket(
    value: ColumnOrName, low: float, high: float, buckets: int
) -> Column:
    """Equal-width bucket 1..n, 0 below ``low``, n+1 from ``high`` on."""
    return F.width_bucket(
        column(value).cast("double"),
        F.lit(float(low)),
        F.lit(float(high)),
        F.lit(buckets),
    )


def installment_level(installments: ColumnOrName) -> Column:
    """LOW for one, MEDIUM below four (0 and negatives too), else HIGH."""
    n = column(installments)
    return F.when(n == 1, "LOW").when(n < 4, "MEDIUM").otherwise("HIGH")


def installment_value(value: ColumnOrName, installments: ColumnOrName) -> Column:
    """Value per installment; the whole value when there are none."""
    v, n = column(value), column(installments)
    return F.when(n > 0, v / n).otherwise(v)


def is_present(*fields: ColumnOrName) -> Column:
    """True if any of the fields is not NULL."""
    return reduce(or_, [column(f).isNotNull() for f in fields])


def not_blank(c: ColumnOrName) -> Column:
    return F.length(F.trim(column(c))) > 0


def null_text_to_null(c: ColumnOrName) -> Column:
    """The text ``null`` in any case becomes NULL."""
    c = column(c)
    return F.when(F.lower(c) != "null", c)
