"""Jaro-Winkler similarity as a native column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published measure.
PREFIX_LENGTH = 4
PREFIX_WEIGHT = 0.1
BOOST_ABOVE = 0.7

# Marks an already matched character; a Unicode non-character, so it is never
# part of a name.
_USED = "￿"


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable.

    Higher-order functions have no common-subexpression elimination, so a value
    used inside another lambda would otherwise be recomputed per element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def _match(a: Column, b: Column, window: Column) -> Column:
    """Greedy matching of the characters of ``a`` inside ``b``.

    Returns a struct: ``left`` are the matched characters of ``a`` in order and
    ``rest`` is ``b`` with every matched character replaced by the marker.
    """
    start = F.struct(F.lit("").alias("left"), b.alias("rest"))

    def step(acc: Column, i: Column) -> Column:
        ch = F.substring(a, i, F.lit(1))
        low = F.greatest(i - window, F.lit(1))
        at = F.instr(F.substring(acc["rest"], low, i + window - low + 1), ch)
        return _bind(
            at,
            lambda at: F.when(at == 0, acc).otherwise(
                F.struct(
                    F.concat(acc["left"], ch).alias("left"),
                    F.overlay(
                        acc["rest"], F.lit(_USED), low + at - 1, F.lit(1)
                    ).alias("rest"),
                )
            ),
        )

    return F.aggregate(F.sequence(F.lit(1), F.length(a)), start, step)


def _count_where(positions: Column, test: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(positions, test))


def _jaro(left: Column, right: Column, found: Column) -> Column:
    la, lb, m = F.length(left), F.length(right), F.length(found["left"])
    # Characters of the right side that were matched, in their own order.
    taken = F.array_join(
        F.transform(
            F.filter(
                F.sequence(F.lit(1), lb),
                lambda p: F.substring(found["rest"], p, F.lit(1)) == _USED,
            ),
            lambda p: F.substring(right, p, F.lit(1)),
        ),
        "",
    )
    moved = _bind(
        taken,
        lambda taken: F.when(taken == found["left"], F.lit(0)).otherwise(
            _count_where(
                F.sequence(F.lit(1), m),
                lambda p: F.substring(found["left"], p, F.lit(1))
                != F.substring(taken, p, F.lit(1)),
            )
        ),
    )
    return F.when(m == 0, F.lit(0.0)).otherwise(
        (m / la + m / lb + (m - F.floor(moved / 2)) / m) / 3
    )


def _common_prefix(left: Column, right: Column) -> Column:
    """Length of the common start, at most ``PREFIX_LENGTH``."""
    same = F.lit(0)
    for n in range(1, PREFIX_LENGTH + 1):
        same = F.when(
            (F.length(left) >= n) & (F.left(left, F.lit(n)) == F.left(right, F.lit(n))),
            F.lit(n),
        ).otherwise(same)
    return same


def jaro_winkler(left: Column, right: Column) -> Column:
    """Similarity in 0.0 .. 1.0; NULL if a side is NULL, 0 if a side is empty."""
    la, lb = F.length(left), F.length(right)
    window = F.greatest(F.floor(F.greatest(la, lb) / 2) - 1, F.lit(0)).cast("int")

    boosted = _bind(
        _bind(
            _match(left, right, window),
            lambda found: _jaro(left, right, found),
        ),
        lambda jaro: F.when(
            jaro > BOOST_ABOVE,
            jaro + _common_prefix(left, right) * PREFIX_WEIGHT * (1 - jaro),
        ).otherwise(jaro),
    )
    return (
        F.when(left.isNull() | right.isNull(), F.lit(None).cast("double"))
        .when((la == 0) | (lb == 0), F.lit(0.0))
        .when(left == right, F.lit(1.0))
        .otherwise(boosted)
    )
