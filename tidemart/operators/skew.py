"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SALT = "__salt"
_HASH = "__hash"

# Any key with a larger share of the rows than this is found; so at most
# 1 / HOT_SHARE hashes are ever held on the driver.
HOT_SHARE = 0.01
FEWEST_SALTS = 64


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def hot_keys(
    df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE
) -> list[int]:
    """Hashes of the keys that hold more than ``share`` of the rows.

    A first pass over the key columns keeps a bounded sketch per task and misses
    no such key; a second one counts the candidates exactly. At most
    ``1 / share`` hashes come back.
    """
    hashes = df.select(_hash(keys).alias(_HASH))
    row = hashes.stat.freqItems([_HASH], share).first()
    candidates = list(row[0] or []) if row else []
    if not candidates:
        return []
    candidate = F.when(F.col(_HASH).isin(*candidates), F.col(_HASH))
    counts = {
        r["h"]: r["n"]
        for r in hashes.groupBy(candidate.alias("h"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    }
    total = sum(counts.values())
    return sorted(h for h, n in counts.items() if h is not None and n > share * total)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    hot: Sequence[int] | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Equi-join whose hot left keys are spread over ``salts`` partitions.

    By default there are as many salts as shuffle partitions, so that a key of any
    share is dealt over all tasks; at least ``FEWEST_SALTS``.
    Only the right rows of the hot keys are repeated, once per salt. Meant for a
    right side that is already grouped or ranked by the key: the runtime skew
    handling of Spark splits plain shuffles only. ``how`` is ``inner``,
    ``left``, ``left_semi`` or ``left_anti``; ``hot`` comes from ``hot_keys``.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    for k in keys:
        # Equal keys must have equal hashes.
        if left.schema[k].dataType != right.schema[k].dataType:
            raise ValueError(f"{k} has different types on the two sides")
    hot = hot_keys(left, keys) if hot is None else hot
    if not hot:
        return left.join(right, list(keys), how)

    if salts is None:
        partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salts = max(FEWEST_SALTS, partitions)
    is_hot = _hash(keys).isin(*hot)
    zero = F.lit(0).cast("bigint")
    # A function of the row and its partition: a repeated task gives the same salt,
    # and equal rows of different partitions get different ones.
    many = F.lit(salts).cast("bigint")
    row_salt = F.pmod(F.pmod(_hash(left.columns), many) + F.spark_partition_id(), many)
    salted_left = left.withColumn(_SALT, F.when(is_hot, row_salt).otherwise(zero))
    copies = F.when(
        is_hot, F.sequence(zero, F.lit(salts - 1).cast("bigint"))
    ).otherwise(F.array(zero))
    salted_right = right.withColumn(_SALT, F.explode(copies))
    return salted_left.join(salted_right, [*keys, _SALT], how).drop(_SALT)
