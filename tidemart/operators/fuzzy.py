"""Matching of free-text city names to an official list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.similarity import (
    BOOST_ABOVE,
    PREFIX_LENGTH,
    PREFIX_WEIGHT,
    jaro_winkler,
)
from tidemart.operators.small import fits_broadcast

# Copies of an official list that is too long for a broadcast.
SHUFFLE_SALTS = 64


def _may_reach(left: Column, right: Column, threshold: float) -> Column:
    """Cheap necessary condition for a similarity of ``threshold``.

    A common start lifts a score by at most ``PREFIX_LENGTH * PREFIX_WEIGHT`` of
    what is missing to 1, and only above ``BOOST_ABOVE``; without one the plain
    Jaro score must reach the threshold. That score is bounded by the characters
    of each name that occur in the other at all.
    """
    aim = threshold / 100.0
    lift = PREFIX_LENGTH * PREFIX_WEIGHT
    lifted = min(aim, max(BOOST_ABOVE, (aim - lift) / (1 - lift)))
    same_start = F.left(left, F.lit(1)) == F.left(right, F.lit(1))
    least = F.when(same_start, F.lit(lifted)).otherwise(F.lit(aim))

    def shared(a: Column, b: Column) -> Column:
        return F.length(a) - F.length(F.call_function("translate", a, b, F.lit("")))

    common = F.least(shared(left, right), shared(right, left))
    bound = common / F.length(left) + common / F.length(right) + 1
    return (
        (F.length(left) > 0)
        & (F.length(right) > 0)
        & (bound >= 3 * least - F.lit(1e-9))
    )


def best_city_match(
    places: DataFrame, cities: DataFrame, threshold: float = 80.0
) -> DataFrame:
    """Best official city for each distinct (city, state) of ``places``.

    ``places`` has ``city`` and ``state``; ``cities`` has ``City``, ``UF`` and
    ``State``. The result has one row per place with a match: the lower-cased
    ``city`` and upper-cased ``state`` it was found for, the standardized names
    and ``match_score`` (0 to 100). Equal scores go to the first name.

    Similarity is computed once per distinct pair of names, not once per row,
    and only within a state. Losing candidates are dropped by an aggregate
    before the exchange.
    """
    spark = places.sparkSession
    names = (
        places.select(F.lower("city").alias("city"), F.upper("state").alias("state"))
        .distinct()
        # Few bytes but much work per row: an explicit number keeps the names
        # from being packed into a handful of tasks by size.
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "city", "state")
    )
    official = cities.select(
        F.upper("UF").alias("state"),
        F.lower("City").alias("standardized_city"),
        F.col("State").alias("full_state_name"),
    ).distinct()

    if fits_broadcast(official):
        pairs = names.join(
            F.broadcast(official),
            (names["state"] == official["state"])
            & _may_reach(names["city"], official["standardized_city"], threshold),
        )
    else:
        # A state may hold a large part of the places: spread its places over
        # salts and repeat the list once per salt.
        salted = names.withColumn(
            "salt", F.pmod(F.xxhash64("city"), F.lit(SHUFFLE_SALTS)).cast("int")
        )
        repeated = official.withColumn(
            "salt", F.explode(F.sequence(F.lit(0), F.lit(SHUFFLE_SALTS - 1)))
        )
        names, official = salted, repeated
        pairs = names.join(
            official,
            (names["state"] == official["state"])
            & (names["salt"] == official["salt"])
            & _may_reach(names["city"], official["standardized_city"], threshold),
        )

    scored = pairs.select(
        names["city"],
        names["state"],
        "standardized_city",
        "full_state_name",
        (jaro_winkler(names["city"], F.col("standardized_city")) * 100).alias(
            "match_score"
        ),
    ).filter(F.col("match_score") >= threshold)
    # Smallest (-score, name) wins.
    best = F.min(
        F.struct(
            (-F.col("match_score")).alias("s"), "standardized_city", "full_state_name"
        )
    )
    return (
        scored.groupBy("city", "state")
        .agg(best.alias("best"))
        .select(
            "city",
            "state",
            "best.standardized_city",
            F.col("state").alias("standardized_state_code"),
            "best.full_state_name",
            (-F.col("best.s")).alias("match_score"),
        )
    )
