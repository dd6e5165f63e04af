"""Operators on data in which one key holds a large part of the rows."""

import pytest
from pyspark.sql import functions as F

from tidemart.operators.fuzzy import best_city_match
from tidemart.operators import fuzzy
from tidemart.operators.neighbours import REPEAT_BLOCK, repeat_rows
from tidemart.operators.skew import hot_keys, salted_join
from tidemart.plans.silver import geolocation_silver


@pytest.fixture
def skewed(spark):
    k = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500)
    return spark.range(6000).select("id", k.cast("bigint").alias("k"))


def test_hot_key_is_found(spark, skewed):
    seven = spark.range(1).select(F.xxhash64(F.lit(7).cast("bigint"))).first()[0]
    assert seven in hot_keys(skewed, ["k"])
    assert len(hot_keys(skewed, ["k"])) <= 101


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_is_exact(spark, skewed, how):
    left = skewed.withColumn("k", F.when(F.col("id") % 10 != 1, F.col("k")))
    right = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    want = left.join(right, "k", how)
    got = salted_join(left, right, ["k"], how, salts=8)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_salted_join_spreads_the_hot_key(spark, skewed):
    right = spark.range(500).select(F.col("id").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(skewed, right, ["k"], salts=32)
        hot = joined.filter("k = 7").groupBy(F.spark_partition_id().alias("p")).count()
        assert hot.count() > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_equal_rows_of_a_hot_key_are_spread(spark):
    left = spark.range(0, 4000, 1, 16).select(F.lit(7).cast("bigint").alias("k"))
    right = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(left, right, ["k"])
        parts = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in parts) == 4000
    assert len(parts) > 2


def test_salted_join_wants_equal_types(spark, skewed):
    right = spark.range(5).select(F.col("id").cast("int").alias("k"))
    with pytest.raises(ValueError):
        salted_join(skewed, right, ["k"])
    with pytest.raises(ValueError):
        salted_join(skewed, skewed, ["k"], "full")


@pytest.mark.parametrize("n", [0, 1, REPEAT_BLOCK, REPEAT_BLOCK + 1, 3 * REPEAT_BLOCK])
def test_repeat_rows(spark, n):
    df = spark.range(1).select(F.lit(n).cast("bigint").alias("n"))
    assert repeat_rows(df, F.col("n")).count() == n


def test_places_have_one_row_whatever_their_size(spark):
    points = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, F.lit("1")).otherwise(F.col("id").cast("string")).alias("geolocation_zip_code_prefix"),
        F.col("id").cast("double").alias("geolocation_lat"),
        F.lit(1.0).alias("geolocation_lng"),
        F.lit("x").alias("standardized_city"),
        F.lit("SP").alias("standardized_state_code"),
        F.lit(None).cast("string").alias("full_state_name"),
    )
    found = {r.geolocation_zip_code_prefix: r for r in geolocation_silver(points).collect()}
    # Ids not divisible by 3 are places of their own, but for id 1 of place "1".
    assert len(found) == geolocation_silver(points).count() == 666
    lats = [i for i in range(1000) if i % 3 == 0 or i == 1]
    assert found["1"].n_coordinates == len(lats)
    assert found["1"].centroid_lat == pytest.approx(sum(lats) / len(lats))
    assert found["2"].n_coordinates == 1


CITIES = [("SP", "São Paulo"), ("SP", "Mauá"), ("SP", "Santos"), ("BA", "Barreiras"), ("MG", "Belo Horizonte")]


def test_city_match_without_broadcast_is_the_same(spark, monkeypatch):
    cities = spark.createDataFrame([(u, c, f"State {u}", i) for i, (u, c) in enumerate(CITIES)], "UF string, City string, State string, ID_IBGE int")
    places = spark.createDataFrame(
        [("sao paulo", "sp"), ("SÃO PAULO", "SP"), ("maua", "SP"), ("barreira", "BA"), ("belo horisonte", "MG"), ("santos", "MG"), ("", "SP"), (None, "SP"), ("xyz", "SP")],
        "city string, state string",
    )
    small = sorted(tuple(r) for r in best_city_match(places, cities).collect())
    assert [(r[0], r[2]) for r in small] == [
        ("barreira", "barreiras"),
        ("belo horisonte", "belo horizonte"),
        ("maua", "mauá"),
        ("sao paulo", "são paulo"),
        ("são paulo", "são paulo"),
    ]
    monkeypatch.setattr(fuzzy, "fits_broadcast", lambda df: False)
    assert sorted(tuple(r) for r in best_city_match(places, cities).collect()) == small


def test_no_match_is_lost_by_the_cheap_filter(spark):
    names = spark.read.parquet("/root/testdata/sf0.001/part.parquet").select("p_name", "p_type").distinct()
    a = names.select(F.col("p_name").alias("a"))
    b = names.select(F.col("p_name").alias("b"))
    from tidemart.functions.similarity import jaro_winkler

    for threshold in (60.0, 72.0, 80.0, 95.0):
        pairs = a.distinct().join(b.distinct(), F.length("a") > 0)
        score = jaro_winkler(F.col("a"), F.col("b")) * 100
        lost = pairs.filter((score >= threshold) & ~fuzzy._may_reach(F.col("a"), F.col("b"), threshold))
        assert lost.count() == 0
