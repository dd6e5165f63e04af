"""Reshaping operators against golden tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidemart.operators import generate as g
from tidemart.operators import reshape as r
from tidemart.operators.latest import latest_per_key


@pytest.fixture
def sizes(spark):
    return spark.createDataFrame(
        [("oak", "saw"), ("oak", "axe"), ("oak", "axe's"), ("elm", "saw")], "wood string, tool string"
    )


def test_deduplicate(spark, rows):
    df = spark.createDataFrame([("pier", 30, 1), ("pier", 40, 5), ("dock", 10, 9), ("pier", 20, 3)], "place string, depth int, seen int")
    latest = latest_per_key(df, ["place"], "seen")
    assert rows(latest) == [("dock", 10, 9), ("pier", 40, 5)]


def test_latest_puts_null_time_first_and_breaks_ties(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", None, "y"), ("b", 2, "x"), ("b", 2, "y")], "k string, t int, v string"
    )
    assert rows(latest_per_key(df, ["k"], "t")) == [("a", None, "y"), ("b", 2, "y")]
    again = latest_per_key(latest_per_key(df, ["k"], "t"), ["k"], "t")
    assert rows(again) == [("a", None, "y"), ("b", 2, "y")]


def test_latest_ships_one_row_per_key_and_task(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = latest_per_key(df, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange") :]
    assert "WindowGroupLimit" in below


def test_pivot(sizes, rows):
    df = sizes.groupBy("wood").agg(*r.pivot_columns("tool", ["saw", "axe", "axe's"]))
    assert df.columns == ["wood", "saw", "axe", "axe's"]
    assert rows(df) == [("elm", 1, 0, 0), ("oak", 1, 1, 1)]


def test_pivot_names_and_errors(sizes):
    df = sizes.groupBy("wood").agg(
        *r.pivot_columns("tool", ["axe's"], prefix="1 ", quote_identifiers=False)
    )
    assert df.columns == ["wood", "_1_axes"]
    with pytest.raises(ValueError):
        r.pivot_columns("tool", ["saw"], agg="median")


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [
            (123, "2017-01-01", "active", "tier 1", True),
            (234, "2017-02-01", "active", "tier 3", False),
            (567, "2017-03-01", "churned", "tier 2", None),
        ],
        "customer_id int, created_at string, status string, segment string, is_updated boolean",
    )


def test_unpivot_keeps_nulls_and_booleans(people, rows):
    df = r.unpivot(people, exclude=["CUSTOMER_ID", "created_at"], field_name="prop", value_name="val")
    assert df.columns == ["customer_id", "created_at", "prop", "val"]
    assert df.count() == 9
    third = rows(df.filter("customer_id = 567"), "prop", "val")
    assert third == [("is_updated", None), ("segment", "tier 2"), ("status", "churned")]
    first = rows(df.filter("customer_id = 123 and prop = 'is_updated'"), "val")
    assert first == [("true",)]


def test_unpivot_and_pivot_are_inverse(people, rows):
    long = r.unpivot(people.drop("created_at"), exclude=["customer_id"])
    wide = long.groupBy("customer_id").pivot("field_name", ["status", "segment", "is_updated"]).agg(F.first("value"))
    back = wide.withColumn("is_updated", F.col("is_updated").cast("boolean"))
    assert rows(back) == rows(people.drop("created_at"))


@pytest.fixture
def unlike(spark):
    return {
        "t1": spark.createDataFrame([(1, "dora", "pi"), (2, "bob", "e"), (3, "alice", "4")], "id int, name string, favorite_number string"),
        "t2": spark.createDataFrame([(1, "green", "7"), (2, "pink", "13")], "id int, favorite_color string, favorite_number string"),
    }


def test_union(unlike, rows):
    df = r.union_relations(unlike, source_column_name=None)
    assert df.columns == ["id", "name", "favorite_number", "favorite_color"]
    assert rows(df, "id", "name", "favorite_color", "favorite_number") == sorted(
        [(1, "dora", None, "pi"), (2, "bob", None, "e"), (3, "alice", None, "4"), (1, None, "green", "7"), (2, None, "pink", "13")],
        key=repr,
    )


def test_union_options(unlike, rows):
    df = r.union_relations(unlike, exclude=["NAME"], where="id = 1", column_override={"id": "bigint"})
    assert df.columns == ["_dbt_source_relation", "id", "favorite_number", "favorite_color"]
    assert dict(df.dtypes)["id"] == "bigint"
    assert rows(df) == [("t1", 1, "pi", None), ("t2", 1, "7", "green")]
    with pytest.raises(ValueError):
        r.union_relations(unlike, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        r.union_relations(unlike, include=["nothing"])


def test_union_of_catalog_tables_by_prefix(spark, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS logs")
    for day, data in [("20180101", [(1, "play")]), ("20180102", [(2, "pause")]), ("2018_skip", [(9, "x")])]:
        df = spark.createDataFrame(data, "user_id int, event string")
        df.write.mode("overwrite").saveAsTable(f"logs.data_events_{day}")
    found = r.tables_by_prefix(spark, "LOGS", "Data_events_", exclude="%skip")
    assert sorted(found) == ["logs.data_events_20180101", "logs.data_events_20180102"]
    assert rows(r.union_relations(found, source_column_name=None)) == [(1, "play"), (2, "pause")]


def test_value_profile(spark):
    df = spark.createDataFrame([(v,) for v in "abcdefggggg"] + [(None,)], "field string")
    assert [x.value for x in r.value_profile(df, "field", max_records=3).collect()] == ["g", "a", "b"]
    assert r.value_profile(df, "field").filter("value is null").first().n_rows == 1
    by_name = r.value_profile(df, "field", order_by=F.col("value").desc_nulls_last(), where="field < 'c'")
    assert [x.value for x in by_name.collect()] == ["b", "a"]


def test_column_values_of_a_missing_table(spark):
    df = r.column_values(spark, "no.such_table", "x", default=["b", "a"])
    assert [x.value for x in df.collect()] == ["b", "a"]
    with pytest.raises(ValueError):
        r.column_values(spark, "no.such_table", "x")
    spark.range(3).withColumn("v", F.lit("same")).write.mode("overwrite").saveAsTable("some_values")
    assert [x.value for x in r.column_values(spark, "some_values", "v").collect()] == ["same"]


def test_union_does_not_tell_names_by_case(spark, rows):
    a = spark.createDataFrame([(1, "x")], "Id int, name string")
    b = spark.createDataFrame([(2, "y")], "ID int, Name string")
    df = r.union_relations({"a": a, "b": b}, source_column_name=None)
    assert df.columns == ["Id", "name"]
    assert rows(df) == [(1, "x"), (2, "y")]


def test_star(spark):
    df = spark.createDataFrame([("a", "b", "c")], "field_1 string, field_2 string, field_3 string")
    assert df.select(*r.star(df, ["FIELD_3"])).columns == ["field_1", "field_2"]
    assert df.select(*r.star(df, prefix="prefix_", suffix="_suffix")).columns == [f"prefix_field_{i}_suffix" for i in (1, 2, 3)]
    assert df.select(*r.star(df, df.columns)).columns == []
    assert df.alias("t").select(*r.star(df.alias("t"), relation_alias="t")).columns == df.columns


def test_nullcheck(spark, rows):
    df = spark.createDataFrame([("a", "", 1), ("", "b", 2), ("", "", 3)], "field_1 string, field_2 string, field_3 int")
    assert rows(r.nullcheck(df)) == sorted([("a", None, 1), (None, "b", 2), (None, None, 3)], key=repr)


def test_difference_treats_nulls_as_equal(spark, rows):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "i int, v string")
    b = spark.createDataFrame([(1, None), (3, "y")], "i int, v string")
    assert rows(r.difference(a, b)) == [("a_minus_b", 2, "x"), ("b_minus_a", 3, "y")]


def test_generate_series(spark):
    assert [x[0] for x in g.generate_series(spark, 10).orderBy("generated_number").collect()] == list(range(1, 11))
    with pytest.raises(ValueError):
        g.generate_series(spark, 0)


def test_date_spine_leaves_the_end_out(spark):
    days = [x[0] for x in g.date_spine(spark, "day", "2018-01-01", "2018-01-10").orderBy("date_day").collect()]
    assert days == [datetime.datetime(2018, 1, d) for d in range(1, 10)]
    months = g.date_spine(spark, "month", "2018-01-31", "2018-04-01")
    assert [x[0].day for x in months.orderBy("date_month").collect()] == [31, 28, 31]


def test_calendar(spark):
    days = {x.date_id: x for x in g.calendar(spark).collect()}
    assert len(days) == 7305
    x = days[20150103]
    assert (x.year_code, x.quarter_code, x.year_quarter_code, x.year_month_code) == ("CY 2015", "Q1", "2015-Q1", "2015-01")
    assert (x.month_name, x.month_name_short, x.day_name, x.day_name_short) == ("January", "Jan", "Saturday", "Sat")
    assert (x.day_of_week_number, x.is_weekend, x.week_of_year) == (6, True, 1)
    assert x.week_start_date == datetime.date(2014, 12, 29)
    assert days[20150104].day_of_week_number == 0
    assert g.calendar_end() == datetime.date(2034, 12, 31)
