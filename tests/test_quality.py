"""Checks, in their passing and their failing case."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemart.operators import quality as q
from tidemart.operators import report as r
from tidemart.operators.fingerprint import unequal_rows
from tidemart.operators.report import RowCheck, Threshold, quality_report
from tidemart.operators.reshape import difference


def table(spark, ddl, *values):
    return spark.createDataFrame(list(values), ddl)


def test_accepted_range(spark, rows):
    t = table(spark, "id int", (-1,), (11,), (None,))
    assert rows(q.accepted_range(t, "id", -1, 11)) == []
    assert rows(q.accepted_range(t, "id", -2, 11.1, inclusive=False)) == []
    assert rows(q.accepted_range(t, "id", -1, 11, inclusive=False)) == [(-1,), (11,)]
    assert rows(q.accepted_range(t, "id")) == []


def test_at_least_one(spark, rows):
    t = table(spark, "field string, value int", ("a", 1), ("b", None))
    assert rows(q.at_least_one(t, "field")) == []
    assert rows(q.at_least_one(t, "value", ["field"])) == [("b", 0)]
    assert rows(q.at_least_one(t.filter("value is null"), "value")) == [(0,)]


def test_cardinality_equality(spark, rows):
    a = table(spark, "same int", (1,), (2,), (3,), (None,))
    b = table(spark, "same int, other int", (1, 2), (2, 3), (3, 1), (None, None))
    assert rows(q.cardinality_equality(a, "same", b, "same")) == []
    assert rows(q.cardinality_equality(a, "same", b, "other")) == []
    c = table(spark, "x int", (1,), (1,), (4,))
    assert rows(q.cardinality_equality(a, "same", c, "x")) == sorted(
        [(1, 1), (1, 2), (2, 1), (3, 1), (4, 1), (None, 1)], key=repr
    )


def test_equality(spark, rows):
    a = table(spark, "col_a string, col_b int, col_c int", *[(w, len(w), 10) for w in ("ebb", "flood", "slack")])
    b = table(spark, "col_a string, col_b int, col_c int", *[(w, len(w), 20) for w in ("ebb", "flood", "slack")])
    assert rows(q.equality(a, a)) == []
    assert q.equality(a, b).count() == 6
    assert rows(q.equality(a, b, compare_columns=["col_a", "col_b"])) == []
    assert rows(q.equality(a, b, exclude_columns=["COL_C"])) == []
    assert q.equality_failures(q.equality(a, b)).first()[0] == 6
    assert q.equality_failures(q.equality(a, a.limit(0))).first()[0] == 6
    with pytest.raises(ValueError):
        q.equality(a, b.drop("col_c"))
    with pytest.raises(ValueError):
        q.equality(a, b, ["col_a"], ["col_b"])


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_equal_tables_are_not_shuffled(spark):
    a = spark.range(20_000).select("id", (F.col("id") % 7).cast("string").alias("v"))
    same = q.equality(a, a.repartition(3))
    assert same.count() == 0 and "Exchange" not in plan(same)
    counts = q.cardinality_equality(a, "v", a.repartition(3), "v")
    assert counts.count() == 0 and "Exchange" not in plan(counts)
    # One changed row of 20,000: the rows of two buckets are left to compare.
    changed = a.withColumn("v", F.when(F.col("id") == 777, "new").otherwise(F.col("v")))
    both = a.withColumn("a", F.lit(1)).unionAll(changed.withColumn("a", F.lit(0)))
    assert 2 <= unequal_rows(both, ["id", "v"], F.col("a") == 1).count() <= 60
    assert sorted(q.equality(a, changed).collect()) == [("a_minus_b", 777, "0"), ("b_minus_a", 777, "new")]


_VALUE = st.one_of(st.none(), st.sampled_from(["", "x", "y"]))
_ROW = st.tuples(_VALUE, _VALUE, st.sampled_from([None, 0.0, -0.0, float("nan"), 1.5]))


@settings(max_examples=15, deadline=None)
@given(st.lists(_ROW, max_size=5), st.lists(_ROW, max_size=5))
def test_fingerprints_lose_no_difference(spark, left, right):
    ddl = "s string, t string, d double"
    a, b = table(spark, ddl, *left), table(spark, ddl, *right)
    expected = sorted(map(repr, difference(a, b).collect()))
    assert sorted(map(repr, difference(a, b, alike=True).collect())) == expected


def test_fingerprints_tell_where_a_null_stands(spark, rows):
    a = table(spark, "s string, t string, l array<int>", (None, "x", [None, 1]))
    b = table(spark, "s string, t string, l array<int>", ("x", None, [1, None]))
    for names in (["s", "t"], ["l"], ["s", "t", "l"]):
        assert q.equality(a, b, names).count() == 2
        assert q.equality(a, a.unionAll(a), names).count() == 0


def test_equality_with_precision(spark):
    a = table(spark, "id string, n double", ("x", 0.12345678), ("y", -7.00000011))
    b = table(spark, "id string, n double", ("x", 0.12345681), ("y", -7.00000014))
    assert q.equality(a, b, precision=4).count() == 0
    assert q.equality(a, b, precision=8).count() == 4


def test_expression_is_true(spark, rows):
    t = table(spark, "col_a double, col_b double", (0.0, 1.0), (1.0, 0.0), (0.5, 0.5), (None, 1.0))
    assert rows(q.expression_is_true(t, "col_a + col_b = 1")) == []
    assert rows(q.expression_is_true(t, "+ col_b = 1", "col_a")) == []
    assert rows(q.expression_is_true(t, "= 0.5", "col_b", where="col_a = 0.5")) == []
    assert len(rows(q.expression_is_true(t, "= 0.5", "col_b"))) == 3


def test_row_counts(spark, rows):
    a = table(spark, "g int, x int", (1, 1), (1, 2), (2, 1), (3, 1), (None, 1))
    b = table(spark, "g int, x int", (1, 1), (2, 1), (2, 2), (4, 1), (None, 1))
    assert rows(q.equal_rowcount(a, b)) == [(5, 5, 0)]
    counts = {r["g_a"] or r["g_b"]: r for r in q.equal_rowcount(a, b, ["g"]).collect() if r["g_a"] or r["g_b"]}
    assert counts[1]["diff_count"] == 1
    assert counts[3]["diff_count"] is None
    assert q.fewer_rows_than(a, b).first()["row_count_delta"] == 1
    deltas = {r["g_a"] or r["g_b"]: r["row_count_delta"] for r in q.fewer_rows_than(a, b, ["g"]).collect()}
    assert deltas[1] == 1 and deltas[2] == 0 and deltas[3] == 0 and deltas[4] == 0


def test_not_accepted_values(spark, rows):
    t = table(spark, "city string", ("Barcelona",), ("London",), ("London",))
    assert rows(q.not_accepted_values(t, "city", ["Madrid", "Berlin"])) == []
    assert rows(q.not_accepted_values(t, "city", ["London"])) == [("London",)]


def test_not_constant(spark, rows):
    t = table(spark, "col_a int, field int", (1, 1), (1, 1), (1, 2), (2, 5), (3, None))
    assert rows(q.not_constant(t, "field")) == []
    assert rows(q.not_constant(t, "field", ["col_a"])) == [(2, 1)]


def test_not_empty_string(spark, rows):
    t = table(spark, "s string", (" ",), ("",), ("x",), (None,))
    assert rows(q.not_empty_string(t, "s")) == [("",), ("",)]
    assert rows(q.not_empty_string(t, "s", trim_whitespace=False)) == [("",)]


def test_not_null_proportion(spark, rows):
    t = table(spark, "p5 int, p9 int", *[(i if i % 2 else None, i if i < 9 else None) for i in range(10)])
    assert rows(q.not_null_proportion(t, "p5", 0.5, 0.5)) == []
    assert rows(q.not_null_proportion(t, "p9", 0.9)) == []
    assert rows(q.not_null_proportion(t, "p9", 0.95)) == [(0.9,)]
    assert len(rows(q.not_null_proportion(t, "p9", 0.5, group_by=["p5"]))) == 1


def test_recency(spark, rows):
    now = "2024-05-02 12:00:00"
    t = table(spark, "g int, at string", (1, "2024-05-01 00:00:00"), (2, "2024-05-02 00:00:00"))
    t = t.withColumn("at", F.col("at").cast("timestamp_ntz"))
    assert q.recency(t, "at", "day", 1, now).count() == 0
    assert q.recency(t, "at", "day", 1, now, group_by=["g"]).count() == 1
    assert q.recency(t, "at", "day", 1, now, True, ["g"]).count() == 0


def test_relationships_where(spark, rows):
    one, two = table(spark, "id int", (1,), (2,), (3,)), table(spark, "id int", (1,), (2,), (4,), (None,))
    assert rows(q.relationships_where(two, "id", one, "id", from_condition="id <> 4")) == []
    assert rows(q.relationships(two, "id", one, "id")) == [(4,)]
    assert rows(q.relationships_where(two, "id", one, "id", to_condition="id > 1")) == [(1,), (4,)]


def test_sequential_values(spark, rows):
    t = table(spark, "col_a int, n int", (1, 2), (1, 4), (1, 6), (2, 8), (2, 10), (2, None))
    assert rows(q.sequential_values(t, "n", 2)) == []
    assert rows(q.sequential_values(t, "n", 2, group_by=["col_a"])) == []
    assert len(rows(q.sequential_values(t, "n", 1))) == 4
    hours = table(spark, "my_timestamp string", *[(f"2021-01-01 0{h}:00:00",) for h in range(4)])
    hours = hours.withColumn("my_timestamp", F.col("my_timestamp").cast("timestamp_ntz"))
    assert rows(q.sequential_values(hours, "my_timestamp", 1, part="hour")) == []
    assert len(rows(q.sequential_values(hours, "my_timestamp", 1, part="day"))) == 3


def test_unique(spark, rows):
    t = table(spark, "month string, product string", ("1", "a"), ("1", "b"), ("2", "a"), (None, "c"), (None, "c"))
    assert rows(q.unique_combination_of_columns(t.limit(3), ["month", "product"])) == []
    assert rows(q.unique_combination_of_columns(t, ["month", "product"])) == [(None, "c")]
    assert rows(q.unique(t, "month")) == [("1", 2)]


def test_accepted_values(spark, rows):
    t = table(spark, "s string", ("a",), ("b",), ("b",), (None,))
    assert rows(q.accepted_values(t, "s", ["a"])) == [("b", 2)]


def test_rows_not_equal(spark, rows):
    t = table(spark, "a int, e int", (1, 1), (1, 2), (1, None), (None, None))
    assert rows(q.rows_not_equal(t, "a", "e")) == [(1, 2)]
    assert rows(q.rows_not_equal(t, "a", "e", null_safe=True)) == [(1, 2), (1, None)]


def test_columns_match_set(spark, rows):
    t = table(spark, "Id int, name string", (1, "x"))
    assert rows(q.columns_match_set(t, ["ID", "NAME"])) == []
    assert rows(q.columns_match_set(t, ["id", "city"])) == sorted([("name", None), (None, "city")], key=repr)


def test_singular_checks(spark, rows):
    orders = spark.sql(
        """SELECT 'a' order_id, timestamp_ntz'2024-01-02' order_purchase_timestamp,
                  timestamp_ntz'2024-01-01' order_delivered_customer_date
           UNION ALL SELECT 'b', timestamp_ntz'2024-01-02', NULL"""
    )
    assert [r[0] for r in rows(q.delivered_before_purchase(orders))] == ["a"]
    sales = table(spark, "order_id string", ("a",), ("z",), (None,))
    assert rows(q.sales_without_order(sales, orders)) == sorted([("z",), (None,)], key=repr)


def test_report_and_thresholds(spark):
    t = {"t": table(spark, "x int", (1,), (None,), (5,))}
    checks = [
        RowCheck("not_null", "t", lambda: q.null_violation("x")),
        RowCheck("range", "t", lambda: q.range_violation("x", 0, 10)),
        RowCheck("must_fail", "t", lambda: q.range_violation("x", 0, 3)),
    ]
    thresholds = {"not_null": Threshold(error_above=1), "must_fail": Threshold(expect_failures=True)}
    got = {r.check_name: (r.failures, r.status, r.passed) for r in quality_report(t, checks, thresholds).collect()}
    assert got == {"not_null": (1, "warn", True), "range": (0, "pass", True), "must_fail": (1, "pass", True)}


# --- ranges -----------------------------------------------------------------


def test_mutually_exclusive_ranges(spark, rows):
    t = table(spark, "lo int, hi int", (0, 1), (1, 2), (2, 4))
    assert rows(q.mutually_exclusive_ranges(t, "lo", "hi", gaps="not_allowed")) == []
    assert len(rows(q.mutually_exclusive_ranges(t, "lo", "hi", gaps="required"))) == 2
    subs = table(spark, "s int, a string, b string", (1, "2019-01-01", "2019-02-01"), (1, "2019-03-03", "2019-04-01"), (2, "2019-05-06", "2019-07-02"), (2, "2019-07-03", None))
    end = F.coalesce("b", F.lit("2099-01-01"))
    for gaps in ("allowed", "required"):
        assert rows(q.mutually_exclusive_ranges(subs, "a", end, "s", gaps)) == []
    # A NULL bound breaks the rule.
    assert len(rows(q.mutually_exclusive_ranges(subs, "a", "b", "s"))) == 1
    with pytest.raises(ValueError):
        q.mutually_exclusive_ranges(t, "lo", "hi", gaps="some")


def test_zero_length_ranges(spark, rows):
    t = table(spark, "s int, a int, b int", (3, 6, 7), (3, 8, 10), (3, 8, 8), (3, 12, 15), (4, 6, 7), (4, 8, 8), (4, 9, 10))
    assert rows(q.mutually_exclusive_ranges(t, "a", "b", "s", zero_length_range_allowed=True)) == []
    assert len(rows(q.mutually_exclusive_ranges(t, "a", "b", "s"))) == 2


bound = st.one_of(st.none(), st.integers(0, 6))


def brute_force(values, gaps, zero):
    """Violations found row by row in plain Python."""

    def key(r):
        return [(v is None, v or 0) for v in r[1:]]

    found = []
    for g in {r[0] for r in values}:
        group = sorted((r for r in values if r[0] == g), key=key)
        for i, (_, lo, hi) in enumerate(group):
            last = i == len(group) - 1
            nxt = None if last else group[i + 1][1]
            own = lo is not None and hi is not None and (lo <= hi if zero else lo < hi)
            if hi is None or nxt is None:
                meets = last
            else:
                meets = {"allowed": hi <= nxt, "not_allowed": hi == nxt, "required": hi < nxt}[gaps]
            if not (own and meets):
                found.append((g, lo, hi, nxt, last, own, meets))
    return sorted(found, key=repr)


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from([0, 0, 0, 0, 1, 2]), bound, bound), min_size=1, max_size=40),
    st.sampled_from(["allowed", "not_allowed", "required"]),
    st.booleans(),
)
def test_ranges_agree_with_brute_force(spark, values, gaps, zero):
    t = spark.createDataFrame(values, "g int, lo int, hi int")
    got = q.mutually_exclusive_ranges(t, "lo", "hi", "g", gaps, zero)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_force(values, gaps, zero)
    whole = [(0, lo, hi) for _, lo, hi in values]
    got = q.mutually_exclusive_ranges(t, "lo", "hi", None, gaps, zero)
    assert sorted(((0, *r) for r in got.collect()), key=repr) == brute_force(whole, gaps, zero)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([0, 0, 0, 1]), bound), min_size=1, max_size=40), st.integers(0, 2))
def test_sequence_agrees_with_brute_force(spark, values, step):
    t = spark.createDataFrame(values, "g int, n int")
    want = []
    for g in {g for g, _ in values}:
        ordered = sorted(n for h, n in values if h == g and n is not None)
        want += [(g, b, a) for a, b in zip(ordered, ordered[1:]) if b != a + step]
    got = q.sequential_values(t, "n", step, group_by=["g"])
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_declared_checks_share_their_scans(spark, tmp_path):
    child = [(1, 10, "x", 0.0), (1, 10, "x", -0.0), (2, None, "y", 1.0), (3, 30, None, 2.0), (None, 40, "z", None)]
    spark.createDataFrame(child, "id int, up int, code string, x double").write.parquet(f"{tmp_path}/child")
    parent = [(10, "a"), (30, "b"), (None, "c")]
    spark.createDataFrame(parent, "key bigint, name string").write.parquet(f"{tmp_path}/parent")
    t = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in ("child", "parent")}
    checks = [
        *r.not_null_checks("child", "id", "up", "x"),
        r.accepted_range_check("child", "x", 1),
        r.row_check("child", "odd", "id % 2 = 1"),
        r.unique_check("child", "id"),
        r.unique_check("child", "x"),
        r.unique_combination_check("child", "id", "up"),
        r.unique_check("parent", "key"),
        r.accepted_values_check("child", "code", ["x"]),
        r.relationships_check("child", "up", "parent", "key"),
        r.present_check("child", "has_parent", "up", "parent", "key"),
    ]
    report = quality_report(t, checks)
    got = {row.check_name: row.failures for row in report.collect()}
    assert got == {
        "child.id.not_null": 1, "child.up.not_null": 1, "child.x.not_null": 1, "child.x.accepted_range": 2,
        "child.odd": 3, "child.id.unique": 1, "child.x.unique": 1, "child.id_up.unique_combination": 1,
        "parent.key.unique": 0, "child.code.accepted_values": 2, "child.up.relationships": 1, "child.has_parent": 2,
    }
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("FileScan parquet") == 2
    for c in checks:
        if isinstance(c, r.KeyCheck):
            assert c.violations(t).count() == got[c.name], c.name
    # Texts of different kinds of numbers differ: such a key is looked up on its own.
    mixed = r.relationships_check("child", "x", "parent", "key")
    assert [row.failures for row in quality_report(t, [mixed, checks[0]]).collect()] == [4, 1]
    empty = {n: df.limit(0) for n, df in t.items()}
    assert {row.failures for row in quality_report(empty, checks).collect()} == {0}
