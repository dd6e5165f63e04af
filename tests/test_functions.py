"""Column functions against golden values."""

import datetime

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemart import functions as fn


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


# Keys that have to agree with those of existing tables.
@pytest.mark.parametrize(
    "fields, key",
    [
        (("a", "b", "c"), "7b193b3d33184464106f41ddf733783b"),
        (("a", None, "c"), "4f32a73dc87b7bbb7a654d8898d58c7e"),
        ((None, None, "c"), "d9c538b129f1a3ad6ecfe55345c32a05"),
        ((None, None, None), "2fa5491950d66d153d23cfbcfea4e164"),
    ],
)
def test_surrogate_key(spark, fields, key):
    assert one(spark, fn.surrogate_key([F.lit(f).cast("string") for f in fields])) == (key,)


def test_surrogate_key_with_empty_nulls(spark):
    empty = fn.surrogate_key([F.lit(""), F.lit("x")])
    null = fn.surrogate_key([F.lit(None), F.lit("x")], nulls_as_empty=True)
    assert one(spark, empty == null) == (True,)


@pytest.mark.parametrize(
    "values, total, difference",
    [((1, 2, 3), 6, -4), ((1, None, 3), 4, -2), ((None, None, 2), 2, -2), ((None, None, None), 0, 0)],
)
def test_safe_add_and_subtract(spark, values, total, difference):
    c = [F.lit(v).cast("int") for v in values]
    assert one(spark, fn.safe_add(c), fn.safe_subtract(c)) == (total, difference)


def test_safe_add_needs_a_list(spark):
    with pytest.raises(ValueError):
        fn.safe_add("a")


@pytest.mark.parametrize(
    "n, d, q",
    [(n, d, None if n is None or not d else n / d) for n in (None, 0, 21, -8) for d in (None, 0, 4, -2)],
)
def test_safe_divide(spark, n, d, q):
    assert one(spark, fn.safe_divide(F.lit(n).cast("int"), F.lit(d).cast("int"))) == (q,)


# Seven buckets of 1.5 from -3; 0 lies below and 8 above.
@pytest.mark.parametrize(
    "amount, bucket",
    [(-3.01, 0), (-3.0, 1), (7.49, 7), (7.5, 8), *[(-3 + 1.5 * i + 0.2, i + 1) for i in range(7)]],
)
def test_width_bucket(spark, amount, bucket):
    assert one(spark, fn.width_bucket(F.lit(amount), -3, 7.5, 7)) == (bucket,)


def test_haversine(spark):
    # A quarter of the equator, and a degree of a meridian.
    quarter = [F.lit(v) for v in (0.0, 10.0, 0.0, 100.0)]
    degree = [F.lit(v) for v in (-33.0, 151.0, -34.0, 151.0)]
    km, mi = (
        one(spark, fn.haversine_distance(*quarter, **u), fn.haversine_distance(*degree, **u))
        for u in ({"unit": "km"}, {})
    )
    assert km[0] / km[1] == pytest.approx(90) and mi[0] / mi[1] == pytest.approx(90)
    assert km[1] == pytest.approx(111.2, abs=0.1) and km[1] / mi[1] == pytest.approx(1.609, abs=0.001)
    with pytest.raises(ValueError):
        fn.haversine_distance(*degree, unit="yards")


# Every scheme with every host, path and query: the parts must come out again.
URLS = [
    (f"{scheme}{host}{path}{query}", host, path.removeprefix("/"))
    for scheme in ("http://", "https://")
    for host in ("tide.example", "a.b.harbour.example")
    for path in ("/", "/quay", "/quay/7/boats.html")
    for query in ("", "?size=3&berth=x")
]


def test_url_host_and_path(spark):
    for url, host, path in URLS:
        assert one(spark, fn.url_host(F.lit(url)), fn.url_path(F.lit(url))) == (host, path), url


@pytest.mark.parametrize(
    "url, berth, size",
    [
        ("https://tide.example/quay?berth=7b", "7b", None),
        ("https://tide.example/quay?size=12&berth=7b", "7b", "12"),
        ("https://tide.example/quay?berth=&size=12", None, "12"),
        ("https://tide.example/quay", None, None),
    ],
)
def test_url_parameter(spark, url, berth, size):
    u = F.lit(url)
    got = one(spark, fn.url_parameter(u, "berth"), fn.url_parameter(u, "size"))
    assert got == (berth, size)


@pytest.mark.parametrize(
    "text, slug",
    [("Tide & Harbour-Log", "tide__harbour_log"), ("7 Seas", "_7_seas"), ("(quay)", "quay"), ("", "")],
)
def test_slugify(spark, text, slug):
    assert fn.slugify_name(text) == slug
    assert one(spark, fn.slugify(F.lit(text))) == (slug,)


@pytest.mark.parametrize(
    "n, level", [(1, "LOW"), (0, "MEDIUM"), (-1, "MEDIUM"), (3, "MEDIUM"), (4, "HIGH"), (None, "HIGH")]
)
def test_installment_level(spark, n, level):
    assert one(spark, fn.installment_level(F.lit(n).cast("int"))) == (level,)


def test_installment_value(spark):
    v = F.lit(10.0)
    got = one(spark, *[fn.installment_value(v, F.lit(n).cast("int")) for n in (4, 0, None)])
    assert got == (2.5, 10.0, 10.0)


def test_null_text(spark):
    got = one(spark, *[fn.null_text_to_null(F.lit(t)) for t in ("null", "NULL", "", "x")])
    assert got == (None, None, "", "x")


def test_hours_between_dates(spark):
    def hours(a, b):
        a, b = (F.lit(t).cast("timestamp_ntz") for t in (a, b))
        return one(spark, fn.hours_between_dates(a, b))[0]

    assert hours("2017-10-11 00:00:00", "2017-10-12 03:43:48") == 24
    assert hours("2018-08-08 00:00:00", "2018-08-08 18:37:50") == 0


@pytest.mark.parametrize(
    "part, a, b, n",
    [
        ("hour", "2024-01-01 10:59:59", "2024-01-01 11:00:00", 1),
        ("hour", "1969-12-31 23:59:59", "1970-01-01 00:00:00", 1),
        # The clock change of the session's time zone does not matter.
        ("hour", "2024-03-10 01:30:00", "2024-03-10 03:30:00", 2),
        ("day", "2024-01-01 23:59:59", "2024-01-02 00:00:00", 1),
        ("week", "2024-01-07 23:00:00", "2024-01-08 00:00:00", 1),
        ("week", "1969-12-28 23:00:00", "1969-12-29 00:00:00", 1),
        ("month", "2024-01-31", "2024-02-01", 1),
        ("quarter", "2024-03-31", "2024-04-01", 1),
        ("year", "2023-12-31", "2024-01-01", 1),
        ("minute", "2024-01-01 00:00:59", "2024-01-01 00:00:01", 0),
        ("second", "2024-01-01 00:00:02", "2024-01-01 00:00:01", -1),
    ],
)
def test_date_diff_counts_boundaries(spark, part, a, b, n):
    a, b = (F.lit(t).cast("timestamp_ntz") for t in (a, b))
    assert one(spark, fn.date_diff(part, a, b)) == (n,)


def test_date_add_ignores_clock_changes(spark):
    at = F.lit("2024-03-10 01:30:00").cast("timestamp_ntz")
    assert one(spark, fn.date_add("hour", 1, at)) == (datetime.datetime(2024, 3, 10, 2, 30),)


def test_date_ids(spark):
    d = F.lit("2018-07-24 20:41:37").cast("timestamp_ntz")
    null = F.lit(None).cast("timestamp_ntz")
    got = one(spark, fn.date_id_text(d), fn.date_id(d), fn.date_id(null), fn.date_id(null, 7))
    assert got == ("20180724", 20180724, None, 7)


# --- similarity -------------------------------------------------------------

words = st.text(alphabet="abcde ", max_size=12)


def scores(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    rows = df.select("i", fn.jaro_winkler(F.col("a"), F.col("b")).alias("s")).collect()
    return [r["s"] for r in sorted(rows)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(words, words), min_size=1, max_size=60))
def test_jaro_winkler_agrees_with_sql(spark, pairs):
    got = scores(spark, pairs)
    want = [
        duckdb.execute("SELECT jaro_winkler_similarity(?, ?)", list(p)).fetchone()[0]
        for p in pairs
    ]
    assert got == pytest.approx(want, abs=1e-9)
    assert all(0 <= s <= 1 for s in got)


def test_jaro_winkler_edges(spark):
    got = scores(spark, [("abc", "abc"), ("", ""), ("a", ""), ("são paulo", "sao paulo"), (None, "a")])
    assert got[:3] == [1.0, 0.0, 0.0]
    assert got[3] > 0.8
    assert got[4] is None
