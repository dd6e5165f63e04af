"""Files in each format, declared in each way, give the same people."""

import gzip
import json
from dataclasses import replace
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemart.constants import EMITTED_AT, FILE_NAME, FILE_ROW_NUMBER
from tidemart.sources.catalog import (
    ListedPartition,
    add_partitions,
    create_statement,
    partition_paths,
    selected,
    stage,
    value_only,
    year_month_day,
)
from tidemart.sources.envelope import BRONZE_TABLES, envelope_schema, extract, read_bronze
from tidemart.sources.files import FileColumn, FilePartition, FileSource, load
from tidemart.sources.workspace import new_folder, shared_folder
from tidemart.streaming.ingest import ingest_files, numbered_rows, read_ingested

PEOPLE = [(i, f"First{i}", f"Last{i}", f"p{i}@host{i % 3}.org") for i in range(1, 41)]
COLUMNS = [
    FileColumn("id", "int"),
    FileColumn("first_name"),
    FileColumn("last_name"),
    FileColumn("email"),
]
NAMES = [c.name for c in COLUMNS]
SECTION = FilePartition(
    "section", "string", "substr(split_part(filename, 'section=', 2), 1, 1)"
)
HEADER = {"header": "true"}


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("people")
    for n, section in enumerate("abcd"):
        part = PEOPLE[n * 10 : n * 10 + 10]
        for kind in ("csv", "json", "parquet", "parquet_upper"):
            (home / kind / f"section={section}").mkdir(parents=True)
        lines = [",".join(NAMES)] + [",".join(map(str, p)) for p in part]
        (home / "csv" / f"section={section}" / f"people_{section}.csv").write_text("\n".join(lines) + "\n")
        objects = [json.dumps(dict(zip(NAMES, p)), indent=4) for p in part]
        (home / "json" / f"section={section}" / f"people_{section}.json").write_text("\n".join(objects) + "\n")
        df = spark.createDataFrame(part, "id int, first_name string, last_name string, email string")
        df.coalesce(1).write.mode("overwrite").parquet(str(home / "parquet" / f"section={section}"))
        df.toDF(*[c.upper() for c in NAMES]).coalesce(1).write.mode("overwrite").parquet(str(home / "parquet_upper" / f"section={section}"))
    return home


def spec(data, kind, **more):
    options = HEADER if kind == "csv" else {}
    layout = {"json_layout": "objects"} if kind == "json" else {}
    return FileSource("ext", f"people_{kind}", str(data / kind), kind.split("_")[0], **{"columns": COLUMNS, "options": options, **layout, **more})


@pytest.mark.parametrize("kind", ["csv", "json", "parquet"])
@pytest.mark.parametrize("partitions", [(), (SECTION,), (FilePartition("section"),)])
def test_declared_columns(spark, data, rows, kind, partitions):
    df = load(spark, spec(data, kind, partitions=partitions))
    assert rows(df, *NAMES) == sorted(PEOPLE, key=repr)
    if partitions:
        assert df.columns[-1] == "section"
        assert {r.section: r["count"] for r in df.groupBy("section").count().collect()} == dict.fromkeys("abcd", 10)


@pytest.mark.parametrize("kind", ["csv", "json", "parquet"])
@pytest.mark.parametrize("partitions", [(), (SECTION,)])
def test_no_columns(spark, data, kind, partitions):
    df = load(spark, spec(data, kind, columns=(), partitions=partitions))
    assert df.columns[0] == "value" and df.count() == 40


@pytest.mark.parametrize("partitions", [(), (SECTION,)])
def test_inferred_parquet(spark, data, rows, partitions):
    df = load(spark, spec(data, "parquet", columns=(), infer_schema=True, partitions=partitions))
    assert rows(df, *NAMES) == sorted(PEOPLE, key=repr)
    upper = load(spark, spec(data, "parquet_upper", columns=(), infer_schema=True))
    assert rows(upper, *[n.upper() for n in NAMES]) == sorted(PEOPLE, key=repr)


def test_case_of_declared_columns(spark, data, rows):
    found = load(spark, spec(data, "parquet_upper", ignore_case=True))
    assert rows(found, *NAMES) == sorted(PEOPLE, key=repr)
    exact = load(spark, spec(data, "parquet_upper"))
    assert rows(exact, *NAMES) == [(None,) * 4] * 40


def test_alias_expression_and_keyword(spark, data, rows):
    columns = [*COLUMNS[:3], FileColumn("email", alias="email_alias"), FileColumn("UNION", expression="split_part(email, '@', 2)")]
    df = load(spark, spec(data, "json", columns=columns))
    assert df.columns == ["id", "first_name", "last_name", "email_alias", "UNION"]
    assert rows(df, "email_alias", "`UNION`")[0] == ("p10@host1.org", "host1.org")


def test_partition_filter_prunes_files(spark, data):
    df = load(spark, spec(data, "csv", partitions=(SECTION,))).filter("section = 'b'")
    assert df.count() == 10
    assert len(df.inputFiles()) == 4
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "_metadata" in plan or "file_path" in plan


def test_uris_pattern_and_glob(spark, data, rows):
    some = [str(p) for p in sorted((data / "csv").glob("*/*.csv"))[:2]]
    df = load(spark, FileSource("ext", "p", some, "csv", COLUMNS, options=HEADER))
    assert df.count() == 20
    assert load(spark, spec(data, "csv", pattern=r".*section=[ab]/.*[.]csv")).count() == 20
    assert load(spark, spec(data, "csv", glob="people_[ab].csv")).count() == 20


def test_null_text_and_bad_values(spark, tmp_path, rows):
    (tmp_path / "t.csv").write_text("1,null\nx,NULL\n3,\n4,ok\n")
    columns = [FileColumn("i", "int"), FileColumn("s")]
    path = str(tmp_path / "t.csv")

    def read(on_error):
        return load(spark, FileSource("e", "t", path, "csv", columns, on_error=on_error))

    assert rows(read("null")) == sorted([(1, None), (None, None), (3, None), (4, "ok")], key=repr)
    assert rows(read("skip")) == sorted([(1, None), (3, None), (4, "ok")], key=repr)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|FAILED"):
        read("fail").collect()
    with pytest.raises(ValueError):
        read("ignore")


def test_json_objects_with_nesting_and_any_end(spark, tmp_path, rows):
    objects = [{"a": 1, "n": {"x": "}{"}}, {"a": 2, "n": {"x": "y"}}, {"a": 3, "n": {}}]
    for name, end in [("one", ""), ("two", "\n")]:
        text = "\n".join(json.dumps(o, indent=1) for o in objects) + end
        (tmp_path / f"{name}.json").write_text(text)
    columns = [FileColumn("a", "int"), FileColumn("x", expression="get_json_object(n, '$.x')"), FileColumn("n")]
    df = load(spark, FileSource("e", "t", str(tmp_path), "json", columns, json_layout="objects"))
    assert rows(df, "a", "x") == sorted([(1, "}{"), (2, "y"), (3, None)] * 2, key=repr)


@pytest.mark.parametrize("between", ["\n", "\r\n", "\n\n", " ", "", "\n  ", "\t\n"])
def test_json_objects_with_any_white_space_between(spark, tmp_path, rows, between):
    objects = [{"a": i, "n": {"x": "} {\\" if i % 2 else 'say "}{"'}} for i in range(5)]
    (tmp_path / "x.json").write_bytes(between.join(json.dumps(o) for o in objects).encode())
    columns = (FileColumn("a", "int"), FileColumn("n"))
    spec = FileSource("e", "t", str(tmp_path), "json", columns, json_layout="objects", on_error="fail")
    assert [r[0] for r in rows(load(spark, spec), "a")] == list(range(5))


def test_text_between_json_objects_is_an_error(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": 1}\n{"a": 2} left over')
    spec = FileSource("e", "t", str(tmp_path), "json", (FileColumn("a", "int"),), json_layout="objects")
    assert {r.a for r in load(spark, spec).collect()} >= {1}
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        load(spark, replace(spec, on_error="fail")).collect()


@pytest.fixture(scope="module")
def raw_files(spark, tmp_path_factory):
    """The same few rows as CSV, JSON lines and Parquet, in folders by kind and day."""
    home = tmp_path_factory.mktemp("raw")
    for kind, day, lines in [
        ("a", "2024-05-01", [("1", "one", "x"), ("2", "null", "Null"), ("no", "three", "z")]),
        ("b", "2024-05-02", [("4", "fo'ur", "w"), ("5", "", "v")]),
    ]:
        for name, text in [
            (f"{day}.csv", "".join(f"{n},{word},{tag}\n" for n, word, tag in lines)),
            (f"{day}.json", "".join(json.dumps({"n": n, "word": w, "tag": t}) + "\n" for n, w, t in lines) + "\n{bad\n"),
        ]:
            folder = home / name.split(".")[1] / f"kind={kind}"
            folder.mkdir(parents=True)
            (folder / name).write_text(text)
        rows = spark.createDataFrame([(n, w, t) for n, w, t in lines], "N string, Word string, tag string")
        rows.coalesce(1).write.parquet(str(home / "parquet" / f"kind={kind}"))
    return str(home)


WORDS = (FileColumn("n", "int"), FileColumn("word", "string", alias="text"), FileColumn("tag"))
COMPUTED = (FilePartition("day", "date", r"regexp_extract(filename, '([0-9]{4}-[0-9]{2}-[0-9]{2})', 1)"),)


@pytest.mark.parametrize(
    "name, declared",
    [
        ("uris", {"location": ["kind=a", "kind=b"], "columns": WORDS, "partitions": COMPUTED}),
        ("files", {"location": ["kind=a/2024-05-01.csv", "kind=b/2024-05-02.csv"], "columns": WORDS}),
        ("expression", {"columns": (*WORDS, FileColumn("twice", "string", expression="concat(word, '\\'', n)"))}),
        ("skipped", {"columns": WORDS, "on_error": "skip", "location": ["kind=a", "kind=b"]}),
        ("pattern", {"columns": WORDS, "pattern": r".*kind=b.*[.]csv$"}),
        ("glob", {"columns": WORDS, "glob": "*.c*", "location": ["kind=b"]}),
        ("json", {"format": "json", "columns": WORDS, "partitions": COMPUTED, "location": ["kind=a", "kind=b"]}),
        ("json_skipped", {"format": "json", "columns": WORDS, "on_error": "skip"}),
        ("variants", {"format": "json", "partitions": COMPUTED, "location": ["kind=a", "kind=b"]}),
        ("inferred", {"format": "parquet", "infer_schema": True, "pattern": ".*"}),
        ("any_case", {"format": "parquet", "columns": WORDS, "ignore_case": True, "partitions": (FilePartition("kind"),)}),
        ("stored", {"columns": WORDS[:1], "location": ["kind=a"], "on_error": "fail", "pattern": "nothing"}),
    ],
)
def test_staged_sources_read_as_loaded(spark, raw_files, rows, name, declared):
    declared = {"location": [""], "format": "csv", **declared}
    kind = declared["format"]
    declared["location"] = [f"{raw_files}/{kind}/{x}".rstrip("/") for x in declared["location"]]
    spec = FileSource("views", name, **declared)
    expected = load(spark, spec)
    assert stage(spark, [spec]) == {f"views.{name}": "created"}
    staged = spark.table(f"views.{name}")
    assert staged.dtypes == expected.dtypes
    text = lambda df: rows(df.select(*[F.col(c).cast("string") for c in df.columns]))
    assert text(staged) == text(expected) and (name == "stored" or len(text(staged)) > 1)
    assert stage(spark, [spec]) == {f"views.{name}": "refreshed"}


def test_staged_views_see_new_files_and_change_with_their_declaration(spark, tmp_path, rows):
    (tmp_path / "1.csv").write_text("1,a\n")
    spec = FileSource("views", "grows", str(tmp_path), "csv", (FileColumn("n", "int", alias="k"), FileColumn("w")))
    stage(spark, [spec])
    (tmp_path / "2.csv").write_text("2,b\n")
    stage(spark, [spec])
    assert rows(spark.table("views.grows")) == [(1, "a"), (2, "b")]
    plain = replace(spec, columns=(FileColumn("n", "int"), FileColumn("w")))
    for declared, name in ((plain, "n"), (spec, "k")):
        assert stage(spark, [declared], full_refresh=True) == {"views.grows": "created"}
        assert spark.table("views.grows").columns == [name, "w"]


def test_objects_back_to_back_are_not_staged(spark):
    spec = FileSource("views", "objects", "/a", "json", (FileColumn("a", "int"),), json_layout="objects")
    with pytest.raises(ValueError, match="cannot be staged"):
        stage(spark, [spec])


# --- catalog ----------------------------------------------------------------


def test_selection():
    a, b = FileSource("one", "t", "/x", "csv"), FileSource("two", "t", "/x", "csv")
    assert selected([a, b], None) == [a, b]
    assert selected([a, b], "one") == [a]
    assert selected([a, b], "two.t one.u") == [b]


def test_stage_creates_then_refreshes(spark, data, rows):
    people = spec(data, "csv", partitions=(FilePartition("section"),))
    assert stage(spark, [people]) == {"ext.people_csv": "created"}
    assert stage(spark, [people], "ext") == {"ext.people_csv": "refreshed"}
    assert stage(spark, [people], full_refresh=True) == {"ext.people_csv": "created"}
    assert rows(spark.table("ext.people_csv"), *NAMES) == sorted(PEOPLE, key=repr)
    assert spark.table("ext.people_csv").filter("section = 'c'").count() == 10


def test_partition_paths(spark, rows):
    parts = [
        ListedPartition("section", ["a", "b"]),
        ListedPartition("kind", ["x"], value_only),
        ListedPartition.days("day", "2024-02-28", "2024-03-01", year_month_day),
    ]
    got = rows(partition_paths(spark, parts))
    assert len(got) == 6
    assert ("a", "x", "2024-02-29", "section=a/x/2024/02/29") in got


def test_listed_partitions_in_batches(spark, data, tmp_path, rows):
    for section in "abcd":
        (tmp_path / section).mkdir()
        source = data / "csv" / f"section={section}" / f"people_{section}.csv"
        (tmp_path / section / "p.csv").write_text(source.read_text())
    people = FileSource("ext", "listed", str(tmp_path), "csv", COLUMNS, [FilePartition("section")], options=HEADER)
    spark.sql("CREATE DATABASE IF NOT EXISTS ext")
    spark.sql("DROP TABLE IF EXISTS ext.listed")
    spark.sql(create_statement(people, "ext.listed"))
    values = [*"abcd", *[f"none{i}" for i in range(120)]]
    n = add_partitions(spark, "ext.listed", str(tmp_path), [ListedPartition("section", values, value_only)])
    assert n == 124
    assert rows(spark.table("ext.listed"), *NAMES) == sorted(PEOPLE, key=repr)
    # A second time adds nothing.
    add_partitions(spark, "ext.listed", str(tmp_path), [ListedPartition("section", values, value_only)])
    assert spark.table("ext.listed").count() == 40


# --- envelopes --------------------------------------------------------------


def test_envelope(spark, tmp_path, rows):
    payload = BRONZE_TABLES["orders"]
    records = [
        ("1", "2024-01-01 10:00:00.123+00:00", ("o1", "c1", "shipped", "2017-10-02 10:56:33", None, None, "bad", None)),
        ("2", "2024-01-02 00:00:00.000+00:00", ("o2", "c2", "created", None, None, None, None, None)),
        ("3", "2024-01-02 00:00:00.001+00:00", ("o3", "c3", "created", None, None, None, None, None)),
    ]
    spark.createDataFrame(records, envelope_schema(payload)).write.parquet(str(tmp_path / "o"))
    stored = spark.read.schema(envelope_schema(payload)).parquet(str(tmp_path / "o"))
    first = extract(stored, payload).filter("order_id = 'o1'").first()
    assert str(first[EMITTED_AT]) == "2024-01-01 10:00:00.123000"
    assert str(first["order_purchase_timestamp"]) == "2017-10-02 10:56:33"
    assert first["order_delivered_customer_date"] is None
    later = extract(stored, payload, since=datetime(2024, 1, 2))
    assert rows(later, "order_id") == [("o3",)]
    narrow = later.select("order_id")
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_airbyte_emitted_at,2024-01-01)" in plan
    assert "order_status" not in plan


def test_envelopes_with_native_numbers_and_missing_fields(spark, tmp_path, rows):
    """Files as pandas writes them: a struct of what each record has."""
    at = "2024-01-01 10:00:00.123+00:00"
    pay = [
        {"order_id": "o1", "payment_sequential": 1, "payment_type": "voucher", "payment_value": 18.12},
        {"order_id": "o2", "payment_sequential": 2, "payment_type": "boleto", "payment_value": 2.0},
    ]
    (tmp_path / "order_payments").mkdir()
    for i, p in enumerate(pay):
        if i:
            p["payment_installments"] = 4
        envelope = {"_airbyte_ab_id": str(i), EMITTED_AT: at, "_airbyte_data": p}
        path = tmp_path / "order_payments" / f"{i}.parquet"
        pd.DataFrame([envelope]).to_parquet(path, index=False, engine="pyarrow")
    want = sorted([("o1", 1, "voucher", None, 18.12), ("o2", 2, "boleto", 4, 2.0)], key=repr)
    for infer in (False, True):
        log = read_bronze(spark, str(tmp_path), "order_payments", infer=infer)
        assert rows(log.drop(EMITTED_AT)) == want
        assert str(log.first()[EMITTED_AT]) == "2024-01-01 10:00:00.123000"


# --- ingest -----------------------------------------------------------------


def test_ingest_takes_each_file_once(spark, data, tmp_path, rows):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    people = FileSource("ext", "p", str(inbox), "csv", COLUMNS, options=HEADER, pattern=r".*[.]csv", on_error="skip")
    target, checkpoint = str(tmp_path / "rows"), str(tmp_path / "checkpoint")
    (inbox / "1.csv").write_text("id,first_name,last_name,email\n1,a,,e\nx,bad,b,e\n3,c,null,e\n")
    ingest_files(spark, people, target, checkpoint)
    (inbox / "2.csv").write_text("id,first_name,last_name,email\n4,d,d,e\n")
    (inbox / "note.txt").write_text("id,first_name,last_name,email\n9,z,z,z\n")
    ingest_files(spark, people, target, checkpoint)
    ingest_files(spark, people, target, checkpoint)
    got = read_ingested(spark, target)
    # Only empty text is NULL here, and a skipped row keeps its number.
    assert rows(got, "id", "last_name", FILE_ROW_NUMBER) == sorted([(1, None, 1), (3, "null", 3), (4, "d", 1)], key=repr)
    assert {r[0].rsplit("/", 1)[1] for r in got.select(FILE_NAME).distinct().collect()} == {"1.csv", "2.csv"}
    assert got.filter("_dbt_copied_at is null or metadata_file_last_modified is null").count() == 0


def test_ingest_without_columns(spark, data, tmp_path):
    people = FileSource("ext", "p", str(data / "json"), "json", (), json_layout="objects")
    target = str(tmp_path / "rows")
    ingest_files(spark, people, target, str(tmp_path / "checkpoint"), max_files_per_trigger=1)
    got = read_ingested(spark, target)
    assert got.count() == 40
    ids = got.select(F.variant_get("value", "$.id", "int").alias("id"), FILE_ROW_NUMBER)
    assert {((r.id - 1) % 10) + 1 == r[1] for r in ids.collect()} == {True}


def test_row_numbers_across_splits(spark, tmp_path):
    (tmp_path / "big.txt").write_text("".join(f"{i}\n" for i in range(1, 5001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = spark.read.text(str(tmp_path / "big.txt")).select(
            F.col("value").cast("int").alias("n"),
            F.col("_metadata.file_path").alias(FILE_NAME),
            F.col("_metadata.file_block_start").alias("__split"),
        )
        assert lines.rdd.getNumPartitions() > 3
        numbered = numbered_rows(lines)
        assert numbered.count() == 5000
        assert numbered.filter(F.col("n") != F.col(FILE_ROW_NUMBER)).count() == 0
        assert "Sort" not in numbered._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_row_numbers_of_several_files_in_a_task(spark, tmp_path):
    for name, n in ("a", 30), ("b", 1), ("c", 700):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name} {i}\n" for i in range(1, n + 1)))
    with gzip.open(tmp_path / "d.txt.gz", "wt") as f:
        f.writelines(f"d {i}\n" for i in range(1, 3001))
    lines = spark.read.text(str(tmp_path)).select(
        F.split("value", " ")[1].cast("int").alias("n"),
        F.col("_metadata.file_path").alias(FILE_NAME),
        F.col("_metadata.file_block_start").alias("__split"),
    )
    numbered = numbered_rows(lines.coalesce(1))
    assert numbered.count() == 3731
    assert numbered.filter(F.col("n") != F.col(FILE_ROW_NUMBER)).count() == 0
    assert numbered_rows(lines.limit(0)).count() == 0


def test_workspace_is_the_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "x") != new_folder(spark, "x")
