"""Micro-batches that keep tables current."""

from datetime import datetime

from pyspark.sql import functions as F

from tidemart.constants import VALID_FROM, VALID_TO
from tidemart.sources.tables import KeyedTable, SnapshotTable
from tidemart.streaming import stream_snapshot, stream_upsert

DDL = "k string, v string, at timestamp_ntz"


def arrive(spark, path, *values):
    rows = [(k, v, day and datetime(2024, 1, day)) for k, v, day in values]
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(path)


def inbox(spark, path):
    return spark.readStream.schema(DDL).parquet(path)


def test_upsert_stream_keeps_the_newest(spark, tmp_path, rows):
    path, check = str(tmp_path / "in"), str(tmp_path / "check")
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=2)
    arrive(spark, path, ("a", "1", 5), ("a", "0", 4), ("b", "1", 5))
    stream_upsert(inbox(spark, path), t, "at", check)
    arrive(spark, path, ("a", "late", 3), ("b", "2", 6), ("c", "1", 1))
    stream_upsert(inbox(spark, path), t, "at", check)
    want = [("a", "1"), ("b", "2"), ("c", "1")]
    assert rows(t.read(), "k", "v") == want
    # Nothing new arrived; and a replay of everything changes nothing.
    stream_upsert(inbox(spark, path), t, "at", check)
    stream_upsert(inbox(spark, path), t, "at", str(tmp_path / "other"))
    assert rows(t.read(), "k", "v") == want


def test_record_without_time_does_not_hide_a_newer_one(spark, tmp_path, rows):
    path, check = str(tmp_path / "in"), str(tmp_path / "check")
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=2)
    arrive(spark, path, ("a", "3", 3), ("b", "none", None))
    stream_upsert(inbox(spark, path), t, "at", check)
    arrive(spark, path, ("a", "none", None), ("a", "5", 5), ("b", "1", 1))
    stream_upsert(inbox(spark, path), t, "at", check)
    assert rows(t.read(), "k", "v") == [("a", "5"), ("b", "1")]
    arrive(spark, path, ("a", "none", None))
    stream_upsert(inbox(spark, path), t, "at", check)
    assert rows(t.read(), "k", "v") == [("a", "5"), ("b", "1")]


def test_snapshot_stream(spark, tmp_path, rows):
    path, check = str(tmp_path / "in"), str(tmp_path / "check")
    t = SnapshotTable(spark, str(tmp_path / "t"), "k", ["v"], buckets=2)
    arrive(spark, path, ("a", "1", 1), ("b", "1", 2))
    stream_snapshot(inbox(spark, path), t, "at", check)
    arrive(spark, path, ("a", "2", 3), ("b", "1", 3), ("a", "1", 2))
    stream_snapshot(inbox(spark, path), t, "at", check)
    assert rows(t.read(), "k", "v", VALID_FROM, VALID_TO) == sorted(
        [
            ("a", "1", datetime(2024, 1, 2), datetime(2024, 1, 3)),
            ("a", "2", datetime(2024, 1, 3), None),
            ("b", "1", datetime(2024, 1, 2), None),
        ],
        key=repr,
    )
    assert t.read().filter(F.col(VALID_TO).isNull()).count() == 2
