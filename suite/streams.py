"""Streams that maintain tables; the result is their final state."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.common import Registry, descending, table
from tidemart.constants import VALID_FROM, VALID_TO
from tidemart.sources.files import FileColumn, FileSource
from tidemart.sources.tables import KeyedTable, SnapshotTable
from tidemart.sources.workspace import new_folder
from tidemart.streaming import ingest_files, stream_snapshot, stream_upsert
from tidemart.streaming.ingest import read_ingested

streams = Registry()

# The events arrive in three parts, cut at these times.
CUTS = ["2024-01-11 00:00:00", "2024-01-21 00:00:00", "2025-01-01 00:00:00"]


def _parts(events):
    before = "1970-01-01 00:00:00"
    for cut in CUTS:
        ts = F.col("ts")
        lo, hi = (F.lit(t).cast("timestamp_ntz") for t in (before, cut))
        yield events.filter((ts >= lo) & (ts < hi))
        before = cut


def _inbox(spark, events, path):
    return spark.readStream.schema(events.schema).parquet(path)


@streams.add("SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_ingest(spark, d):
    """Parquet files appended by a stream as they arrive."""
    events = table(spark, d, "events")
    path, work = new_folder(spark, "events"), new_folder(spark, "stream")
    names = ["event_id", "ts", "user_id", "event_type", "value"]
    types = dict(events.dtypes)
    spec = FileSource(
        "shop", "events", path, "parquet", [FileColumn(n, types[n]) for n in names],
        ignore_case=True,
    )
    for part in _parts(events):
        part.write.mode("append").parquet(path)
        ingest_files(spark, spec, f"{work}/rows", f"{work}/checkpoint")
    return read_ingested(spark, f"{work}/rows").select(*names)


@streams.add(
    f"""SELECT user_id, event_type, event_id, ts, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type
          ORDER BY ts DESC, {descending('event_id', 'value')}) = 1"""
)
def stream_upsert_latest(spark, d):
    """Latest event per user and type; the parts arrive newest first."""
    events = table(spark, d, "events").select(
        "user_id", "event_type", "event_id", "ts", "value"
    )
    path, work = new_folder(spark, "events"), new_folder(spark, "stream")
    latest = KeyedTable(spark, f"{work}/table", ["user_id", "event_type"])
    for part in reversed(list(_parts(events))):
        part.write.mode("append").parquet(path)
        stream_upsert(_inbox(spark, events, path), latest, "ts", f"{work}/checkpoint")
    return latest.read()


@streams.add(
    f"""WITH e AS (SELECT *, CASE WHEN ts < TIMESTAMP '{CUTS[0]}' THEN 1
                               WHEN ts < TIMESTAMP '{CUTS[1]}' THEN 2 ELSE 3 END AS part
                   FROM events),
    t AS (SELECT part, max(ts) AS at_ FROM e GROUP BY 1),
    seen AS (SELECT e.user_id, e.event_type, e.event_id, t.at_ FROM e
             JOIN t ON e.part = t.part
             QUALIFY row_number() OVER (PARTITION BY e.user_id, e.part
               ORDER BY e.ts DESC, {descending('e.event_type', 'e.event_id')}) = 1),
    steps AS (SELECT *, lag(event_type) OVER w AS old, lag(at_) OVER w AS old_at FROM seen
              WINDOW w AS (PARTITION BY user_id ORDER BY at_))
    SELECT user_id, event_type, event_id, at_ AS {VALID_FROM},
           lead(at_) OVER (PARTITION BY user_id ORDER BY at_) AS {VALID_TO}
    FROM steps WHERE old_at IS NULL OR old IS DISTINCT FROM event_type"""
)
def stream_history(spark, d):
    """Versions of a user's last activity; the second part arrives last, out of order."""
    events = table(spark, d, "events").select("user_id", "event_type", "event_id", "ts")
    path, work = new_folder(spark, "events"), new_folder(spark, "stream")
    history = SnapshotTable(spark, f"{work}/table", "user_id", ["event_type"])
    first, late, last = _parts(events)
    for part in (first, last, late):
        part.write.mode("append").parquet(path)
        stream_snapshot(_inbox(spark, events, path), history, "ts", f"{work}/checkpoint")
    return history.read().drop("ts")
