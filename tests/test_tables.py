"""Versioned tables: upserts, history, and jobs that died half way."""

import random
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemart.constants import VALID_FROM, VALID_TO
from tidemart.operators.history import apply_snapshot, dimension_increment, open_versions
from tidemart.operators.upsert import DuplicateKeys, high_watermark, newer_than, upsert
from tidemart.sources import runs as run_files
from tidemart.sources.tables import FullTable, KeyedTable, LateBatch, SnapshotTable

DDL = "k int, s string, v int"


def frame(spark, *values, ddl=DDL):
    return spark.createDataFrame(list(values), ddl)


@pytest.fixture
def home(tmp_path):
    return str(tmp_path)


def test_upsert_function(spark, rows):
    target = frame(spark, (1, "a", 1), (2, "a", 1))
    batch = frame(spark, (2, "b", 2), (3, "b", 2))
    assert rows(upsert(target, batch, ["k"])) == [(1, "a", 1), (2, "b", 2), (3, "b", 2)]


@settings(max_examples=5, deadline=None)
@given(st.sets(st.integers(0, 30)), st.sets(st.integers(31, 60)))
def test_upsert_of_other_keys_is_a_union(spark, a, b):
    first, second = (frame(spark, *[(k, "x", k) for k in s]) for s in (a, b))
    got = {r.k for r in upsert(first, second, ["k"]).collect()}
    assert got == a | b


def test_keyed_table(spark, rows, home):
    t = KeyedTable(spark, f"{home}/t", ["k", "s"], buckets=4)
    assert t.read() is None and t.watermark("v") is None
    t.upsert(frame(spark, *[(k, "a", 1) for k in range(20)]))
    t.upsert(frame(spark, (3, "a", 2), (3, "b", 2)))
    got = rows(t.read())
    assert len(got) == 21
    assert (3, "a", 2) in got and (3, "b", 2) in got and (3, "a", 1) not in got
    assert t.watermark("v") == 2


def committed(table, part="rows"):
    return table.store.state().of(part)


def test_a_small_batch_writes_its_own_rows_only(spark, home):
    t = KeyedTable(spark, f"{home}/t", ["id"])
    t.upsert(spark.range(200_000).withColumn("v", F.lit(0)), unique=True)
    t.upsert(spark.range(0, 200_000, 2000).withColumn("v", F.lit(1)))
    assert [r.rows for r in committed(t)] == [200_000, 100]
    assert (t.read().count(), t.read().filter("v = 1").count()) == (200_000, 100)
    # The large run is not shuffled for it.
    plan = t.read()._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_runs_are_merged_by_tiers(spark, rows, home, monkeypatch):
    monkeypatch.setattr(run_files, "SMALLEST", 10)
    t = KeyedTable(spark, f"{home}/t", ["k"])
    t.upsert(frame(spark, *[(k, "a", 0) for k in range(1000)]))
    for v in range(1, 10):
        t.upsert(frame(spark, (v, "b", v), (0, "b", v), (2000 + v, "n", v)))
    sizes = [r.rows for r in committed(t)]
    assert sizes[0] == 1000 and len(sizes) < 7 and max(sizes[1:]) < 25
    got = rows(t.read())
    assert len(got) == 1009 and (0, "b", 9) in got and (4, "b", 4) in got
    # Much in proportion to the table: one run again, in as many files as asked for.
    t.buckets = 3
    t.upsert(frame(spark, *[(k, "c", 99) for k in range(1000)]))
    assert [r.rows for r in committed(t)] == [1009]
    assert len(t.read().inputFiles()) == 3
    assert t.read().filter("s = 'c'").count() == 1000


def test_deleted_keys_stay_away(spark, rows, home, monkeypatch):
    monkeypatch.setattr(run_files, "SMALLEST", 1)
    t = KeyedTable(spark, f"{home}/t", ["k"])
    t.delete(frame(spark, (1, "a", 1)))
    assert t.read() is None
    t.upsert(frame(spark, *[(k, "a", 1) for k in range(6)]))
    t.delete(frame(spark, (1, "?", 0), (2, "?", 0), (77, "?", 0)))
    t.upsert(frame(spark, (2, "back", 2)))
    assert rows(t.read(), "k", "s") == [(0, "a"), (2, "back"), (3, "a"), (4, "a"), (5, "a")]
    t.compact()
    assert len(committed(t)) == 1 and t.read().count() == 5


def test_rows_placed_by_different_rules(spark, rows, home):
    t = KeyedTable(spark, f"{home}/t", ["k"])
    t.upsert(frame(spark, (1, "a", 5), (2, "a", 5), (3, "a", None)))
    t.upsert(frame(spark, (1, "late", 4), (2, "new", 6), (3, "b", None)), newest_by="v")
    t.upsert(frame(spark, (1, "forced", 1)))
    t.upsert(frame(spark, (1, "late", 0), (3, "c", 1), (2, "none", None)), newest_by="v")
    assert rows(t.read(), "k", "s") == [(1, "forced"), (2, "new"), (3, "c")]


def test_null_is_a_key_like_others(spark, rows, home):
    t = KeyedTable(spark, f"{home}/t", ["k", "s"])
    t.upsert(frame(spark, (None, "a", 1), (1, None, 1)))
    t.upsert(frame(spark, (None, "a", 2), (1, None, 2)))
    assert rows(t.read()) == [(1, None, 2), (None, "a", 2)]


def test_two_writers_lose_nothing(spark, rows, home):
    first, second = (KeyedTable(spark, f"{home}/t", ["k"]) for _ in range(2))
    first.upsert(frame(spark, (1, "a", 1)))
    store, write = second.store, second.store.write

    def interrupted(*args, **kwargs):
        run = write(*args, **kwargs)
        first.upsert(frame(spark, (2, "first", 1)))
        return run

    store.write = interrupted
    second.upsert(frame(spark, (3, "second", 1)))
    assert rows(first.read(), "k", "s") == [(1, "a"), (2, "first"), (3, "second")]
    old = store.state()
    assert not store.commit(run_files.State(old.version - 1)) and store.state() == old


def test_two_writers_of_a_history(spark, home):
    a, b = (SnapshotTable(spark, f"{home}/h", "k", ["s"]) for _ in range(2))
    a.apply(frame(spark, (1, "a", 1)), T1)
    commit, others = b.store.commit, [lambda: a.apply(frame(spark, (1, "b", 1)), T2)]

    def interrupted(state):
        if others:
            others.pop()()
        return commit(state)

    b.store.commit = interrupted
    b.apply(frame(spark, (1, "c", 1)), T3)
    found = versions(b.read())
    assert [(v[1], v[3], v[4]) for v in found] == [
        ("a", AT[T1], AT[T2]), ("b", AT[T2], AT[T3]), ("c", AT[T3], None)
    ]


def test_the_watermark_is_read_from_the_manifest(spark, home):
    t = KeyedTable(spark, f"{home}/t", ["k"])
    log = spark.sql(
        """SELECT id k, timestamp_ntz'2024-01-02 00:00:00.5' + make_interval(0, 0, 0, id) at, 1.5BD d,
           date'2024-02-03' day, cast(id AS double) x, string(id) s FROM range(3)"""
    )
    t.upsert(log)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("mark", "mark")
    assert t.watermark("at") == datetime(2024, 1, 4, 0, 0, 0, 500000)
    assert (t.watermark("k"), t.watermark("x"), str(t.watermark("d"))) == (2, 2.0, "1.5")
    assert str(t.watermark("day")) == "2024-02-03"
    assert len(tracker.getJobIdsForGroup("mark")) == 0
    assert t.watermark("s") == "2"
    assert len(tracker.getJobIdsForGroup("mark")) > 0
    spark.sparkContext.setJobGroup(None, None)


def test_expire_keeps_what_is_current(spark, home, tmp_path):
    t = KeyedTable(spark, f"{home}/t", ["k"])
    t.upsert(frame(spark, *[(k, "a", 1) for k in range(20)]))
    for v in range(2, 8):
        t.upsert(frame(spark, (1, "b", v)))
    before = sorted(map(tuple, t.read().collect()))
    t.expire(keep=1)
    kept = {p.name for p in (tmp_path / "t" / "data").iterdir()}
    assert kept == {r.path.split("/")[-1] for r in committed(t)}
    assert sorted(map(tuple, t.read().collect())) == before
    f = FullTable(spark, f"{home}/f")
    for v in range(4):
        f.replace(frame(spark, (1, "a", v)))
    f.expire()
    assert len(list((tmp_path / "f" / "data").iterdir())) == 2
    assert f.read().first().v == 3


def test_empty_batches(spark, rows, home):
    t = KeyedTable(spark, f"{home}/t", ["k"])
    t.upsert(frame(spark, (1, "a", 1)).limit(0))
    assert t.read() is None
    t.upsert(frame(spark, (1, "a", 1)))
    t.upsert(frame(spark, (1, "a", 1)).limit(0))
    assert rows(t.read()) == [(1, "a", 1)]


def test_duplicate_keys_are_refused(spark, home):
    t = KeyedTable(spark, f"{home}/t", ["k"])
    with pytest.raises(DuplicateKeys):
        t.upsert(frame(spark, (1, "a", 1), (1, "b", 2)))
    assert t.read() is None


def test_late_rows_do_not_replace_newer_ones(spark, rows, home):
    t = KeyedTable(spark, f"{home}/t", ["k"])
    t.upsert(frame(spark, (1, "new", 5)), newest_by="v")
    t.upsert(frame(spark, (1, "old", 4), (2, "old", 4)), newest_by="v")
    assert rows(t.read()) == [(1, "new", 5), (2, "old", 4)]


def test_a_run_without_commit_is_ignored(spark, rows, home):
    t = KeyedTable(spark, f"{home}/t", ["k"])
    t.upsert(frame(spark, (1, "a", 1)))
    # A writer died before its commit.
    t.store.write(frame(spark, (1, "dead", 9), (7, "dead", 9)), "rows")
    assert rows(t.read()) == [(1, "a", 1)]
    t.upsert(frame(spark, (1, "b", 2)))
    assert rows(t.read()) == [(1, "b", 2)]


def test_full_table_replaces_itself(spark, rows, home):
    t = FullTable(spark, f"{home}/f")
    assert t.read() is None
    t.replace(frame(spark, (1, "a", 1)))
    t.replace(t.read().withColumn("v", F.col("v") + 1))
    assert rows(t.read()) == [(1, "a", 2)]


def test_watermark(spark, rows):
    log = frame(spark, (1, "a", 1), (2, "a", 5), (3, "a", 6))
    assert rows(newer_than(log, "v", 5), "k") == [(3,)]
    assert len(rows(newer_than(log, "v", None))) == 3
    assert high_watermark(log.limit(0), "v") is None


def test_watermark_does_not_depend_on_the_time_zone(spark, rows):
    log = spark.sql(
        """SELECT timestamp_ntz'2024-01-02 00:00:00' at
           UNION ALL SELECT timestamp_ntz'2024-01-02 00:00:01'"""
    )
    late = newer_than(log, "at", datetime(2024, 1, 2))
    assert rows(late) == [(datetime(2024, 1, 2, 0, 0, 1),)]


# --- history ----------------------------------------------------------------

T1, T2, T3 = (f"2024-01-0{i} 00:00:00" for i in (1, 2, 3))
AT = {t: datetime.fromisoformat(t) for t in (T1, T2, T3)}


def versions(df):
    return sorted(
        ((r.k, r.s, r.v, r[VALID_FROM], r[VALID_TO]) for r in df.collect()), key=repr
    )


EXPECTED = sorted(
    [
        (1, "a", 1, AT[T1], AT[T2]),
        (1, "b", 1, AT[T2], AT[T3]),
        (1, None, 1, AT[T3], None),
        # v is not checked: the first value stays.
        (2, "a", 1, AT[T1], None),
        # Missing from later batches: stays open.
        (3, "a", 1, AT[T1], None),
        (4, "n", 1, AT[T2], None),
    ],
    key=repr,
)


def history_batches(spark):
    yield frame(spark, (1, "a", 1), (2, "a", 1), (3, "a", 1)), T1
    yield frame(spark, (1, "b", 1), (2, "a", 2), (4, "n", 1)), T2
    yield frame(spark, (1, None, 1), (4, "n", 1)), T3


def test_apply_snapshot(spark):
    history = None
    for batch, t in history_batches(spark):
        history = (
            open_versions(batch, t)
            if history is None
            else apply_snapshot(history, batch, "k", ["s"], t)
        )
    assert versions(history) == EXPECTED
    replayed = apply_snapshot(history, batch, "k", ["s"], "2024-09-09 00:00:00")
    assert versions(replayed) == EXPECTED


def test_snapshot_table(spark, home, tmp_path):
    t = SnapshotTable(spark, f"{home}/h", "k", ["s"], buckets=2)
    assert t.read() is None
    for batch, at in history_batches(spark):
        t.apply(batch, at)
    assert versions(t.read()) == EXPECTED
    t.apply(batch, "2024-09-09 00:00:00")
    assert versions(t.read()) == EXPECTED


def test_snapshot_run_that_died_before_its_commit(spark, home, monkeypatch):
    t = SnapshotTable(spark, f"{home}/h", "k", ["s"], buckets=2)
    (first, at1), (second, at2), (third, at3) = history_batches(spark)
    t.apply(first, at1)
    t.apply(second, at2)

    def dies(state):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(t.store, "commit", dies)
        with pytest.raises(RuntimeError):
            t.apply(third, at3)
    assert all(r[VALID_FROM] < AT[T3] for r in t.read().collect())
    assert sum(r[VALID_TO] is None and r.k == 1 for r in t.read().collect()) == 1
    t.apply(third, at3)
    assert versions(t.read()) == EXPECTED


def test_dimension_increment(spark):
    t = None
    for batch, at in history_batches(spark):
        t = open_versions(batch, at) if t is None else apply_snapshot(t, batch, "k", ["s"], at)
    assert versions(dimension_increment(t)) == EXPECTED
    after = versions(dimension_increment(t, T2))
    assert after == [v for v in EXPECTED if v[3] > AT[T2] or (v[4] and v[4] > AT[T2])]


def timeline(batches):
    """Versions by plain steps through the batches in the order of their times."""
    seen = {}
    for at, batch in sorted(batches):
        for k, (s, v) in batch.items():
            seen.setdefault(k, []).append((at, s, v))
    out = []
    for k, steps in seen.items():
        runs = [x for i, x in enumerate(steps) if i == 0 or x[1] != steps[i - 1][1]]
        ends = [x[0] for x in runs[1:]] + [None]
        out += [(k, s, v, at, end) for (at, s, v), end in zip(runs, ends)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_batches_in_any_order_give_one_history(spark, home, seed, monkeypatch):
    monkeypatch.setattr(run_files, "SMALLEST", 4)
    chance = random.Random(seed)
    batches = [
        (
            datetime(2024, 1, day, 0, 0, 0, 500000 * (day % 2)),
            {k: (chance.choice("ab\0").replace("\0", "") or None, day) for k in range(6) if chance.random() < 0.6},
        )
        for day in range(1, 8)
    ]
    chance.shuffle(batches)
    t = SnapshotTable(spark, f"{home}/h", "k", ["s"])
    known, since = {}, None
    for n, (at, batch) in enumerate(batches):
        df = frame(spark, *[(k, s, v) for k, (s, v) in batch.items()])
        t.apply(df, at)
        if n % 3 == 0:
            t.apply(df, at)  # a replay
        assert versions(t.read()) == timeline(batches[: n + 1])
        if n % 2:
            # Who follows the changes holds the same versions.
            since, rows, removed = t.changes(since)
            for r in removed.collect() if removed is not None else []:
                known.pop((r.k, r[VALID_FROM]), None)
            known |= {(v[0], v[3]): v for v in versions(rows)}
            assert sorted(known.values(), key=repr) == versions(t.read())


def test_changes_open_only_their_own_runs(spark, home):
    t = SnapshotTable(spark, f"{home}/h", "k", ["s"])
    assert t.changes(None)[1] is None
    for batch, at in history_batches(spark):
        t.apply(batch, at)
        last = t.store.state().version
    files = t.changes(last - 1)[1].inputFiles()
    new = [r.path for r in t.store.state().runs if r.version == last and r.part != "seen"]
    assert len(new) == 2 and {f.rsplit("/", 1)[0].removeprefix("file://") for f in files} == set(new)
    assert len(files) < len(t.read().inputFiles())
    assert t.changes(last) == (last, None, None)


def test_a_table_fed_in_order_refuses_a_late_batch(spark, home):
    t = SnapshotTable(spark, f"{home}/h", "k", ["s"], any_order=False)
    t.apply(frame(spark, (1, "z", 1)).limit(0), T1)
    assert t.read() is None
    for batch, at in history_batches(spark):
        t.apply(batch, at)
    assert versions(t.read()) == EXPECTED and not t.store.state().of("seen")
    with pytest.raises(LateBatch):
        t.apply(batch, T2)
    assert versions(t.read()) == EXPECTED
