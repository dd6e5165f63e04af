"""Tables kept in runs: replaced as a whole, by key, or with their history.

Plain Parquet has no MERGE. A change is therefore a small run of its own, merged when
the table is read, and rewritten into larger runs as its tier fills up (see ``runs``).
Any number of writers may work at once; each commit builds on the one before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.constants import VALID_FROM, VALID_TO
from tidemart.operators.history import differs, late_changes, open_versions
from tidemart.operators.small import reduced_to_keys
from tidemart.operators.upsert import DuplicateKeys, high_watermark, require_unique
from tidemart.sources.runs import GONE, SEEN, Run, State, Store, due, may_exceed, merged, small


def _with(state: State, rows: DataFrame | None, part: str, *runs: Run, **properties) -> State:
    schemas = state.schemas
    if rows is not None and part not in schemas:
        schema = rows.drop(GONE, SEEN).schema
        schemas = {**schemas, part: schema.jsonValue()}
    return replace(
        state,
        runs=(*state.runs, *runs),
        schemas=schemas,
        properties={**state.properties, **properties},
    )


class FullTable:
    """A table replaced as a whole on every run."""

    def __init__(self, spark: SparkSession, path: str):
        self.store = Store(spark, path)

    def read(self) -> DataFrame | None:
        state = self.store.state()
        return self.store.read(state, state.runs).drop(GONE) if state.runs else None

    def replace(self, df: DataFrame) -> None:
        """The last of several writers counts."""
        run = self.store.write(df, "rows")
        schemas = {"rows": df.schema.jsonValue()}
        self.store.change(lambda s: replace(s, runs=(run,), schemas=schemas))

    def expire(self, keep: int = 2) -> None:
        """Delete what only versions older than the newest ones hold."""
        self.store.expire(keep)


class KeyedTable:
    """A table with one row per key, kept current by upserts.

    An upsert writes the rows of its batch and nothing else, whatever the size of the
    table; the newest row of a key counts when it is read. ``buckets`` is the number of
    files of a run that holds the whole table, by default as many as Spark finds right.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        buckets: int | None = None,
    ):
        self.store = Store(spark, path)
        self.keys, self.buckets = list(keys), buckets

    def _runs(self, state: State) -> list[Run]:
        return state.of("rows")

    def read(self) -> DataFrame | None:
        """Current rows, None before the first non-empty write."""
        state = self.store.state()
        runs = self._runs(state)
        return merged(self.store, state, runs, self.keys) if runs else None

    def watermark(self, name: str):
        """The largest value of a column that was ever loaded, from the manifest.

        Columns other than numbers, dates and zone-free times are scanned.
        """
        state = self.store.state()
        if not self._runs(state):
            return None
        if self.store.tracks(state, "rows", name):
            return self.store.most(state, "rows", name)
        return high_watermark(self.read(), name)

    def property(self, name: str):
        """What an upsert said about itself, such as how far it had read its source."""
        return self.store.state().properties.get(name)

    def upsert(
        self,
        batch: DataFrame,
        newest_by: str | None = None,
        unique: bool = False,
        properties: Mapping | None = None,
    ) -> None:
        """Insert the rows of the batch, replacing rows with the same key.

        With ``newest_by`` a stored row stays if it has a larger value there, so
        late records do not undo newer ones and a repeated batch changes
        nothing. ``unique`` says the keys are known to be unique in the batch;
        otherwise the write counts the rows of each key, and a batch with two of
        one raises ``DuplicateKeys`` and is not committed.
        """
        if unique:
            run = self.store.write(batch.sortWithinPartitions(*self.keys), "rows", newest_by=newest_by)
        else:
            # Grouped and sorted as the run has to be anyway.
            group = Window.partitionBy(*self.keys).orderBy(*self.keys)
            counted = batch.repartition(*self.keys).withColumn(SEEN, F.row_number().over(group))
            measured = {"twice": F.max(SEEN)}
            run = self.store.write(counted, "rows", measured, newest_by=newest_by)
            if (measured["twice"] or 0) > 1:
                require_unique(batch, self.keys)
                raise DuplicateKeys("a key is not unique in the batch")
        self._add(batch, run, properties or {})

    def delete(self, keys: DataFrame, properties: Mapping | None = None) -> None:
        """Remove rows by their key; keys that are not there do no harm."""
        marks = keys.select(*self.keys).withColumn(GONE, F.lit(True))
        self._add(None, self.store.write(marks, "rows"), properties or {})

    def _add(self, batch: DataFrame | None, run: Run, properties: Mapping) -> None:
        def added(state: State) -> State | None:
            old = self._runs(state)
            if not run.rows or (batch is None and not old):
                return replace(state, properties={**state.properties, **properties}) if properties else None
            if any(r.newest_by != run.newest_by for r in old[1:]):
                # Rows that were placed by another rule are settled first.
                self._merge(state, old)
                state = self.store.state()
            return _with(state, batch, "rows", run, **properties)

        self.store.change(added)
        state = self.store.state()
        while runs := due(self._runs(state)):
            if not self._merge(state, runs):
                break
            state = self.store.state()

    def _merge(self, state: State, runs: list[Run], files: int | None = None) -> bool:
        """Make one run of the newest ones, unless another writer did."""
        whole = runs[0] == self._runs(state)[0]
        rows = merged(self.store, state, runs, self.keys, gone=not whole)
        if not whole:
            rows = rows.sortWithinPartitions(*self.keys)
        elif files or self.buckets:
            rows = rows.repartition(files or self.buckets, *self.keys).sortWithinPartitions(*self.keys)
        else:
            rows = rows.repartition(*self.keys).sortWithinPartitions(*self.keys)
        run = self.store.write(rows, "rows", newest_by=runs[-1].newest_by)
        return self.store.swap(runs, run)

    def compact(self, files: int | None = None) -> None:
        """Make one run of all, in so many files; reads and writes the whole table."""
        state = self.store.state()
        if runs := self._runs(state):
            self._merge(state, runs, files)

    def expire(self, keep: int = 2) -> None:
        """Delete what only versions older than the newest ones hold."""
        self.store.expire(keep)


class LateBatch(ValueError):
    """A batch is older than the newest one, in a table that is fed in order."""


class SnapshotTable:
    """SCD-2 history: open versions by key, closed ones beside them.

    A run writes the versions that it opens and closes in one commit. Batches may come
    in any order: one that is older than the newest is put in its place among the
    versions of its keys, and the history is the same as if it had come in time. That
    takes the rows of every batch, unchanged ones too, so they are kept; a table that
    is fed in order can do without (``any_order=False``) and refuses a late batch.
    A batch of the same time as a version of a key replaces that version.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str,
        check_cols: Sequence[str],
        buckets: int | None = None,
        any_order: bool = True,
    ):
        self.store = Store(spark, path)
        self.key, self.check_cols, self.buckets = key, list(check_cols), buckets
        self.any_order = any_order

    def _open(self, state: State, runs: Sequence[Run] | None = None) -> DataFrame:
        return merged(self.store, state, runs or state.of("open"), [self.key])

    def _closed(self, state: State, runs: Sequence[Run], gone: bool = False) -> DataFrame:
        return merged(self.store, state, runs, [self.key, VALID_FROM], gone)

    def read(self) -> DataFrame | None:
        state = self.store.state()
        if not state.of("open"):
            return None
        current = self._open(state)
        closed = state.of("closed")
        return current.unionByName(self._closed(state, closed)) if closed else current

    def changes(self, since: int | None) -> tuple[int, DataFrame | None, DataFrame | None]:
        """The newest commit, what commits after ``since`` wrote, and what they removed.

        Rows are versions that began or ended; the removed ones are named by key and
        beginning, and may have begun anew since. Only the runs of those commits are
        opened; runs that were merged meanwhile bring some older versions along.
        """
        state = self.store.state()
        new = [r for r in state.runs if since is None or r.version > since]
        opened, closed = ([r for r in new if r.part == p] for p in ("open", "closed"))
        parts, removed = [], None
        if opened:
            parts.append(self._open(state, opened))
        if closed:
            rows = self._closed(state, closed, gone=True)
            parts.append(rows.filter(F.col(GONE).isNull()).drop(GONE))
            if any(r.replaces for r in closed):
                removed = rows.filter(GONE).select(self.key, VALID_FROM)
        rows = reduce(DataFrame.unionByName, parts) if parts else None
        return state.version, rows, removed

    def apply(self, batch: DataFrame, valid_from) -> None:
        """Record a batch with one row per key, valid from the given time on."""
        at = valid_from if isinstance(valid_from, datetime) else datetime.fromisoformat(str(valid_from))
        # Read several times below; lost partitions are computed again.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            seen = None
            if self.any_order:
                rows = batch.withColumn("__at", F.lit(str(at)).cast("timestamp_ntz"))
                seen = self.store.write(rows, "seen", replaces=False)
            while not self._applied(self.store.state(), batch, seen, at):
                pass
        finally:
            batch.unpersist()
        self._tidy()

    def _applied(self, state: State, batch: DataFrame, seen: Run | None, at: datetime) -> bool:
        """One attempt; False if another writer committed meanwhile."""
        first = open_versions(batch, at)
        last = state.properties.get("last")
        last = datetime.fromisoformat(last) if last else at
        late = at < last
        if late and not self.any_order:
            raise LateBatch(f"{at} is older than the newest batch, of {last}")
        new = _with(_with(state, first, "open"), first, "closed", last=max(last, at).isoformat())
        if seen is not None:
            rows = batch.withColumn("__at", F.lit(None).cast("timestamp_ntz"))
            new = _with(new, rows, "seen", *([seen] if seen.rows else []))

        def of_batch(rows: DataFrame) -> DataFrame:
            # Spared where the keys are many: the join that follows needs no help then.
            if seen is None:
                return reduced_to_keys(rows, batch, [self.key])
            wanted = F.broadcast(self.store.read(new, [seen]).select(self.key))
            return rows.join(wanted, self.key, "left_semi") if small([seen]) else rows

        if not state.of("open"):
            opened = self.store.write(self._spread(first), "open")
            return not opened.rows or self.store.commit(_with(new, None, "open", opened))
        current = of_batch(self._open(state))
        if late:
            # Rows that replace others count wherever those are.
            closed = [r for r in state.of("closed") if r.replaces or may_exceed(r, VALID_TO, at)]
            versions = current
            if closed:
                ended = self._closed(state, closed).filter(F.col(VALID_TO) > F.lit(str(at)).cast("timestamp_ntz"))
                versions = current.unionByName(of_batch(ended))
            later = [r for r in state.of("seen") if may_exceed(r, "__at", at)]
            sightings = of_batch(self.store.read(state, later).drop(GONE))
            changed = late_changes(versions, sightings, batch, self.key, self.check_cols, at)
            changed = changed.persist(StorageLevel.MEMORY_AND_DISK)
        else:
            old = current.select(F.col(self.key).alias("__key"), F.struct("*").alias("old"))
            fresh = first.select(F.col(self.key).alias("__key"), F.struct(*current.columns).alias("new"))
            pairs = fresh.join(old, "__key", "left")
            changed = pairs.filter(F.col("old").isNull() | differs(self.check_cols))
            changed = changed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if late:
                opened = changed.filter(f"{GONE} IS NULL AND {VALID_TO} IS NULL").drop(GONE)
                closed = changed.filter(f"{GONE} OR {VALID_TO} IS NOT NULL")
            else:
                opened = changed.select("new.*")
                ended = changed.filter(f"old.`{VALID_FROM}` < new.`{VALID_FROM}`").select("old.*", F.col(f"new.`{VALID_FROM}`").alias("__end"))
                closed = ended.withColumn(VALID_TO, F.col("__end")).drop("__end")
            runs = [
                self.store.write(opened.sortWithinPartitions(self.key), "open"),
                self.store.write(closed, "closed", replaces=late),
            ]
        finally:
            changed.unpersist()
        return self.store.commit(_with(new, None, "open", *[r for r in runs if r.rows]))

    def _spread(self, rows: DataFrame) -> DataFrame:
        rows = rows.repartition(self.buckets, self.key) if self.buckets else rows
        return rows.sortWithinPartitions(self.key)

    def _tidy(self) -> None:
        """Merge runs whose tier is full."""
        for part in ("open", "closed", "seen"):
            state = self.store.state()
            runs = due(state.of(part), whole=part == "open")
            if part != "open":
                # The rows of these replace nothing, so they are only put together.
                while runs and any(r.replaces for r in runs):
                    runs = runs[next(i for i, r in enumerate(runs) if r.replaces) + 1 :]
            if len(runs) < 2:
                continue
            if part == "open":
                whole = runs[0] == state.of(part)[0]
                rows = merged(self.store, state, runs, [self.key], gone=not whole)
                rows = self._spread(rows.drop(GONE))
            else:
                rows = self.store.read(state, runs).drop(GONE)
            run = self.store.write(rows, part, replaces=part == "open")
            self.store.swap(runs, run)

    def expire(self, keep: int = 2) -> None:
        """Delete what only versions older than the newest ones hold."""
        self.store.expire(keep)
