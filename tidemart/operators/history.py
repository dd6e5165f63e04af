"""Versioned tables (SCD-2): check strategy and the dimension built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.constants import OPEN_END, VALID_FROM, VALID_TO
from tidemart.functions.calendar import clock_time


def _timestamp(value) -> Column:
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return clock_time(value)


def open_versions(batch: DataFrame, valid_from) -> DataFrame:
    """Rows of a first or new version, open from ``valid_from`` on."""
    return batch.select(
        "*",
        _timestamp(valid_from).alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
    )


def differs(check_cols: Sequence[str]) -> Column:
    changed = F.lit(False)
    for c in check_cols:
        changed = changed | ~F.col(f"old.`{c}`").eqNullSafe(F.col(f"new.`{c}`"))
    return changed


def version_changes(
    current: DataFrame,
    batch: DataFrame,
    key: str,
    check_cols: Sequence[str],
    valid_from,
) -> tuple[DataFrame, DataFrame]:
    """What a batch changes: the versions it closes and the ones it opens.

    ``current`` holds the open version of each key, ``batch`` one row per key.
    Keys that are missing from the batch, or equal in the check columns, appear
    in neither result, so the work grows with the batch and not the history.
    """
    old = current.select(F.col(key).alias("__key"), F.struct("*").alias("old"))
    new = batch.select(F.col(key).alias("__key"), F.struct("*").alias("new"))
    pairs = new.join(old, "__key", "left")
    known = F.col("old").isNotNull()
    differs = differs(check_cols)

    closed = (
        pairs.filter(known & differs)
        .select("old.*")
        .withColumn(VALID_TO, _timestamp(valid_from))
    )
    opened = open_versions(pairs.filter(~known | differs).select("new.*"), valid_from)
    return closed, opened


def apply_snapshot(
    history: DataFrame,
    batch: DataFrame,
    key: str,
    check_cols: Sequence[str],
    valid_from,
) -> DataFrame:
    """Whole history after a batch, in one full join.

    Each joined pair yields the rows it stands for: an untouched open version, a
    closed one with its successor, or a first version.
    """
    is_open = F.col(VALID_TO).isNull()
    names = history.columns
    old = history.filter(is_open).select(
        F.col(key).alias("__key"), F.struct("*").alias("old")
    )
    new = open_versions(batch, valid_from).select(
        F.col(key).alias("__key"), F.struct(*names).alias("new")
    )
    known, fresh = F.col("old").isNotNull(), F.col("new").isNotNull()
    changed = known & fresh & differs(check_cols)
    keep_old = F.when(known & ~changed, F.col("old"))
    close_old = F.when(
        changed, F.col("old").withField(VALID_TO, _timestamp(valid_from))
    )
    add_new = F.when(fresh & (changed | ~known), F.col("new"))
    rows = (
        old.join(new, "__key", "full")
        .select(F.explode(F.array(F.coalesce(keep_old, close_old), add_new)).alias("r"))
        .filter(F.col("r").isNotNull())
        .select("r.*")
    )
    return history.filter(~is_open).unionByName(rows)


def late_changes(
    versions: DataFrame,
    sightings: DataFrame,
    batch: DataFrame,
    key: str,
    check_cols: Sequence[str],
    valid_from,
) -> DataFrame:
    """Versions that a batch older than the newest one writes, and those it removes.

    ``versions`` holds those of the batch's keys that end after ``valid_from`` or are
    open, ``sightings`` the rows of later batches and their time (column ``__at``). The
    version that covers the time is cut there. The batch's row counts until the key was
    seen next; if that was unchanged, the old version goes on from then. A row that
    equals the version after it becomes its beginning. Removed versions come with
    ``__gone``, the others replace those of the same key and beginning.
    """
    names = versions.columns
    at = _timestamp(valid_from)
    whole = F.struct(*names)
    begins, ends = F.col(VALID_FROM), F.col(VALID_TO)
    around = (
        versions.filter(ends.isNull() | ((ends > at) & (begins < ends)))
        .groupBy(F.col(key).alias("__key"))
        .agg(
            F.any_value(F.when(begins <= at, whole), ignoreNulls=True).alias("old"),
            F.min_by(whole, F.when(begins > at, begins)).alias("next"),
        )
    )
    seen = sightings.filter(F.col("__at") > at).groupBy(F.col(key).alias("__key"))
    seen = seen.agg(F.min("__at").alias("seen"), F.min_by(F.struct(*batch.columns), "__at").alias("sighting"))
    new = open_versions(batch, valid_from)
    new = new.select(F.col(key).alias("__key"), F.struct(*names).alias("new"))
    joined = new.join(around, "__key", "left").join(seen, "__key", "left")

    old, following, row = F.col("old"), F.col("next"), F.col("new")
    after = F.lit(False)
    for c in check_cols:
        after = after | ~F.col(f"next.`{c}`").eqNullSafe(F.col(f"new.`{c}`"))
    follows = following.isNotNull() & (
        old.isNull() | (F.col(f"old.`{VALID_TO}`") == F.col(f"next.`{VALID_FROM}`"))
    )
    # Seen again before the next version: unchanged from the covering one.
    resumes = old.isNotNull() & F.col("seen").isNotNull() & (
        ~follows | (F.col("seen") < F.col(f"next.`{VALID_FROM}`"))
    )
    absorbs = follows & ~resumes & ~after
    end = (
        F.when(resumes, F.col("seen"))
        .when(absorbs, F.col(f"next.`{VALID_TO}`"))
        .when(follows, F.col(f"next.`{VALID_FROM}`"))
    )
    cut = F.when(old.isNotNull() & (F.col(f"old.`{VALID_FROM}`") < at), old.withField(VALID_TO, at))
    again = {VALID_FROM: F.col("seen"), VALID_TO: F.col(f"old.`{VALID_TO}`")}
    again = [again.get(c, F.col(f"sighting.`{c}`")).alias(c) for c in names]
    resumed = F.when(resumes, F.struct(*again))
    reopened = (F.col(f"old.`{VALID_FROM}`") == at) & F.col(f"old.`{VALID_TO}`").isNotNull() & end.isNull()
    kept = F.lit(None).cast("boolean")
    rows = F.array(
        F.struct(row.withField(VALID_TO, end).alias("r"), kept.alias("gone")),
        F.struct(cut.alias("r"), kept.alias("gone")),
        F.struct(resumed.alias("r"), kept.alias("gone")),
        F.struct(F.when(absorbs, following).alias("r"), F.lit(True).alias("gone")),
        # Replaced by an open version, which is kept elsewhere.
        F.struct(F.when(reopened, old).alias("r"), F.lit(True).alias("gone")),
    )
    changed = joined.filter(old.isNull() | differs(check_cols))
    each = changed.select(F.explode(rows).alias("e")).filter("e.r IS NOT NULL")
    return each.select("e.r.*", F.col("e.gone").alias("__gone"))


def dimension_increment(history: DataFrame, mark=None) -> DataFrame:
    """Versions opened after the mark, or closed after it; all without a mark."""
    if mark is None:
        return history
    mark = _timestamp(mark)
    return history.filter((F.col(VALID_FROM) > mark) | (F.col(VALID_TO) > mark))


def closed_end() -> Column:
    """End of a version, with the far future for an open one."""
    return F.coalesce(F.col(VALID_TO), _timestamp(OPEN_END)).alias(VALID_TO)


def is_current() -> Column:
    return F.col(VALID_TO).isNull().alias("is_current")
