"""What tables are made of: runs of rows, and a log of commits.

A write puts its rows into a folder of its own, a run, and then commits a manifest that
lists every run of the new version with its rows, bytes and the least and largest value
of its columns. The manifest of a version is created only if there is none, so of two
writers one has to look again at what the other did. A reader opens the newest manifest
and the runs it names; no folder is searched and nothing is counted.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace
from datetime import date, datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    AtomicType,
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    FractionalType,
    IntegralType,
    NumericType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tidemart.operators.small import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS
from tidemart.sources.filesystem import child_names, delete, put_if_absent, read_text

#: Marks a row that says its key is gone.
GONE = "__gone"
#: Numbers the rows of a key while they are written.
SEEN = "__seen"
_RUN = "__run"
#: Runs of one tier that are merged, the rows that the smallest tier holds, and the
#: share of the oldest run beyond which newer ones are merged into it.
FAN, SMALLEST, SHARE = 4, 10_000, 1.0
#: Manifests that are kept, so that no writer can be so late that its number is free.
MANIFESTS = 1000


@dataclass(frozen=True)
class Run:
    """A folder of rows. ``version`` is that of its commit, or the last one merged in."""

    part: str
    path: str
    rows: int
    size: int
    least: dict = field(default_factory=dict)
    most: dict = field(default_factory=dict)
    version: int = -1
    # The column that decided on conflicts, and whether rows may replace or remove
    # others of their part.
    newest_by: str | None = None
    replaces: bool = True


@dataclass(frozen=True)
class State:
    """A committed version: runs from old to new, schemas by part, properties."""

    version: int = -1
    runs: tuple[Run, ...] = ()
    schemas: dict = field(default_factory=dict)
    properties: dict = field(default_factory=dict)

    def of(self, part: str) -> list[Run]:
        return [r for r in self.runs if r.part == part]

    def schema(self, part: str) -> StructType:
        return StructType.fromJson(self.schemas[part])


def _tracked(kind: DataType) -> bool:
    return isinstance(kind, NumericType | DateType | TimestampNTZType)


def _parsed(text: str | None, kind: DataType):
    if text is None:
        return None
    if isinstance(kind, IntegralType):
        return int(text)
    if isinstance(kind, DecimalType):
        return Decimal(text)
    if isinstance(kind, FractionalType):
        return float(text)
    return date.fromisoformat(text) if isinstance(kind, DateType) else datetime.fromisoformat(text)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


class Store:
    """A table's folder: its commits and the runs they name."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _numbers(self) -> list[int]:
        names = child_names(self.spark, f"{self.path}/log")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[0] != ".")

    def state(self) -> State:
        """The newest version; an empty one before the first commit."""
        numbers = self._numbers()
        if not numbers:
            return State()
        return self._load(numbers[-1])

    def _load(self, number: int) -> State:
        found = json.loads(read_text(self.spark, f"{self.path}/log/{number:012d}.json"))
        runs = tuple(Run(**r) for r in found["runs"])
        return State(number, runs, found["schemas"], found["properties"])

    def commit(self, state: State) -> bool:
        """Make this the next version, unless another writer has been faster."""
        new = state.version + 1
        runs = tuple(replace(r, version=new) if r.version < 0 else r for r in state.runs)
        text = json.dumps(
            {"runs": [asdict(r) for r in runs], "schemas": state.schemas, "properties": state.properties}
        )
        return put_if_absent(self.spark, f"{self.path}/log/{new:012d}.json", text)

    def change(self, step: Callable[[State], State | None]) -> State | None:
        """Commit what ``step`` makes of the newest version, as often as it takes."""
        while True:
            new = step(self.state())
            if new is None or self.commit(new):
                return new

    def write(self, rows: DataFrame, part: str, measured: dict | None = None, **about) -> Run:
        """Write a run. ``measured`` takes names of further aggregates to their values."""
        path = f"{self.path}/data/{uuid.uuid4().hex}"
        kept = [f for f in rows.schema if f.name not in (GONE, SEEN)]
        tracked = [f for f in kept if _tracked(f.dataType)]
        bytes_ = F.lit(8 * len(rows.columns))
        for f in kept:
            # Eight bytes hold a number or a time; texts and nested values are measured.
            if not isinstance(f.dataType, AtomicType) or isinstance(f.dataType, StringType | BinaryType):
                text = F.octet_length(_quoted(f.name).cast("string"))
                bytes_ = bytes_ + F.coalesce(text, F.lit(0))
        wanted = [F.count(F.lit(1)).alias("n"), F.sum(bytes_.cast("bigint")).alias("size")]
        for i, f in enumerate(tracked):
            wanted += [F.min(_quoted(f.name)).cast("string").alias(f"l{i}")]
            wanted += [F.max(_quoted(f.name)).cast("string").alias(f"m{i}")]
        own = measured or {}
        seen = Observation()
        out = rows.observe(seen, *wanted, *[c.alias(name) for name, c in own.items()])
        out.drop(SEEN).write.parquet(path)
        got = seen.get
        own.update({name: got[name] for name in own})
        least, most = ({f.name: got[f"{x}{i}"] for i, f in enumerate(tracked)} for x in "lm")
        return Run(part, path, got["n"], got["size"] or 0, least, most, **about)

    def read(self, state: State, runs: Sequence[Run]) -> DataFrame:
        """Rows of runs of one part as they were written, with ``__gone``."""
        schema = state.schema(runs[0].part)
        schema = StructType([*schema.fields, StructField(GONE, BooleanType())])
        return self.spark.read.schema(schema).parquet(*[r.path for r in runs])

    def most(self, state: State, part: str, name: str):
        """Largest value that the runs ever took, None without rows."""
        kind = state.schema(part)[name].dataType
        values = [_parsed(r.most.get(name), kind) for r in state.of(part)]
        return max((v for v in values if v is not None), default=None)

    def swap(self, old: Sequence[Run], new: Run) -> bool:
        """Put one run in the place of adjoining ones, unless they are gone already."""
        paths = {r.path for r in old}
        new = replace(new, version=max(r.version for r in old))

        def swapped(state: State) -> State | None:
            if not paths <= {r.path for r in state.runs}:
                return None
            at = next(i for i, r in enumerate(state.runs) if r.path in paths)
            rest = [r for r in state.runs if r.path not in paths]
            return replace(state, runs=(*rest[:at], new, *rest[at:]))

        return self.change(swapped) is not None

    def tracks(self, state: State, part: str, name: str) -> bool:
        return _tracked(state.schema(part)[name].dataType)

    def expire(self, keep: int = 2) -> None:
        """Delete runs that only versions older than the newest ``keep`` name."""
        numbers = self._numbers()
        old, kept = numbers[:-keep], numbers[-keep:]
        needed = {r.path for n in kept for r in self._load(n).runs}
        gone = {r.path for n in old for r in self._load(n).runs} - needed
        for path in gone:
            delete(self.spark, path)
        for n in numbers[: -max(keep, MANIFESTS)]:
            delete(self.spark, f"{self.path}/log/{n:012d}.json")


def may_exceed(run: Run, name: str, value: datetime) -> bool:
    """Whether a time column of the run may hold a later value."""
    most = _parsed(run.most.get(name), TimestampNTZType())
    return most is None or most > value


def small(runs: Sequence[Run]) -> bool:
    """Whether the rows of the runs are few and short enough for a broadcast."""
    return (
        sum(r.rows for r in runs) <= MAX_BROADCAST_ROWS
        and sum(r.size for r in runs) <= MAX_BROADCAST_BYTES
    )


def _agree(df: DataFrame, keys: Sequence[str], named: DataFrame) -> Column:
    """The keys of the one side equal those of the other, called ``__k0, __k1, ...``."""
    same = [df[k].eqNullSafe(named[f"__k{i}"]) for i, k in enumerate(keys)]
    return reduce(Column.__and__, same)


def merged(store: Store, state: State, runs: Sequence[Run], keys: Sequence[str], gone: bool = False) -> DataFrame:
    """Rows of the runs, of each key the one that counts.

    Rows of runs that replace nothing stand as they are, so does the oldest run. Of the
    others the newest row of a key counts, or the one with the largest value of
    ``newest_by`` where runs name it. As long as they are few, the rest is read where
    it lies and not shuffled. ``gone`` keeps the marks of removed keys.
    """
    plain = [r for i, r in enumerate(runs) if i == 0 or not r.replaces]
    deltas = [r for i, r in enumerate(runs) if i > 0 and r.replaces]
    base = store.read(state, plain)
    if not deltas:
        return base if gone else base.filter(F.col(GONE).isNull()).drop(GONE)
    by = deltas[0].newest_by
    parts = [store.read(state, [r]).withColumn(_RUN, F.lit(i)) for i, r in enumerate(deltas)]
    delta = reduce(DataFrame.unionByName, parts)
    order = F.struct(F.col(by), F.col(_RUN)) if by else F.col(_RUN)
    if len(deltas) > 1:
        best = delta.groupBy(*keys).agg(F.max_by(F.struct(*delta.columns), order).alias("r"))
        delta = best.select("r.*")
    marked = F.broadcast if small(deltas) else lambda df: df
    names = [F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]
    told = marked(delta.select(*names, *([F.col(by).alias("__by")] if by else [])))
    same = _agree(base, keys, told)
    if by:
        # A NULL is older than any time, and gives way to another one.
        newer = base[by].isNotNull() & (told["__by"].isNull() | (told["__by"] < base[by]))
        kept = base.join(told, same & ~newer, "left_anti")
        winners = base.select(*names, F.col(by).alias("__by"))
        if small(deltas):
            asked = marked(delta.select(*keys))
            winners = winners.join(asked, _agree(asked, keys, winners), "left_semi")
        same = _agree(delta, keys, winners)
        older = winners["__by"].isNotNull() & (delta[by].isNull() | (delta[by] < winners["__by"]))
        delta = delta.join(winners, same & older, "left_anti")
    else:
        kept = base.join(told, same, "left_anti")
    rows = kept.unionByName(delta.drop(_RUN))
    return rows if gone else rows.filter(F.col(GONE).isNull()).drop(GONE)


def _tier(run: Run) -> int:
    tier, most = 0, SMALLEST
    while run.rows > most:
        tier, most = tier + 1, most * FAN
    return tier


def due(runs: Sequence[Run], whole: bool = True) -> list[Run]:
    """The runs that should become one, always the newest ones; none if all is well.

    Runs of one size are merged when there are ``FAN`` of them, and everything when the
    newer runs are no longer small next to the oldest: a row is rewritten a number of
    times that grows with the logarithm of the table. Without ``whole``, for rows that
    replace none, the oldest run is left alone.
    """
    newer = runs[1:]
    rows = sum(r.rows for r in newer)
    if whole and len(newer) > 1 and rows > SMALLEST * FAN and rows > SHARE * runs[0].rows:
        return list(runs)
    last = _tier(runs[-1]) if runs else 0
    same = []
    for r in reversed(newer):
        if _tier(r) > last:
            break
        same.insert(0, r)
    return same if len(same) >= FAN else []
