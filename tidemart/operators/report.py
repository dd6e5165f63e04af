"""All checks of a layer as one table: name, failures, pass.

Declared checks share their scans. Every row of a table is expanded into what its checks
look at: a broken rule, the key that has to be unique, a value outside a list, a foreign
key or the key that it refers to. All tables' entries meet in one grouping by check and
key, partly counted before the exchange, and a second one adds up the failures. Checks
given as a query of their own add their own aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegralType

from tidemart.operators import quality as q

Tables = Mapping[str, DataFrame]


def _count_rows(violations: DataFrame) -> DataFrame:
    return violations.agg(F.count(F.lit(1)).alias("failures"))


def sum_of(name: str) -> Callable[[DataFrame], DataFrame]:
    """Failures as the sum of a column, NULL counted as 0."""
    return lambda v: v.agg(F.coalesce(F.sum(name), F.lit(0)).alias("failures"))


@dataclass(frozen=True)
class RowCheck:
    """A rule on one row of a table, given as the predicate of a violation."""

    name: str
    table: str
    violation: Callable[[], Column]


@dataclass(frozen=True)
class TableCheck:
    """A rule given as a query of violating rows."""

    name: str
    violations: Callable[[Tables], DataFrame]
    failures: Callable[[DataFrame], DataFrame] = _count_rows


@dataclass(frozen=True)
class Threshold:
    """Bounds of a passing result; the default is no failure at all.

    ``error_if`` and ``warn_if`` are comparisons that the number of failures is held
    against, such as ``"<1"`` or ``"BETWEEN 2 AND 5"``; each replaces its bound.
    """

    error_above: int = 0
    warn_above: int = 0
    # Turns the check round: it must find something.
    expect_failures: bool = False
    error_if: str | None = None
    warn_if: str | None = None

    def status(self) -> Column:
        """``error``, ``warn`` or ``pass`` by the column ``failures``."""
        error = self.error_if or ("< 1" if self.expect_failures else f"> {self.error_above}")
        warn = self.warn_if or ("< 1" if self.expect_failures else f"> {self.warn_above}")
        return (
            F.when(F.expr(f"failures {error}"), "error")
            .when(F.expr(f"failures {warn}"), "warn")
            .otherwise("pass")
        )


@dataclass(frozen=True)
class KeyCheck:
    """A rule on the keys of a table, told by its ``kind``.

    ``unique`` counts values that occur twice, NULL passes; ``combination`` the same of
    several columns, NULL being a value; ``values`` counts values outside ``accepted``;
    ``parent`` counts rows whose value is not in ``field`` of the table ``to``, NULL
    passes; ``present`` does so too, and NULL fails.
    """

    name: str
    table: str
    columns: tuple[str, ...]
    kind: str
    accepted: tuple = ()
    to: str | None = None
    field: str | None = None

    def violations(self, t: Tables) -> DataFrame:
        """The rows or values that break the rule, each with its own scan."""
        df, name = t[self.table], self.columns[0]
        if self.kind == "unique":
            return q.unique(df, name)
        if self.kind == "combination":
            return q.unique_combination_of_columns(df, self.columns)
        if self.kind == "values":
            return q.accepted_values(df, name, self.accepted)
        if self.kind == "parent":
            return q.relationships(df, name, t[self.to], self.field)
        to = t[self.to].select(F.col(self.field).alias(name))
        return df.select(name).join(to, name, "left_anti")


def _text(df: DataFrame, name: str) -> Column:
    """A value as text that is equal for equal values."""
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, FloatType | DoubleType):
        c = c + 0.0  # minus zero
    return c.cast("string")


def _same_kind(a: DataType, b: DataType) -> bool:
    return a == b or isinstance(a, IntegralType) and isinstance(b, IntegralType)


def _comparable(tables: Tables, c: KeyCheck) -> bool:
    """Whether both sides of a foreign key have equal texts for equal values."""
    if c.to is None:
        return True
    own, other = tables[c.table].schema[c.columns[0]], tables[c.to].schema[c.field]
    return _same_kind(own.dataType, other.dataType)


def _entry(number: int, key: Column, side: str = "own") -> Column:
    is_own = F.lit(1 if side == "own" else 0).cast("bigint")
    return F.struct(
        F.lit(number).alias("check"),
        key.cast("array<string>").alias("key"),
        is_own.alias("own"),
        (1 - is_own).alias("other"),
    )


def _entries(df: DataFrame, checks: Sequence[tuple[int, RowCheck | KeyCheck, str]]) -> DataFrame:
    """What the checks look at in a table, from one scan."""
    found = []
    for number, c, side in checks:
        if isinstance(c, RowCheck):
            found.append(F.when(c.violation(), _entry(number, F.lit(None))))
            continue
        names = c.columns if side == "own" else (c.field,)
        entry = _entry(number, F.array(*[_text(df, n) for n in names]), side)
        value = F.col(f"`{names[0]}`")
        if c.kind == "values":
            entry = F.when(q.accepted_values_violation(names[0], c.accepted), entry)
        elif c.kind == "unique" or c.kind == "parent" or side == "other":
            entry = F.when(value.isNotNull(), entry)
        found.append(entry)
    listed = F.filter(F.array(*found), lambda e: e.isNotNull())
    return df.select(F.explode(listed).alias("e")).select("e.*")


def _shared_report(tables: Tables, checks: Sequence[RowCheck | KeyCheck]) -> DataFrame:
    by_table: dict[str, list] = {}
    kinds: dict[str, list[int]] = {}
    for number, c in enumerate(checks):
        by_table.setdefault(c.table, []).append((number, c, "own"))
        kinds.setdefault(c.kind if isinstance(c, KeyCheck) else "row", []).append(number)
        if isinstance(c, KeyCheck) and c.to:
            by_table.setdefault(c.to, []).append((number, c, "other"))
    entries = reduce(DataFrame.unionByName, [_entries(tables[t], each) for t, each in by_table.items()])
    keys = entries.groupBy("check", "key").agg(F.sum("own").alias("own"), F.sum("other").alias("other"))
    of = lambda *names: F.col("check").isin(*[i for n in names for i in kinds.get(n, [-1])])
    failures = (
        F.when(of("unique", "combination"), (F.col("own") > 1).cast("bigint"))
        .when(of("values"), F.lit(1).cast("bigint"))
        .when(of("parent", "present"), F.when(F.col("other") == 0, F.col("own")).otherwise(0))
        .otherwise(F.col("own"))
    )
    counted = keys.groupBy("check").agg(F.sum(failures).alias("n"))
    named = [F.struct(F.lit(i).alias("check"), F.lit(c.name).alias("check_name")) for i, c in enumerate(checks)]
    every = entries.sparkSession.range(1).select(F.explode(F.array(*named)).alias("c")).select("c.*")
    return every.join(counted, "check", "left").select(
        "check_name", F.coalesce("n", F.lit(0)).alias("failures")
    )


def quality_report(
    tables: Tables,
    checks: Sequence[RowCheck | KeyCheck | TableCheck],
    thresholds: Mapping[str, Threshold] | None = None,
) -> DataFrame:
    """One row per check: ``check_name``, ``failures``, ``status``, ``passed``."""
    thresholds = thresholds or {}
    shared, parts = [], []
    for c in checks:
        if isinstance(c, RowCheck) or isinstance(c, KeyCheck) and _comparable(tables, c):
            shared.append(c)
            continue
        count = c.failures if isinstance(c, TableCheck) else _count_rows
        parts.append(
            count(c.violations(tables)).select(
                F.lit(c.name).alias("check_name"),
                F.col("failures").cast("bigint").alias("failures"),
            )
        )
    if shared:
        parts.append(_shared_report(tables, shared))
    report = reduce(DataFrame.unionByName, parts)

    status = Threshold().status()
    for name, limit in thresholds.items():
        status = F.when(F.col("check_name") == name, limit.status()).otherwise(status)
    return report.select(
        "check_name",
        "failures",
        status.alias("status"),
        (status != "error").alias("passed"),
    )


def not_null_checks(table: str, *names: str) -> list[RowCheck]:
    return [
        RowCheck(f"{table}.{n}.not_null", table, lambda n=n: q.null_violation(n))
        for n in names
    ]


def accepted_range_check(table: str, name: str, low=None, high=None) -> RowCheck:
    return RowCheck(
        f"{table}.{name}.accepted_range",
        table,
        lambda: q.range_violation(name, low, high),
    )


def row_check(table: str, rule: str, violation: str) -> RowCheck:
    """A rule whose violation is an SQL predicate."""
    return RowCheck(f"{table}.{rule}", table, lambda: F.expr(violation))


def accepted_values_check(table: str, name: str, values: Sequence) -> KeyCheck:
    """Counts the distinct values outside the list."""
    return KeyCheck(f"{table}.{name}.accepted_values", table, (name,), "values", tuple(values))


def unique_check(table: str, name: str) -> KeyCheck:
    return KeyCheck(f"{table}.{name}.unique", table, (name,), "unique")


def unique_combination_check(table: str, *names: str) -> KeyCheck:
    return KeyCheck(f"{table}.{'_'.join(names)}.unique_combination", table, names, "combination")


def relationships_check(table: str, name: str, to: str, field: str) -> KeyCheck:
    return KeyCheck(f"{table}.{name}.relationships", table, (name,), "parent", (), to, field)


def present_check(table: str, rule: str, name: str, to: str, field: str) -> KeyCheck:
    """As a relationship, but a NULL has no partner either."""
    return KeyCheck(f"{table}.{rule}", table, (name,), "present", (), to, field)
