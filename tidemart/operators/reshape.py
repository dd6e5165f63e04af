"""Column selection, pivoting, profiles and unions of unlike tables."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import CharType, DataType, StringType, VarcharType

from tidemart.constants import SOURCE_RELATION
from tidemart.functions.scalar import ColumnOrName, column
from tidemart.functions.text import slugify_name
from tidemart.operators.fingerprint import unequal_rows

_STRINGS = (StringType, VarcharType, CharType)


def _lower(names: Sequence[str]) -> set[str]:
    return {n.lower() for n in names}


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def columns_except(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Column names without the excluded ones, compared without case."""
    unwanted = _lower(exclude)
    return [c for c in df.columns if c.lower() not in unwanted]


def star(
    df: DataFrame,
    exclude: Sequence[str] = (),
    prefix: str = "",
    suffix: str = "",
    relation_alias: str | None = None,
) -> list[Column]:
    """All columns but the excluded ones, for use in ``select`` or ``groupBy``."""
    owner = f"`{relation_alias}`." if relation_alias else ""
    return [
        F.col(f"{owner}`{c}`").alias(f"{prefix}{c}{suffix}")
        for c in columns_except(df, exclude)
    ]


def nullcheck(df: DataFrame) -> DataFrame:
    """Empty strings become NULL in every string column."""
    return df.select(
        *[
            F.nullif(_quoted(f.name), F.lit("")).alias(f.name)
            if isinstance(f.dataType, _STRINGS)
            else _quoted(f.name)
            for f in df.schema.fields
        ]
    )


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    """Distinct values of a column without NULL."""
    return df.select(name).filter(_quoted(name).isNotNull()).distinct()


def value_profile(
    df: DataFrame,
    name: str,
    order_by: Column | None = None,
    max_records: int | None = None,
    where: str | Column | None = None,
) -> DataFrame:
    """Values of a column with their row counts, most frequent first.

    NULL is a value. ``order_by`` may use the columns ``value`` and ``n_rows``;
    equal counts are ordered by value.
    """
    if where is not None:
        df = df.filter(where)
    counts = df.groupBy(_quoted(name).alias("value")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    first = F.col("n_rows").desc() if order_by is None else order_by
    ordered = counts.orderBy(first, F.col("value").asc_nulls_last())
    return ordered if max_records is None else ordered.limit(max_records)


def column_values(
    spark: SparkSession, table: str, name: str, default: Sequence | None = None, **profile
) -> DataFrame:
    """Values of a catalog table's column, as ``value_profile`` orders them.

    Without the table, the default values in their given order.
    """
    if spark.catalog.tableExists(table):
        return value_profile(spark.table(table), name, **profile).select("value")
    if default is None:
        raise ValueError(f"{table} does not exist and no default was given")
    return spark.createDataFrame([(v,) for v in default], ["value"])


def group_by_first(df: DataFrame, n: int):
    """Group by the first ``n`` columns."""
    return df.groupBy(*[_quoted(c) for c in df.columns[:n]])


# Comparison and aggregate names a pivot accepts.
_COMPARE = {
    "=": operator.eq,
    "!=": operator.ne,
    "<>": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
}
_AGGREGATE = {"sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg, "count": F.count}
_DISTINCT = {"sum": F.sum_distinct, "count": F.count_distinct}


def pivot_columns(
    name: str,
    values: Sequence,
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value: ColumnOrName | int = 1,
    else_value: ColumnOrName | int | None = 0,
    quote_identifiers: bool = True,
    distinct: bool = False,
) -> list[Column]:
    """One aggregate per listed value, for ``groupBy(...).agg(*columns)``.

    All aggregates are computed in one pass with partial aggregation, and the
    values are given, so there is no extra job that looks for them.
    """

    def branch(v) -> Column:
        return column(v) if isinstance(v, (str, Column)) else F.lit(v)

    aggregate = (_DISTINCT if distinct else _AGGREGATE).get(agg)
    # min, max and avg-free aggregates do not change under distinct.
    if aggregate is None and distinct and agg in ("min", "max"):
        aggregate = _AGGREGATE[agg]
    if aggregate is None:
        raise ValueError(f"unsupported aggregate {agg!r} (distinct={distinct})")

    out = []
    for value in values:
        case = F.when(
            _COMPARE[cmp](_quoted(name), F.lit(value)), branch(then_value)
        ).otherwise(branch(else_value))
        label = f"{prefix}{value}{suffix}"
        out.append(
            aggregate(case).alias(label if quote_identifiers else slugify_name(label))
        )
    return out


def unpivot(
    df: DataFrame,
    cast_to: str | DataType = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """One row per remaining column and input row; NULL values are kept.

    ``exclude`` columns are repeated on every row, ``remove`` columns dropped.
    """
    kept_names = _lower(exclude)
    kept = [c for c in df.columns if c.lower() in kept_names]
    melted = columns_except(df, [*exclude, *remove])
    if not melted:
        raise ValueError("no columns left to unpivot")
    typed = df.select(
        *[_quoted(c) for c in kept],
        *[_quoted(c).cast(cast_to).alias(c) for c in melted],
    )
    return typed.unpivot(
        [_quoted(c) for c in kept],
        [_quoted(c) for c in melted],
        field_name,
        value_name,
    )


def union_relations(
    relations: Mapping[str, DataFrame],
    column_override: Mapping[str, str] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    source_column_name: str | None = SOURCE_RELATION,
    where: str | None = None,
) -> DataFrame:
    """Union of named tables over all their columns, missing ones as NULL.

    Columns come in the order first seen, with the type first seen or the
    overriding one. ``where`` is applied to each table before its columns are
    chosen, so it may use columns that are left out.
    """
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    override = dict(column_override or {})
    wanted, unwanted = _lower(include), _lower(exclude)

    types: dict[str, DataType] = {}
    for df in relations.values():
        seen = _lower(types)
        types.update(
            (f.name, f.dataType)
            for f in df.schema.fields
            if f.name.lower() not in unwanted | seen
            and (not wanted or f.name.lower() in wanted)
        )
    if not types:
        raise ValueError(f"no columns found to union for {list(relations)}")

    def aligned(name: str, df: DataFrame) -> DataFrame:
        rows = df.filter(where) if where else df
        present = _lower(df.columns)
        label = (
            [] if source_column_name is None else [F.lit(name).alias(source_column_name)]
        )
        return rows.select(
            *label,
            *[
                (_quoted(c) if c.lower() in present else F.lit(None))
                .cast(override.get(c, kind))
                .alias(c)
                for c, kind in types.items()
            ],
        )

    return reduce(
        DataFrame.unionAll, [aligned(name, df) for name, df in relations.items()]
    )


def _like(name: str, pattern: str) -> bool:
    """SQL LIKE without case, for names known on the driver."""
    import re

    parts = (
        ".*" if ch == "%" else "." if ch == "_" else re.escape(ch)
        for ch in pattern.lower()
    )
    return re.fullmatch("".join(parts), name.lower(), re.DOTALL) is not None


def matching_tables(names: Sequence[str], pattern: str, exclude: str = "") -> list[str]:
    """Names like ``pattern`` and not like ``exclude``, in sorted order."""
    return sorted(n for n in set(names) if _like(n, pattern) and not _like(n, exclude))


def tables_by_pattern(
    spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = ""
) -> dict[str, DataFrame]:
    """Catalog tables of the matching schemas, by full name."""
    found = {}
    for schema in matching_tables(
        [d.name for d in spark.catalog.listDatabases()], schema_pattern
    ):
        names = [t.name for t in spark.catalog.listTables(schema) if not t.isTemporary]
        for name in matching_tables(names, table_pattern, exclude):
            found[f"{schema}.{name}"] = spark.table(f"`{schema}`.`{name}`")
    return found


def tables_by_prefix(
    spark: SparkSession, schema: str, prefix: str, exclude: str = ""
) -> dict[str, DataFrame]:
    return tables_by_pattern(spark, schema, f"{prefix}%", exclude)


def difference(
    a: DataFrame,
    b: DataFrame,
    names: Sequence[str] | None = None,
    alike: bool = False,
) -> DataFrame:
    """Set difference both ways, tagged ``a_minus_b`` or ``b_minus_a``.

    One grouped pass over both sides instead of two EXCEPTs: duplicates fall
    together before the exchange and each side is read once. For tables that are
    ``alike``, fingerprints of buckets are compared first, and only rows of unequal
    buckets are shuffled, at the price of another reading.
    """
    names = list(names or a.columns)
    left = a.select(*[_quoted(c) for c in names]).withColumn("__a", F.lit(1))
    right = b.select(*[_quoted(c) for c in names]).withColumn("__a", F.lit(0))
    both = left.unionAll(right)
    if alike:
        both = unequal_rows(both, names, F.col("__a") == 1)
    return (
        both.groupBy(*[_quoted(c) for c in names])
        .agg(F.min("__a").alias("__lo"), F.max("__a").alias("__hi"))
        .filter(F.col("__lo") == F.col("__hi"))
        .select(
            F.when(F.col("__hi") == 1, "a_minus_b")
            .otherwise("b_minus_a")
            .alias("which_diff"),
            *[_quoted(c) for c in names],
        )
    )


def except_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that are not in ``b``."""
    return a.subtract(b)
