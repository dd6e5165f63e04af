"""Data-quality checks: each returns the rows that break its rule.

A check that looks at one row at a time also exists as a predicate
(``*_violation``), so that many of them can be counted in one scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from tidemart.functions.calendar import clock_time, date_add
from tidemart.functions.scalar import ColumnOrName, column
from tidemart.functions.text import slugify_name
from tidemart.operators.fingerprint import unequal_rows
from tidemart.operators.neighbours import COPIES, repeat_rows, with_neighbour
from tidemart.operators.reshape import columns_except, difference


def _n_rows() -> Column:
    return F.count(F.lit(1))


# --- rules on one row ------------------------------------------------------


def range_violation(
    c: ColumnOrName, min_value=None, max_value=None, inclusive: bool = True
) -> Column:
    c = column(c)
    broken = F.lit(False)
    if min_value is not None:
        low = column(min_value) if isinstance(min_value, Column) else F.lit(min_value)
        broken = broken | ~((c >= low) if inclusive else (c > low))
    if max_value is not None:
        high = column(max_value) if isinstance(max_value, Column) else F.lit(max_value)
        broken = broken | ~((c <= high) if inclusive else (c < high))
    return broken


def expression_violation(expression: str | Column) -> Column:
    return ~(F.expr(expression) if isinstance(expression, str) else expression)


def null_violation(c: ColumnOrName) -> Column:
    return column(c).isNull()


def accepted_values_violation(c: ColumnOrName, values: Sequence) -> Column:
    return ~column(c).isin(*values)


def empty_string_violation(c: ColumnOrName, trim_whitespace: bool = True) -> Column:
    c = column(c)
    return (F.trim(c) if trim_whitespace else c) == ""


def accepted_range(
    df: DataFrame, c: ColumnOrName, min_value=None, max_value=None, inclusive=True
) -> DataFrame:
    """Rows outside the range; NULL passes."""
    return df.filter(range_violation(c, min_value, max_value, inclusive))


def expression_is_true(
    df: DataFrame,
    expression: str,
    column_name: str | None = None,
    where: str | None = None,
) -> DataFrame:
    """Rows for which the expression is false; NULL passes."""
    rows = df.filter(where) if where else df
    text = f"{column_name} {expression}" if column_name else expression
    return rows.filter(expression_violation(text))


def not_null(df: DataFrame, name: str) -> DataFrame:
    return df.filter(null_violation(name))


def not_empty_string(
    df: DataFrame, name: str, trim_whitespace: bool = True
) -> DataFrame:
    """Empty values of the column; NULL passes."""
    c = F.trim(F.col(name)) if trim_whitespace else F.col(name)
    return df.select(c.alias(name)).filter(F.col(name) == "")


def rows_not_equal(
    df: DataFrame, actual: str, expected: str, null_safe: bool = False
) -> DataFrame:
    """Rows whose two columns differ.

    A pair with a NULL passes, unless ``null_safe`` asks for an exact match.
    """
    a, e = F.col(actual), F.col(expected)
    return df.filter(~a.eqNullSafe(e) if null_safe else a != e)


# --- rules on values and groups --------------------------------------------


def unique(df: DataFrame, name: str) -> DataFrame:
    """Values that occur more than once, with their row count; NULL passes."""
    return (
        df.filter(F.col(name).isNotNull())
        .groupBy(F.col(name).alias("unique_field"))
        .agg(_n_rows().alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def unique_combination_of_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once."""
    return df.groupBy(*names).agg(_n_rows().alias("n")).filter("n > 1").drop("n")


def accepted_values(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    """Values not in the list, with their row count; NULL passes."""
    return (
        df.filter(accepted_values_violation(name, values))
        .groupBy(F.col(name).alias("value_field"))
        .agg(_n_rows().alias("n_records"))
    )


def not_accepted_values(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    """Forbidden values that occur."""
    return (
        df.filter(F.col(name).isin(*values))
        .select(F.col(name).alias("value_field"))
        .distinct()
    )


def at_least_one(
    df: DataFrame, name: str, group_by: Sequence[str] = ()
) -> DataFrame:
    """Groups without any value; without groups, one row if there is no value.

    The ungrouped form stops reading at the first value it meets.
    """
    if group_by:
        counted = df.groupBy(*group_by).agg(F.count(name).alias("filler_column"))
    else:
        probe = df.select(name).filter(F.col(name).isNotNull()).limit(1)
        counted = probe.agg(F.count(name).alias("filler_column"))
    return counted.filter(F.col("filler_column") == 0)


def not_constant(df: DataFrame, name: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups in which the column has exactly one distinct value.

    One value means that the smallest equals the largest: two plain aggregates
    instead of a shuffle of the distinct values.
    """
    spread = df.groupBy(*group_by).agg(
        F.min(name).alias("__lo"), F.max(name).alias("__hi")
    )
    return spread.filter(F.col("__lo") == F.col("__hi")).select(
        *group_by, F.lit(1).cast("bigint").alias("filler_column")
    )


def not_null_proportion(
    df: DataFrame,
    name: str,
    at_least: float,
    at_most: float = 1.0,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Groups whose share of non-NULL rows is outside the bounds."""
    share = df.groupBy(*group_by).agg(
        F.count(name).alias("__filled"), _n_rows().alias("__all")
    )
    share = share.select(
        *group_by,
        F.try_divide(F.col("__filled"), F.col("__all")).alias("not_null_proportion"),
    )
    p = F.col("not_null_proportion")
    return share.filter((p < at_least) | (p > at_most))


def recency(
    df: DataFrame,
    field: str,
    part: str,
    interval: int,
    now,
    ignore_time_component: bool = False,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Groups whose newest value is older than ``now`` minus the interval."""
    kind = "date" if ignore_time_component else "timestamp_ntz"
    now = now if isinstance(now, Column) else clock_time(now)
    threshold = date_add(part, -interval, now).cast(kind)
    newest = df.groupBy(*group_by).agg(F.max(field).cast(kind).alias("most_recent"))
    return newest.select("*", threshold.alias("threshold")).filter(
        F.col("most_recent") < F.col("threshold")
    )


def sequential_values(
    df: DataFrame,
    name: str,
    interval: int = 1,
    part: str | None = None,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Rows that do not follow the previous value by the fixed step."""
    previous = f"previous_{slugify_name(name)}"

    def broken(before: Column) -> Column:
        if part is None:
            rule = F.col(name) == before + F.lit(interval)
        else:
            moved = date_add(part, interval, before)
            rule = F.col(name).cast("timestamp_ntz") == moved
        return F.coalesce(~rule, F.lit(False))

    # Among equal rows all but the first follow the value itself.
    repeats = F.col(COPIES) - 1
    # NULL sorts last and never breaks the rule, so it can be left out.
    rows = with_neighbour(
        df.filter(F.col(name).isNotNull()).select(*group_by, name),
        groups=list(group_by),
        order=[name],
        value=name,
        out="__before",
        direction=-1,
        keep=lambda n: broken(n[name]) | ((repeats > 0) & broken(F.col(name))),
    )

    def found(before: Column, times: Column) -> Column:
        n = F.when(broken(before), times).otherwise(F.lit(0)).cast("bigint")
        return F.struct(before.alias("p"), n.alias("n"))

    both = F.array(
        found(F.col(f"__before.{name}"), F.lit(1)), found(F.col(name), repeats)
    )
    counted = rows.select(*group_by, name, F.explode(both).alias("__row"))
    return repeat_rows(counted, F.col("__row.n")).select(
        *group_by, name, F.col("__row.p").alias(previous)
    )


# Comparison of an upper bound with the next lower bound, per treatment of gaps.
_GAPS = {
    "not_allowed": ("equal_to", lambda a, b: a == b),
    "allowed": ("less_than_or_equal_to", lambda a, b: a <= b),
    "required": ("less_than", lambda a, b: a < b),
}
_LENGTH = {
    False: ("less_than", lambda a, b: a < b),
    True: ("less_than_or_equal_to", lambda a, b: a <= b),
}


def mutually_exclusive_ranges(
    df: DataFrame,
    lower_bound: ColumnOrName,
    upper_bound: ColumnOrName,
    partition_by: ColumnOrName | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
) -> DataFrame:
    """Ranges that are empty, or that run into the next one of their group."""
    if gaps not in _GAPS:
        raise ValueError(f"gaps must be one of {sorted(_GAPS)}, got {gaps!r}")
    gap_words, reaches = _GAPS[gaps]
    length_words, ordered = _LENGTH[bool(zero_length_range_allowed)]
    own_rule = f"lower_bound_{length_words}_upper_bound"
    next_rule = f"upper_bound_{gap_words}_next_lower_bound"

    groups = [] if partition_by is None else ["partition_by_col"]
    bounds = df.select(
        *([] if partition_by is None else [column(partition_by).alias(groups[0])]),
        column(lower_bound).alias("lower_bound"),
        column(upper_bound).alias("upper_bound"),
    )
    lower, upper = F.col("lower_bound"), F.col("upper_bound")
    own_holds = F.coalesce(ordered(lower, upper), F.lit(False))
    repeats = F.col(COPIES) - 1

    def next_holds(next_lower: Column, is_last: Column) -> Column:
        return F.coalesce(reaches(upper, next_lower), is_last)

    def broken(next_lower: Column, is_last: Column) -> Column:
        return ~(own_holds & next_holds(next_lower, is_last))

    # Of equal ranges all but the last are followed by the range itself.
    rows = with_neighbour(
        bounds,
        groups=groups,
        order=["lower_bound", "upper_bound"],
        value="lower_bound",
        out="__next",
        direction=1,
        keep=lambda n: broken(n["lower_bound"], n.isNull())
        | ((repeats > 0) & broken(lower, F.lit(False))),
    )

    def judged(next_lower: Column, is_last: Column, times: Column) -> Column:
        n = F.when(broken(next_lower, is_last), times).otherwise(F.lit(0))
        return F.struct(
            next_lower.alias("next_lower_bound"),
            is_last.alias("is_last_record"),
            own_holds.alias(own_rule),
            next_holds(next_lower, is_last).alias(next_rule),
            n.cast("bigint").alias("copies"),
        )

    both = F.array(
        judged(F.col("__next.lower_bound"), F.col("__next").isNull(), F.lit(1)),
        judged(lower, F.lit(False), repeats),
    )
    broken_rows = rows.select(
        *groups, "lower_bound", "upper_bound", F.explode(both).alias("j")
    )
    return repeat_rows(broken_rows, F.col("j.copies")).select(
        *groups,
        "lower_bound",
        "upper_bound",
        "j.next_lower_bound",
        "j.is_last_record",
        f"j.{own_rule}",
        f"j.{next_rule}",
    )


# --- rules on two tables ---------------------------------------------------


def cardinality_equality(
    df: DataFrame, name: str, to: DataFrame, field: str
) -> DataFrame:
    """Values whose row counts differ between the columns, one row per side.

    Only values of buckets whose fingerprints differ are counted.
    """
    a = df.select(F.col(name).alias("value"), F.lit(1).alias("__a"), F.lit(0).alias("__b"))
    b = to.select(F.col(field).alias("value"), F.lit(0).alias("__a"), F.lit(1).alias("__b"))
    counts = (
        unequal_rows(a.unionAll(b), ["value"], F.col("__a") == 1)
        .groupBy("value")
        .agg(F.sum("__a").alias("n_a"), F.sum("__b").alias("n_b"))
        .filter(F.col("n_a") != F.col("n_b"))
    )
    return (
        counts.select("value", F.explode(F.array("n_a", "n_b")).alias("num_rows"))
        .filter(F.col("num_rows") > 0)
        .withColumnRenamed("value", name)
    )


def _paired_counts(
    df: DataFrame, other: DataFrame, group_by: Sequence[str], names: tuple[str, str]
) -> DataFrame:
    """Row counts of both tables per group, or of the whole tables.

    A group that only one table has gets NULL for the other; so does a NULL
    group, as NULL never equals NULL in a join.
    """
    a = df.groupBy(*group_by).agg(_n_rows().alias(names[0])).alias("a")
    b = other.groupBy(*group_by).agg(_n_rows().alias(names[1])).alias("b")
    if group_by:
        same = reduce(and_, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in group_by])
    else:
        same = F.lit(True)
    return a.join(b, same, "full").select(
        *[F.col(f"{t}.{c}").alias(f"{c}_{t}") for c in group_by for t in ("a", "b")],
        *names,
    )


def equal_rowcount(
    df: DataFrame, compare: DataFrame, group_by: Sequence[str] = ()
) -> DataFrame:
    """Counts per group with their difference; failures are its sum."""
    counts = _paired_counts(df, compare, group_by, ("count_a", "count_b"))
    return counts.withColumn(
        "diff_count", F.abs(F.col("count_a") - F.col("count_b"))
    )


def fewer_rows_than(
    df: DataFrame, compare: DataFrame, group_by: Sequence[str] = ()
) -> DataFrame:
    """Counts per group; ``row_count_delta`` is 0 where this table has fewer."""
    ours, theirs = "count_our_model", "count_comparison_model"
    counts = _paired_counts(df, compare, group_by, (ours, theirs))
    excess = F.col(ours) - F.col(theirs)
    return counts.withColumn(
        "row_count_delta",
        F.when(excess > 0, excess).when(excess == 0, F.lit(1)).otherwise(F.lit(0)),
    )


def equality(
    df: DataFrame,
    compare: DataFrame,
    compare_columns: Sequence[str] | None = None,
    exclude_columns: Sequence[str] | None = None,
    precision: int | None = None,
) -> DataFrame:
    """Rows of one table that the other lacks; duplicates do not count.

    Fingerprints are compared first: tables that pass are not shuffled.
    """
    if compare_columns and exclude_columns:
        raise ValueError("give compare_columns or exclude_columns, not both")
    if compare_columns:
        names = list(compare_columns)
    else:
        names = columns_except(df, exclude_columns or ())
        others = columns_except(compare, exclude_columns or ())
        if {n.lower() for n in names} != {n.lower() for n in others}:
            raise ValueError("the tables have different columns")

    def shaped(t: DataFrame) -> DataFrame:
        if precision is None:
            return t.select(*names)
        kinds = {f.name.lower(): f.dataType for f in df.schema.fields}
        inexact = (DoubleType, FloatType, DecimalType)
        return t.select(
            *[
                F.round(F.col(n), precision).alias(n)
                if isinstance(kinds[n.lower()], inexact)
                else F.col(n)
                for n in names
            ]
        )

    return difference(shaped(df), shaped(compare), names, alike=True)


def equality_failures(differences: DataFrame) -> DataFrame:
    """Number of failures: all rows plus the imbalance of the two sides."""
    side = F.sum(F.when(F.col("which_diff") == "a_minus_b", 1).otherwise(-1))
    return differences.agg((_n_rows() + F.coalesce(F.abs(side), F.lit(0))).alias("failures"))


def relationships_where(
    df: DataFrame,
    name: str,
    to: DataFrame,
    field: str,
    from_condition: str | None = None,
    to_condition: str | None = None,
) -> DataFrame:
    """Keys without a partner, once per row; NULL keys are ignored.

    Keys are counted before they are looked up, so a frequent one crosses the
    network once per task and not once per row.
    """
    child = df.filter(from_condition) if from_condition else df
    parent = to.filter(to_condition) if to_condition else to
    keys = (
        child.select(F.col(name).alias("id"))
        .filter(F.col("id").isNotNull())
        .groupBy("id")
        .agg(_n_rows().alias(COPIES))
    )
    orphans = keys.join(parent.select(F.col(field).alias("id")), "id", "left_anti")
    return repeat_rows(orphans, F.col(COPIES)).select("id")


def relationships(df: DataFrame, name: str, to: DataFrame, field: str) -> DataFrame:
    """Foreign keys without a partner."""
    return relationships_where(df, name, to, field).withColumnRenamed("id", "from_field")


# --- rules of the order models ---------------------------------------------


def delivered_before_purchase(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id", "order_purchase_timestamp", "order_delivered_customer_date"
    ).filter("order_delivered_customer_date < order_purchase_timestamp")


def sales_without_order(sales: DataFrame, orders: DataFrame) -> DataFrame:
    """Order ids of the fact table, NULL too, that no order has."""
    ids = sales.groupBy("order_id").agg(_n_rows().alias(COPIES))
    missing = ids.join(orders.select("order_id"), "order_id", "left_anti")
    return repeat_rows(missing, F.col(COPIES)).select("order_id")


def answered_before_creation(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        "review_id", "review_creation_date", "review_answer_timestamp"
    ).filter("review_answer_timestamp < review_creation_date")


# --- rules on the columns of a table ---------------------------------------


def columns_match_set(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Column names that only the table or only the list has, without case."""
    have = {c.lower() for c in df.columns}
    want = {c.lower() for c in names}
    rows = [(c, None) for c in sorted(have - want)]
    rows += [(None, c) for c in sorted(want - have)]
    return df.sparkSession.createDataFrame(
        rows, "relation_column string, input_column string"
    )

