"""Declared sources as catalog tables: create, refresh, add partitions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.sources.files import CORRUPT, FileSource, declared_names

# Partitions added by one statement.
PARTITION_BATCH = 100


def selected(sources: Sequence[FileSource], select: str | None) -> list[FileSource]:
    """Sources named by ``source`` or ``source.table``, separated by blanks."""
    if not select:
        return list(sources)
    wanted = set(select.split())
    return [s for s in sources if s.source in wanted or f"{s.source}.{s.name}" in wanted]


def _text(value: str) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def plain(spec: FileSource) -> bool:
    """Whether a catalog table over the files alone reads what ``load`` reads."""
    special = (
        len(spec.paths) > 1
        or any(c.alias or c.expression for c in spec.columns)
        or any(p.expression for p in spec.partitions)
        or spec.pattern is not None
        or spec.glob is not None
        or spec.ignore_case
        or spec.on_error != "null"
        or spec.format == "json"
    )
    return not special


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _create(table: str, columns, format: str, options, partitions, location: str) -> str:
    listed = ", ".join(f"{_quoted(n)} {t}" for n, t in columns)
    told = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in options.items())
    parts = ", ".join(_quoted(p) for p in partitions)
    return " ".join(
        [
            f"CREATE TABLE {table}",
            f"({listed})" if listed else "",
            f"USING {format}",
            f"OPTIONS ({told})" if told else "",
            f"PARTITIONED BY ({parts})" if parts else "",
            f"LOCATION {_text(location)}",
        ]
    )


def create_statement(spec: FileSource, table: str) -> str:
    """DDL of the table of a plain declaration; partition columns come last."""
    own = {c.name for c in spec.columns}
    listed = [(c.name, c.data_type) for c in spec.columns]
    listed += [(p.name, p.data_type) for p in spec.partitions if p.name not in own]
    names = [p.name for p in spec.partitions]
    return _create(table, listed, spec.format, spec.options, names, spec.paths[0])


def raw_statement(spec: FileSource, table: str, location: str) -> str:
    """DDL of a table of the raw values at one location, for the view to read."""
    options = dict(spec.options)
    if spec.glob:
        options["pathGlobFilter"] = spec.glob
    # Found in directory names; computed ones have no column here.
    stored = [p.name for p in spec.partitions if not p.expression]
    format, columns = spec.format, []
    if spec.format == "json":
        format, columns = "text", [("value", "STRING")]
    elif spec.format == "csv" and declared_names(spec):
        columns = [(n, "STRING") for n in [*declared_names(spec), CORRUPT]]
        options["mode"] = "FAILFAST" if spec.on_error == "fail" else "PERMISSIVE"
    if columns:
        columns += [(n, "STRING") for n in stored]
    elif stored:
        # Columns and partitions are found in the files and their folders.
        stored = []
    return _create(table, columns, format, options, stored, location)


def _clean_sql(value: str) -> str:
    return f"CASE WHEN lower(CAST({value} AS STRING)) <> 'null' THEN {value} END"


def view_query(spec: FileSource, raw: Sequence[str], stored: Sequence[str]) -> str:
    """The source as SQL over its raw tables, with the columns ``stored``."""
    named = any(p.expression for p in spec.partitions)
    chosen = f" WHERE _metadata.file_path RLIKE {_text(spec.pattern)}" if spec.pattern else ""
    path = ", _metadata.file_path AS filename" if named else ""
    rows = " UNION ALL ".join(f"SELECT *{path} FROM {t}{chosen}" for t in raw)
    columns = [c for c in stored if c not in {p.name for p in spec.partitions}]
    if spec.format == "json":
        rows = f"SELECT * FROM ({rows}) WHERE trim(value) <> ''"
        if names := declared_names(spec):
            fields = ", ".join(f"{_quoted(n)} STRING" for n in [*names, CORRUPT])
            mode = "FAILFAST" if spec.on_error == "fail" else "PERMISSIVE"
            options = f"map('mode', '{mode}', 'columnNameOfCorruptRecord', '{CORRUPT}')"
            others = [p.name for p in spec.partitions if not p.expression] + ["filename"] * named
            kept = "".join(f", {_quoted(c)}" for c in others)
            rows = f"SELECT from_json(value, {_text(fields)}, {options}) AS __row{kept} FROM ({rows})"
            rows = f"SELECT __row.*{kept} FROM ({rows})"
            columns = [*names, CORRUPT]
    parts = [
        f"CAST({f'({p.expression})' if p.expression else _quoted(p.name)} AS {p.data_type}) AS {_quoted(p.name)}"
        for p in spec.partitions
    ]
    if spec.infer_schema:
        listed = [f"{_clean_sql(_quoted(c))} AS {_quoted(c)}" for c in columns]
        return f"SELECT {', '.join([*listed, *parts])} FROM ({rows})"
    if not spec.columns:
        whole = f"to_variant_object(struct({', '.join(map(_quoted, columns))}))"
        if spec.format == "json":
            whole = "try_parse_json(value)"
        return f"SELECT {', '.join([f'{whole} AS value', *parts])} FROM ({rows})"
    found = {c.lower() if spec.ignore_case else c: c for c in reversed(columns)}
    cast = "CAST" if spec.on_error == "fail" else "TRY_CAST"
    sound, listed = [f"{CORRUPT} IS NULL"] if CORRUPT in columns else [], []
    for c in spec.columns:
        name = found.get(c.name.lower() if spec.ignore_case else c.name)
        value = f"({c.expression})" if c.expression else _clean_sql(_quoted(name)) if name else "NULL"
        typed = f"{cast}({value} AS {c.data_type})"
        listed.append(f"{typed} AS {_quoted(c.output)}")
        sound.append(f"({value} IS NULL OR {typed} IS NOT NULL)")
    where = f" WHERE {' AND '.join(sound)}" if spec.on_error == "skip" else ""
    return f"SELECT {', '.join([*listed, *parts])} FROM ({rows}){where}"


def _stage_view(spark: SparkSession, spec: FileSource, create: bool) -> None:
    """Tables of the raw values and, over them, a view of what ``load`` reads."""
    if spec.format == "json" and spec.json_layout == "objects":
        raise ValueError(f"{spec.source}.{spec.name} cannot be staged: objects back to back")
    view, raw = f"{_quoted(spec.source)}.{_quoted(spec.name)}", []
    for i, location in enumerate(spec.paths):
        raw.append(f"{_quoted(spec.source)}.{_quoted(f'{spec.name}__raw_{i}')}")
        if create:
            spark.sql(f"DROP TABLE IF EXISTS {raw[-1]}")
            spark.sql(raw_statement(spec, raw[-1], location))
        else:
            spark.catalog.refreshTable(raw[-1])
        if any(c.isPartition for c in spark.catalog.listColumns(raw[-1])):
            spark.catalog.recoverPartitions(raw[-1])
    if create:
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS {view_query(spec, raw, spark.table(raw[0]).columns)}")


def stage(
    spark: SparkSession,
    sources: Sequence[FileSource],
    select: str | None = None,
    full_refresh: bool = False,
) -> dict[str, str]:
    """Make the catalog match the declarations; what was done per table.

    A table is created when it is missing or a full refresh is asked for, else
    its file listing is refreshed. What a table cannot declare (several locations,
    aliases, expressions, computed partitions, patterns, other error modes, JSON)
    becomes a view over tables of the raw values, called ``name__raw_0`` and so on.
    Files are never copied. JSON objects back to back can only be loaded: staging
    them raises ``ValueError``.
    """
    done = {}
    for spec in selected(sources, select):
        table = f"{_quoted(spec.source)}.{_quoted(spec.name)}"
        create = full_refresh or not spark.catalog.tableExists(f"{spec.source}.{spec.name}")
        if create:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(spec.source)}")
            for kind in ("VIEW", "TABLE"):
                if spark.catalog.tableExists(f"{spec.source}.{spec.name}"):
                    is_view = spark.catalog.getTable(f"{spec.source}.{spec.name}").tableType == "VIEW"
                    if is_view == (kind == "VIEW"):
                        spark.sql(f"DROP {kind} {table}")
        if not plain(spec):
            _stage_view(spark, spec, create)
        elif create:
            spark.sql(create_statement(spec, table))
        else:
            spark.catalog.refreshTable(table)
        if plain(spec) and spec.partitions:
            spark.catalog.recoverPartitions(table)
        done[f"{spec.source}.{spec.name}"] = "created" if create else "refreshed"
    return done


# --- partitions listed by value --------------------------------------------

PathRule = Callable[[str, Column], Column]


def key_value(name: str, value: Column) -> Column:
    """``name=value``"""
    return F.concat(F.lit(f"{name}="), value)


def value_only(name: str, value: Column) -> Column:
    """``value``"""
    return value


def year_month_day(name: str, value: Column) -> Column:
    """``yyyy/mm/dd`` of a date written ``yyyy-mm-dd``"""
    return F.replace(value, F.lit("-"), F.lit("/"))


@dataclass(frozen=True)
class ListedPartition:
    """Values of one partition column, and how a value becomes a directory."""

    name: str
    values: Sequence[str]
    rule: PathRule = key_value

    @staticmethod
    def days(name: str, first: str, last: str, rule: PathRule = year_month_day):
        """Every day of a range, both ends included."""
        start, end = date.fromisoformat(first), date.fromisoformat(last)
        count = (end - start).days + 1
        listed = [(start + timedelta(days=i)).isoformat() for i in range(count)]
        return ListedPartition(name, listed, rule)


def partition_paths(
    spark: SparkSession, partitions: Sequence[ListedPartition]
) -> DataFrame:
    """Every combination of the listed values with its relative path."""
    combos = spark.range(1).select(F.lit("").alias("path"))
    for p in partitions:
        values = F.array(*[F.lit(str(v)) for v in p.values])
        combos = combos.withColumn(p.name, F.explode(values))
    parts = [p.rule(p.name, F.col(f"`{p.name}`")) for p in partitions]
    return combos.withColumn("path", F.concat_ws("/", *parts)).select(
        *[p.name for p in partitions], "path"
    )


def add_partitions(
    spark: SparkSession,
    table: str,
    location: str,
    partitions: Sequence[ListedPartition],
) -> int:
    """Register every listed partition of a table, in batches; their number.

    The statements are built from the declared value lists, never from data.
    """
    names = [p.name for p in partitions]
    rows = partition_paths(spark, partitions).collect()
    clauses = []
    for r in rows:
        keys = ", ".join(f"`{n}` = {_text(r[n])}" for n in names)
        where = _text(f"{location.rstrip('/')}/{r['path']}/")
        clauses.append(f"PARTITION ({keys}) LOCATION {where}")
    for i in range(0, len(clauses), PARTITION_BATCH):
        batch = " ".join(clauses[i : i + PARTITION_BATCH])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {batch}")
    return len(clauses)
