"""Declared file sources: location, format, columns, partitions.

A source is a description; ``load`` turns it into a lazy scan. Raw values are
read as text, cleaned, and cast to the declared type.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"

# Between two objects written back to back. A raw line break cannot occur
# inside a JSON string, and nested objects are followed by a comma or bracket,
# so this text occurs between records only and a large file can be split.
OBJECT_BREAK = "}\n{"
# Other records may be told apart by any white space, or none. Outside of strings a
# closing brace stands before an opening one between records only. The mark is a
# control character that JSON text cannot hold.
_STRING = r'"(?:[^"\\]|\\.)*+"'
_MARK = "\u001e"


@dataclass(frozen=True)
class FileColumn:
    """A column: ``expression`` is SQL over the raw columns (all text)."""

    name: str
    data_type: str = "string"
    alias: str | None = None
    expression: str | None = None

    @property
    def output(self) -> str:
        return self.alias or self.name


@dataclass(frozen=True)
class FilePartition:
    """A partition column.

    With ``expression``, SQL over the column ``filename``, it is computed from
    the path of the file. Without, it is found in directories ``name=value``.
    """

    name: str
    data_type: str = "string"
    expression: str | None = None


@dataclass(frozen=True)
class FileSource:
    """A table over files.

    ``location`` is a path or a list of file URIs. ``pattern`` is a regular
    expression for the whole path, ``glob`` one for the file name.
    ``on_error``: ``null`` keeps a bad row with NULL, ``skip`` leaves it out,
    ``fail`` stops. ``json_layout`` is ``lines`` or ``objects`` (pretty-printed
    objects back to back).
    """

    source: str
    name: str
    location: str | Sequence[str]
    format: str
    columns: Sequence[FileColumn] = ()
    partitions: Sequence[FilePartition] = ()
    options: Mapping[str, str] = field(default_factory=dict)
    pattern: str | None = None
    glob: str | None = None
    infer_schema: bool = False
    ignore_case: bool = False
    on_error: str = "null"
    json_layout: str = "lines"

    @property
    def paths(self) -> list[str]:
        if isinstance(self.location, str):
            return [self.location]
        return list(self.location)


def _text_schema(names: Iterable[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def _reader(spark: SparkSession, spec: FileSource, streaming: bool):
    reader = spark.readStream if streaming else spark.read
    reader = reader.options(**spec.options)
    if spec.glob:
        reader = reader.option("pathGlobFilter", spec.glob)
    return reader


def _scan(spec: FileSource, reader, streaming: bool) -> DataFrame:
    if not streaming:
        return reader.load(spec.paths)
    if len(spec.paths) != 1:
        raise ValueError("a streaming source has one location")
    return reader.load(spec.paths[0])


def declared_names(spec: FileSource) -> list[str]:
    """Raw columns of a text format, in file order."""
    return [c.name for c in spec.columns if c.expression is None]


def raw_rows(
    spark: SparkSession, spec: FileSource, streaming: bool = False
) -> DataFrame:
    """Rows as stored: text columns for CSV and JSON, file types for Parquet."""
    reader = _reader(spark, spec, streaming)
    if spec.format == "csv":
        names = declared_names(spec)
        if not names:
            return _scan(spec, reader.format("csv"), streaming)
        schema = _text_schema([*names, CORRUPT])
        mode = "FAILFAST" if spec.on_error == "fail" else "PERMISSIVE"
        return _scan(
            spec, reader.format("csv").schema(schema).option("mode", mode), streaming
        )
    if spec.format == "json":
        return _json_rows(spec, reader, streaming)
    reader = reader.format(spec.format)
    if streaming:
        # A stream needs its schema up front: the declared one, or that of the
        # files already there.
        reader = reader.schema(_stored_schema(spec) or raw_rows(spark, spec).schema)
    return _scan(spec, reader, streaming)


def _stored_schema(spec: FileSource) -> StructType | None:
    stored = [f"`{c.name}` {c.data_type}" for c in spec.columns if not c.expression]
    return StructType.fromDDL(", ".join(stored)) if stored else None


def _objects(doc: Column) -> Column:
    """The records of a piece of text between two breaks.

    The break took the closing brace of one record and the opening one of the
    next; they are put back. Text before or after the braces makes its record
    malformed, so that ``on_error`` decides about it. Strings are only told apart
    in a piece with a closing brace, which may be its own, a nested one, or text.
    """
    trimmed = F.btrim(doc, F.lit(" \t\n\x0b\f\r"))
    opened = F.when(trimmed.startswith("{"), trimmed).otherwise(F.concat(F.lit("{"), trimmed))
    doubtful = opened.contains("}")
    bare = F.regexp_replace(opened, _STRING, "")
    braces = lambda b: F.length(F.regexp_replace(bare, rf"[^{b}]", ""))
    whole = F.when(braces("{") > braces("}"), F.concat(opened, F.lit("}"))).otherwise(opened)
    marked = F.regexp_replace(whole, f"({_STRING})" + r"|(?<=\})\s*(?=\{)", f"$1{_MARK}")
    parts = F.split(marked, r"(?<=\})" + _MARK + r"(?=\{)")
    parts = F.when(bare.rlike(r"\}\s*\{"), parts).otherwise(F.array(whole))
    clean = F.transform(parts, lambda x: F.regexp_replace(x, _MARK, ""))
    sound = lambda x: F.when(x.endswith("}"), x).otherwise(F.concat(F.lit("{"), x))
    return (
        F.when(trimmed == "", F.array())
        .when(~doubtful, F.array(F.concat(opened, F.lit("}"))))
        .otherwise(F.transform(clean, sound))
    )


def _json_rows(spec: FileSource, reader, streaming: bool) -> DataFrame:
    text = reader.format("text")
    if spec.json_layout == "objects":
        text = text.option("lineSep", OBJECT_BREAK)
    lines = _scan(spec, text, streaming)
    if spec.json_layout == "objects":
        doc = F.col("value")
        lines = lines.withColumn("value", F.explode(_objects(doc)))
    lines = lines.filter(F.trim("value") != "")
    names = declared_names(spec)
    if not names:
        return lines
    mode = "FAILFAST" if spec.on_error == "fail" else "PERMISSIVE"
    schema = _text_schema([*names, CORRUPT])
    parsed = F.from_json(
        "value", schema, {"mode": mode, "columnNameOfCorruptRecord": CORRUPT}
    )
    return lines.withColumn("value", parsed).select(
        "value.*", *[F.col(p) for p in lines.columns if p != "value"], "_metadata"
    )


def _find(df: DataFrame, name: str, ignore_case: bool) -> Column:
    """Column of a self-describing file; NULL if it has none of that name."""
    for c in df.columns:
        if c == name or (ignore_case and c.lower() == name.lower()):
            return F.col(f"`{c}`")
    return F.lit(None).cast("string")


def _clean(c: Column, empty_as_null: bool) -> Column:
    text = c.cast("string")
    if empty_as_null:
        return F.when(text != "", c)
    return F.when(F.lower(text) != "null", c)


def _cast(c: Column, kind: str, on_error: str) -> Column:
    return c.cast(kind) if on_error == "fail" else c.try_cast(kind)


def typed_columns(
    df: DataFrame, spec: FileSource, empty_as_null: bool = False
) -> tuple[list[Column], Column]:
    """Declared columns with their types, and whether a row is well-formed."""
    out, sound = [], F.lit(True)
    if CORRUPT in df.columns:
        sound = F.col(CORRUPT).isNull()
    for c in spec.columns:
        if c.expression:
            value = F.expr(c.expression)
        else:
            value = _clean(_find(df, c.name, spec.ignore_case), empty_as_null)
        typed = _cast(value, c.data_type, spec.on_error)
        out.append(typed.alias(c.output))
        sound = sound & (value.isNull() | typed.isNotNull())
    return out, sound


def _partition_columns(spec: FileSource) -> list[Column]:
    """Partition columns; a filter on them prunes files before they are opened."""
    return [
        (F.expr(p.expression) if p.expression else F.col(f"`{p.name}`"))
        .cast(p.data_type)
        .alias(p.name)
        for p in spec.partitions
    ]


def load(spark: SparkSession, spec: FileSource) -> DataFrame:
    """The source as a lazy DataFrame."""
    if spec.on_error not in ("null", "skip", "fail"):
        raise ValueError(f"on_error must be null, skip or fail, got {spec.on_error!r}")
    rows = raw_rows(spark, spec)
    if spec.pattern:
        rows = rows.filter(F.col("_metadata.file_path").rlike(spec.pattern))
    partitions = _partition_columns(spec)
    stored = rows.columns
    if any(p.expression for p in spec.partitions):
        rows = rows.withColumn("filename", F.col("_metadata.file_path"))
    if spec.infer_schema:
        computed = {p.name for p in spec.partitions}
        names = [c for c in stored if c not in computed]
        return rows.select(
            *[_clean(F.col(f"`{c}`"), False).alias(c) for c in names], *partitions
        )
    if not spec.columns:
        return rows.select(whole_row(stored, spec), *partitions)
    columns, sound = typed_columns(rows, spec)
    if spec.on_error == "skip":
        rows = rows.filter(sound)
    return rows.select(*columns, *partitions)


def whole_row(stored: Sequence[str], spec: FileSource) -> Column:
    """The row as one variant, for a source without declared columns."""
    if spec.format == "json":
        return F.try_parse_json("value").alias("value")
    names = [c for c in stored if c not in {p.name for p in spec.partitions}]
    return F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in names])).alias(
        "value"
    )
