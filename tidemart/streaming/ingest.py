"""Ingest of new files only, exactly once per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.constants import (
    COPIED_AT,
    FILE_LAST_MODIFIED,
    FILE_NAME,
    FILE_ROW_NUMBER,
)
from tidemart.operators.small import fits_broadcast
from tidemart.sources.files import FileSource, raw_rows, typed_columns, whole_row
from tidemart.sources.filesystem import delete
from tidemart.sources.workspace import new_folder

_SPLIT, _SEEN = "__split", "__seen"


def numbered_rows(rows: DataFrame, folder: str | None = None) -> DataFrame:
    """Add the position of each row in its file, starting at 1.

    ``rows`` come straight from a file scan, with the file and its split. A split is
    read in order by one task, whose row ids rise by one from row to row: a row's
    distance from the split's least id, moved by the rows in the earlier splits of the
    file, is its position. No row is sorted or shuffled, and a compressed file, which
    is one split however large, only passes through its task.

    Rows and splits are written to ``folder`` once, because a second scan may cut the
    files into other splits, for instance after executors came or went.
    """
    spark = rows.sparkSession
    folder = folder or new_folder(spark, "numbered")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    seen = kept(rows.withColumn(_SEEN, F.monotonically_increasing_id()), "rows")
    splits = seen.groupBy(FILE_NAME, _SPLIT).agg(
        F.min(_SEEN).alias("__first"), F.count(F.lit(1)).alias("__n")
    )
    earlier = (
        Window.partitionBy(FILE_NAME)
        .orderBy(_SPLIT)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("__n").over(earlier), F.lit(0))
    # From a row's id to its position.
    starts = splits.select(FILE_NAME, _SPLIT, (before - F.col("__first") + 1).alias("__shift"))
    starts = kept(starts, "splits")
    starts = F.broadcast(starts) if fits_broadcast(starts) else starts.hint("shuffle_hash")
    return (
        seen.join(starts, [FILE_NAME, _SPLIT])
        .withColumn(FILE_ROW_NUMBER, (F.col(_SEEN) + F.col("__shift")).cast("bigint"))
        .drop(_SPLIT, _SEEN, "__shift")
    )


def _file_columns(spec: FileSource) -> list[Column]:
    meta = [
        F.col("_metadata.file_path").alias(FILE_NAME),
        F.col("_metadata.file_modification_time").alias(FILE_LAST_MODIFIED),
    ]
    if spec.format == "parquet":
        row = F.col("_metadata.row_index") + 1
        return [*meta, row.cast("bigint").alias(FILE_ROW_NUMBER)]
    return [*meta, F.col("_metadata.file_block_start").alias(_SPLIT)]


def ingest_files(
    spark: SparkSession,
    spec: FileSource,
    target: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
) -> None:
    """Append the rows of files not loaded before to the Parquet at ``target``.

    The stream's checkpoint remembers the loaded files. Each batch writes its
    own directory, so a batch repeated after a failure replaces itself. Columns
    are the declared ones (or one variant ``value``), then path, row number and
    modification time of the file and the load time. Empty text becomes NULL.
    """
    if max_files_per_trigger:
        options = {**spec.options, "maxFilesPerTrigger": str(max_files_per_trigger)}
        spec = FileSource(**{**spec.__dict__, "options": options})
    rows = raw_rows(spark, spec, streaming=True)
    if spec.pattern:
        rows = rows.filter(F.col("_metadata.file_path").rlike(spec.pattern))
    if spec.columns:
        columns, sound = typed_columns(rows, spec, empty_as_null=True)
    else:
        columns, sound = [whole_row(rows.columns, spec)], F.lit(True)
    stream = rows.select(*columns, sound.alias("__sound"), *_file_columns(spec))
    names = [c.output for c in spec.columns] or ["value"]

    def append(batch: DataFrame, batch_id: int) -> None:
        scratch = new_folder(spark, "numbered")
        out = batch if FILE_ROW_NUMBER in batch.columns else numbered_rows(batch, scratch)
        if spec.on_error == "skip":
            out = out.filter("__sound")
        (
            out.select(
                *[F.col(f"`{n}`") for n in names],
                FILE_NAME,
                FILE_ROW_NUMBER,
                FILE_LAST_MODIFIED,
                F.current_timestamp().alias(COPIED_AT),
            )
            .write.mode("overwrite")
            .parquet(f"{target}/batch={batch_id}")
        )
        delete(spark, scratch)

    (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def read_ingested(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).drop("batch")
