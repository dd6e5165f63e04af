"""Tables kept current from a stream of change records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.operators.latest import latest_per_key
from tidemart.sources.tables import KeyedTable, SnapshotTable


def _run(stream: DataFrame, checkpoint: str, each: Callable) -> None:
    (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def stream_upsert(
    stream: DataFrame, table: KeyedTable, order_by: str, checkpoint: str
) -> None:
    """Latest row per key into the table, for everything new in the stream.

    The stream's offsets replace the high-watermark filter, and a stored row
    gives way only to one that is not older: late records are not lost and do
    no harm, and a repeated batch changes nothing.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        # A record without time says nothing about its place: any other one wins.
        latest = latest_per_key(batch, table.keys, F.col(order_by).desc_nulls_last())
        table.upsert(latest, newest_by=order_by, unique=True)

    _run(stream, checkpoint, apply)


def stream_snapshot(
    stream: DataFrame, table: SnapshotTable, order_by: str, checkpoint: str
) -> None:
    """Version history of the keys, one step per micro-batch.

    New versions are valid from the newest ``order_by`` of their batch. A
    repeated batch finds its own versions unchanged. A batch that is older than
    earlier ones is put in its place among the versions of its keys.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        valid_from = batch.agg(F.max(order_by)).first()[0]
        if valid_from is not None:
            order = F.col(order_by).desc_nulls_last()
            table.apply(latest_per_key(batch, [table.key], order), valid_from)

    _run(stream, checkpoint, apply)
