"""Best-fit packing whose bin counts are certified by lower bounds.

Pieces are dealt over partitions, and each partition packs its own by best-fit
decreasing. Dual feasible functions give a lower bound of the bins that its pieces
need; where the count equals the bound, the packing is certified. Partitions with
a gap give up the pieces of their imperfect bins, certified ones those of their
emptiest bin; the pieces exchanged so are dealt anew over fewer partitions and
packed again, until nothing can be gained.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import bound_batches, give_back, ship, written
from tidemart.llm.word_tokens import tokenizer

CAPACITY = 2048
#: Pieces that one task packs, about, and those that are not worth dealing out.
PIECES_PER_PARTITION, FEW = 200_000, 4_000
_END = np.zeros(1, "<u4").tobytes()

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = f"{PIECE}, sequence_id long, offset long, bins long, bound long, open boolean"


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The most that two families of dual feasible functions prove about the bins.

    With the first, pieces longer than ``capacity - t`` count as whole bins and
    those shorter than ``t`` as nothing; with the second, a length ``x`` with
    ``(k + 1) * x`` no multiple of the capacity is rounded down to a multiple of
    ``1 / k``.
    """
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    sizes = np.arange(capacity + 1)
    numbers, totals = np.cumsum(counts), np.cumsum(counts * sizes)
    t = np.arange(capacity // 2 + 1)
    whole = numbers[-1] - numbers[capacity - t]
    below = np.where(t > 0, totals[t - 1], 0)
    first = whole + -(-(totals[capacity - t] - below) // capacity)
    best = int(first.max())
    for k in range(1, 33):
        scaled = (k + 1) * sizes
        floors = scaled // capacity
        # In units of 1 / (k * capacity).
        value = np.where(scaled % capacity == 0, sizes * k, floors * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and the room left in each bin.

    Pieces must come in descending order. Of the bins with room the fullest is
    taken; the set of rooms is kept as the bits of one number.
    """
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    left: list[int] = []
    there = 0
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    for i, length in enumerate(lengths.tolist()):
        fits = there >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            chosen = rooms[room].pop()
            if not rooms[room]:
                there ^= 1 << room
        else:
            room, chosen = capacity, len(left)
            left.append(capacity)
        bins[i], offsets[i] = chosen, capacity - room
        left[chosen] = room = room - length
        rooms[room].append(chosen)
        there |= 1 << room
    return bins, offsets, np.array(left, np.int64)


def _pack(capacity: int, rnd: int):
    def pack(part: pd.DataFrame) -> pd.DataFrame:
        number = int(part.partition.iloc[0])
        part = part.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True])
        lengths = part.length.to_numpy()
        bins, offsets, left = best_fit(lengths, capacity)
        bound = lower_bound(lengths, capacity)
        given = left > 0
        if len(left) == bound:
            given = np.arange(len(left)) == np.argmax(left)
            given &= left > 0
        return part.drop(columns="partition").assign(
            sequence_id=(rnd << 56) + (number << 32) + bins,
            offset=offsets,
            bins=len(left),
            bound=bound,
            open=given[bins],
        )

    return pack


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    per_partition: int = PIECES_PER_PARTITION,
    few: int = FEW,
) -> DataFrame:
    """Adds ``sequence_id, offset`` to pieces of at most ``capacity`` tokens.

    ``pieces`` has the columns of ``PIECE``; an empty table gives no rows, repeated
    rows are packed one by one, NULL ids like others. ``bins`` and ``bound`` tell
    how many sequences the partition that packed the row made, and how many it
    must make at least. Ties go to the smaller id and piece.

    Partitions whose bins exceed their bound put the pieces of all bins with room
    together, deal them out anew and pack them again. That goes on while it saves
    bins; a round that does not is dropped. Up to ``few`` pieces end in one partition,
    more are dealt over four at least.
    """
    ship(pieces.sparkSession)
    done, rnd, before = [], 0, None
    current = written(pieces, "pieces")
    while True:
        n = current.count()
        partitions = max(-(-n // per_partition), 4 if n > few else 1)
        key = F.xxhash64("doc_id", "piece", "start", F.lit(rnd))
        dealt = current.select(*pieces.columns)
        dealt = dealt.withColumn("partition", F.pmod(key, F.lit(partitions)).cast("int"))
        packed = written(
            dealt.groupBy("partition").applyInPandas(_pack(capacity, rnd), _PACKED), "packed"
        )
        after = packed.select("sequence_id").distinct().count()
        if before is not None and after >= before:
            done.append(current)
            break
        # One partition has seen all that is left: nothing remains to exchange with.
        if partitions == 1:
            done.append(packed)
            break
        done.append(packed.where("NOT open"))
        current, rnd = packed.where("open"), rnd + 1
        before = current.select("sequence_id").distinct().count()
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out.drop("open")


def _cut(path: str, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = []
                ids_of = encoder.encode(part.column(1).to_pylist())
                for doc_id, ids in zip(part.column(0).to_pylist(), ids_of, strict=True):
                    ids += _END
                    for number, start in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[start : start + 4 * capacity]
                        rows.append((doc_id, number, start // 4, len(piece) // 4, zlib.crc32(piece)))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
                )
        encoder.forget()
        give_back()

    return cut


def pack_documents(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Tokenizes whole texts and packs them into sequences of ``capacity`` tokens.

    A document is its ids and one id 0; a NULL or empty text is the id 0 alone.
    Only documents longer than a sequence are cut, into full pieces and a rest.
    Columns besides the two named are ignored; rows with a NULL id are packed like
    others, repeated rows each on their own; an empty table gives no rows.
    Returns the columns of ``PIECE``, ``sequence_id, offset, bins, bound``.
    """
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return pack(texts.mapInArrow(_cut(path, capacity), PIECE), capacity)
