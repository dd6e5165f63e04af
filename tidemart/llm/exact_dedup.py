"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Every partition sends each owner of a hash range its distinct 64-bit fingerprints
of that range, sorted and Golomb-Rice coded, with one bit for those it holds
twice. The owner merges the lists and answers each with a bitmap of duplicates.
Only rows whose fingerprint came back marked (suspects) are then compared byte by
byte, by grouping on the text itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import parallelism, ship, written

WHITE_SPACE = r"[\x20\x09-\x0D]+"
#: Fingerprints that an owner decodes at once, about, and that a task sends at once.
OWNED = 1_000_000
SENT = 4_000_000


def rice_encode(values: np.ndarray) -> tuple[int, bytes]:
    """Ascending unsigned 64-bit values as Golomb-Rice coded differences.

    First come all quotients in unary, then all remainders with ``k`` bits each.
    """
    gaps = np.diff(values, prepend=np.uint64(0))
    mean = int(values[-1]) // len(values) if len(values) else 0
    k = max(0, mean.bit_length() - 1)
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    shifts = np.arange(k - 1, -1, -1, dtype=np.uint64)
    rest = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
    return k, np.packbits(np.concatenate([unary, rest])).tobytes()


def rice_decode(code: bytes, n: int, k: int) -> np.ndarray:
    """The values that ``rice_encode`` was given."""
    if not n:
        return np.zeros(0, np.uint64)
    bits = np.unpackbits(np.frombuffer(code, np.uint8))
    ends = np.flatnonzero(bits)[:n]
    quotients = (np.diff(ends, prepend=-1) - 1).astype(np.uint64)
    rest = bits[ends[-1] + 1 : ends[-1] + 1 + n * k].reshape(n, k)
    gaps = quotients << np.uint64(k)
    for j in range(k):
        gaps |= rest[:, j].astype(np.uint64) << np.uint64(k - 1 - j)
    return np.cumsum(gaps, dtype=np.uint64)


def _send(owners: int):
    edges = [-(-(j << 64) // owners) for j in range(owners)]
    starts = np.array(edges, np.uint64)

    def messages(found: np.ndarray, number: int) -> pa.RecordBatch:
        values, counts = np.unique(found, return_counts=True)
        cuts = np.append(np.searchsorted(values, starts), len(values))
        rows = []
        for owner in np.flatnonzero(np.diff(cuts)):
            part = slice(cuts[owner], cuts[owner + 1])
            k, code = rice_encode(values[part] - starts[owner])
            twice = np.packbits(counts[part] > 1).tobytes()
            rows.append((number, int(owner), int(cuts[owner + 1] - cuts[owner]), k, code, twice))
        names = ["message", "owner", "n", "k", "code", "twice"]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names
        )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch.column(0).to_numpy().view(np.uint64))
            if sum(map(len, held)) >= SENT:
                yield messages(np.concatenate(held), number)
                held, number = [], number + 1
        if held:
            yield messages(np.concatenate(held), number)

    return send


def _answer(owned: pd.DataFrame) -> pd.DataFrame:
    """A bitmap for each message to one owner: which of its values come twice."""
    lists = [rice_decode(r.code, r.n, r.k) for r in owned.itertuples()]
    flags = [
        np.unpackbits(np.frombuffer(r.twice, np.uint8))[: r.n].astype(bool)
        for r in owned.itertuples()
    ]
    values, counts = np.unique(np.concatenate(lists), return_counts=True)
    twice = [v[f] for v, f in zip(lists, flags, strict=True)]
    marked = np.union1d(values[counts > 1], np.concatenate(twice))
    bitmaps = [np.packbits(np.isin(v, marked)).tobytes() for v in lists]
    return pd.DataFrame({"message": owned.message, "owner": owned.owner, "bitmap": bitmaps})


def _marked(owners: int):
    starts = [-(-(j << 64) // owners) for j in range(owners)]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                values = rice_decode(r["code"], r["n"], r["k"])
                bits = np.unpackbits(np.frombuffer(r["bitmap"], np.uint8))[: r["n"]]
                found = values[bits.astype(bool)] + np.uint64(starts[r["owner"]])
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["fp"])

    return decode


def suspect_fingerprints(fingerprints: DataFrame) -> DataFrame:
    """Fingerprints (column ``fp``) that occur in more than one row, once each."""
    spark = fingerprints.sparkSession
    owners = max(parallelism(spark), -(-fingerprints.count() // OWNED))
    sent = written(
        fingerprints.mapInArrow(
            _send(owners),
            "message long, owner int, n int, k int, code binary, twice binary",
        ),
        "golomb",
    )
    answers = sent.groupBy("owner").applyInPandas(
        _answer, "message long, owner int, bitmap binary"
    )
    received = sent.join(answers, ["message", "owner"]).select("owner", "n", "k", "code", "bitmap")
    return received.mapInArrow(_marked(owners), "fp long").distinct()


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: the row that stays for its text, and the group's size.

    Texts are equal when identical after deleting white space (``WHITE_SPACE``);
    a NULL text counts as empty, so empty, blank and NULL texts are one group. Of
    a group the row with the most code points in its original text stays, then
    the smallest id; NULL ids come last. Repeated rows with one id all carry the
    same verdict. Columns besides the two named are ignored; an empty table gives
    no rows. Returns ``doc_id, keep_id, group_size, kept, text_sha256``.
    """
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = docs.select(
        F.col(id_col).alias("doc_id"),
        F.regexp_replace(text, WHITE_SPACE, "").alias("bare"),
        F.length(text).alias("points"),
    )
    printed = bare.withColumn("fp", F.xxhash64("bare"))
    marked = written(suspect_fingerprints(printed.select("fp")), "suspects")
    suspects = printed.join(marked, "fp", "left_semi")
    # Equal bytes meet here, and only here; tasks unite their equal texts first.
    best = F.max(F.struct("points", (-F.col("doc_id")).alias("order")))
    groups = (
        suspects.groupBy("bare")
        .agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
        .where("group_size > 1")
        .select(
            F.sha2("bare", 256).alias("text_sha256"),
            "group_size",
            (-F.col("best.order")).alias("keep_id"),
        )
    )
    groups = written(groups, "groups")
    rows = printed.select("doc_id", F.sha2("bare", 256).alias("text_sha256"))
    keep_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return rows.join(groups, "text_sha256", "left").select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        "text_sha256",
    )
