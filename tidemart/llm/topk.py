"""Exact top-k inner products by refining histograms of all scores.

Every query is scored against every row, in blocks. Each pass counts the scores of a
query's current interval in equal bins; the counts of all blocks together tell which
bin holds the kth score, and the next pass looks into that bin alone. Once the kth
score is known exactly, rows above it are kept, and of the rows that equal it the
smallest ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import parallelism, ship, written

#: Rows of a block of candidates, of a block of queries, and queries scored at once.
ROWS, QUERIES, AT_ONCE = 8192, 2048, 128
#: Bins of a pass, as a power of two.
BITS = 10
_BLOCK = "block long, n int, width int, largest long, ids binary, matrix binary"
_LIMIT = 2**63 - 1


def quantized(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector``: components as ``floor(256 * x)``, of usable rows only."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    usable = vectors.where(x.isNotNull() & F.col(id_col).isNotNull() & finite)
    whole = F.transform(x, lambda e: F.floor(F.lit(256.0) * e.cast("double")).cast("bigint"))
    return usable.select(F.col(id_col).cast("bigint").alias("vec_id"), whole.alias("vector"))


def _blocks(size: int):
    def pack(ids: list[int], vectors: list[np.ndarray], number: int) -> pa.RecordBatch:
        width = max(map(len, vectors))
        matrix = np.zeros((len(ids), width), np.int64)
        for i, v in enumerate(vectors):
            matrix[i, : len(v)] = v
        largest = int(min(_LIMIT, max(abs(int(matrix.max(initial=0))), abs(int(matrix.min(initial=0))))))
        values = (number, len(ids), width, largest, np.array(ids, np.int64).tobytes(), matrix.tobytes())
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        names = ["block", "n", "width", "largest", "ids", "matrix"]
        arrays = [pa.array([v], k) for v, k in zip(values, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list[int] = []
        vectors: list[np.ndarray] = []
        for batch in batches:
            column = batch.column(1)
            flat, ends = column.flatten().to_numpy(), np.append(0, np.cumsum(column.value_lengths()))
            for i, vec_id in enumerate(batch.column(0).to_pylist()):
                ids.append(vec_id)
                vectors.append(flat[ends[i] : ends[i + 1]])
                if len(ids) == size:
                    yield pack(ids, vectors, number)
                    ids, vectors, number = [], [], number + 1
        if ids:
            yield pack(ids, vectors, number)

    return blocks


def _scores(q: np.ndarray, c: np.ndarray, bound: int) -> np.ndarray:
    """Inner products; numbers past 64 bits are cut to the ends of that range."""
    if bound < 2**53:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    exact = q.astype(object) @ c.T.astype(object)
    return np.clip(exact, -_LIMIT, _LIMIT).astype(np.int64)


def _tiles(row: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Scores of one pair of blocks, some queries at once; False marks a query's own row."""
    ids = np.frombuffer(row["c_ids"], np.int64)
    c = np.frombuffer(row["c_matrix"], np.int64).reshape(len(ids), row["c_width"])
    q_ids = np.frombuffer(row["q_ids"], np.int64)
    q = np.frombuffer(row["q_matrix"], np.int64).reshape(len(q_ids), row["q_width"])
    width = min(c.shape[1], q.shape[1])
    bound = width * row["c_largest"] * row["q_largest"]
    own = np.flatnonzero(np.isin(ids, q_ids))
    for at in range(0, len(q_ids), AT_ONCE):
        s = _scores(q[at : at + AT_ONCE, :width], c[:, :width], bound)
        other = np.ones(s.shape, bool)
        other[:, own] = q_ids[at : at + AT_ONCE, None] != ids[own]
        yield at, s, other, ids


def _histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the bins that may hold the scores still needed, by query."""
    for batch in batches:
        for row in batch.to_pylist():
            low = np.frombuffer(row["low"], np.int64)
            need = np.frombuffer(row["need"], np.int64)
            for at, s, other, _ in _tiles(row):
                lows, needs = low[at : at + len(s), None], need[at : at + len(s)]
                # In Python's integers: the interval may span all 64 bits.
                inside = other & (s >= lows)
                inside &= s - np.where(inside, lows, s) <= (1 << row["bits"]) - 1
                bins = np.where(inside, (s - np.where(inside, lows, s)) >> row["shift"], -1)
                k = min(int(needs.max(initial=1)), bins.shape[1])
                least = np.partition(bins, -k, axis=1)[:, -k] if k else np.zeros(len(bins), int)
                i, j = np.nonzero(inside & (bins >= least[:, None]))
                pairs, n = np.unique(np.stack([i + at, bins[i, j]]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), row["q"])), *map(pa.array, (pairs[0], pairs[1], n))],
                    ["q", "i", "bin", "n"],
                )


def _narrow(shift: int):
    """The next interval of each query of a block, from the counts of all blocks."""

    def narrow(key, state: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        low = np.frombuffer(state.low.iloc[0], np.int64).copy()
        need = np.frombuffer(state.need.iloc[0], np.int64).copy()
        counts = counts.sort_values(["i", "bin"], ascending=[True, False])
        above = counts.groupby("i").n.cumsum() - counts.n
        reached = counts[(above < need[counts.i]) & (above + counts.n >= need[counts.i])]
        short = np.setdiff1d(np.arange(len(low)), reached.i)
        low[reached.i] += reached.bin.to_numpy() << shift
        need[reached.i] -= above[reached.index]
        # Fewer rows than asked for: all of the interval's rows belong to the result.
        need[short] = np.iinfo(np.int32).max
        return pd.DataFrame({"q": [key[0]], "low": [low.tobytes()], "need": [need.tobytes()]})

    return narrow


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows above the kth score, and the smallest ids of those that equal it."""
    for batch in batches:
        for row in batch.to_pylist():
            low = np.frombuffer(row["low"], np.int64)
            need = np.frombuffer(row["need"], np.int64)
            q_ids = np.frombuffer(row["q_ids"], np.int64)
            for at, s, other, ids in _tiles(row):
                order = np.argsort(ids, kind="stable")
                s, other, ordered = s[:, order], other[:, order], ids[order]
                lows, needs = low[at : at + len(s), None], need[at : at + len(s), None]
                ties = other & (s == lows)
                keep = other & (s > lows) | ties & (np.cumsum(ties, axis=1) <= needs)
                i, j = np.nonzero(keep)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[i + at]), pa.array(ordered[j]), pa.array(s[i, j])],
                    ["query_id", "vec_id", "score"],
                )


def exact_top_k(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` best rows of every query: ``query_id, rank, vec_id, score``.

    Queries are the rows whose id is divisible by ``every``; candidates are all
    rows with another id. Scores are inner products of ``floor(256 * x)``; ties go
    to the smaller id. Rows with a NULL id, and vectors that are NULL or hold a
    NULL or non-finite component, take no part. A shorter vector counts as filled
    up with zeros; an empty one scores 0. Repeated candidates count each, repeated
    queries once. Columns besides the two named are ignored; without rows, or with
    a single one, there is no result.
    """
    ship(vectors.sparkSession)
    spark = vectors.sparkSession
    rows = quantized(vectors, id_col, vector_col)
    asked = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"])
    candidates = written(rows.mapInArrow(_blocks(ROWS), _BLOCK), "candidates")
    queries = written(asked.mapInArrow(_blocks(QUERIES), _BLOCK), "queries")
    c, q = (b.agg(F.max("largest"), F.max("width"), F.count("n")).first() for b in (candidates, queries))
    if not c[2] or not q[2]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    bound = min(_LIMIT >> 1, min(c[1], q[1]) * c[0] * q[0])
    bits = bound.bit_length() + 1

    # Every block of candidates gets a slot, and every block of queries one copy a slot.
    slots = min(max(c[2], 1), 16 * parallelism(spark))
    names = ["width", "largest", "ids", "matrix"]
    c_side = candidates.select(
        F.pmod(F.xxhash64("block"), F.lit(slots)).alias("slot"),
        *[F.col(x).alias(f"c_{x}") for x in names],
    )
    q_side = queries.select(
        F.col("block").alias("q"), "n", *[F.col(x).alias(f"q_{x}") for x in names]
    )
    slot = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slots - 1).cast("bigint")))

    def scored(state: DataFrame, **columns: int) -> DataFrame:
        placed = q_side.drop("n").join(state, "q").withColumn("slot", slot)
        pairs = c_side.join(placed, "slot")
        return pairs.withColumns({x: F.lit(v) for x, v in columns.items()})

    def start(batches):
        for b in batches:
            for r in b.to_pylist():
                low, need = np.full(r["n"], -bound - 1), np.full(r["n"], k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["q"]]), pa.array([low.tobytes()]), pa.array([need.tobytes()])],
                    ["q", "low", "need"],
                )

    kind = "q long, low binary, need binary"
    state = written(q_side.select("q", "n").mapInArrow(start, kind), "intervals")
    bits = max(bits, 1)
    while bits > 0:
        shift = max(0, bits - BITS)
        found = scored(state, bits=bits, shift=shift).mapInArrow(
            _histograms, "q long, i long, bin long, n long"
        )
        counts = found.groupBy("q", "i", "bin").agg(F.sum("n").alias("n"))
        state = written(
            state.groupBy("q").cogroup(counts.groupBy("q")).applyInPandas(_narrow(shift), kind),
            "intervals",
        )
        bits = shift
    best = scored(state).mapInArrow(_kept, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        best.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
