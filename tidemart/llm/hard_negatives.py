"""Hard negatives by disjoint slots of scores.

Anchors are scored against all rows, in blocks: tasks get some blocks of anchors each and
read the blocks of rows one by one, a Cartesian product for which nothing is copied in
advance or broadcast. A first pass finds every anchor's positives, the best rows of its label. The upper limits of
their windows cut the scores into disjoint slots: one slot reaches from a limit down to
the next smaller one, the last one to the least score that any window takes. In a second
pass tasks keep the best rows of other labels in every slot. What a window returns lies
among the best rows below its limit, and those come from merging the slots from the last
one up; its lower limit then only cuts the list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import bound_batches, parallelism, ship, written

#: Rows of a block of candidates and of anchors, and anchors scored at once.
ROWS, ANCHORS, AT_ONCE = 4096, 1024, 128
#: Labels that two blocks share, up to which each label is scored on its own.
LABELS = 32
#: Blocks of anchors whose best rows a task holds, at most.
HELD = 32
_BLOCK = "block long, n int, width int, largest long, kind string, ids binary, labels binary, matrix binary"
_SIDE = ("width", "largest", "kind", "ids", "labels", "matrix")
_ASKED = "q long, q_width int, q_largest long, q_kind string, q_ids binary, q_labels binary, q_matrix binary"
_LIMIT = 2**62
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
#: The score of a place that no row has taken; its negative fits in 64 bits too.
_ABSENT = _LEAST + 1
_FOUND = "q long, anchor_id long, slot int, vec_id long, score long"
_PAIRS = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(vectors: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """``vec_id, label, vector``: components as ``floor(256 * x)``, of whole rows only."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    there = x.isNotNull() & F.col(id_col).isNotNull() & F.col(label_col).isNotNull()
    whole = F.transform(x, lambda e: F.floor(F.lit(256.0) * e.cast("double")).cast("bigint"))
    return vectors.where(there & finite).select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.col(label_col).cast("bigint").alias("label"),
        whole.alias("vector"),
    )


def _blocks(size: int):
    """Rows as blocks of a matrix, in the smallest integers, ordered by id."""

    def pack(rows: pa.Table, number: int) -> pa.RecordBatch:
        ids, labels = (rows.column(k).to_numpy() for k in (0, 1))
        order = np.argsort(ids, kind="stable")
        vectors = rows.column(2).combine_chunks()
        lengths = vectors.value_lengths().to_numpy()
        matrix = np.zeros((len(ids), lengths.max()), np.int64)
        matrix[np.arange(matrix.shape[1]) < lengths[:, None]] = vectors.flatten().to_numpy()
        ends = int(matrix.min(initial=0)), int(matrix.max(initial=0))
        kind = next(k for k in ("int16", "int32", "int64") if np.can_cast(np.min_scalar_type(min(ends[0], -1)), k) and np.iinfo(k).max >= ends[1])
        values = (
            number,
            len(ids),
            matrix.shape[1],
            min(max(-ends[0], ends[1]), _LIMIT),
            kind,
            ids[order].astype(np.int64).tobytes(),
            labels[order].astype(np.int64).tobytes(),
            matrix.astype(kind)[order].tobytes(),
        )
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string(), *[pa.binary()] * 3]
        names = [c.split()[0] for c in _BLOCK.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list = []
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) < size:
                continue
            rows = pa.Table.from_batches(held)
            while rows.num_rows >= size:
                yield pack(rows.slice(0, size), number)
                rows, number = rows.slice(size), number + 1
            held = rows.to_batches()
        if any(x.num_rows for x in held):
            yield pack(pa.Table.from_batches(held), number)

    return blocks


def _side(row: dict, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = (np.frombuffer(row[f"{side}_{x}"], np.int64) for x in ("ids", "labels"))
    matrix = np.frombuffer(row[f"{side}_matrix"], row[f"{side}_kind"]).reshape(len(ids), row[f"{side}_width"])
    return ids, labels, matrix


def _products(a: np.ndarray, b: np.ndarray, bound: int) -> np.ndarray:
    """Inner products, in floats that hold them exactly; past 62 bits they are cut to that range."""
    for kind, exact in ((np.float32, 2**24), (np.float64, 2**53)):
        if bound < exact:
            return a.astype(kind) @ b.T.astype(kind)
    products = a.astype(object) @ b.T.astype(object)
    return np.clip(products, -_LIMIT, _LIMIT).astype(np.int64)


def best(scores: np.ndarray, among: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each row's ``k`` best scores, ties by the smaller column."""
    low = np.where(among, scores, scores.dtype.type(_LEAST))
    k = min(k, low.shape[1])
    kth = np.partition(low, -k, axis=1)[:, -k, None]
    above, equal = among & (low > kth), among & (low == kth)
    left = k - above.sum(axis=1, keepdims=True)
    return np.nonzero(above | equal & (np.cumsum(equal, axis=1) <= left))


def _few(among: np.ndarray) -> bool:
    """Whether sorting the places takes less time than a pass over all scores."""
    return np.count_nonzero(among) <= among.size // 16


def _hits(scores: np.ndarray, among: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places among which are each row's ``k`` best scores: all where they are few, or those."""
    return np.divmod(np.flatnonzero(among), among.shape[1]) if _few(among) else best(scores, among, k)


def _tiles(q_labels: np.ndarray, labels: np.ndarray, alike: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of anchors and rows to score with each other: all, or where labels are few those of one label."""
    pairs = [(np.arange(len(q_labels)), np.arange(len(labels)))]
    if alike and len(both := np.intersect1d(q_labels, labels)) <= LABELS:
        pairs = [(np.flatnonzero(q_labels == x), np.flatnonzero(labels == x)) for x in both]
    for anchors, rows in pairs:
        for at in range(0, len(anchors), AT_ONCE):
            yield anchors[at : at + AT_ONCE], rows


class _Kept:
    """The ``k`` best rows of each cell, an anchor and a slot, among those added so far."""

    def __init__(self, cells: int, k: int):
        self.scores, self.ids = np.full((cells, k), _ABSENT), np.full((cells, k), _MOST)

    def floors(self, first: int) -> np.ndarray:
        """The least score that can still enter each cell, with an id of ``first`` or more."""
        return self.scores[:, -1] + (self.ids[:, -1] < first)

    def add(self, cells: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        k, old = self.scores.shape[1], np.unique(cells)
        cells = np.concatenate([np.repeat(old, k), cells])
        ids = np.concatenate([self.ids[old].ravel(), ids])
        scores = np.concatenate([self.scores[old].ravel(), scores])
        order = np.lexsort((ids, -scores, cells))
        cells = cells[order]
        place = np.arange(len(cells)) - np.searchsorted(cells, cells)
        first = place < k
        at, order = (cells[first], place[first]), order[first]
        self.scores[at], self.ids[at] = scores[order], ids[order]


def _scored(k: int, slots: int, negative: bool):
    """Best rows of an anchor's label, or of other labels by slot, as far as a task sees them."""

    def search(row: dict, kept: _Kept) -> None:
        """Adds the rows of a block of candidates to those of a block of anchors."""
        ids, labels, matrix = _side(row, "c")
        q_ids, q_labels, q = _side(row, "q")
        width = min(matrix.shape[1], q.shape[1])
        bound = width * row["c_largest"] * row["q_largest"]
        floors = kept.floors(ids.min()).reshape(-1, slots)
        least = floors[:, 0]
        if negative:
            limits = np.frombuffer(row["limits"], np.int64).reshape(-1, slots)
            below = np.append(limits[:, 1:], np.full((len(limits), 1), _LEAST), axis=1)
            floors = np.where(limits > below, np.maximum(floors, below + 1), _MOST)
            least = np.maximum(np.frombuffer(row["least"], np.int64), floors.min(axis=1))
        for anchors, rows in _tiles(q_labels, labels, not negative):
            scores = _products(q[anchors, :width], matrix[rows, :width], bound)
            kind = scores.dtype
            among = scores >= least[anchors, None].astype(kind)
            if negative:
                among &= scores <= limits[anchors, :1].astype(kind)
                among &= q_labels[anchors, None] != labels[rows]
            else:
                among &= q_labels[anchors, None] == labels[rows]
                among &= q_ids[anchors, None] != ids[rows]
            if negative and not _few(among):
                ends = ((x[anchors, s, None].astype(kind) for x in (floors, limits)) for s in range(slots))
                found = [_hits(scores, among & (scores >= low) & (scores <= high), k) for low, high in ends]
            else:
                found = [_hits(scores, among, k)]
            i, j = (np.concatenate(x) for x in zip(*found, strict=True))
            if len(i):
                anchor, score, slot = anchors[i], scores[i, j].astype(np.int64), np.zeros(len(i), np.int64)
                if negative:
                    slot = (score[:, None] <= limits[anchor]).sum(axis=1) - 1
                enters = score >= floors[anchor, slot]
                kept.add((anchor * slots + slot)[enters], ids[rows[j]][enters], score[enters])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["q"] not in held:
                    anchors = np.frombuffer(row["q_ids"], np.int64)
                    held[row["q"]] = anchors, _Kept(len(anchors) * slots, k)
                search(row, held[row["q"]][1])
        names = [c.split()[0] for c in _FOUND.split(", ")]
        for q, (anchors, kept) in held.items():
            cell, place = np.nonzero(kept.scores > _ABSENT)
            slot = (cell % slots).astype(np.int32)
            rows = [np.full(len(cell), q), anchors[cell // slots], slot, kept.ids[cell, place], kept.scores[cell, place]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows], names)

    return combine


def share(p: np.ndarray, percent: int) -> np.ndarray:
    """``percent`` of the scores, rounded down, without leaving 64 bits."""
    return p // 100 * percent + p % 100 * percent // 100


def _limits(positives: int, low: int, high: int):
    """Blocks of anchors with the upper limits of their slots, descending, and their least scores."""

    def limits(key, asked: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not (len(asked) and len(found)):
            return pd.DataFrame(columns=[*asked.columns, "limits", "least"])
        ids = np.frombuffer(asked.q_ids.iloc[0], np.int64)
        out, least = np.full((len(ids), positives), _LEAST), np.full(len(ids), _MOST)
        at, score = np.searchsorted(ids, found.anchor_id.to_numpy()), found.score.to_numpy()
        out[at, found["rank"].to_numpy() - 1] = share(score, high)
        np.minimum.at(least, at, -share(-score, low))
        return asked.assign(limits=[out.tobytes()], least=[least.tobytes()])

    return limits


def _merged(positives: int, negatives: int, low: int, high: int):
    """Answers of all windows of a block's anchors, from the best rows of their slots."""

    def merge(key, pairs: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(pairs):
            return pd.DataFrame(columns=[c.split()[0] for c in _PAIRS.split(", ")])
        anchors, anchor = np.unique(pairs.anchor_id.to_numpy(np.int64), return_inverse=True)
        shape = (len(anchors), positives, negatives)
        scores, ids = np.full(shape, _ABSENT), np.full(shape, _MOST)
        at = np.searchsorted(anchors, found.anchor_id.to_numpy(np.int64))
        at = at, found.slot.to_numpy(np.int64), found["rank"].to_numpy(np.int64) - 1
        scores[at], ids[at] = found.score, found.vec_id
        there = scores > _ABSENT
        # From the last slot up: the best rows of a slot and of all below it.
        for slot in range(positives - 2, -1, -1):
            s, v, t = (np.concatenate([x[:, slot], x[:, slot + 1]], axis=1) for x in (scores, ids, there))
            order = np.lexsort((v, -s, ~t), axis=1)[:, :negatives]
            for x, y in ((scores, s), (ids, v), (there, t)):
                x[:, slot] = np.take_along_axis(y, order, axis=1)
        p, slot = pairs.score.to_numpy(np.int64), pairs["rank"].to_numpy(np.int64) - 1
        s, v = scores[anchor, slot], ids[anchor, slot]
        fits = there[anchor, slot] & (s >= -share(-p, low)[:, None]) & (s <= share(p, high)[:, None])
        i, j = np.nonzero(fits)
        return pd.DataFrame(
            {
                "anchor_id": pairs.anchor_id.to_numpy()[i],
                "positive_id": pairs.vec_id.to_numpy()[i],
                "rank": j + 1,
                "negative_id": v[i, j],
                "positive_score": p[i],
                "negative_score": s[i, j],
            }
        )

    return merge


def hard_negatives(
    vectors: DataFrame,
    positives: int = 5,
    negatives: int = 3,
    every: int = 50,
    low: int = 50,
    high: int = 95,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """The best rows of other labels within each positive's window of scores.

    Anchors are the rows whose id is divisible by ``every``; an anchor's positives are
    the first ``positives`` other rows of its label. For each of them come the first
    ``negatives`` rows of other labels with ``low`` to ``high`` percent of the
    positive's score. Scores are inner products of ``floor(256 * x)``, higher ones
    first, ties by smaller ids. Returns ``anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score``; windows without rows, as those of negative
    scores, give none.

    Rows without id, label or vector, or with a NULL or non-finite component, take no
    part. A shorter vector counts as filled up with zeros. An id that repeats is not
    its own positive; its rows are candidates each, and as an anchor the least of them
    counts. Columns besides the three named are ignored; without anchors or
    candidates there is no result.
    """
    spark = vectors.sparkSession
    ship(spark)
    bound_batches(spark)
    rows = usable(vectors, id_col, label_col, vector_col)
    asked = usable(vectors.where(F.col(id_col).cast("bigint") % every == 0), id_col, label_col, vector_col)
    asked = asked.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("least"))
    asked = written(asked.select("vec_id", "least.label", "least.vector"), "asked")

    def blocks(rows: DataFrame, n: int, size: int, purpose: str) -> tuple[DataFrame, int]:
        """The rows in blocks, whole ones as far as they come, and the number of blocks."""
        out = written(rows.coalesce(-(-n // size) or 1).mapInArrow(_blocks(size), _BLOCK), purpose)
        return out, out.count()

    candidates, n_candidates = blocks(rows, vectors.count(), ROWS, "candidates")
    anchors, n_anchors = blocks(asked, asked.count(), ANCHORS, "anchors")
    c_side = candidates.select(*[F.col(x).alias(f"c_{x}") for x in _SIDE])
    q_side = anchors.select(F.col("block").alias("q"), *[F.col(x).alias(f"q_{x}") for x in _SIDE])

    # A task reads its blocks of candidates one by one and holds its blocks of anchors. As
    # few tasks as may be share an anchor, because each of them sends its best rows on.
    tasks = 2 * parallelism(spark)
    parts = max(min(n_anchors, tasks), -(-n_anchors // HELD), 1)
    splits = max(min(n_candidates, -(-tasks // parts)), 1)
    few = candidates.rdd.getNumPartitions() < splits
    c_side = c_side.repartition(splits) if few else c_side.coalesce(splits)

    def searched(asked: DataFrame, k: int, slots: int, negative: bool) -> DataFrame:
        """The best ``k`` rows of each anchor and slot, with their ``rank``."""
        # The hint keeps a table that only looks small from being broadcast.
        pairs = c_side.crossJoin(asked.repartition(parts).hint("shuffle_replicate_nl"))
        found = pairs.mapInArrow(_scored(k, slots, negative), _FOUND)
        group = Window.partitionBy("q", "anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
        ranked = found.withColumn("rank", F.row_number().over(group))
        return ranked.where(F.col("rank") <= k)

    near = written(searched(q_side, positives, 1, False), "positives")
    # Groups that meet are shuffled on both sides, whatever the planner takes their sizes for.
    limits = q_side.groupBy("q").cogroup(near.groupBy("q"))
    limits = limits.applyInPandas(_limits(positives, low, high), f"{_ASKED}, limits binary, least binary")
    far = written(searched(limits, negatives, positives, True), "negatives")
    merge = _merged(positives, negatives, low, high)
    return near.groupBy("q").cogroup(far.groupBy("q")).applyInPandas(merge, _PAIRS)
