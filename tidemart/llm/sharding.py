"""Shards by balanced label propagation, in DataFrame operations only.

Documents start on shards dealt by a hash. Equal texts are linked. In each round
every parcel (the rows of one group that started on one shard) looks at how many of
its group lie on each shard and moves towards the most, as far as the quotas of the
shards with room allow. A last pass evens the sizes exactly, moving rows without
links first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import written

SHARDS = 16
#: Rounds without a gain after which a class of groups has settled.
PATIENCE = 4
#: Rows that one task numbers, about.
NUMBERED = 20_000
_FINE = 1 << 20


def _nth(values: list[int], at: Column) -> Column:
    """``values[at]``, for a number from 0 to their count."""
    return F.get(F.array(*[F.lit(v).cast("bigint") for v in values]), at.cast("int"))


def _by_shard(df: DataFrame, shards: int, column: str = "shard") -> list[int]:
    """Rows of each shard: as many numbers as shards, whatever the table."""
    found = {r[0]: r[1] for r in df.groupBy(column).agg(F.sum("n")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def _classes(capacity: int) -> tuple[int, int, int]:
    """Groups of more members than each number settle together, large ones first."""
    return max(3, capacity // 4), max(2, capacity // 64), 1


def _votes(parcels: DataFrame) -> DataFrame:
    return parcels.groupBy("hub", "shard").agg(F.sum("n").alias("votes"))


def _standing(votes: DataFrame, capacity: int, shards: int) -> tuple[float, list[int]]:
    """How well linked rows lie together, and the rows of each shard.

    The first is the sum of squared votes, which grows with the pairs of linked rows on
    one shard; of a shard that is too full, the rows beyond its quota do not count.
    """
    square = F.sum(F.col("votes").cast("double") * F.col("votes"))
    found = {r[0]: r for r in votes.groupBy("shard").agg(F.sum("votes"), square).collect()}
    load = [found[s][1] if s in found else 0 for s in range(shards)]
    return sum(r[2] * min(1, capacity / r[1]) ** 2 for r in found.values()), load


def propagate(parcels: DataFrame, capacity: int, shards: int) -> DataFrame:
    """Moves ``hub, members, start, shard, n`` while that brings linked rows together.

    Large groups settle first, as if the smaller ones took no room; these then leave
    the shards that are too full. A class of groups has settled when no parcel wishes
    to move, or when ``PATIENCE`` rounds brought no more linked rows together within the
    quotas; the best of its rounds stands.
    """
    state, larger = parcels, 0
    for least in dict.fromkeys(_classes(capacity)):
        best, standing, rnd, tried = state, -1.0, 0, 0
        while state is not None and tried < PATIENCE:
            counted = state.where(F.col("members") > least)
            votes = written(_votes(counted), "votes")
            now, load = _standing(votes, capacity, shards)
            tried += 1
            if now > standing:
                best, standing, tried = state, now, 0
            state, rnd = _round(state, counted, votes, load, capacity, shards, larger, rnd), rnd + 1
        state, larger = best, least
    return state


def _round(
    state: DataFrame,
    counted: DataFrame,
    votes: DataFrame,
    load: list[int],
    capacity: int,
    shards: int,
    larger: int,
    rnd: int,
) -> DataFrame | None:
    """One round of moves; None if no parcel wishes to move."""
    room = [max(0, capacity - x) for x in load]
    crowded = F.col("shard").isin([s for s in range(shards) if load[s] > capacity])
    open_to = F.col("shard").isin([s for s in range(shards) if room[s]])
    ordered = (-F.col("shard")).alias("order")
    best = votes.where(open_to).groupBy("hub").agg(F.max(F.struct("votes", ordered)).alias("best"))
    # Groups that settled before stay where they are.
    leaves = crowded & (F.col("members") <= larger if larger else F.lit(False))
    own = F.struct(F.when(leaves, F.lit(0)).otherwise(F.col("votes")).alias("votes"), ordered)
    wishes = (
        counted.join(votes, ["hub", "shard"])
        .join(best, "hub")
        .withColumn("target", (-F.col("best.order")).cast("int"))
        .where((F.col("target") != F.col("shard")) & (F.col("best") > own))
        .where(F.col("n") <= _nth(room, F.col("target")))
        .select("hub", "start", "n", "target")
    )
    wishes = written(wishes, "wishes")
    demand = _by_shard(wishes, shards, "target")
    if not any(demand):
        return None
    # The share of the wishes that fits, by a hash of the parcel.
    share = [_FINE if d <= r else _FINE * r // d for d, r in zip(demand, room, strict=True)]
    drawn = F.pmod(F.xxhash64("hub", "start", F.lit(rnd)), F.lit(_FINE))
    goes = wishes.where(drawn < _nth(share, F.col("target"))).select("hub", "start", "target")
    moved = state.join(goes, ["hub", "start"], "left")
    shard = F.coalesce("target", "shard").alias("shard")
    return written(moved.select("hub", "members", "start", shard, "n"), "parcels")


def cut_links(placed: DataFrame, texts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row, ``links, cut``: pairs of documents with equal texts, and those lying apart.

    ``placed`` has ``doc_id`` and ``shard`` of the documents of ``texts``. Pairs are counted
    from the groups' sizes, not made. Rows with a NULL id are left out.
    """
    text = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), F.lit("group")).alias("hub")
    hubs = texts.select(F.col(id_col).cast("bigint").alias("doc_id"), text).distinct()
    held = placed.select("doc_id", "shard").join(hubs, "doc_id")
    held = held.groupBy("hub", "shard").agg(F.count(F.lit(1)).cast("double").alias("n"))
    n = F.col("n")
    hub = held.groupBy("hub").agg(F.sum("n").alias("n"), F.sum(n * (n - 1) / 2).alias("together"))
    pairs = n * (n - 1) / 2
    whole = lambda c: F.coalesce(F.sum(c), F.lit(0.0)).cast("bigint")
    return hub.agg(whole(pairs).alias("links"), whole(pairs - F.col("together")).alias("cut"))


def balanced_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    The law is ``rows``: the shards' counts are at most one apart. Equal texts are
    linked, and NULL counts as the empty text; ``size`` is the text's UTF-8 bytes
    plus 1. Slots count the rows of a shard from 0. Rows with a NULL id and repeated
    rows are placed one by one. Columns besides the two named are ignored; an empty
    table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text, F.lit("group")).alias("hub"),
        F.xxhash64(F.col(id_col), text).alias("row"),
    ).withColumn("start", F.pmod("row", F.lit(shards)).cast("int"))
    base = written(base, "rows")
    total = base.count()
    capacity = -(-total // shards)

    parcels = written(base.groupBy("hub", "start").agg(F.count(F.lit(1)).alias("n")), "parcels")
    groups = parcels.groupBy("hub").agg(F.sum("n").alias("members")).where("members > 1")
    linked = parcels.join(groups, "hub").withColumn("shard", F.col("start"))
    moved = propagate(written(linked.select("hub", "members", "start", "shard", "n"), "linked"), capacity, shards)

    large, middle, _ = _classes(capacity)
    members = F.col("members")
    order = F.when(members > large, 0).when(members > middle, 1).otherwise(2)
    moved = moved.select("hub", "start", "members", F.col("shard").alias("moved"), order.alias("order"))
    placed = base.join(moved, ["hub", "start"], "left").select(
        "doc_id", "size", "text_crc32", "hub", "row",
        F.coalesce("moved", "start").alias("at"),
        F.coalesce("order", F.lit(3)).alias("free"),
        F.coalesce("members", F.lit(1)).alias("members"),
    )
    numbered, counts = _numbered(placed, total, shards)
    return _evened(numbered, counts, total, shards)


def _numbered(placed: DataFrame, total: int, shards: int) -> tuple[DataFrame, list[int]]:
    """Adds ``pos``, a number from 0 within ``at``, rows of large groups first.

    Rows are ranked in buckets of about ``NUMBERED`` and shifted by the rows of the
    buckets before, so that no task ranks a whole shard. Linked rows lie in the
    order of their groups, unless a group is too large for a bucket.
    """
    buckets = max(1, -(-total // (shards * NUMBERED)))
    lone = F.pmod("row", F.lit(buckets))
    spread = F.ceil(F.col("members") / NUMBERED).cast("bigint")
    group = F.pmod(F.xxhash64("hub", F.pmod(F.shiftright("row", 20), spread)), F.lit(buckets))
    bucketed = placed.withColumn("bucket", F.when(F.col("free") == 3, lone).otherwise(group))
    bucketed = written(bucketed, "placed")
    sizes = bucketed.groupBy("at", "free", "bucket").agg(F.count(F.lit(1)).alias("n"))
    sizes = written(sizes, "sizes")
    counts = _by_shard(sizes, shards, "at")
    before = Window.partitionBy("at").orderBy("free", "bucket")
    offsets = sizes.select(
        "at", "free", "bucket", (F.sum("n").over(before) - F.col("n")).alias("offset")
    )
    within = Window.partitionBy("at", "free", "bucket").orderBy("hub", "row", "doc_id")
    ranked = bucketed.withColumn("rank", F.row_number().over(within) - 1)
    joined = ranked.join(offsets, ["at", "free", "bucket"])
    return joined.withColumn("pos", F.col("rank") + F.col("offset")), counts


def _evened(numbered: DataFrame, counts: list[int], total: int, shards: int) -> DataFrame:
    """Rows beyond a shard's quota fill the holes of the others, in order."""
    fullest = sorted(range(shards), key=lambda s: (-counts[s], s))
    quota = [total // shards] * shards
    for s in fullest[: total % shards]:
        quota[s] += 1
    over, excess = [], 0
    for s in range(shards):
        over.append(excess)
        excess += max(0, counts[s] - quota[s])
    # Shards with holes, and how many holes there are before and up to each.
    hollow = [s for s in range(shards) if quota[s] > counts[s]] or [0]
    ends = [sum(quota[s] - counts[s] for s in hollow[: i + 1]) for i in range(len(hollow))]
    starts = [0, *ends[:-1]]
    passed = F.filter(F.array(*[F.lit(e).cast("bigint") for e in ends]), lambda e: e <= F.col("number"))
    settled = numbered.select(
        "doc_id", "size", "text_crc32", "at", "pos",
        (F.col("pos") < _nth(quota, F.col("at"))).alias("stays"),
        (F.col("pos") - _nth(quota, F.col("at")) + _nth(over, F.col("at"))).alias("number"),
    ).withColumn("hole", F.size(passed))
    slot = F.col("number") - _nth(starts, F.col("hole")) + _nth([counts[s] for s in hollow], F.col("hole"))
    return settled.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.when(F.col("stays"), F.col("at")).otherwise(_nth(hollow, F.col("hole"))).cast("int").alias("shard"),
        F.when(F.col("stays"), F.col("pos")).otherwise(slot).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
