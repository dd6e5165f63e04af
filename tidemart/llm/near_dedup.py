"""Near duplicates by b-bit MinHash.

Every text becomes the set of its hashed word shingles. Band keys of the full
minima give candidates; only the low bits of the minima are kept, packed. The
count of equal bit groups, corrected for chance collisions, drops candidates far
below the threshold; the others are confirmed on the full sets.

Large groups are never expanded into all pairs. Equal sets are one class. In a
bucket every class is first compared with the bucket's least id. Of the members of
buckets that this leaves in several components only the rarest shingles are looked
at: in one common order two sets of the wanted similarity share one of them, so a
member that shares none with another component is done, and those that share one are
compared with the least id that has it. Only what is still apart then meets in its
buckets, block by block, until it is linked to a component or all its members of a
promising estimate are refuted. So each candidate pair is confirmed, refuted, or
inside one component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import bound_batches, give_back, ship, written
from tidemart.llm.components import connected

ROWS, BANDS, BITS = 6, 42, 4
HASHES = ROWS * BANDS
#: A pair at the threshold has an estimate below this with a chance of about 3e-6:
#: so many standard deviations of the estimate are left.
DEVIATIONS = 4.5
#: Members of a bucket that meet in one task.
BLOCK = 512
#: Counters, as a power of two, that order shingles from rare to frequent. Any order
#: gives the same links; shared counters only leave more members to compare.
COUNTERS = 20
#: Words that a worker remembers within a task.
_WORDS_KEPT = 60_000
_LOW = np.uint64(0x1111111111111111)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHashes()


def _forget() -> None:
    """Leaves a worker, which later stages use again, without this stage's words."""
    _hashes.clear()
    give_back()


_FACTORS = np.random.default_rng(20240101).integers(0, 2**63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text.

    Words are runs of bytes other than ASCII white space, with A-Z lower-cased. A
    text of fewer words than a shingle is one shingle; without words it has none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    get = _hashes.__getitem__
    h = np.fromiter(map(get, words), np.uint64, len(words))
    size = min(shingle, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, np.uint64)
    for i in range(size):
        total = _mix(total * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    return np.unique(total)


def minima(members: np.ndarray) -> np.ndarray:
    """For every hash function the least value over a set."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(members), 512):
        np.minimum(least, (_FACTORS[:, None] * members[at : at + 512]).min(axis=1), out=least)
    return _mix(least)


def band_keys(least: np.ndarray) -> np.ndarray:
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def packed(least: np.ndarray) -> bytes:
    """The low ``BITS`` bits of each minimum, 16 of them to a word of 64 bits."""
    low = (least & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    low = np.concatenate([low, np.zeros(-len(low) % 16, np.uint8)])
    return (low[::2] | low[1::2] << 4).tobytes()


def similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of packed signatures (last axis: words).

    Equal groups of bits are counted; two different minima agree by chance with
    probability ``2 ** -BITS``, which is taken out again.
    """
    x = a ^ b
    x = (x | x >> np.uint64(1) | x >> np.uint64(2) | x >> np.uint64(3)) & _LOW
    equal = 1 - np.bitwise_count(x).sum(axis=-1, dtype=np.int32) / HASHES
    chance = 2.0**-BITS
    return (equal - chance) / (1 - chance)


def least_estimate(percent: int) -> float:
    """The estimate below which a pair is dropped unseen."""
    j, chance = percent / 100, 2.0**-BITS
    equal = j + (1 - j) * chance
    return j - DEVIATIONS * np.sqrt(equal * (1 - equal) / HASHES) / (1 - chance)


_ROW = "doc_id long, n_shingles long, set1 long, set2 long, bands array<long>, bits binary"


def _signatures(shingle: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                out: list[list] = [[] for _ in range(5)]
                for text in part.column(1):
                    members = shingle_set(text.as_py(), shingle)
                    digest = xxhash.xxh3_128_digest(members.tobytes())
                    some = len(members) > 0
                    least = minima(members) if some else None
                    for column, value in zip(
                        out,
                        (
                            len(members),
                            int.from_bytes(digest[:8], "little", signed=True),
                            int.from_bytes(digest[8:], "little", signed=True),
                            band_keys(least) if some else np.zeros(0, np.int64),
                            packed(least) if some else b"",
                        ),
                        strict=True,
                    ):
                        column.append(value)
                kinds = [pa.int64()] * 3 + [pa.list_(pa.int64()), pa.binary()]
                arrays = [pa.array(c, t) for c, t in zip(out, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *arrays],
                    ["doc_id", "n_shingles", "set1", "set2", "bands", "bits"],
                )
        _forget()

    return sign


def _sets(shingle: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = [shingle_set(t.as_py(), shingle).tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, pa.binary())], ["id", "members"]
                )
        _forget()

    return sets


def _words(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint64).reshape(len(column), -1)


def _promising(cutoff: float):
    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pairs in batches:
            if len(pairs):
                near = similarity(_words(pairs.bits_u), _words(pairs.bits_v)) >= cutoff
                yield pairs.loc[near, ["u", "v"]]

    return keep


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.sort(np.concatenate([a, b]), kind="stable")
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _confirmed(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                a = np.frombuffer(batch.column(2)[i].as_py(), np.uint64)
                b = np.frombuffer(batch.column(3)[i].as_py(), np.uint64)
                linked[i] = _similar(a, b, percent)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(linked)], ["u", "v", "linked"]
            )
        give_back()

    return confirm


def _slots(members: np.ndarray) -> np.ndarray:
    return (_mix(members * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - COUNTERS)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many sets of a task have a shingle on each counter."""
    counts = np.zeros(1 << COUNTERS, np.int64)
    for batch in batches:
        for members in batch.column("members"):
            np.add.at(counts, _slots(np.frombuffer(members.as_py(), np.uint64)), 1)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["slot", "n"])


def _prefix(members: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The rarest shingles of a set, of which a similar set must share one.

    Similar sets share at least ``percent`` of the larger one, so at most the rest of
    either can come before their first common shingle. A counter of 1 belongs to a
    shingle that no other set has.
    """
    length = len(members) + (-percent * len(members)) // 100 + 1
    seen = counts[_slots(members)]
    rarest = np.lexsort((members, seen))[:length]
    return members[rarest[seen[rarest] > 1]]


def _prefixes(counts, percent: int):
    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids, comps = (part.column(name).to_numpy() for name in ("id", "comp"))
                sets = [np.frombuffer(m.as_py(), np.uint64) for m in part.column("members")]
                found = [_prefix(m, counts.value, percent) for m in sets]
                times, sizes = [len(f) for f in found], np.array([len(m) for m in sets], np.int64)
                columns = [np.concatenate(found).view(np.int64), *(np.repeat(c, times) for c in (ids, comps, sizes))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["shingle", "id", "comp", "size"])

    return rarest


def _across(cutoff: float, percent: int):
    """Links in one block from its odd members to each other component."""

    def links(block: pd.DataFrame) -> pd.DataFrame:
        key = block.key.iloc[0]
        odd, other = block[block.odd], block[~block.odd]
        out = []
        if len(odd) and len(other):
            bits, bands = _words(other.bits), np.stack(other.bands.to_numpy())
            comps, ids = other.comp.to_numpy(), other.id.to_numpy()
            sets = [np.frombuffer(m, np.uint64) for m in other.members]
            for row in odd.itertuples():
                estimate = similarity(np.frombuffer(row.bits, np.uint64), bits)
                near = np.flatnonzero((estimate >= cutoff) & (comps != row.comp))
                # A pair is looked at in the first of the buckets that it shares.
                shared = (bands[near] == row.bands).argmax(axis=1)
                near = near[row.bands[shared] == key]
                own, linked = np.frombuffer(row.members, np.uint64), set()
                for i in near[np.argsort(-estimate[near], kind="stable")]:
                    if comps[i] not in linked and _similar(own, sets[i], percent):
                        linked.add(comps[i])
                        out.append((row.id, ids[i]))
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return links


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
) -> DataFrame:
    """One row per document: the component of texts linked to it, by its least id.

    Two documents are linked when ``100 * intersection >= percent * union`` holds
    for their shingle sets. Texts without words (NULL, empty, blank) are linked
    with nothing. ``kept`` marks the least id of each component. Rows with a NULL
    id are linked with nothing, have a NULL component and are kept. Repeated rows
    with one id carry the same verdict. Columns besides the two named are ignored;
    an empty table gives no rows. With ``percent`` below 80 some links may be
    missed, since bands are chosen for 80 and more.
    Returns ``doc_id, n_shingles, component_id, kept``.
    """
    ship(docs.sparkSession)
    bound_batches(docs.sparkSession)
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")
    )
    signed = written(texts.mapInArrow(_signatures(shingle), _ROW), "signatures")

    # Equal sets are one class, named by its least id.
    same = ["n_shingles", "set1", "set2"]
    usable = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = written(usable.groupBy(*same).agg(F.min("doc_id").alias("id")), "classes")
    first = usable.withColumnRenamed("doc_id", "id").join(classes, ["id", *same], "left_semi")
    bits = written(first.select("id", "bits", "bands"), "bits")

    banded = bits.select("id", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("id").alias("hub"), F.count("id").alias("n"))
    buckets = written(buckets.where("n > 1"), "buckets")
    members = written(banded.join(buckets, "key"), "members")

    stars = members.where("id != hub").select(F.col("id").alias("u"), F.col("hub").alias("v"))
    candidates = written(_estimated(stars.distinct(), bits, least_estimate(percent)), "candidates")
    involved = members.select("id").distinct()
    sets = texts.withColumnRenamed("doc_id", "id").join(involved, "id", "left_semi")
    sets = written(sets.mapInArrow(_sets(shingle), "id long, members binary"), "sets")

    checked = _checked(candidates, sets, percent)
    links = written(checked.where("linked").select("u", "v"), "links")
    roots = written(connected(links), "roots")
    apart = _apart(members, roots)
    if not apart.isEmpty():
        apart = written(sets.join(apart, "id"), "apart")
        shared = written(_shared(apart, percent), "shared")
        nearest = written(_estimated(_nearest(shared, percent), bits, least_estimate(percent)), "candidates")
        linked = written(_checked(nearest, apart, percent).where("linked").select("u", "v"), "links")
        if not linked.isEmpty():
            links = links.union(linked)
            roots = written(connected(links), "roots")
        left = written(_contenders(shared, roots), "contenders")
        if not left.isEmpty():
            linked = written(_remaining(members, left, bits, apart, percent), "links")
            roots = written(connected(links.union(linked)), "roots")

    named = signed.join(classes, same, "left").select("doc_id", "n_shingles", "id")
    named = named.join(roots, "id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "id", "doc_id"))
    return named.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def _estimated(pairs: DataFrame, bits: DataFrame, cutoff: float) -> DataFrame:
    of = lambda side: bits.select(F.col("id").alias(side), F.col("bits").alias(f"bits_{side}"))
    both = pairs.join(of("u"), "u").join(of("v"), "v").select("u", "v", "bits_u", "bits_v")
    return both.mapInPandas(_promising(cutoff), "u long, v long")


def _checked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    of = lambda side: sets.select(F.col("id").alias(side), F.col("members").alias(f"set_{side}"))
    both = pairs.join(of("u"), "u").join(of("v"), "v").select("u", "v", "set_u", "set_v")
    return both.mapInArrow(_confirmed(percent), "u long, v long, linked boolean")


def _components(ids: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows with ``comp``, the component of ``id``."""
    found = ids.join(roots.withColumnRenamed("root", "comp"), "id", "left")
    return found.withColumn("comp", F.coalesce("comp", "id"))


def _several(rows: DataFrame, by: str) -> DataFrame:
    """The groups of several components: size, least id, and its component and size."""
    some = F.min(F.struct("id", "comp", *[c for c in ("size",) if c in rows.columns])).alias("hub")
    groups = rows.groupBy(by).agg(F.count("id").alias("n"), some, F.min("comp").alias("a"), F.max("comp").alias("b"))
    return groups.where("a != b").select(by, "n", "hub")


def _apart(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``id, comp`` of the members of buckets that the stars left in several components.

    Buckets of two have been compared already.
    """
    placed = written(_components(members.where("n > 2").select("key", "id"), roots), "placed")
    mixed = placed.join(_several(placed, "key").select("key"), "key", "left_semi")
    return written(mixed.select("id", "comp").distinct(), "mixed")


def _shared(apart: DataFrame, percent: int) -> DataFrame:
    """``shingle, id, comp, size, n, hub``: rare shingles that several components have.

    The counters are of a fixed number; they alone come to the driver and go back.
    """
    spark = apart.sparkSession
    totals = apart.select("members").mapInArrow(_counted, "slot long, n long")
    totals = totals.groupBy("slot").agg(F.sum("n").alias("n")).where("n > 1").toPandas()
    counts = np.ones(1 << COUNTERS, np.uint32)
    counts[totals.slot.to_numpy(np.int64)] = np.minimum(totals.n.to_numpy(np.int64), np.iinfo(np.uint32).max)
    rarest = apart.mapInArrow(
        _prefixes(spark.sparkContext.broadcast(counts), percent), "shingle long, id long, comp long, size long"
    )
    rarest = written(rarest, "rarest")
    return rarest.join(_several(rarest, "shingle"), "shingle")


def _nearest(shared: DataFrame, percent: int) -> DataFrame:
    """Members of a rare shingle beside the least id that has it, where they may be similar."""
    small, large = F.least("size", "hub.size"), F.greatest("size", "hub.size")
    near = shared.where((F.col("comp") != F.col("hub.comp")) & (100 * small >= percent * large))
    return near.select(F.col("id").alias("u"), F.col("hub.id").alias("v")).distinct()


def _contenders(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """``id, comp`` of what shares a rare shingle with another component, beyond two members."""
    placed = written(_components(shared.where("n > 2").select("shingle", "id"), roots), "placed")
    mixed = placed.join(_several(placed, "shingle").select("shingle"), "shingle", "left_semi")
    return mixed.select("id", "comp").distinct()


def _remaining(members: DataFrame, left: DataFrame, bits: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links in a bucket between components that no star has joined.

    Members outside the component of the bucket's least id are odd. Every odd one
    meets every member, in blocks of ``BLOCK`` by ``BLOCK`` with their full sets.
    """
    placed = written(members.select("key", "id").join(left, "id"), "placed")
    placed = placed.join(_several(placed, "key"), "key")
    placed = written(placed.select("key", "id", "n", "comp", (F.col("comp") != F.col("hub.comp")).alias("odd")), "odd")
    odd = placed.where("odd").groupBy("key").agg(F.count("id").alias("n_odd"))
    full = bits.join(sets.select("id", "members"), "id")
    split = placed.join(odd, "key").join(full, "id")
    rows = F.ceil(F.col("n_odd") / BLOCK).cast("int")
    columns = F.ceil(F.col("n") / BLOCK).cast("int")
    up_to = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    place = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    every = split.withColumn("j", place(columns)).withColumn("i", up_to(rows))
    lone = split.where("odd").withColumn("i", place(rows)).withColumn("j", up_to(columns))
    out = ["key", "i", "j", "id", "comp", "bits", "bands", "members"]
    blocks = every.select(*out, F.lit(False).alias("odd")).union(
        lone.select(*out, F.lit(True).alias("odd"))
    )
    return blocks.groupBy("key", "i", "j").applyInPandas(
        _across(least_estimate(percent), percent), "u long, v long"
    )
