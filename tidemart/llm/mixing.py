"""Sources mixed to target weights by Sainte-Laguë apportionment, without Python.

Targets share all words by weight, at most so many copies of a source. Equal blocks of
words are apportioned to the sources by highest quotients ``target / (2 k - 1)``. The
method is house-monotone: the seats of the first shards are the apportionment of that
many blocks, so the differences between one shard's seats and the next one's are integer
quotas for every shard. A source's documents lie in a seeded order, going round and cut
into blocks; the shards take their quotas from it one after the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import matched, running, written

WORD = r"[^\x20\x09-\x0D]+"
#: Words of a block, shards, and the copies of a source that a mix may hold.
BLOCK, SHARDS, COPIES = 16, 16, 3


def word_count(text: Column) -> Column:
    """Words of a whole text; NULL has none."""
    each = F.regexp_replace(text, WORD, "w")
    return F.coalesce(F.length(F.translate(each, " \t\n\x0b\x0c\r", "")), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, copies: int = COPIES) -> DataFrame:
    """Adds ``target`` to ``source_size`` and ``weight``: the words of each source.

    All words are shared by weight. What a source would get beyond ``copies`` times its
    size is shared again among the others, until no target is above. Every round is one
    aggregate; the driver holds the words a unit of weight gets and nothing by source.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    limit = copies * F.col("source_size")
    level, capped = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > limit
        row = sources.agg(
            F.count(F.when(above, 1)).alias("n"),
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0)).alias("held"),
            F.sum(F.when(~above, F.col("weight"))).alias("weights"),
        ).first()
        if row.n == capped or not row.weights:
            break
        level, capped = (total - row.held) / row.weights, row.n
    target = F.least(F.col("weight") * F.lit(level), limit.cast("double"))
    return sources.withColumn("target", target)


def apportioned(sources: DataFrame, houses: list[int]) -> DataFrame:
    """Adds ``seats``: for each size of house the seats that ``target`` wins there.

    ``place`` numbers the sources and breaks ties. Seats that a source is sure of, as
    rounding moves all others by half a seat at most, are not looked at one by one: the
    remaining ones, about four times as many as sources, go to the highest quotients.
    """
    whole = sources.agg(F.sum("target").alias("votes"), F.count(F.when(F.col("target") > 0, 1)).alias("n")).first()
    votes = whole.votes or 0.0
    house = F.explode(F.array(*[F.struct(F.lit(i).alias("house"), F.lit(h).cast("bigint").alias("size")) for i, h in enumerate(houses)]))
    voted = sources.where("target > 0").select("place", "target", house.alias("h")).select("place", "target", "h.*")
    share = F.col("target") / F.lit(votes or 1.0)
    apart = 1.5 + share * (whole.n / 2)
    sure = F.greatest(F.floor(share * F.col("size") - apart), F.lit(0)).cast("bigint")
    most = F.ceil(share * F.col("size") + apart).cast("bigint")
    voted = written(voted.withColumns({"sure": sure, "most": most}), "votes")
    left = voted.groupBy("house").agg((F.max("size") - F.sum("sure")).alias("left"))
    seat = F.explode(F.sequence(F.col("sure") + 1, "most"))
    asked = voted.select("house", "place", "target", seat.alias("seat"))
    asked = asked.withColumn("quotient", F.col("target") / (2 * F.col("seat") - 1))
    ranked = running(asked, ["house"], [F.desc("quotient"), F.col("place")], F.lit(1), "rank")
    won = matched(ranked, left, ["house"]).where(F.col("rank") < F.col("left"))
    won = won.groupBy("house", "place").agg(F.count(F.lit(1)).alias("won"))
    each = voted.join(won, ["house", "place"], "left").select(
        "place", "house", (F.col("sure") + F.coalesce("won", F.lit(0))).alias("seats")
    )
    listed = each.groupBy("place").agg(F.sort_array(F.collect_list(F.struct("house", "seats"))).alias("all"))
    listed = listed.select("place", F.transform("all", lambda x: x["seats"]).alias("seats"))
    none = F.array_repeat(F.lit(0).cast("bigint"), len(houses))
    joined = sources.join(listed, "place", "left")
    return joined.withColumn("seats", F.coalesce("seats", none))


def _spans(copies: int, shards: int) -> Column:
    """Parts of a document that the shards take, from the ends of their quotas in words."""

    def in_copy(copy: Column) -> Column:
        first = copy.cast("bigint") * F.col("source_size") + F.col("start")

        def in_shard(shard: Column) -> Column:
            low = F.greatest(F.get("ends", shard), first)
            high = F.least(F.get("ends", shard + 1), first + F.col("size"))
            return F.struct(
                shard.alias("shard"),
                copy.alias("copy"),
                (low - first).alias("first"),
                (high - low).alias("words"),
            )

        every = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), in_shard)
        return F.filter(every, lambda s: s["words"] > 0)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(copies - 1)), in_copy))


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block: int = BLOCK,
    shards: int = SHARDS,
    copies: int = COPIES,
    seed: int = 1,
) -> DataFrame:
    """One row per document: its size in words and what the mix takes of it.

    Returns ``doc_id, size, source_size, target, taken, spans``. Sources, in the order
    of code points and NULL last, weigh 1, 2, 3 and again. ``spans`` lists shard, copy,
    first word and words of every part taken, ``taken`` adds their words up. A source
    takes its target up to a block.

    NULL and wordless texts have size 0 and nothing is taken. Documents lie in the order
    of a hash of seed and id, then id and size; rows that repeat an id are documents of
    their own, those with a NULL id come first. Columns not named are ignored; an empty
    table gives no rows. All sums run over ranges, so one source may hold most rows.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
    )
    rows = written(rows, "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = running(sources, [], [F.col("source").asc_nulls_last()], F.lit(1), "place")
    weight = 1 + F.col("place") % 3
    sources = written(sources.select("source", "source_size", "place", weight.alias("weight")), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    seats = (total + block // 2) // block
    houses = [seats * s // shards for s in range(shards + 1)]
    wanted = written(apportioned(targets(sources, copies), houses), "quotas")
    ends = F.transform("seats", lambda s: F.least(s * block, copies * F.col("source_size")))
    wanted = wanted.select("source", "source_size", "target", ends.alias("ends"))

    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")))
    order = [F.col("key"), F.col("doc_id"), F.col("size")]
    placed = running(rows.withColumn("key", key), ["source"], order, F.col("size"), "start")
    found = matched(placed, wanted, ["source"]).withColumn("spans", _spans(copies, shards))
    taken = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["words"])
    return found.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "spans")
