"""Merkle manifest of a dataset: a tree a source, and one over the sources.

Nodes are lowercase hex SHA-256. The leaves of a source, in the order of their ids,
are cut into aligned blocks of ``3 ** LEVELS``. A block keeps each of its levels as one
string of concatenated hex hashes: a parent is the hash of a fixed-width substring of
the level below, and what flanks a node in that substring are its siblings. The blocks'
roots are the leaves of the next round, until every source has one root; those, in the
order of the sources, are the leaves of the last tree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import matched, running, written

#: Children of a node, hex digits of a hash, and levels of a block.
FAN, HEX, LEVELS = 3, 64, 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(values: Sequence[Column]) -> Column:
    """Hash of a row: each value as byte count, colon and text, NULL as a dash."""
    texts = [v.cast("string") for v in values]
    sized = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.sha2(F.concat(*[F.coalesce(s, F.lit("-")) for s in sized]), 256)


def _parents(level: Column) -> Column:
    """The level above one, both as concatenated hex."""
    width = FAN * HEX
    starts = F.sequence(F.lit(0), F.floor((F.length(level) - 1) / width).cast("int"))
    hashes = F.transform(starts, lambda i: F.sha2(F.substring(level, i * width + 1, F.lit(width)), 256))
    return F.array_join(hashes, "").cast("binary")


def _blocks(nodes: DataFrame, by: list[str], levels: int) -> DataFrame:
    """Blocks with their levels ``l0, l1, ...`` and their ``top``.

    A block that is its group's only one ends with one node, later levels are NULL;
    others climb all levels, a lone node too, so that the tree's levels stay aligned.
    """
    width = FAN**levels
    held = [c for c in nodes.columns if c not in {*by, "pos", "n"}]
    number = F.floor(F.col("pos") / width).cast("bigint")
    blocks = nodes.groupBy(*by, number.alias("block")).agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", *held))).alias("nodes")
    )
    lowest = F.array_join(F.transform("nodes", lambda x: x["hash"]), "").cast("binary")
    blocks = blocks.withColumn("l0", lowest)
    alone = F.col("n") <= width
    for j in range(levels):
        level = F.col(f"l{j}")
        goes_on = level.isNotNull() & (~alone | (F.length(level) > HEX))
        blocks = blocks.withColumn(f"l{j + 1}", F.when(goes_on, _parents(level)))
    top = F.coalesce(*[F.col(f"l{j}") for j in range(levels, -1, -1)]).cast("string")
    nodes_left = F.transform("nodes", lambda x: x.dropFields("hash"))
    return blocks.withColumns({"top": top, "alone": alone, "nodes": nodes_left})


def _path(slot: Column, levels: int) -> Column:
    """What stands left and right of a node's ancestors in their runs, bottom up."""
    steps = []
    for j in range(levels):
        at = F.floor(slot / FAN**j).cast("int")
        inside = at % FAN
        run, level = (at - inside) * HEX, F.col(f"l{j}")
        left = F.substring(level, run + 1, inside * HEX)
        right = F.substring(level, run + (inside + 1) * HEX + 1, (FAN - 1 - inside) * HEX)
        flanks = F.struct(left.alias("left"), right.alias("right"))
        steps.append(F.when(F.col(f"l{j + 1}").isNotNull(), flanks))
    return F.filter(F.array(*steps), lambda s: s.isNotNull())


def _nodes_with_paths(blocks: DataFrame, upper: DataFrame, by: list[str], levels: int) -> DataFrame:
    """Every node of the blocks with its path up to the root that ``upper`` tells."""
    both = matched(blocks, upper, [*by, "block"])
    width = FAN**levels

    def placed(x: Column) -> Column:
        slot = (x["pos"] - F.col("block") * width).cast("int")
        return x.withField("path", F.concat(_path(slot, levels), F.col("up")))

    rest = [c for c in upper.columns if c not in {*by, "block", "up"}]
    return both.select(*by, *rest, F.explode(F.transform("nodes", placed)).alias("x")).select(*by, *rest, "x.*")


def _climb(nodes: DataFrame, by: list[str], levels: int) -> tuple[DataFrame, DataFrame]:
    """The lowest blocks, and of each its path ``up`` and its group's ``subroot``.

    Each round has ``3 ** levels`` times fewer rows than the one before.
    """
    rounds = []
    while True:
        blocks = written(_blocks(nodes, by, levels), "blocks")
        rounds.append(blocks)
        nodes = blocks.where("NOT alone").select(
            *by,
            F.col("block").alias("pos"),
            F.ceil(F.col("n") / FAN**levels).cast("bigint").alias("n"),
            F.col("top").alias("hash"),
        )
        if nodes.isEmpty():
            break
    none = F.array().cast("array<struct<left:binary,right:binary>>")
    upper = None
    for blocks in reversed(rounds):
        ends = blocks.where("alone").select(*by, "block", none.alias("up"), F.col("top").alias("subroot"))
        if upper is not None:
            inner = _nodes_with_paths(above, upper, by, levels)
            ends = ends.union(
                inner.select(*by, F.col("pos").alias("block"), F.col("path").alias("up"), "subroot")
            )
        upper, above = written(ends, "paths"), blocks
    return rounds[0], upper


def proofs(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    id_col: str = "doc_id",
    group_col: str = "source",
    levels: int = LEVELS,
    **carried: Column,
) -> DataFrame:
    """One row per document: ``doc_id, leaf, path, subroot, root`` and what is carried.

    A leaf hashes the named fields in their order. ``path`` lists, from the leaf to the
    root, the concatenated hashes left and right of each node in its run. Carried
    columns are computed from ``docs`` and returned with their rows.

    NULL sources are a source of their own, the first; NULL ids are a source's first
    leaves. Rows with one id come in the order of their hashes, so repeated rows give
    the same tree whatever their order. A lone leaf is its source's subroot. Texts are
    hashed whole; an empty one differs from NULL. Columns not named are ignored; an
    empty table has no rows and no root.
    """
    rows = docs.select(
        F.col(group_col).alias("source"),
        F.col(id_col).alias("doc_id"),
        leaf([F.col(c) for c in fields]).alias("hash"),
        *[value.alias(name) for name, value in carried.items()],
    )
    order = [F.col("doc_id"), F.col("hash")]
    rows = running(written(rows, "leaves"), ["source"], order, F.lit(1), "pos")
    rows = rows.withColumnRenamed("pos_total", "n").withColumn("leaf", F.col("hash"))
    blocks, upper = _climb(rows, ["source"], levels)

    tree = F.lit(0).alias("tree")
    subroots = upper.where("block = 0").select(tree, "source", F.col("subroot").alias("hash"))
    subroots = running(subroots, ["tree"], [F.col("source")], F.lit(1), "pos")
    sources, last = _climb(subroots.withColumnRenamed("pos_total", "n"), ["tree"], levels)
    tops = _nodes_with_paths(sources, last.withColumnRenamed("subroot", "root"), ["tree"], levels)
    tops = written(tops.select("source", F.col("path").alias("last"), "root"), "roots")

    whole = matched(upper, tops, ["source"]).withColumn("up", F.concat("up", "last")).drop("last")
    found = _nodes_with_paths(blocks, whole, ["source"], levels)
    return found.select("doc_id", "leaf", "path", "subroot", "root", *carried)


def siblings_hash(path: Column) -> Column:
    """Hash of all siblings of a path, level by level, left to right."""
    segments = F.transform(path, lambda s: F.concat(s["left"], s["right"]).cast("string"))
    return F.sha2(F.array_join(segments, ""), 256)


def folded(hash: Column, path: Column) -> Column:
    """The root that a leaf's hash leads to."""
    return F.aggregate(
        path, hash, lambda h, s: F.sha2(F.concat(s["left"], h.cast("binary"), s["right"]), 256)
    )
