"""Repeated runs of lines, cut at content-defined boundaries, without Python.

Every line is hashed. A rolling polynomial over the hashes of a line and those after it
decides whether a chunk begins there, so that nothing in front of a moved passage has a
say in where the passage is cut; a long line is a chunk of its own, wherever it stands.
Chunks of several lines, and long lines, that occur more than once anywhere are removed
but for their first occurrence; occurrences are brought together by their bytes. What is
removed then grows line by line into the chunks beside it, as far as those agree with
what stands beside the first occurrence; a shorter line on its own only goes if it grows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import ship, written

#: Lines that the rolling hash sees, its base and modulus; a chunk has DIVISOR lines on average.
WINDOW, BASE, MODULUS, DIVISOR = 2, 257, 1_000_003, 2
#: Characters from which on a line is a chunk of its own and counts like several lines.
LONG = 200
#: Characters from which on a chunk of one line is looked for elsewhere.
SHORT = 40
_RUNS = "array<struct<start:int,length:int>>"


def _rolling(digests: Column, i: Column, window: int) -> Column:
    value = F.lit(0).cast("bigint")
    for ahead in range(window):
        digest = F.get(digests, (i + ahead).cast("int"))
        line = F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint")
        value = (value * BASE + F.coalesce(line, F.lit(0))) % MODULUS
    return value


def _with_chunks(texts: DataFrame, window: int, divisor: int) -> DataFrame:
    """Adds ``lines``, their ``digests``, and ``chunks``: ``start, length, counts`` from 0."""
    is_long = lambda i: F.length(F.get("lines", i)) >= LONG
    starts = F.filter(
        F.sequence(F.lit(0), F.size("lines") - 1),
        lambda i: (i == 0)
        | is_long(i)
        | is_long(i - 1)
        | (_rolling(F.col("digests"), i, window) % divisor == 0),
    )
    # Columns of their own: inside a lambda they would be made anew for every chunk.
    ends = F.concat(F.array_except("starts", F.array(F.lit(0))), F.array(F.size("lines")))
    chunks = F.zip_with(
        "starts",
        "ends",
        lambda s, e: F.struct(
            s.alias("start"), (e - s).alias("length"), ((e - s > 1) | is_long(s)).alias("counts")
        ),
    )
    return (
        texts.withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n", -1))
        .withColumn("digests", F.transform("lines", F.md5))
        .withColumn("starts", starts)
        .withColumn("ends", ends)
        .withColumn("chunks", chunks)
        .drop("starts", "ends")
    )


def _part(lines: Column, chunk: Column) -> Column:
    return F.slice(lines, chunk["start"] + 1, chunk["length"])


def _agreeing(mine: Column, theirs: Column) -> Column:
    """How many first elements of two arrays are equal one by one."""
    least = F.least(F.size(mine), F.size(theirs))
    differing = F.filter(
        F.sequence(F.lit(0), least), lambda i: (i == least) | (F.get(mine, i) != F.get(theirs, i))
    )
    return F.get(differing, 0)


def remove_repeated_chunks(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    divisor: int = DIVISOR,
) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_chunks, removed, text``.

    ``removed`` lists the removed runs as ``start, length`` in lines from 0, chunk by
    chunk, and ``text`` is what is left, NULL for a NULL text. Of equal chunks of
    several lines, and of equal lines of ``LONG`` characters and more, the one of the
    smallest id stays, and there the first. From a removed chunk, lines of the chunks
    beside it go too while they equal, by MD5, those beside the chunk that stays; chunks
    that are repeated themselves are left to their own verdict. A chunk of one line of
    ``SHORT`` characters and more goes only if a line beside it goes with it, other
    single lines stay. A removed line always has an equal one earlier in the order of ids and
    lines. Empty texts are one empty line. Rows with a NULL id take no part and stay
    whole. Repeated rows carry the same verdict, and so do chunks that begin with the
    same line of different texts of one id. Columns besides the two
    named are ignored; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    # Texts of one id are told apart.
    rows = rows.withColumn("version", F.xxhash64("text"))
    of = ["doc_id", "version"]

    def cut(texts: DataFrame) -> DataFrame:
        return _with_chunks(texts, window, divisor)

    def beside(k: Column, step: int) -> Column:
        found = F.get("chunks", k + step)
        digests = F.coalesce(_part(F.col("digests"), found), F.array().cast("array<string>"))
        return F.reverse(digests) if step < 0 else digests

    def candidates(*wanted: str) -> DataFrame:
        """Chunks to look for elsewhere, with what is wanted of them."""

        def listed(chunk: Column, k: Column) -> Column:
            told = {
                "start": chunk["start"],
                "counts": chunk["counts"],
                "bytes": F.array_join(_part(F.col("lines"), chunk), "\n"),
                "left": beside(k, -1),
                "right": beside(k, 1),
            }
            there = chunk["counts"] | (F.length(F.get("lines", chunk["start"])) >= SHORT)
            return F.when(there, F.struct(*[told[name].alias(name) for name in wanted]))

        found = F.filter(F.transform("chunks", listed), lambda c: c.isNotNull())
        texts = cut(rows.where("doc_id IS NOT NULL"))
        return texts.select(*of, F.explode(found).alias("c")).select(*of, "c.*")

    # Here the bytes themselves are compared; tasks unite their equal chunks first.
    repeated = (
        candidates("bytes")
        .groupBy("bytes")
        .agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc"))
        .where("n > 1")
        .select(F.sha2("bytes", 256).alias("print"), "first_doc")
    )
    repeated = written(repeated, "chunks")
    # Never NULL, so that the join does not test it by hashing once more.
    print_ = F.coalesce(F.sha2("bytes", 256), F.lit("")).alias("print")
    prints = candidates("start", "counts", "bytes", "left", "right")
    prints = prints.select(*of, "start", "counts", print_, "left", "right")
    found = written(prints.join(repeated, "print"), "found")
    firsts = found.where("doc_id = first_doc").groupBy("print")
    firsts = firsts.agg(F.min(F.struct("start", "left", "right")).alias("first"))
    firsts = firsts.select("print", F.col("first.start").alias("first_start"), F.col("first.left").alias("l"), F.col("first.right").alias("r"))
    firsts = written(firsts, "firsts")
    later = (F.col("doc_id") != F.col("first_doc")) | (F.col("start") != F.col("first_start"))
    verdicts = found.join(firsts, "print").select(
        *of,
        "start",
        "counts",
        later.alias("later"),
        F.when(later, _agreeing(F.col("left"), F.col("l"))).otherwise(0).alias("before"),
        F.when(later, _agreeing(F.col("right"), F.col("r"))).otherwise(0).alias("after"),
    )
    gone = F.col("later") & (F.col("counts") | (F.col("before") + F.col("after") > 0))
    # A short line that stays may still go with the passage beside it.
    verdicts = written(verdicts.withColumn("gone", gone).where("gone OR counts"), "verdicts")
    marked = verdicts.groupBy(*of).agg(
        F.map_from_entries(F.collect_set(F.struct("start", F.struct("gone", "before", "after")))).alias("verdicts")
    )

    # Merged at every size, so that the plan tested on little is the one that runs on
    # much; only the text itself is shuffled.
    out = cut(rows.join(marked.hint("merge"), of, "left"))
    verdict = lambda chunk: F.try_element_at(F.col("verdicts"), chunk["start"])
    none = F.lit(0)

    def parts(chunk: Column, k: Column) -> Column:
        """What stays of a chunk, and what goes in front of it and after it."""
        own = verdict(chunk)
        front = F.coalesce(verdict(F.get("chunks", k - 1))["after"], none)
        back = F.coalesce(verdict(F.get("chunks", k + 1))["before"], none)
        front = F.when(own.isNull(), F.least(front, chunk["length"])).when(own["gone"], chunk["length"]).otherwise(none)
        back = F.when(own.isNull(), F.least(back, chunk["length"] - front)).otherwise(none)
        return F.struct(chunk["start"].alias("start"), chunk["length"].alias("length"), front.alias("front"), back.alias("back"))

    def removed(p: Column) -> Column:
        ends = F.struct((p["start"] + p["length"] - p["back"]).alias("start"), p["back"].alias("length"))
        runs = F.array(F.struct(p["start"].alias("start"), p["front"].alias("length")), ends)
        return F.filter(runs, lambda r: r["length"] > 0)

    def kept(p: Column) -> Column:
        return F.slice("lines", p["start"] + p["front"] + 1, p["length"] - p["front"] - p["back"])

    judged = out.withColumn("parts", F.when(F.col("verdicts").isNotNull(), F.transform("chunks", parts)))
    left = F.array_join(F.flatten(F.transform("parts", kept)), "\n")
    gone = F.flatten(F.transform("parts", removed))
    return judged.select(
        "doc_id",
        F.size("lines").alias("n_lines"),
        F.size("chunks").alias("n_chunks"),
        F.coalesce(gone, F.array().cast(_RUNS)).alias("removed"),
        F.when(F.col("text").isNotNull(), F.coalesce(left, F.col("text"))).alias("text"),
    )
