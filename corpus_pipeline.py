"""A corpus made ready for training: language, toxicity, copies, near copies, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import exact_dedup, langid, near_dedup, packing, toxicity
from tidemart.llm.common import table, written
from tidemart.llm.queries import vocabulary

#: Language identification and the toxicity models are not SQL; tests hold the
#: stages against brute force instead.
ORACLE_SQL = None

#: Identifies a row where its ``doc_id`` does not.
ROW = "__row"


def _told_apart(docs: DataFrame) -> DataFrame:
    """The documents with ``__row``: their id, or a new one where it repeats or is NULL."""
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    odd = written(ids.where("n > 1 OR doc_id IS NULL").select("doc_id"), "odd-ids")
    if odd.isEmpty():
        return docs.withColumn(ROW, F.col("doc_id"))
    own = docs["doc_id"].eqNullSafe(odd["doc_id"])
    # Numbered in a copy, so that every reading finds the same numbers.
    rows = written(docs.join(odd, own, "left_semi").withColumn(ROW, F.monotonically_increasing_id()), "odd-rows")
    first = docs.agg(F.coalesce(F.max("doc_id"), F.lit(0))).first()[0] + 1
    rows = rows.withColumn(ROW, F.col(ROW) + F.lit(first))
    return docs.join(odd, own, "left_anti").withColumn(ROW, F.col("doc_id")).unionByName(rows)


def _without(rows: DataFrame, verdict: DataFrame) -> DataFrame:
    """The rows but those that the verdict, which names them by ``__row``, drops."""
    dropped = verdict.where("NOT kept").select(F.col("doc_id").alias(ROW))
    return rows.join(dropped, ROW, "left_anti").drop(ROW)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model accepts.

    Texts that are NULL, empty or without letters are rejected; long ones are read
    whole. Every row is judged on its own, so repeated rows stay or go together. An
    empty table stays empty.
    """
    model = langid.fit(docs)
    judged = docs.withColumn("__verdict", langid.verdict(docs, model, F.col("text")))
    return judged.where("NOT __verdict.rejected").select(*docs.columns)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models do not predict toxic.

    NULL and wordless texts get the score of no evidence, which keeps them unless most
    labelled documents are toxic. Texts are read whole and rows judged one by one.
    Without labels all score alike; an empty table stays empty.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    judged = docs.withColumn("__score", toxicity.score(docs, model, F.col("text")))
    return judged.where(F.col("__score") < toxicity.THRESHOLD).select(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal but for white space.

    The longest text stays, then the smallest id; rows that repeat an id, and those
    without one, come last. NULL, empty and blank texts are one group. Whole texts are
    compared. An empty table stays empty.
    """
    rows = _told_apart(docs)
    return _without(rows, exact_dedup.exact_duplicates(rows, id_col=ROW))


def dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates: five words, 0.8 and more.

    The smallest id stays; rows that repeat an id, and those without one, come last.
    Texts without words, NULL and empty ones too, are linked with nothing and stay.
    Whole texts are compared. An empty table stays empty.
    """
    rows = _told_apart(docs)
    return _without(rows, near_dedup.near_duplicates(rows, id_col=ROW, shingle=5, percent=80))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in sequences of 2048 tokens.

    A NULL or empty text is one piece of its end token; longer texts than a sequence
    are cut into several. Every row is packed, repeated ones too. An empty table gives
    no pieces.
    """
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("language identification", language),
    ("toxicity", clean),
    ("exact dedup", distinct),
    ("near dedup", dissimilar),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
