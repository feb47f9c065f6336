"""The corpus pipeline over ``documents``: five stages, each with one operator of ``kinweave.llm``.

A stage takes (spark, docs, sf_dir) and gives documents again, the last one token
ids. Every stage works on all rows that the one before it kept. No stage of these
can be put as SQL, so ORACLE_SQL is None and the tests hold the stages against
brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm import bpe, contamination, langid, secrets, simhash, tables

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _begin(spark: SparkSession) -> None:
    """Before each stage: modest batches to Python, and heaps without the garbage of the stage before."""
    tables.modest_batches(spark)
    tables.settle(spark)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no language (null texts, texts without a letter); lang becomes the predicted language."""
    _begin(spark)
    model = langid.train(docs.where(langid.fold() != 1))
    told = docs.select(*COLUMNS, langid.prediction(model, spark)("text").alias("_p"))
    kept = told.where("_p.lang_pred != 'und'")
    return kept.select("doc_id", "text", F.col("_p.lang_pred").alias("lang"), "source", "n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of texts with five-word similarity of 0.8 or more: smallest id, null last, then text hash.

    Classes are of texts, so a shared or null id merges nothing; of rows with the
    same id and text the least by source, language and length stays, nulls first.
    """
    _begin(spark)
    rows = docs.select("doc_id", "source", "lang", "n_chars", "text")
    return simhash.one_of_each_class(rows).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a benchmark item stands; rows with null texts or ids and repeated rows as in drop_contaminated."""
    _begin(spark)
    return contamination.drop_contaminated(docs.select(*COLUMNS), tables.read(spark, sf_dir, "benchmark", "item_id", "text"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in the texts; keeps every document, null and empty texts as they are."""
    _begin(spark)
    return secrets.redact(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of what they decode to; a null text has no ids, every row stays."""
    _begin(spark)
    return bpe.digests(docs, *bpe.public_vocabulary(), ids=True)


STAGES = [
    ("language_id", language),
    ("near_dedup", near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", redact_secrets),
    ("tokenize", tokenize),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = tables.read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
