"""A corpus from raw documents to packed batches: five operators, one after the other.

Each stage's result is written as Parquet and read again, so a stage works on what the one before kept,
and a lost executor costs no more than the stage under way.

In every stage, nulls may stand in any column, texts are taken whole however long, an empty table gives an
empty table, and further columns are passed on; one named like an output of the stage's operator holds that output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from policy_mart.llm import language, lines, mixture, near_duplicates, packing
from policy_mart.llm._work import Shelf, name

#: Documents whose language is less sure than this are rejected, as are those without a letter.
LEAST_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; learned from the documents' own labels.

    Null texts and texts without a letter are rejected. Rows of equal text are kept or rejected together.
    """
    found = language.identify_languages(docs)
    sure = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return _columns(found.filter(sure), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of templates that recur across documents.

    Documents stay, all of them; `n_chars` is counted again where lines went. Null and empty texts stay as they
    are, rows of equal text lose the same lines, and copies are left whole (see `lines.drop_recurring_lines`).
    """
    found = lines.drop_recurring_lines(docs)
    length = F.when(F.size("dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return _columns(found.withColumn("n_chars", length), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of copies and near copies.

    Null and empty texts are no copies of each other and all stay. Of rows that agree in key and text, one stays.
    """
    return near_duplicates.one_of_each(docs)


def mixture_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    A null source is a source. Null texts have no words and are taken like others; a source without words is
    not taken. Rows that agree in key, size and text stand in any order, so which of them is taken is open.
    """
    return mixture.repeated(mixture.mix_sources(docs), docs.columns)


def pack_lengths(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their length bucket and batch.

    Null and empty texts have length 0 and share the lowest bucket. Rows that agree in key and text, such as the
    copies that the mix took, stand in any order.
    """
    return packing.pack(docs)


def _columns(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(*[name(c) for c in docs.columns])


STAGES = [
    ("language id", language_id),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("mixture", mixture_to_weights),
    ("packing", pack_lengths),
]

#: Trained and signature-based stages cannot be put in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus of `documents`."""
    shelf = Shelf(spark, "corpus")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = shelf.last(stage(spark, docs, sf_dir))
    return docs
