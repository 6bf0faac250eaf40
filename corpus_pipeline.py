"""The corpus pipeline: documents in, a weighted mix of clean and distinct documents out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hockeylake.llm.common import intermediates, keep, stash
from hockeylake.llm.decontaminate import drop_contaminated
from hockeylake.llm.exact_dedup import drop_exact_duplicates
from hockeylake.llm.language_id import drop_unidentified, train_language_model
from hockeylake.llm.mixing import draw_mix
from hockeylake.llm.ngram_join import drop_near_duplicates


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language is not recognised, go; the model is fitted on all other rows' own languages.

    Null texts go; null ids and repeated rows are rows like others; an empty table, or one without a known language, gives an empty result.
    """
    return drop_unidentified(docs, train_language_model(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays.

    Rows of that id that repeat stay all, and so do rows with null id; null texts are equal to empty ones; an empty table gives an empty result.
    """
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents with similar sets of word 5-grams the smallest id stays.

    Documents without a word, rows with null id and rows that repeat the smallest id stay; an empty table gives an empty result.
    """
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, word for word in any letter case or with other values, go.

    Null and empty texts and rows with null id stay; rows that share an id go together; an empty table or benchmark changes nothing.
    """
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), any_case=True)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target takes it, with the output shard and the place in it.

    Documents that the mix takes no copy of are not in it. A null source is a source; null ids, null texts and repeated rows are drawn like others; an empty table gives an empty mix.
    """
    return draw_mix(docs)


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("near-duplicate join", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: SQL can't express the training of the language model in the first stage, nor keyed draws in the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again; what is between goes at the end. Edge cases are those of the stages, one after the other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with intermediates(spark):
        for name, stage in STAGES[:-1]:
            docs = stash(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        return keep(STAGES[-1][1](spark, docs, sf_dir), "mix")
