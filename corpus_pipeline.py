"""The corpus pipeline: documents in, packed training sequences out. Each stage is written and read again before the next.

All stages but the last return the columns of documents, whatever others there are beside id and text. Defined results: texts that
are NULL, empty or too short go in the first stage; repeated rows are copies, of which near deduplication keeps one, whatever ids
are repeated or missing; a document that loses all its text to passage deduplication stays as an empty one; without
labels or languages the first two stages keep what the counted rules keep. An empty table passes through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillhouse.llm import language, near_duplicates, packing, quality, repeats
from tillhouse.llm.common import prepare, stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the line field keep; the field is fitted on labelled documents among them."""
    prepare(spark)
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def language_identification(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near a centroid of some language; the centroids are fitted on those that have a language."""
    prepare(spark)
    return language.keep_known(docs, language.train(docs.select("doc_id", "text", "lang")))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, a similarity of 0.8 or more."""
    prepare(spark)
    return near_duplicates.keep_one(docs)


def passage_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what is covered by a 250-byte string that starts elsewhere, too; n_chars is counted again."""
    prepare(spark)
    return repeats.strip(docs, repeats.PASSAGE)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences of 1024 tokens."""
    prepare(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("language_identification", language_identification),
    ("near_deduplication", near_deduplication),
    ("passage_deduplication", passage_deduplication),
    ("sequence_packing", sequence_packing),
]

#: The line field, the centroids and the packing are not SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between stages the rows are a Parquet table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = stored(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
