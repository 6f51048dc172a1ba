"""A training corpus from ``documents`` in five stages, each written and read again.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; all but the last return the columns of
``documents``. ``run`` applies them in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm import curriculum, decontaminate, jaccard, line_dedup, toxicity
from shelfline.llm.common import stage_table, table


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half. Null and empty texts stay, repeated rows stay or go together."""
    costs, marks = toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.remove_toxic(docs, costs, marks)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without lines that stand in five or more; ``n_chars`` follows the text.

    A document that loses nothing keeps its text as it is, null included. Rows without an id lose lines and count for none.
    """
    return line_dedup.without_repeated(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity of 0.8 or more): its smallest doc_id."""
    return jaccard.one_of_each(docs, width=5, percent=80)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs; null and empty texts have none."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: doc_id, source, size, copies, words taken and training position of every document that is taken.

    Null and empty texts have no words and are not taken; repeated rows are documents next to each other.
    """
    mixed = curriculum.mix(docs.select("doc_id", "text", "source"))
    return mixed.where("taken > 0").select("doc_id", "source", "size", "source_size", "target", "copies", "taken", "position").orderBy("position")


STAGES = [
    ("toxicity", remove_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", keep_one_of_near_copies),
    ("decontamination", remove_contaminated),
    ("mixing", mix_sources),
]

#: Character-model decoding and similarity components have no plain SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
