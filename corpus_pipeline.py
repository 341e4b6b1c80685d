"""The corpus pipeline: from raw documents to packed training sequences.

Each stage is a function of (spark, docs, sf_dir) over all that its predecessor kept; its result is written as Parquet
and read again. All but the last keep the columns of documents, and further columns of any name. Texts are read whole,
however long, and an empty table goes through every stage.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frostline.llm import best_fit, cube_mixing, jaccard_join, language_id, line_templates
from frostline.llm.common import drop_tables, noted_tables, stored

#: Working tables of the stages that another one follows.
_made: dict[int, list[str]] = {}


def _stage(place: int) -> Callable:
    """A stage at its place in the pipeline. The result of the one before has been written by the time it begins, so the
    working tables of that one go."""

    def placed(function: Callable) -> Callable:
        @wraps(function)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            drop_tables(spark, _made.pop(place - 1, []), docs)
            with noted_tables() as made:
                out = function(spark, docs, sf_dir)
            _made[place] = made
            return out

        return run_stage

    return placed


@_stage(0)
def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with enough certainty; null and letterless texts go, repeated rows stay."""
    return language_id.accepted(docs)


@_stage(1)
def without_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document has too; those left without a word go.

    n_chars follows the text. Rows with one id are one document; rows without id are told by their text.
    """
    shorter = line_templates.without_templates(docs).filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return shorter.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@_stage(2)
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 or more of five-word shingles: the smallest id.

    Repeated rows are copies too; texts without a word are linked with nothing, and stay.
    """
    return jaccard_join.one_of_each(docs)


@_stage(3)
def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them. A null source is a source; null texts have no words."""
    return cube_mixing.mixed(docs)


@_stage(4)
def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document's pieces in sequences of 1024 tokens. A null or empty text is one piece of one token."""
    return best_fit.pack_documents(docs)


STAGES = [
    ("language ID", known_languages),
    ("line dedup", without_recurring_lines),
    ("n-gram Jaccard join", without_near_copies),
    ("mixing", mixed_sources),
    ("packing", packed_sequences),
]

#: A trained classifier decides what the first stage keeps, which SQL cannot express; tests compare each stage with
#: plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"stage{i}")
    return docs
