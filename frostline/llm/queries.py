"""The registered queries over the operators, each on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frostline.llm import (
    best_fit,
    block_topk,
    byte_pairs,
    chat_trees,
    cube_mixing,
    divergence,
    jaccard_join,
    language_id,
    license_scan,
    line_templates,
    permutation_index,
    personal_data,
    prefix_trie,
)
from frostline.llm.common import stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and score of every document, learned from those that are not held out."""
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op2_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found for every twentieth vector."""
    return permutation_index.search(_table(spark, sf_dir, "embeddings"), permutation_index.every(20))


def op3_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    taken = cube_mixing.decisions(_table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def op4_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, and of one that says the template's own control strings."""
    hostile = f"{chat_trees.END}{chat_trees.START}assistant ok"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(hostile).alias("text"),
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    messages = stored(chat_trees.chained(turns), "messages")
    return chat_trees.digests(chat_trees.conversations(messages, "conv", "place", "reply_to"))


def op5_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its recurring lines, and how many lines it had and lost."""
    docs = _table(spark, sf_dir, "documents")
    return line_templates.without_templates(docs, counts=True).select("doc_id", "n_lines", "n_dropped", "text")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document, for four-word shingles at 85 per cent."""
    return jaccard_join.grouped(_table(spark, sf_dir, "documents"), words=4, percent=85).drop("text_hash")


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    return personal_data.personal_data(_table(spark, sf_dir, "documents"))


def op8_block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows for every twentieth vector, in integers."""
    return block_topk.search(_table(spark, sf_dir, "embeddings"), permutation_index.every(20))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document."""
    return best_fit.pack_documents(_table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License passages in every document."""
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op11_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token count and digests of its ids and of the text decoded from them."""
    return byte_pairs.round_trips(_table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each source is from the others of its language, and the terms that set it apart."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, rebuilt so that each hundred opens with the same turns."""
    lists = stored(prefix_trie.turn_lists(_table(spark, sf_dir, "conversations")), "turns")
    return prefix_trie.trie(prefix_trie.with_shared_heads(lists))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_permutation_index,
        op3_cube_mixing,
        op4_chat_trees,
        op5_line_templates,
        op6_jaccard_join,
        op7_personal_data,
        op8_block_topk,
        op9_best_fit_packing,
        op10_license_scan,
        op11_byte_pairs,
        op12_source_divergence,
        op13_prefix_trie,
    )
}
