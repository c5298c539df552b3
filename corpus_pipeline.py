"""The corpus pipeline: five operators in turn, each on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlegraph.llm import bpe, decontaminate, language_id, line_dedup, ngram_join
from titlegraph.llm.common import cut, drop, with_settings
from titlegraph.llm.queries import table, tokenizer_path

#: Rows of a batch between Spark and Python, for the memory of executors and workers; results do not depend on it.
ROWS = 1_000
#: doc_ids of 8 bytes up to which a table of them is broadcast; a larger one is joined by shuffle.
BROADCAST_IDS = 2_000_000


def _same_columns(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs; n_chars follows the text."""
    return kept.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents and drops those without a language: null text, no letter, or, in a text long
    enough to tell, n-grams that fit no learned language. Without any labelled document all that have a letter stay."""
    filters = language_id.learn(docs.select("text", "lang"))
    if not filters.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language_id.identify(docs, filters, names=("__lang_pred", "__score", "__fits"))
    return found.where("__fits").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated passages of three lines, or of 51 words at any place; a document of which nothing but white space is left goes."""
    return _same_columns(line_dedup.dedup_lines(docs, passage=line_dedup.PASSAGE).where(F.col("text").rlike(r"\S")), docs)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near duplicates the document with the smallest id, and one row of those that repeat its id and text.

    Rows with a null doc_id are in no group and all stay.
    """
    groups = ngram_join.near_duplicates(docs)
    keep = cut(groups.where("doc_id = component_id").groupBy(F.col("doc_id").alias("__keep")).agg(F.count(F.lit(1)).alias("n")), "keep")
    once, more = keep.where("n = 1"), keep.where("n > 1")
    once, more = (F.broadcast(x) if x.count() <= BROADCAST_IDS else x for x in (once.select("__keep"), more.select("__keep")))
    same = F.col("doc_id") == F.col("__keep")
    repeated = docs.join(more, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return docs.join(once, same, "left_semi").unionByName(repeated).unionByName(docs.where("doc_id is null"))


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes benchmark passages; a document of which nothing but white space is left goes."""
    cleaned = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _same_columns(cleaned.where(F.col("text").rlike(r"\S")), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every document."""
    return bpe.bpe_encode(docs, tokenizer_path(), bpe.build_lexicon(docs, tokenizer_path()))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _small_batches(stage: Stage) -> Stage:
    """The stage in a session of its own, with at most ROWS texts at a time on their way to Python."""

    @wraps(stage)
    def limited(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        docs = with_settings(docs, spark__sql__execution__arrow__maxRecordsPerBatch=ROWS)
        return stage(docs.sparkSession, docs, sf_dir)

    return limited


STAGES: list[tuple[str, Stage]] = [
    (name, _small_batches(stage))
    for name, stage in (
        ("language_id", identify_language),
        ("line_dedup", dedup_lines),
        ("ngram_join", join_near_duplicates),
        ("decontaminate", decontaminate_documents),
        ("bpe", encode),
    )
]

#: Language ID learns its filters; SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, each result written to the shared folder; the one before it is deleted then.

    Rows may have any other columns, whatever their names: each stage but the last hands them on as they are. Repeated
    doc_ids of different texts are different documents until ngram_join, which keeps the rows of the ids that it keeps.
    Null texts go at language_id; rows with a null doc_id take no part in line_dedup and ngram_join and stay. An empty
    table gives none.
    """
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}", spark)
        if last is not None:
            drop(spark, last)
        last = docs
    return docs
