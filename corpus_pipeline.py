"""A corpus pipeline of five stages, each one operator over all its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.llm.common import drop_tables, read_table, unclashed, working_tables, written
from tallywright.llm.line_dedup import line_dedup
from tallywright.llm.mixing import domain_of, mix
from tallywright.llm.ngram_join import ngram_jaccard_join
from tallywright.llm.packing import pack
from tallywright.llm.quality_rules import quality_rules

#: Token shares by domain.  Documents that are most likely good stay; the others get the rate,
#: below one or above, that brings their domains to these shares.
TARGETS = {"good": 0.90, "low": 0.05, "toxic": 0.05}


def _boxed(docs: DataFrame, *names: str) -> DataFrame:
    """Whole rows as ``_doc`` beside the columns a stage reads, so that no result's name meets one of theirs."""
    return docs.select(F.struct(*docs.columns).alias("_doc"), *names)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and resemble their language."""
    return quality_rules(_boxed(docs, "text", "lang"), keep=("_doc",)).where("kept").select("_doc.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that a tenth of their source's documents hold."""
    return line_dedup(docs).select(*docs.columns).withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies (five words, 0.8)."""
    columns = tuple(docs.columns)
    joined = ngram_jaccard_join(docs, carry=columns)
    return joined.where(unclashed(columns, "kept")).select(*columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that expected tokens by domain match the targets."""
    labels = domain_of(read_table(spark, sf_dir, "labels"))
    rated = mix(_boxed(docs, "doc_id", "text"), labels, TARGETS, whole=("good",), carry=("_doc",))
    return rated.select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_doc.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return pack(docs, tokenizer=public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("mixing", mixture),
    ("packing", packed),
]

#: The divergence, the trained classifier and the tokenizer are beyond SQL; tests hold each
#: stage against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it.

    A stage's working tables go once its own result is written, and no others: the last
    stage's are read by the frame returned.
    """
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with working_tables() as made:
            result = stage(spark, docs, sf_dir)
        docs = written(result, f"pipeline-{name}")
        drop_tables(spark, made)
    return STAGES[-1][1](spark, docs, sf_dir)
