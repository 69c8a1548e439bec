"""A training-data pipeline: quality rules, language ID, near-dedup, source mix, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet in the
shared folder and read again as the next one's docs. All but the last return the columns of
``documents``: rejected documents are gone, taken documents occur as often as they are taken.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deckforge.llm import bpe, language, mixing, neardup, repetition
from deckforge.llm.common import fresh_name
from deckforge.session import materialize

#: The least share of a text's words that must have a letter to be in a language at all.
MIN_LETTERED = 0.4
DEDUP_SHINGLE_WORDS = 5
DEDUP_PERCENT = 80
VOCABULARY = "byte_bpe_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base and repetition rules."""
    name = fresh_name(docs, "_quality")
    return repetition.quality_rules(docs, out_col=name).where(F.col(name).kept).drop(name)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language, be they mixed or in a script that no labelled document has; those without
    letters, or with few words that have any, go. Where no document is labelled there is nothing to judge by,
    and all stay."""
    name, held = fresh_name(docs, "_language"), fresh_name(docs, "_held_out")
    tagged = docs.withColumn(held, language.held_out())
    model = language.fit(tagged, ~F.col(held) & F.col("doc_id").isNotNull())
    if model is None:
        return docs
    found = F.col(name)
    return language.label(docs, model, out_col=name).where(
        (found.lang != language.UNDETERMINED) & (found.lettered >= MIN_LETTERED)).drop(name)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies."""
    return neardup.deduplicated(docs, width=DEDUP_SHINGLE_WORDS, percent=DEDUP_PERCENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, their number, and whether they decode to the text."""
    encoded = bpe.encode_and_decode(docs.select("doc_id", "lang", "source", "text"),
                                    public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    same = F.col("bpe.decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return encoded.select("doc_id", "lang", "source", F.size("bpe.ids").cast("bigint").alias("n_tokens"),
                          F.col("bpe.ids").alias("ids"), same.alias("round_trip"))


STAGES = [("quality rules", quality), ("language ID", languages), ("near-dedup", near_dedup), ("source mix", mix),
          ("byte-level BPE", tokens)]

#: Viterbi labels, exponential tilting and merges by rank are beyond SQL; tests hold run() against
#: a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
