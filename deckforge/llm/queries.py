"""Registered queries: each applies one operator to the whole of its table and derives digests."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat, collocations, decontaminate, edits, fingerprints, language, licenses, manifest, mixing, neardup,
               repetition, urlfilter)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = "quality"
    return repetition.quality_rules(_documents(spark, sf_dir)).select("doc_id", *[F.col(f"{q}.{c}") for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "long_repeat",
        "base_failed", "kept")])


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = language.identify(_documents(spark, sf_dir))
    return docs.select("doc_id", language.held_out().alias("held_out"), F.col("language.lang").alias("lang_pred"),
                       F.col("language.score").alias("score"), F.size("language.spans").alias("n_spans"))


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(_documents(spark, sf_dir))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_documents(spark, sf_dir))


def edited_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three edits of every document: words put in at its middle, 16 characters taken out at a quarter,
    8 characters at three quarters replaced by its first 24."""
    n = F.char_length("text").cast("bigint")
    edit = lambda seq, start, length, new: F.struct(
        F.lit(seq).cast("bigint").alias("seq"), F.floor(start).cast("bigint").alias("start"),
        F.lit(length).cast("bigint").alias("length"), new.alias("replacement"))
    docs = _documents(spark, sf_dir).select("doc_id", "text", F.array(
        edit(1, n / 2, 0, F.lit(" newly revised ")), edit(2, n / 4, 16, F.lit("")),
        edit(3, n * 3 / 4, 8, F.substring("text", 1, 24))).alias("edits"))
    c = edits.count_edited(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return c.select("doc_id", *[F.col(f"counts.{x}") for x in ("n_tokens", "n_edited_tokens", "n_edited_chars",
                                                              "n_reencoded")],
                    F.sha2(F.col("counts.text").cast("binary"), 256).alias("edited_sha256"))


def _hex(text: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), start, digits), 16, 10).cast("int")


def list_changes(pages: DataFrame) -> DataFrame:
    """Dated list changes for about half of the pages' hosts and of their parent domains: up to four
    each, on days of 2020 to 2023 that follow from the name."""
    hosts = pages.select(urlfilter.host_of(F.col("url")).alias("h")).distinct()
    names = hosts.select(F.explode(F.slice(urlfilter.domains(F.col("h")), 1, 2)).alias("host")).distinct()
    host = F.col("host")
    change = lambda j: F.struct(
        F.when(_hex(host, 25 + j, 1) < 12, "block").otherwise("allow").alias("list"),
        F.when(_hex(host, 20 + j, 1) < 9, "add").otherwise("remove").alias("action"),
        F.date_add(F.lit("2020-01-01").cast("date"), _hex(host, 1 + 4 * j, 4) % 1461).alias("at"))
    return names.where(_hex(host, 30, 1) < 8).select("host", F.inline(F.array(*[change(j) for j in range(4)])))


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a capture fetched on a day that follows from its id."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    captures = pages.withColumn("fetched", F.date_add(F.lit("2020-01-01").cast("date"),
                                                      (F.pmod(F.col("page_id") * 7919, F.lit(1461))).cast("int")))
    return urlfilter.judge(captures, list_changes(pages)).select("page_id", "fetched", "verdict.*")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a file of a tree of directories that follows from its source and id."""
    step = F.expr("doc_id div 20")
    name = F.when(step % 3 == 0, F.lit("LICENSE")).otherwise(F.concat(F.lit("f"), F.col("doc_id"), F.lit(".txt")))
    inner = F.concat_ws("/", F.concat(F.lit("a"), step % 7), F.concat(F.lit("b"), F.expr("doc_id div 2000")))
    path = F.concat_ws("/", F.col("source"), F.when(step % 11 != 0, inner), name)
    files = _documents(spark, sf_dir).select("doc_id", "text", path.alias("path"))
    return licenses.scan(files).select("doc_id", "path", "license.*")


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = chat.format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return chats.select("conv_id", "n_turns", "n_equal", F.char_length("rendered").cast("bigint").alias("n_chars"),
                        F.sha2(F.col("rendered").cast("binary"), 256).alias("rendered_sha256"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bpe.encode_and_decode(_documents(spark, sf_dir).select("doc_id", "text"),
                                 public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return docs.select(
        "doc_id", F.size("bpe.ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("bpe.ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bpe.decoded", 256).alias("decoded_sha256"))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_documents(spark, sf_dir))


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = decontaminate.scan(_documents(spark, sf_dir).select("doc_id", "text"),
                                 spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    found = F.col("benchmark")
    return scanned.select("doc_id", found.n_words.alias("n_words"), found.n_hit.alias("n_hit"),
                          F.size(found["items"]).cast("bigint").alias("n_items"),
                          F.sha2(F.array_join(found["items"], ","), 256).alias("items_sha256"),
                          decontaminate.contaminated().alias("contaminated"))


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest, and for every row the root that its leaf leads to after line ends are taken out of the
    texts of every other id (by checksum)."""
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0,
                      manifest.leaf(text=F.translate("text", "\n", "")))
    made = manifest.manifest(_documents(spark, sf_dir), tampered)
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s.left, s.right)), "")
    folded = made.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
                         manifest.fold(F.coalesce("other", "leaf"), F.col("proof")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": quality_rules,
    "op2_language_id": language_id,
    "op3_document_fingerprints": document_fingerprints,
    "op4_near_duplicates": near_duplicates,
    "op5_edited_token_counts": edited_token_counts,
    "op6_url_filter": url_filter,
    "op7_license_scan": license_scan,
    "op8_byte_bpe": byte_bpe,
    "op9_chat_format": chat_format,
    "op10_source_mix": source_mix,
    "op11_phrase_collocations": phrase_collocations,
    "op12_benchmark_decontamination": benchmark_decontamination,
    "op13_merkle_manifest": merkle_manifest,
    "pipeline": pipeline,
}
