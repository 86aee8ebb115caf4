"""Registered queries opN_* and their SQL; each is thin and gets its rows through its operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (license_scan, main_text, mixing, near_dup, packing, phrases, quality_rules, repair, suffix_dedup, token_files, vector_dedup,
               warc, wordpiece)
from .common import documents


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known license notices in all documents: a row per document and notice."""
    return license_scan.scan(documents(spark, sf_dir))


def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chosen-path join over 4-word shingles of all documents, 80 per cent or more."""
    return near_dup.link(documents(spark, sf_dir), near_dup.ChosenPath(words=4, threshold_pct=80))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as byte-level BPE ids in Simple-8b files, read back."""
    folder, manifest = token_files.write(documents(spark, sf_dir), token_files.TokenFiles(tokenizer="byte_bpe_50k.json", end_id=0))
    return token_files.read(folder, manifest)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents that 100-byte strings with an earlier start cover."""
    return suffix_dedup.repeat_digests(documents(spark, sf_dir), suffix_dedup.Repeats(length=100))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records, normalised to a member per record, and read back by the index."""
    a = warc.Archive(least=1000)
    folder, rough = warc.write(spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet"), a)
    members = warc.normalise(folder, rough, a, remove=True)
    return warc.read(folder, members).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 150 per cent of their words, sources weighing 5, 2, 1."""
    t = mixing.take(documents(spark, sf_dir), mixing.Mix(weights=(5.0, 2.0, 1.0), budget=1.5, most=2.0))
    return t.select("doc_id", "source", "size", "source_size", "target", "taken")


def op7_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of cosine 0.9 or more linked by sorted projection passes."""
    return vector_dedup.link(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"), vector_dedup.Passes(cosine=0.9))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens; capacities of documents and cost that 4096 tokens imply."""
    p = packing.Packing(tokens=4096, documents=4096, cost=4096.0 ** 2)
    return packing.pack_documents(documents(spark, sf_dir), p, "word_bpe_49k.json", end_id=1)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first cleaning of all documents: counts, base rules and verdict."""
    return quality_rules.judge_documents(documents(spark, sf_dir))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece counts of all documents, words of any length."""
    return wordpiece.token_counts(documents(spark, sf_dir), wordpiece.Vocabulary(max_chars=None))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by a hash of their turns, repaired by weighted interval parsing."""
    whole = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")
    return repair.reports(repair.damage(whole), every=whole)


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages, by the container paths that win their host's vote."""
    return main_text.extract(spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of 2 to 5 words in all documents, by dynamic itemset counting."""
    return phrases.collocations(documents(spark, sf_dir), phrases.Mining(least=100, longest=5, top=2000))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """corpus_pipeline.run: quality rules, near-dedup, repeat removal, mixing, packing."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_license_scan, op2_near_dup, op3_token_files, op4_suffix_dedup, op5_warc, op6_mixing, op7_vector_dedup,
                            op8_packing, op9_quality_rules, op10_token_counts, op11_conversation_repair, op12_main_text, op13_phrases,
                            pipeline)}
ORACLE: dict[str, str] = {"op13_phrases": phrases.SQL}
