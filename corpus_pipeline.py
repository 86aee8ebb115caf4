"""A corpus pipeline of five stages over ``documents``.

quality rules -> MinHash near-dedup -> suffix-array dedup -> mixing -> packing.
Each stage takes (spark, docs, sf_dir), works on everything its predecessor
kept and returns a DataFrame; all but the last return the columns of
``documents``.  ``run`` writes every stage's result to the shared folder and
hands the reread table on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import mixing, near_dup, packing, quality_rules, suffix_dedup
from tidemark.llm.common import cut, documents, drop


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose the lines that fail."""
    return quality_rules.clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8) stays: the least id."""
    return near_dup.keep_one(docs, near_dup.ChosenPath(words=5, threshold_pct=80))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes or more that stand earlier in the corpus are cut out."""
    return suffix_dedup.remove_repeats(docs, suffix_dedup.Repeats(length=100))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents repeat by whole epochs."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 4096 tokens.

    Workers that four stages ran in hold fewer token ids than packing alone lets them: an executor's memory is shared by all stages.
    """
    return packing.pack_documents(docs, packing.Packing(held=400_000))


STAGES = [("quality rules", quality), ("near-dedup", near_duplicates), ("suffix-array dedup", repeats),
          ("mixing", mix), ("packing", pack)]

#: tokenizer ids and the union of links are beyond SQL; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = documents(spark, sf_dir), None
    for name, stage in STAGES:
        out = cut(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
        drop(last)
        docs = last = out
    return docs
