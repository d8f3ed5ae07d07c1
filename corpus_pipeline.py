"""A corpus pipeline: quality rules, exact and near duplicates, source mix, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each result to the shared
folder and reads it again as the next stage's ``docs``.  All but the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm import byte_bpe, exact_dedup, jaccard_join, mixing, quality
from basketlens.llm.queries import RANK_FILE
from basketlens.sources.session import cut_lineage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, judged against references learnt from ``docs``."""
    judged = quality.judge(docs.select(F.struct("*").alias("row"), "text"), quality.learn(docs))
    return judged.filter("kept").select("row.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text: the one with the smallest id."""
    found = exact_dedup.exact_dedup(docs.select(F.struct("*").alias("row"), "doc_id", "text"))
    return found.filter("kept").select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    found = jaccard_join.near_duplicates(docs.select(F.struct("*").alias("row"), "doc_id", "text"), carry=["row"])
    return found.filter("kept").select("row.*")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_rows(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the bytes they decode to, a row per row of the mix."""
    ranks = byte_bpe.read_ranks(spark, RANK_FILE)
    both = byte_bpe.round_trip(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return both.select("doc_id", *byte_bpe.digests())


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", source_mix),
    ("byte-level BPE encoding and decoding", encoded),
]

#: Jensen-Shannon distances against learnt references, links and merges by rank have no plain SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0])
    return docs
