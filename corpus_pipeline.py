"""Corpus pipeline: quality rules, line dedup, near-dedup, decontamination, tokenisation.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. Every
stage but the last returns the columns of ``documents``; each result is written as Parquet
to the shared checkpoint folder and read again as the next stage's input, so a lost executor
never reaches back over a stage. ``n_chars`` is brought up to date where lines are removed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barmarts.llm import bpe, decontaminate, line_dedup, minhash, quality
from barmarts.llm.common import Workspace
from barmarts.llm.queries import RANK_FILE
from barmarts.sources.tables import read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality cascade keeps."""
    judged = quality.quality(docs).select(*docs.columns, "kept")
    # the rows pass through one generator, which the filter is not pushed through: the counts behind
    # ``kept`` are then worked out once a row, not in the filter and the projection
    return judged.select(F.inline(F.array(F.struct("*")))).where("kept").select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines seen earlier; those left without any word go."""
    out = line_dedup.line_dedup(docs)
    left = (F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return out.where(left).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group (five-word shingles, similarity 0.8): the least doc_id."""
    return minhash.near_dedup(docs, width=5, threshold=80).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark")).select(*docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests that check the round trip."""
    ranks = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    ids = bpe.encode(docs.select("doc_id", "lang", "source", "text"), ranks, public_tokenizers.PATTERN).drop("text")
    return bpe.digests(bpe.decode(ids, ranks)).drop("decoded")


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("bpe", bpe_stage),
]

#: Prefix-table BPE and SimHash candidates are not SQL; tests check run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, ws = read_table(spark, sf_dir, "documents"), Workspace(spark, "pipeline")
    for name, stage in STAGES:
        docs = ws.store(stage(spark, docs, sf_dir), name)
    return docs
