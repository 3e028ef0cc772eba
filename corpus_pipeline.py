"""From raw documents to packed token ids: the llm operators as stages, each on all that the one before kept.

Each stage is written and read again, so that a lost executor costs one stage's tasks at most. There is
no SQL for the rows: the fertility bands, the latent search, the drawing of copies and the encoding are
beyond it. ``tests/llm/test_pipeline.py`` holds the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from visitlens.llm import decontamination, fertility, mixing, neardup, packing
from visitlens.llm.common import saved, table

NEAR_PERCENT = 80
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fertility band of their language."""
    return fertility.clean_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return neardup.without_near_duplicates(docs, NEAR_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontamination.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids."""
    return packing.packed_documents(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix),
          ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
