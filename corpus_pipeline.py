"""Corpus pipeline: quality rules, near-duplicates, benchmark passages, source mix, packed token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's docs. All but the last return the columns of ``documents``. As a stage's
output is written by then, the next one first drops the intermediate tables that the stage left.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carelake.llm import base, decontaminate, mixing, near_dedup, packing, quality

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the base rules and the likelihood ratio keep."""
    return quality.keep_good(docs, base.table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies."""
    return near_dedup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that aren't contaminated, without their benchmark passages."""
    return decontaminate.clean(docs, base.table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as its source's target takes it, in order of virtual finish time."""
    return mixing.mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids."""
    return packing.pack(docs)


#: Intermediate tables of the stage that ran last.
_left: list[str] = []


def sweeping(stage: Stage) -> Stage:
    """The stage, dropping first what the one before left."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        base.drop_stashes(spark, _left)
        before = set(base.stashes())
        out = stage(spark, docs, sf_dir)
        _left[:] = [p for p in base.stashes() if p not in before]
        return out

    return run_stage


STAGES = [(name, sweeping(stage)) for name, stage in (
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_output", token_output),
)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    out = base.table(spark, sf_dir, "documents")
    written: list[str] = []
    for name, stage in STAGES:
        new = stage(spark, out, sf_dir)
        before = set(base.stashes())
        out = base.stash(new, f"stage-{name}")
        base.drop_stashes(spark, written)  # the stage before has been read
        written = [p for p in base.stashes() if p not in before]
    base.drop_stashes(spark, _left)
    _left.clear()
    return out


#: The likelihood ratio, the signatures and the packing have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None
