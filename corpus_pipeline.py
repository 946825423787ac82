"""Corpus pipeline: five filtering and packing stages over ``documents``, each written as Parquet and read again.

Quality rules drop what they reject, line dedup cuts lines, near-dedup keeps
one document of each class, decontamination drops contaminated documents, and
packing turns what is left into pieces of sequences.  Each stage works on all
that its predecessor kept; the cases of nulls, ties and empty tables are those
of the operators.  A stage is called with its predecessor's output as it was
written and read again, so it begins by clearing the predecessor's scratch
tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gavel.llm import decontamination, line_dedup, near_dedup, packing, quality_rules
from gavel.llm.common import Scratch, documents
from gavel.sources.scratch import noted


def _quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.stage(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.stage(docs)


def _near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.stage(docs)


def _decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.stage(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.stage(docs)


_scratch: list[Scratch] = []  # of the stage before, whose output has been written


def _clearing(stage, first: bool = False, last: bool = False):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _scratch and not first:
            _scratch.pop().clear()
        _scratch.clear()
        with noted() as made:
            out = stage(spark, docs, sf_dir)
        if not last:
            _scratch.extend(made)
        return out
    return run


STAGES = [
    ("quality_rules", _clearing(_quality_rules, first=True)),
    ("line_dedup", _clearing(_line_dedup)),
    ("near_dedup", _clearing(_near_dedup)),
    ("decontamination", _clearing(_decontamination)),
    ("packing", _clearing(_packing, last=True)),
]

#: SQL can't express the trained trees, so the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; all stages before it are written to the shared scratch folder, and cleared once the next is written."""
    scratch, docs, before = Scratch(spark, "pipeline"), documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        if before:
            scratch.clear(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
