"""The queries of this subpackage: ``name -> fn(spark, sf_dir)``, and DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gavel.llm import (decontamination, filter_audit, license_scan, line_dedup, near_dedup, packing, prefix_trie, pseudonyms, quality_rules, sharding,
                       suffix_dedup, token_counts, toxicity)
from gavel.llm.common import documents

QueryFn = Callable[[SparkSession, str], DataFrame]


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.query(documents(spark, sf_dir))


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.query(documents(spark, sf_dir))


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.query(documents(spark, sf_dir))


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.query(documents(spark, sf_dir))


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.query(documents(spark, sf_dir))


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.query(documents(spark, sf_dir))


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.query(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.query(documents(spark, sf_dir))


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.query(documents(spark, sf_dir))


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.query(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.query(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.query(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.query(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES: dict[str, QueryFn] = {
    "op1_line_dedup": _op1,
    "op2_near_dedup": _op2,
    "op3_sharding": _op3,
    "op4_suffix_dedup": _op4,
    "op5_token_counts": _op5,
    "op6_license_scan": _op6,
    "op7_quality_rules": _op7,
    "op8_packing": _op8,
    "op9_pseudonyms": _op9,
    "op10_decontamination": _op10,
    "op11_prefix_trie": _op11,
    "op12_filter_audit": _op12,
    "op13_toxicity": _op13,
}

ORACLE: dict[str, str] = {
    "op1_line_dedup": line_dedup.SQL,
    "op6_license_scan": license_scan.SQL,
    "op10_decontamination": decontamination.SQL,
    "op11_prefix_trie": prefix_trie.SQL,
    "op12_filter_audit": filter_audit.SQL,
}
