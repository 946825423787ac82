"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_results(df: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """Results as JSON Lines or Parquet."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "json":
        w.json(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt}")


def write_bad_cases(bad: DataFrame, folder: str, date_col: str = "dt", mode: str = "append") -> None:
    """Bad-case sink: results with any SandboxError case, one folder per date."""
    bad.write.mode(mode).partitionBy(date_col).json(folder)
