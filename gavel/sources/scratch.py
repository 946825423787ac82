"""Tables in the shared scratch folder: lineage is cut by writing, and any executor can read them again."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from gavel.session import ensure_checkpoint_dir


_NOTED: list[list[Scratch]] = []


@contextmanager
def noted() -> Iterator[list[Scratch]]:
    """The scratch folders made inside, so that they can be cleared once what reads them has been written."""
    _NOTED.append([])
    try:
        yield _NOTED[-1]
    finally:
        _NOTED.pop()


class Scratch:
    """Tables written below one fresh path of the shared checkpoint folder."""

    def __init__(self, spark: SparkSession, what: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/gavel-{what}-{uuid.uuid4().hex}"
        for made in _NOTED:
            made.append(self)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and read it back."""
        path = f"{self.root}/{name}"
        df.write.mode("error").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self, name: str = "") -> None:
        """Delete one table, or all: for tables that no result still reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
