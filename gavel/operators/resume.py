"""Resumable results (C4, C5): batches of samples committed once each, and the latest sample of every id.

A batch is written to a folder of its own and then entered in the store's log;
only then does it count.  A job that dies between the two leaves a folder that
nothing reads, and its rerun writes another one; a batch id that the log has is
not applied again.  So a rerun repeats no committed batch and loses none.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavel.operators.tables import pending

_LOG = "batch string, seq long, path string"


class ResultStore:
    """Committed batches of (id, sample) below one folder of a shared file system; opened again by its folder."""

    def __init__(self, spark: SparkSession, folder: str, key: str = "id", sample_col: str = "sample"):
        self.spark, self.folder, self.key, self.sample_col = spark, folder.rstrip("/"), key, sample_col
        self.log = f"{self.folder}/log"
        path = spark._jvm.org.apache.hadoop.fs.Path(self.log)
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            self._enter([])

    def _enter(self, entries: list[tuple]) -> None:
        self.spark.createDataFrame(entries, _LOG).coalesce(1).write.mode("append").parquet(self.log)

    def committed(self) -> dict[str, tuple[int, str]]:
        """Sequence number and folder of each batch (one row each); of a batch that was entered twice the first."""
        rows = self.spark.read.schema(_LOG).parquet(self.log).groupBy("batch").agg(F.min(F.struct("seq", "path")).alias("at"))
        return {r["batch"]: (r["at"]["seq"], r["at"]["path"]) for r in rows.collect()}

    def commit(self, batch: str, rows: DataFrame) -> bool:
        """Write and enter a batch; False if it was committed before."""
        known = self.committed()
        if batch in known:
            return False
        path = f"{self.folder}/batches/{uuid.uuid4().hex}"
        rows.select(self.key, self.sample_col).write.parquet(path)
        self._enter([(batch, 1 + max((seq for seq, _ in known.values()), default=0), path)])
        return True

    def latest(self) -> DataFrame | None:
        """The last committed sample that isn't empty of every id, as a partial aggregate; None without batches."""
        out = None
        for seq, path in sorted(self.committed().values()):
            rows = self.spark.read.parquet(path).select(self.key, self.sample_col, F.lit(seq).alias("seq"))
            out = rows if out is None else out.unionByName(rows)
        return out and (out.where(F.size(self.sample_col) > 0).groupBy(self.key)
                        .agg(F.max_by(self.sample_col, "seq").alias(self.sample_col)))

    def pending(self, problems: DataFrame) -> DataFrame:
        """The problems without a sample."""
        done = self.latest()
        return problems if done is None else pending(problems, done, self.key)

    def results(self, problems: DataFrame) -> DataFrame:
        """Every problem's id with its sample; an empty list where there is none."""
        done, none = self.latest(), F.array().cast("array<string>")
        if done is None:
            return problems.select(self.key, none.alias(self.sample_col))
        return problems.select(self.key).join(done, self.key, "left").select(self.key, F.coalesce(self.sample_col, none).alias(self.sample_col))
