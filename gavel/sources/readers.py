"""Sources.  Always an explicit schema; nothing inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Text-column candidates tried in order when none is named.
TEXT_FIELD_CANDIDATES = ["problem", "prompt", "description", "statement", "question", "text", "content"]


def _list_files(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    """File names in a folder through the Hadoop FileSystem (works for any cluster store)."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(st.getPath().getName() for st in fs.listStatus(path) if st.getPath().getName().endswith(suffix))


def read_problem_tables(spark: SparkSession, folder: str, schemas: dict[str, StructType]) -> dict[str, DataFrame]:
    """Every ``*.jsonl`` in a folder becomes a table named after the file (A1).

    A file without a schema is an error, as columns it doesn't name would be lost.
    Columns declared as strings receive nested JSON values as JSON text.
    """
    out = {}
    for name in _list_files(spark, folder, ".jsonl"):
        table = name[: -len(".jsonl")]
        if table not in schemas:
            raise ValueError(f"no schema for table {table}")
        out[table] = spark.read.schema(schemas[table]).json(f"{folder}/{name}")
    return out


def read_open_table(spark: SparkSession, path: str, known: StructType) -> DataFrame:
    """JSON lines with columns that no schema names (A1): the known ones typed, all others kept in ``other``, a map of
    their JSON texts.  Each line is parsed once, into a VARIANT."""
    lines = spark.read.format("json").option("singleVariantColumn", "line").load(path)
    fields = F.try_variant_get("line", "$", "map<string,variant>")
    other = F.map_filter(fields, lambda k, _: ~k.isin([f.name for f in known.fields]))
    typed = (F.try_variant_get("line", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in known.fields)
    return lines.select(*typed, F.transform_values(other, lambda _, v: F.to_json(v)).alias("other"))


def cache_tables(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep chosen columns of a reused dimension table cached (A2).

    The reference uses its cache when the cached columns are a strict superset
    in name only; here every requested column must be present.
    """
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in table: {missing}")
    from pyspark import StorageLevel
    return df.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)


def read_versions(spark: SparkSession, base: str, versions: Sequence[str], pattern: str = "*.parquet") -> DataFrame:
    """One Parquet glob per version, appended (A3)."""
    return spark.read.parquet(*[f"{base}/{v}/{pattern}" for v in versions])


def read_corpus(spark: SparkSession, path: str, text_field: str | None = None, max_items: int | None = None,
                schema: StructType | None = None) -> tuple[DataFrame, str]:
    """Reader by suffix (.jsonl / .parquet), first ``max_items`` rows, text column
    inferred from a fixed candidate list (A4).  JSON needs a schema (else reading it
    would take a pass of its own).  Empty input raises."""
    if path.endswith(".jsonl") or path.endswith(".json"):
        if schema is None:
            raise ValueError("JSON input needs a schema")
        df = spark.read.schema(schema).json(path)
    elif path.endswith(".parquet"):
        df = spark.read.parquet(path)
    else:
        raise ValueError("Unsupported file extension (use .jsonl or .parquet).")
    if max_items is not None:
        df = df.limit(max_items)
    if df.isEmpty():
        raise ValueError("No data loaded.")
    if text_field is None:
        text_field = next((c for c in TEXT_FIELD_CANDIDATES if c in df.columns), None)
        if text_field is None:
            raise ValueError("Could not infer the text field.")
    return df, text_field


def inline_rows(spark: SparkSession, rows: list[dict], cols: Sequence[str] | None = None,
                schema: StructType | None = None) -> DataFrame:
    """Inline rows in place of a table scan, optionally projected (A5)."""
    if not isinstance(rows, list):
        raise TypeError("inline data must be a list of rows")
    df = spark.createDataFrame(rows, schema=schema) if schema else spark.createDataFrame(rows)
    return df.select(*cols) if cols else df

