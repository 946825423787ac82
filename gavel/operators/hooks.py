"""User hooks.

The reference accepts source strings and ``exec``s them; here callers hand
over Python functions.  Row hooks run as Arrow-batched pandas UDFs on
pre-filtered rows only (the checker sees mismatching cases, nothing else).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

BLOCK_STRUCT = StructType([StructField("priority", IntegerType()), StructField("language", StringType()),
                           StructField("code", StringType())])


def blocks_hook(fn: Callable[[str], list[tuple[int, str, str]]]) -> Callable[[Column], Column]:
    """Wrap ``completion -> [(priority, language, code), ...]`` as a vectorised UDF
    whose result can be passed as ``custom=`` to ``with_blocks`` / ``pick``."""
    @F.pandas_udf(ArrayType(BLOCK_STRUCT))
    def _udf(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"priority": int(p), "language": lang, "code": code}
                                    for p, lang, code in (fn(t) if t is not None else [])])
    return _udf


def checker_hook(fn: Callable[[str, str, str], bool]) -> Callable[[Column, Column, Column], Column]:
    """Special judge ``(stdin, expected, answer) -> bool`` as a vectorised UDF."""
    @F.pandas_udf(BooleanType())
    def _udf(stdin: pd.Series, expected: pd.Series, answer: pd.Series) -> pd.Series:
        return pd.Series([bool(fn(a, b, c)) for a, b, c in zip(stdin, expected, answer)], dtype=bool)
    return _udf


METRICS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def register_metric(name: str):
    """A metrics function over all results is a plain ``DataFrame -> DataFrame``."""
    def deco(fn: Callable[[DataFrame], DataFrame]):
        METRICS[name] = fn
        return fn
    return deco


@dataclass
class DatasetProfile:
    """What a dataset plug-in contributes, looked up by dataset id."""
    name: str
    schema: StructType | None = None
    prompt: Callable[..., Column] | None = None
    assemble: Callable[..., Column] | None = None
    judge: Callable[..., DataFrame] | None = None
    match: Callable[[str], bool] = field(default=lambda ds: False)


DATASETS: list[DatasetProfile] = []


def register_dataset(profile: DatasetProfile) -> DatasetProfile:
    DATASETS.append(profile)
    return profile


def list_datasets() -> list[str]:
    """Names of the registered datasets, in order of registration."""
    return [p.name for p in DATASETS]


def dataset_for(dataset_id: str) -> DatasetProfile | None:
    """First registered profile whose rule matches the id (first match wins)."""
    return next((p for p in DATASETS if p.name == dataset_id or p.match(dataset_id)), None)
