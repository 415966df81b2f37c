"""Registry of named queries over the provided tables.

Each entry is a Spark callable ``(spark, sf_dir) -> DataFrame`` and, where
the result is expressible in SQL, an equivalent DuckDB statement used as an
independent oracle.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@dataclass(frozen=True)
class Entry:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    bench: bool = False


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, bench: bool = False):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, bench)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (floating sums differ in the last bits
    between engines); the oracle SQL rounds the same columns."""
    return df.select(*[F.round(F.col(c), digits).alias(c) if t in ("double", "float") else F.col(c)
                       for c, t in df.dtypes])
