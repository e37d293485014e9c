"""Registry of named queries over the driver tables.

``@query(name, sql)`` registers a function ``(spark, sf_dir) -> DataFrame``
together with the DuckDB SQL that states the same result over the same
parquet tables (``None`` when the result is not expressible in SQL — it is then
checked by row count only).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
