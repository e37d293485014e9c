"""Database tables as sources and sinks.

Reads are split into ``num_partitions`` parallel range queries on a numeric
column so no single connection pulls a whole table. Credentials come from the
options the caller passes (typically read from the environment by the job),
never from code.

No registered query uses these: a test would need a database, and none is
started here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int = 8,
              properties: dict[str, str] | None = None, fetch_size: int = 10_000) -> DataFrame:
    props = {"fetchsize": str(fetch_size), **(properties or {})}
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=props)
    if lower is None or upper is None:
        bounds = spark.read.jdbc(
            url, f"(SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {table}) b",
            properties=props).first()
        lower, upper = bounds["lo"], bounds["hi"]
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=num_partitions, properties=props)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               mode: str = "append", batch_size: int = 10_000, max_connections: int | None = None) -> None:
    """Append rows. Spark commits per partition; for an all-or-nothing load write
    to a staging table and swap it in with one statement on the database."""
    props = {"batchsize": str(batch_size), **(properties or {})}
    out = df.coalesce(max_connections) if max_connections else df
    out.write.jdbc(url, table, mode=mode, properties=props)
