"""Writers (group B): files, tables, by-name inserts, layouts.

Inserts into existing tables always go *by name*: a positional insert of a
projection in another column order silently swaps values (the CAD/NZD and the
weather-column defects this library must not copy).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True, mode: str = "overwrite") -> None:
    """CSV with header and no index; values holding the separator are quoted."""
    (df.write.mode(mode).options(**TS_OPTIONS).option("header", header).option("sep", sep)
     .option("escape", '"').csv(path))


# Timestamp text formats with full microsecond precision (the JSON
# and CSV defaults keep only milliseconds and would lose data on a round trip).
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
TS_OPTIONS = {"timestampNTZFormat": TS_NTZ_FORMAT, "timestampFormat": TS_FORMAT}


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**TS_OPTIONS).json(path)


def write_json_array_documents(df: DataFrame, path: str, spread_by: str | None = None, rows_per_doc: int = 50_000) -> None:
    """Pretty-printed JSON array documents (one document spans many lines), one file each of about ``rows_per_doc`` rows.

    A multi-line document cannot be split when read, so there are many bounded ones instead of one huge one. Rows
    are dealt out evenly and become lines one by one; a line's frame depends on its place in the file (a bracket before the first,
    commas between, a bracket after the last), so no document is held in memory. ``spread_by`` is a helper column that is not written.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    cols = [c for c in df.columns if c != spread_by]
    n_docs = max(1, -(-df.count() // rows_per_doc))

    def framed(batches):
        first = True
        for b in batches:
            if not b.num_rows:
                continue
            line = b.column(0)
            if first:
                yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise("[", line.slice(0, 1), "")], ["value"])
                line, first = line.slice(1), False
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(",", line, "")], ["value"])
        if not first:
            yield pa.RecordBatch.from_arrays([pa.array(["]"])], ["value"])

    lines = df.select(F.to_json(F.struct(*cols), TS_OPTIONS).alias("value")).repartition(n_docs)
    lines.mapInArrow(framed, "value string").write.text(path)


def flatten_nested_as_json(df: DataFrame) -> DataFrame:
    """Struct / array / map columns → JSON text, so they survive a CSV file."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(*[F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
                       for f in df.schema.fields])


def write_single_csv(df: DataFrame, path: str) -> None:
    """A result with one row per a fixed set of values (a report) as one CSV file. One task
    writes it; results that grow with the data go through :func:`write_csv`."""
    write_csv(flatten_nested_as_json(df).coalesce(1), path)


def save_table(df: DataFrame, name: str, path: str | None = None, mode: str = "errorifexists",
               fmt: str = "parquet", partition_by: Sequence[str] | None = None) -> None:
    """Create a table from a DataFrame (external when ``path`` is given)."""
    w = df.write.mode(mode).format(fmt)
    if path:
        w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def align_to_table(spark: SparkSession, df: DataFrame, table: str, strict: bool = True) -> DataFrame:
    """Project ``df`` onto the table's columns *by name* with explicit casts.

    Missing columns raise under ``strict``; otherwise they become NULL.
    Case-insensitive like the rest of Spark SQL.
    """
    target = spark.table(table).schema
    have = {c.lower(): c for c in df.columns}
    cols: list[Column] = []
    for f in target.fields:
        src = have.get(f.name.lower())
        if src is None:
            if strict:
                raise ValueError(f"column {f.name} missing from the insert")
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(f"`{src}`").cast(f.dataType).alias(f.name))
    return df.select(*cols)


def insert_by_name(spark: SparkSession, df: DataFrame, table: str, overwrite: bool = False) -> None:
    """``INSERT INTO table BY NAME`` for any DataFrame."""
    align_to_table(spark, df, table).write.insertInto(table, overwrite=overwrite)


def create_external_csv_table(spark: SparkSession, name: str, columns_ddl: str, location: str,
                              sep: str = ",", header: bool = False) -> None:
    """``CREATE TABLE … USING csv LOCATION …`` (external comma-delimited table)."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns_ddl}) USING csv "
              f"OPTIONS (sep '{sep}', header '{str(header).lower()}') LOCATION '{location}'")


def truncate_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def drop_table_if_exists(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_database_if_absent(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def with_time_partitions(df: DataFrame, ts: str, grain: str = "day") -> DataFrame:
    """Derive the ``day`` / ``hour`` partition value of a timestamp column."""
    if grain == "day":
        return df.withColumn(f"{ts}_day", F.to_date(F.col(ts)))
    if grain == "hour":
        return df.withColumn(f"{ts}_hour", F.date_format(F.date_trunc("hour", F.col(ts)), "yyyy-MM-dd-HH"))
    raise ValueError(grain)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite",
                      fmt: str = "parquet", max_records_per_file: int | None = None) -> None:
    """Directory-partitioned layout.

    ``REBALANCE`` on the partition columns lets AQE size the write tasks: rows
    of one partition value go to the same task (few files per directory),
    small partitions are coalesced, and a hot value is split into
    advisory-size pieces instead of landing in one task.
    """
    out = df.hint("rebalance", *by)
    w = out.write.mode(mode).format(fmt).partitionBy(*by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(path)


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], n_files: int | None = None,
                    mode: str = "overwrite") -> None:
    """Clustered layout: range-partition and sort on the key, so each file holds
    a narrow key range and row-group min/max statistics prune well. Rows of one
    key are ranged further on a hash of the row, so a hot key fills several files."""
    n = n_files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()])
    (df.repartitionByRange(n, *keys, spread).sortWithinPartitions(*keys)
     .write.mode(mode).parquet(path))
