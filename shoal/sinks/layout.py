"""File layouts of plain Parquet: target file sizes, buckets, an index of file bounds.

What the driver handles is a list of files, never rows: names, sizes and bounds.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A file of at least this share of the target size is left alone.
GOOD_ENOUGH = 0.75
FOLDER = r"^(.*)/[^/]+$"
#: Spark's setting for partitioned writes: files that a task may have open before it sorts its rows by folder.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def open_files(spark: SparkSession, n: int) -> Iterator[None]:
    """Partitioned writes hand rows to up to ``n`` open files a task as they come; without it a task sorts all its rows by folder first."""
    before = spark.conf.get(OPEN_FILES)
    spark.conf.set(OPEN_FILES, str(n))
    try:
        yield
    finally:
        spark.conf.set(OPEN_FILES, before)


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(file, folder, length) of the Parquet files under ``path``: a distributed listing that opens no file."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
            .select(F.col("path").alias("file"), F.regexp_extract("path", FOLDER, 1).alias("folder"), "length"))


def compaction_plan(spark: SparkSession, path: str, target_bytes: int) -> DataFrame:
    """(file, folder, length, bin): the files well below ``target_bytes`` packed, folder by folder in order of size, into bins of about that
    many bytes. Right-sized and larger files, and a file that would be alone in its bin, are not listed."""
    small = file_sizes(spark, path).where(F.col("length") < GOOD_ENOUGH * target_bytes)
    before = F.sum("length").over(Window.partitionBy("folder").orderBy("length", "file").rowsBetween(Window.unboundedPreceding, -1))
    binned = small.withColumn("bin", F.floor(F.coalesce(before, F.lit(0)) / F.lit(target_bytes)))
    alone = Window.partitionBy("folder", "bin")
    return binned.withColumn("_n", F.count(F.lit(1)).over(alone)).where("_n > 1").drop("_n")


def compact_files(spark: SparkSession, path: str, target_bytes: int) -> DataFrame:
    """Rewrite the small files of a Parquet folder (partitioned or not) into files of about ``target_bytes``; others are not touched.
    Returns the (file, folder, length, bin) that were replaced.

    Each bin is written by one task of its own, row by row as they come: memory does not follow the target. New files are written aside and moved in before the old ones go: a
    reader in between sees rows twice, none lost; a job that fails before leaves the folder as it was. For readers at any time use a
    versioned table.
    """
    plan = spark.createDataFrame(compaction_plan(spark, path, target_bytes).collect(), "file string, folder string, length bigint, bin bigint")
    files = [r["file"] for r in plan.select("file").collect()]
    if not files:
        return plan
    rows = spark.read.parquet(*files)  # one folder's partition values are not read: the folder says them
    numbered = plan.select("file", F.dense_rank().over(Window.orderBy("folder", "bin")).alias("_bin"))
    n = plan.select("folder", "bin").distinct().count()
    aside = f"{path.rstrip('/')}/_compact-{uuid.uuid4().hex[:12]}"
    dealt = (rows.withColumn("_file", F.regexp_replace(F.col("_metadata.file_path"), "^file:///", "file:/"))
             .join(F.broadcast(numbered.withColumn("_file", F.regexp_replace("file", "^file:///", "file:/")).drop("file")), "_file").drop("_file")
             .repartitionById(n, F.col("_bin") - 1))
    with open_files(spark, 2):
        dealt.write.partitionBy("_bin").parquet(aside)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(aside).getFileSystem(conf)
    folder_of = {r["_bin"]: r["folder"] for r in numbered.join(plan, "file").select("_bin", "folder").distinct().collect()}
    for r in file_sizes(spark, aside).select("file", "folder").collect():
        home = folder_of[int(r["folder"].rsplit("_bin=", 1)[1])]
        if not fs.rename(at(r["file"]), at(f"{home}/{uuid.uuid4().hex[:8]}-{r['file'].rsplit('/', 1)[1]}")):
            raise OSError(f"cannot move {r['file']} to {home}")
    for f in files:
        fs.delete(at(f), False)
    fs.delete(at(aside), True)
    return plan


def save_bucketed(df: DataFrame, name: str, buckets: int, by: Sequence[str], sort_by: Sequence[str] | None = None,
                  path: str | None = None) -> None:
    """A table in ``buckets`` hash buckets of ``by``, sorted in each: tables bucketed alike on their join keys join, and aggregate by them,
    without a shuffle. The rows of a bucket go to one writer, unless that would be far larger than others: then to several files."""
    w = df.hint("rebalance", buckets, *by).write.bucketBy(buckets, *by).sortBy(*(sort_by or by))
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def file_bounds(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """An index of the files of ``path``: (file, n_rows, <c>_min, <c>_max, <c>_nulls). One pass that reads only ``columns``."""
    return (spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), *columns).groupBy("file")
            .agg(F.count(F.lit(1)).alias("n_rows"), *[x for c in columns for x in (
                F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"))]))


def read_indexed(spark: SparkSession, path: str, index: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Rows of ``path`` with ``low <= column <= high`` (None: open), opening only the files whose bounds in ``index`` admit any."""
    def between(lo: Column, hi: Column) -> Column:
        inside = F.lit(True)
        if low is not None:
            inside &= hi >= F.lit(low)
        if high is not None:
            inside &= lo <= F.lit(high)
        return inside

    files = [r["file"] for r in index.where(between(F.col(f"{column}_min"), F.col(f"{column}_max"))).select("file").collect()]
    whole = spark.read.parquet(path)
    found = spark.read.option("basePath", path).schema(whole.schema).parquet(*files) if files else whole.limit(0)
    return found.where(between(F.col(column), F.col(column)))
