"""File and table readers (group A).

Every reader takes an explicit schema: inference costs an extra pass over the
data and guesses optional fields differently per file. Paths are plain Hadoop
FS URIs (``hdfs://``, ``s3a://``, ``abfss://``, local), so object stores need
only configuration.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.functions.scalar import cast_failed, typed

CORRUPT = "_corrupt_record"
#: Thresholds below this are searched for task by task.
EARLY_STOP = 100


def text_schema(columns: list[str]) -> T.StructType:
    """All-text landing schema (every column ``string``)."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_csv_landing(spark: SparkSession, path: str | list[str], columns: list[str], sep: str = ",",
                     header: bool = True) -> DataFrame:
    """CSV into an all-text table: ``"`` quotes, ``""`` as escaped quote, header skipped."""
    return (spark.read.schema(text_schema(columns))
            .option("header", header).option("sep", sep)
            .option("quote", '"').option("escape", '"').option("multiLine", False)
            .csv(path))


def read_csv_typed(spark: SparkSession, path: str | list[str], schema: dict[str, str],
                   formats: dict[str, str] | None = None, sep: str = ",") -> DataFrame:
    """CSV → typed columns; text that does not parse becomes NULL (never NaN)."""
    landed = read_csv_landing(spark, path, list(schema), sep=sep)
    return cast_table(landed, schema, formats)


def cast_table(landed: DataFrame, schema: dict[str, str], formats: dict[str, str] | None = None,
               with_errors: bool = False) -> DataFrame:
    """Typed projection of a text landing table with per-column formats.

    With ``with_errors`` a ``cast_errors`` column counts the non-blank values
    per row that did not survive their cast.
    """
    formats = formats or {}
    cols = [typed(c, t, formats.get(c)).alias(c) for c, t in schema.items()]
    if not with_errors:
        return landed.select(*cols)
    errs = sum((cast_failed(c, typed(c, t, formats.get(c))).cast("int") for c, t in schema.items()), F.lit(0))
    return landed.select(*cols, errs.alias("cast_errors"))


def _flagged(spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str, header: bool) -> DataFrame:
    """The typed rows with the raw line in ``_corrupt_record``, ``_bad`` and ``_file``."""
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    raw = (spark.read.schema(full).option("header", header).option("sep", sep)
           .option("quote", '"').option("escape", '"')
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
           .csv(path))
    # the flag also depends on every column, so that whatever is selected later, each line is
    # parsed whole (the second half can only be true if the first is)
    data = [f"`{f.name}`" for f in schema.fields]
    bad = F.col(CORRUPT).isNotNull() | (F.xxhash64(*data, CORRUPT) != F.xxhash64(*data))
    return raw.select("*", bad.alias("_bad"), F.col("_metadata.file_path").alias("_file"))


def read_csv_with_rejects(spark: SparkSession, path: str | list[str], schema: T.StructType,
                          max_rejects: int = 0, sep: str = ",", header: bool = True
                          ) -> tuple[DataFrame, DataFrame]:
    """Typed CSV load with a reject threshold.

    Returns ``(good, rejected)``. ``rejected`` keeps the raw line in
    ``_corrupt_record`` beside whatever fields did parse. When more than
    ``max_rejects`` rows are bad the load fails (``max_rejects=0`` behaves like
    ``FAILFAST``, stopping at the first bad row). The check runs one
    aggregation over the rejected rows only.
    """
    tagged = _flagged(spark, path, schema, sep, header).drop("_file")
    rejected = tagged.where("_bad").drop("_bad")
    good = tagged.where(~F.col("_bad")).drop("_bad", CORRUPT)
    n_bad = tagged.agg(F.count_if("_bad").alias("bad")).first()["bad"]
    if n_bad > max_rejects:
        raise ValueError(f"{n_bad} rejected rows exceed the threshold of {max_rejects}")
    return good, rejected


def numbered_lines(spark: SparkSession, path: str | list[str], where: Column | None = None) -> DataFrame:
    """Text lines as (file, line, value), ``line`` counted from 1 in each file, blank ones included.

    A file is read in splits by many tasks. A line's place in its split comes from the row numbers that the scan hands out, and a
    table with one row per split (its first row number and its lines) says how many lines stand before the split. ``where`` limits the files
    (a condition on the column ``file``); others are not opened.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), "value")
    if where is not None:
        lines = lines.where(where)
    lines = lines.withColumn("_at", F.monotonically_increasing_id())
    splits = lines.groupBy("file", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("file", "_block", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    return lines.join(splits, ["file", "_block"]).select("file", (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("line"), "value")


def _parsed(spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str, header: bool, where: Column | None = None) -> DataFrame:
    """Numbered data lines with their typed fields ``_row`` and whether they are bad."""
    lines = numbered_lines(spark, path, where).where(F.trim("value") != "")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*schema.fields, T.StructField(CORRUPT, T.StringType())])
    row = F.from_csv("value", fields, {"mode": "PERMISSIVE", "sep": sep, "quote": '"', "escape": '"', "columnNameOfCorruptRecord": CORRUPT})
    rows = lines.where("line > 1") if header else lines
    return rows.withColumn("_row", row).withColumn("_bad", F.col(f"_row.{CORRUPT}").isNotNull())


def read_csv_numbered(spark: SparkSession, path: str | list[str], schema: T.StructType, max_rejects: int | None = 0, sep: str = ",",
                      header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Typed CSV load that says which line of which file was rejected: ``(good, rejects)``, rejects being (file, line, value), the first
    data row of a file with a header line 2. Blank lines are skipped but counted.

    With more than ``max_rejects`` bad lines the load fails (None: never), naming lines. For thresholds below ``EARLY_STOP`` the
    search ends there: splits are read few by few until so many bad lines are met, and only the files that hold them are numbered, so a
    zero threshold ends at the first bad line met instead of reading everything.
    """
    if max_rejects is not None:
        tagged = _flagged(spark, path, schema, sep, header)
        if max_rejects < EARLY_STOP:
            met = tagged.where("_bad").select("_file").take(max_rejects + 1)
            n, files = len(met), sorted({r["_file"] for r in met})
        else:
            n, files = tagged.where("_bad").count(), None
        if n > max_rejects:
            where = F.col("file").isin(*files) if files else None
            found = _parsed(spark, path, schema, sep, header, where).where("_bad").orderBy("file", "line").limit(min(10, max_rejects + 1)).collect()
            raise ValueError("rejected lines exceed the threshold of {}: {}".format(
                max_rejects, ", ".join(f"{r['file']} line {r['line']}" for r in found)))
    rows = _parsed(spark, path, schema, sep, header)
    rejects = rows.where("_bad").select("file", "line", "value")
    good = rows.where(~F.col("_bad")).select(*[F.col(f"_row.`{f.name}`").alias(f.name) for f in schema.fields])
    return good, rejects


def read_json_lines(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """JSON Lines with an explicit schema."""
    return spark.read.schema(schema).json(path)


def read_json_documents(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """Pretty-printed JSON (one document or a top-level array over many lines)."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text file(s) as one ``value`` row per line."""
    return spark.read.text(path)


def read_table(spark: SparkSession, name: str | None = None, fmt: str | None = None,
               path: str | None = None) -> DataFrame:
    """A catalogue table by identifier, or a path in a given format."""
    if name:
        return spark.table(name)
    return spark.read.format(fmt or "parquet").load(path)


def split_packed_list(df: DataFrame, col: str, out: str, sep: str = " ") -> DataFrame:
    """One row per element of a ``sep``-packed text list (empty elements dropped)."""
    return (df.withColumn(out, F.explode(F.split(F.col(col), sep)))
            .where(F.col(out) != ""))
