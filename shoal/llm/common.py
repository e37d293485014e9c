"""Shared helpers: intermediate tables, hash splits, bounded samples and array code for texts.

Texts reach Python as Arrow batches and are processed as whole arrays of code
points (:class:`Texts`), a few million characters at a time, so that no step
loops over characters in Python and memory per task stays bounded by the chunk
or by the longest single document.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.session import scratch_path

#: Rows per Arrow batch and characters per array chunk: what one Python worker holds at a time.
BATCH_ROWS = 512
CHUNK_CHARS = 1 << 20
#: Rows of a small table that share one file.
FILE_ROWS = 1 << 16
#: Spark's setting for removing the shuffle files of a finished query.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

ODD = np.uint64(0x9E3779B97F4A7C15)
MIX1 = np.uint64(0xBF58476D1CE4E5B9)
MIX2 = np.uint64(0x94D049BB133111EB)


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Arrow batches of at most ``rows`` rows: long documents must not fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def few_files(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in a partition for each ``FILE_ROWS`` of its ``rows``, one for each core at least, if it has more: partitions are joined
    where they are, without a shuffle. Else a small table is written as a file for each shuffle partition, and for each
    file of a local folder Hadoop starts processes that set its rights."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))


def materialise(df: DataFrame, name: str, tidy: bool = False, rows: int | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read back: cuts the lineage,
    survives lost executors, is read column by column. ``tidy``: the write's shuffle files go once it has ended, not only when
    the driver collects its garbage. ``rows``: how many rows it has about, for :func:`few_files`."""
    spark = df.sparkSession
    if rows is not None:
        df = few_files(df, rows)
    path = scratch_path(spark, name)
    before = spark.conf.get(TIDY)
    if tidy:
        spark.conf.set(TIDY, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(TIDY, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Remove the files of a :func:`materialise`d table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def crc_mod(col: str, m: int) -> Column:
    """crc32 of the id as text, modulo ``m``; NULL for a NULL id."""
    return F.crc32(F.col(col).cast("string")) % F.lit(m)


def hash_sample(df: DataFrame, id_col: str, rows: int, total: int, salt: int = 0) -> DataFrame:
    """About ``rows`` of ``total`` rows, the same ones on every run: those whose hashed id is low."""
    if total <= rows:
        return df
    bar = math.floor(rows / total * (1 << 31))
    return df.filter(F.pmod(F.xxhash64(F.col(id_col), F.lit(salt)), F.lit(1 << 31)) < F.lit(bar))


def splitmix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


_powers: list[np.ndarray] = []
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_CHARS + 1)
        with np.errstate(over="ignore"):
            _powers[:] = [np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)], dtype=np.uint64)
                          for b in (_BASE, _INVERSE)]
    return _powers[0], _powers[1]


class Texts:
    """Some documents as one array of code points, made when first asked for; ``offsets[i]:offsets[i + 1]`` is document i."""

    def __init__(self, col: pa.Array, first: int):
        self.first, self.n = first, len(col)
        if col.null_count:
            col = col.fill_null("")
        wide = pa.types.is_large_string(col.type)
        _, off, data = col.buffers()
        at = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + self.n + 1].astype(np.int64)
        self.raw = memoryview(data)[at[0]:at[-1]] if data is not None else b""
        #: ``offsets`` in bytes
        self.places = at - at[0]

    @cached_property
    def text(self) -> str:
        return str(self.raw, "utf-8", "replace") if len(self.raw) else ""

    @cached_property
    def codes(self) -> np.ndarray:
        return np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), np.uint32)

    @cached_property
    def offsets(self) -> np.ndarray:
        lead = (np.frombuffer(self.raw, np.uint8) & 0xC0) != 0x80
        return self.places if lead.all() else np.r_[0, np.cumsum(lead)][self.places]

    def lowered(self) -> np.ndarray:
        """Code points with A-Z lowered."""
        c = self.codes
        return c + (((c >= 65) & (c <= 90)).astype(np.uint32) << np.uint32(5))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and document of every maximal run of characters other than space and 9-13."""
        c = self.codes
        inside = ~((c == 32) | ((c >= 9) & (c <= 13)))
        left = np.r_[False, inside[:-1]] if len(c) else inside
        left[self.offsets[:-1][self.offsets[:-1] < len(c)]] = False
        starts = np.flatnonzero(inside & ~left)
        right = np.r_[inside[1:], False] if len(c) else inside
        last = self.offsets[1:] - 1
        right[last[last >= 0]] = False
        ends = np.flatnonzero(inside & ~right) + 1
        return starts, ends, np.searchsorted(self.offsets, starts, "right") - 1

    def hashes(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each ``codes[start:end]``."""
        with np.errstate(over="ignore"):
            up, down = _power_tables(len(codes) + 1)
            v = (codes.astype(np.uint64) + np.uint64(0x5851)) * MIX1
            sums = np.r_[np.uint64(0), np.cumsum(v * up[:len(codes)], dtype=np.uint64)]
            h = (sums[ends] - sums[starts]) * down[starts]
            return splitmix(h + (ends - starts).astype(np.uint64) * ODD)


def chunks(col: pa.Array, size: int = CHUNK_CHARS) -> Iterator[Texts]:
    """The documents of a batch in runs of about ``size`` bytes, one document at least."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if not n:
        return
    wide = pa.types.is_large_string(col.type)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + n + 1]
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + size, "right")) - 1)
        yield Texts(col.slice(at, min(to, n) - at), at)
        at = min(to, n)


def append_columns(df: DataFrame, carry: Iterable[str], reads: Iterable[str],
                   fn: Callable[[pa.RecordBatch], list[pa.Array]], schema: str) -> DataFrame:
    """The ``carry`` columns of ``df`` and, from ``fn`` on each Arrow batch, the columns of ``schema``.
    Only ``carry`` and ``reads`` leave the scan; other columns, whatever their names, play no part."""
    carry, reads = list(carry), list(reads)
    fields = [df.schema[c] for c in carry] + list(T._parse_datatype_string(schema).fields)
    names = [f.name for f in fields]

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(c) for c in carry] + fn(b), names)

    return df.select(*dict.fromkeys(carry + reads)).mapInArrow(run, T.StructType(fields))


def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """An Arrow list column from flat values and the length of each row."""
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(values))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components: (node, component) for every node of ``edges``, component the smallest node.

    Alternates "every neighbour above me points to my smallest neighbour" and "everything below or
    at me points to the smallest" until nothing changes. Minima are combined before the shuffle and
    joined back, so a hub with a third of all edges costs a join that AQE splits, never a list of
    neighbours. Only two numbers per round reach the driver. Empty edges give no rows.
    """
    spark = edges.sparkSession
    edges = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    rows = edges.count()
    now = materialise(edges.distinct(), "edges", rows=rows)
    state = None
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                               F.struct("u", F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").filter("u <> v").distinct())
        new = materialise(small, "edges", rows=rows)
        after = new.agg(F.count(F.lit(1)).alias("n"),
                        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        drop_table(now)
        now = new
        if state == after or not after["n"]:
            break
        state, rows = after, after["n"]
    roots = now.select(F.col("v").alias("node")).distinct()
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(roots.select("node", F.col("node").alias("component"))))
