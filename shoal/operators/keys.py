"""Dense surrogate keys and global ranks without a single-partition window.

``row_number() OVER (ORDER BY …)`` with no ``PARTITION BY`` moves every row
into one task. Instead the rows are range-partitioned and sorted, each row
gets its position inside its partition (``monotonically_increasing_id`` packs
``partition << 33 | position``), and a table of per-partition counts — one row
per partition, so bounded by the partition count — supplies the offsets.

The positioned rows are checkpointed into the shared checkpoint folder before
the offsets are taken, so the counts and the rows are the same rows even if an
executor is lost and tasks are recomputed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoal.session import checkpoint_root

_POS_BITS = 33


def _order(spec: Sequence[str | Column | tuple[str, bool]]) -> list[Column]:
    out = []
    for s in spec:
        if isinstance(s, tuple):
            out.append(F.col(s[0]).asc_nulls_last() if s[1] else F.col(s[0]).desc_nulls_last())
        elif isinstance(s, str):
            out.append(F.col(s).asc_nulls_last())
        else:
            out.append(s)
    return out


def global_rank(df: DataFrame, order: Sequence[str | Column | tuple[str, bool]], out: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1..n following ``order`` (ties get distinct, arbitrary ranks).

    Give a total order (end ``order`` with a unique key) for repeatable ranks.
    """
    checkpoint_root(df.sparkSession)
    cols = _order(order)
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    positioned = (df.repartitionByRange(n_parts, *cols).sortWithinPartitions(*cols)
                  .withColumn("_mid", F.monotonically_increasing_id())
                  .checkpoint(eager=True))
    pid = F.shiftright(F.col("_mid"), _POS_BITS)
    pos = F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    counts = positioned.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a window over it is a window over a few hundred rows
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    return (positioned.join(F.broadcast(offsets), pid == F.col("_pid"))
            .withColumn(out, F.col("_off") + pos + 1)
            .drop("_mid", "_pid", "_off"))


def surrogate_keys(df: DataFrame, natural_key: Sequence[str], out: str = "id") -> DataFrame:
    """Distinct natural keys numbered 1..n in key order (``serial``)."""
    distinct = df.select(*natural_key).distinct()
    ranked = global_rank(distinct, list(natural_key), out=out)
    return ranked.select(F.col(out).cast("long").alias(out), *natural_key)


def hashed_keys(df: DataFrame, natural_key: Sequence[str], out: str = "id") -> DataFrame:
    """Stable 64-bit keys from the natural key, no ordering pass at all."""
    return df.withColumn(out, F.xxhash64(*natural_key))
