"""Status intervals: overlaps, islands, status as of a date.

Overlaps and islands need, per key, the largest end among the *earlier*
intervals — a prefix aggregate. A per-key window would sort a hot key (say a
third of all rows) inside one task; :func:`prefix_aggregate` instead
range-partitions on (key, order) so a hot key is spread over many tasks, takes
the prefix inside each piece, and adds the carry from earlier pieces through a
summary with one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoal.session import checkpoint_root

_POS_BITS = 33
_AGG = {"max": F.max, "sum": F.sum, "min": F.min}


def positioned(df: DataFrame, keys: Sequence[str], order: Sequence[str], partitions: int | None = None
               ) -> DataFrame:
    """Range-partition and sort on (keys, order), number the rows (``_mid``,
    ``_pid``) and checkpoint them, so several prefix aggregates can share one
    shuffle and see the same rows even if executors are lost."""
    checkpoint_root(df.sparkSession)
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = [*[F.col(k) for k in keys], *[F.col(o) for o in order]]
    return (df.repartitionByRange(n_parts, *ordered).sortWithinPartitions(*ordered)
            .withColumn("_mid", F.monotonically_increasing_id())
            .withColumn("_pid", F.shiftright(F.col("_mid"), _POS_BITS))
            .checkpoint(eager=True))


def prefix_on_positioned(pos: DataFrame, keys: Sequence[str], value: str | Column, how: str = "max",
                         out: str = "prefix", inclusive: bool = False) -> DataFrame:
    """Prefix aggregate over rows numbered by :func:`positioned` (keeps ``_mid``, ``_pid``).

    Only the first key of a partition can continue from earlier partitions, so
    the carry into each partition comes from a table with one row per partition
    (bounded by the partition count, broadcast), never from a join over all rows.
    """
    agg = _AGG[how]
    key = F.struct(*[F.col(k) for k in keys])
    pos = pos.withColumn("_val", F.col(value) if isinstance(value, str) else value)
    upper = 0 if inclusive else -1
    w_local = Window.partitionBy(*keys, "_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, upper)
    local = pos.withColumn("_local", agg("_val").over(w_local))
    # one row per partition: its first and last key
    ends = pos.groupBy("_pid").agg(F.min(key).alias("_first"), F.max(key).alias("_last"))
    # aggregate of the rows holding each partition's last key (one row per partition)
    tail = (pos.join(F.broadcast(ends), "_pid").where(key == F.col("_last"))
            .groupBy("_pid", "_last").agg(agg("_val").alias("_tail")))
    # running aggregate of those tails over consecutive partitions ending in the same key
    w_tail = Window.partitionBy("_last").orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    cum = tail.select(F.col("_pid").alias("_cpid"), F.col("_last").alias("_prev_last"),
                      agg("_tail").over(w_tail).alias("_cum"))
    # the carry into a partition comes from the nearest earlier non-empty partition
    # (a window over one row per partition)
    prev = ends.withColumn("_prev_pid", F.lag("_pid").over(Window.orderBy("_pid")))
    carry = (prev.join(cum, prev["_prev_pid"] == cum["_cpid"], "left")
             .select("_pid", "_first",
                     F.when(F.col("_prev_last") == F.col("_first"), F.col("_cum")).alias("_carry")))
    joined = (local.join(F.broadcast(carry), "_pid")
              .withColumn("_carry", F.when(key == F.col("_first"), F.col("_carry"))))
    if how == "sum":
        combined = F.when(F.col("_local").isNull() & F.col("_carry").isNull(), F.lit(None)).otherwise(
            F.coalesce(F.col("_local"), F.lit(0)) + F.coalesce(F.col("_carry"), F.lit(0)))
    elif how == "max":
        combined = F.greatest(F.col("_local"), F.col("_carry"))
    else:
        combined = F.least(F.col("_local"), F.col("_carry"))
    return joined.withColumn(out, combined).drop("_val", "_local", "_carry", "_first")


def prefix_aggregate(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str | Column,
                     how: str = "max", out: str = "prefix", inclusive: bool = False,
                     partitions: int | None = None) -> DataFrame:
    """Add ``out`` = ``how``(value) over the rows before this one (or up to it) within ``keys``.

    Rows are range-partitioned on (keys, order), so a key is split only where a
    partition boundary falls inside it; see :func:`prefix_on_positioned`.
    """
    pos = positioned(df, keys, order, partitions)
    return prefix_on_positioned(pos, keys, value, how, out, inclusive).drop("_mid", "_pid")


def overlaps(df: DataFrame, key: str, start: str, end: str, tiebreak: str) -> DataFrame:
    """Intervals that start before an earlier interval of the same key ended."""
    p = prefix_aggregate(df, [key], [start, end, tiebreak], end, "max", out="prev_max_end")
    return p.where(F.col(start) < F.col("prev_max_end"))


def islands(df: DataFrame, key: str, status: str, start: str, end: str, tiebreak: str) -> DataFrame:
    """Merge overlapping or adjoining intervals of equal status per key.

    A new island starts when an interval begins after every earlier one of the
    same (key, status) has ended; the island number is the running count of
    such starts.
    """
    keys = [key, status]
    pos = positioned(df, keys, [start, end, tiebreak])  # one shuffle and checkpoint for both prefixes
    p = prefix_on_positioned(pos, keys, end, "max", out="_prev_end")
    # stored once: the second prefix reads it three times
    flagged = p.select(key, status, start, end, "_mid", "_pid",
                       F.when(F.col("_prev_end").isNull() | (F.col(start) > F.col("_prev_end")), 1)
                       .otherwise(0).alias("_new")).checkpoint(eager=True)
    numbered = prefix_on_positioned(flagged, keys, "_new", "sum", out="island", inclusive=True)
    return (numbered.groupBy(key, status, "island")
            .agg(F.min(start).alias("start_date"), F.max(end).alias("end_date"),
                 F.count(F.lit(1)).alias("n_intervals")))


def status_as_of(df: DataFrame, key: str, start: str, end: str, status: str, day, tiebreak: str) -> DataFrame:
    """Status per key on ``day``: interval with ``start <= day < end``, latest start wins."""
    d = F.lit(day).cast("date")
    live = df.where((F.col(start) <= d) & (d < F.col(end)))
    best = F.max(F.struct(F.col(start).alias("s"), F.col(tiebreak).alias("t"), F.col(status).alias("st")))
    return live.groupBy(key).agg(best.alias("_b")).select(
        key, F.col("_b.st").alias(status), F.col("_b.s").alias(start))


def overlap_pairs(df: DataFrame, key: str, start: str, end: str, tiebreak: str) -> DataFrame:
    """Every pair of intervals of one key that share a day, once: (key, first, second, overlap_start, overlap_end), ``first`` the one that
    starts earlier (ties by ``tiebreak``).

    Time is cut in cells as long as the average interval. An interval is copied to the cells it covers, about two on
    average, and meets the intervals that *start* there: the pair lies in the cell of the later start, in no other. So work is that of the
    pairs in a cell, a hot key is spread over its cells, and no pair needs to be removed again. NULL keys, starts or ends and
    empty intervals pair with nothing.
    """
    rows = df.where((F.col(start) < F.col(end)) & F.col(key).isNotNull()).select(
        F.col(key).alias("_k"), F.col(tiebreak).alias("_t"), F.col(start).alias("_s"), F.col(end).alias("_e"))
    width = rows.agg(F.avg(F.date_diff("_e", "_s")).alias("w")).first()["w"]
    days = max(1, round(width or 1))

    def cell(c: Column) -> Column:
        return F.floor(F.date_diff(c, F.lit("1970-01-01").cast("date")) / F.lit(days))

    covers = rows.withColumn("_cell", F.explode(F.sequence(cell(F.col("_s")), cell(F.date_sub("_e", 1)))))
    starts = rows.select(F.col("_k").alias("_k2"), F.col("_t").alias("_t2"), F.col("_s").alias("_s2"), F.col("_e").alias("_e2"),
                         cell(F.col("_s")).alias("_cell2"))
    met = covers.join(starts, (F.col("_k") == F.col("_k2")) & (F.col("_cell") == F.col("_cell2"))
                      & (F.struct("_s", "_t") < F.struct("_s2", "_t2")) & (F.col("_s2") < F.col("_e")))
    return met.select(F.col("_k").alias(key), F.col("_t").alias("first"), F.col("_t2").alias("second"), F.col("_s2").alias("overlap_start"),
                      F.least("_e", "_e2").alias("overlap_end"))


def as_of_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, tiebreak: str,
               columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``left`` with ``columns`` of the last row of ``right`` of the same key whose ``right_time`` is at or before ``left_time`` (ties:
    largest ``tiebreak``); NULL where there is none.

    Both sides are dealt by range of (key, time) together, so a hot key is spread over many tasks, and the last known row is a
    running maximum carried over the partitions' borders (:func:`prefix_on_positioned`). NULL times on the right and NULL keys match
    nothing. Times of both sides have one type.
    """
    value = F.struct(F.col(right_time).alias("t"), F.col(tiebreak).alias("b"), F.struct(*columns).alias("v"))
    known = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(key).alias("_key"), F.col(right_time).alias("_time"), F.lit(0).alias("_side"), value.alias("_known"))
    asked = left.select(F.col(key).alias("_key"), F.col(left_time).alias("_time"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"))
    # a row without key or time has nothing before it
    plain = F.col("_key").isNotNull() & F.col("_time").isNotNull()
    both = known.unionByName(asked.where(plain), allowMissingColumns=True)
    pos = positioned(both, ["_key"], ["_time", "_side"], partitions)
    met = prefix_on_positioned(pos, ["_key"], "_known", "max", out="_last", inclusive=True).where("_side = 1")
    rest = asked.where(~plain).withColumn("_last", F.lit(None).cast(known.schema["_known"].dataType))
    out = met.select("_row", "_last").unionByName(rest.select("_row", "_last"))
    return out.select("_row.*", *[F.col(f"_last.v.`{c}`").alias(c) for c in columns])
