"""Re-run-safe loads into tables (the load steps of SURVEY §3.1 and §3.3).

A daily job that appends must be idempotent: running it twice for the same
day may not duplicate rows. The batch is deduplicated on its key (latest row
wins, a partial aggregate), missing measures are filled, rows whose key is
already in the target are dropped with a NULL-safe ``left_anti`` join (a NULL
key is a key like any other), and the rest is inserted *by name*. A row for a
key that an earlier batch loaded is not appended, also when it is newer; :func:`replace_late` is the load that
puts such rows in the place of the loaded ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.operators.relational import dedup_latest, fill_zero
from shoal.session import checkpoint_root
from shoal.sinks import align_to_table, insert_by_name


def idempotent_append(spark: SparkSession, batch: DataFrame, table: str, keys: Sequence[str],
                      order: Sequence[str], fill: Sequence[str] = (), range_col: str | None = None
                      ) -> DataFrame:
    """Dedup ``batch`` on ``keys`` (greatest ``order`` wins), fill ``fill`` with 0,
    append the rows whose key is new to ``table``. Returns the appended rows, read
    from the checkpoint that the insert read too, so they stay what was appended.

    ``range_col`` (a key column, typically the load date) bounds the target
    scan: the batch's min and max — one row — become literal filters that reach
    the target's Parquet scan (partition pruning, row-group skipping), so a
    daily batch does not re-read the table's whole history. Rows without a
    ``range_col`` are compared with the target's rows without one.
    """
    latest = dedup_latest(batch, list(keys), list(order))
    if fill:
        latest = fill_zero(latest, list(fill))
    aligned = align_to_table(spark, latest, table, strict=False)
    existing = spark.table(table).select(*keys)
    if range_col is not None:
        lo, hi, empty = aligned.agg(F.min(range_col), F.max(range_col), F.count_if(F.col(range_col).isNull())).first()
        inside = F.lit(False) if lo is None else F.col(range_col).between(F.lit(lo), F.lit(hi))
        existing = existing.where(inside | F.col(range_col).isNull() if empty else inside)
    existing = existing.select(*[F.col(k).alias(f"_e_{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"_e_{i}")) for i, k in enumerate(keys)]
    checkpoint_root(spark)
    new_rows = aligned.join(existing, same, "left_anti").checkpoint()
    insert_by_name(spark, new_rows, table)
    return new_rows


#: Touched days that become literals of the target's partition filter; more are met in a join.
LITERAL_DAYS = 1000


def replace_late(spark: SparkSession, batch: DataFrame, table: str, keys: Sequence[str], order: Sequence[str], day: str,
                 fill: Sequence[str] = ()) -> DataFrame:
    """Merge ``batch`` into ``table``, which is partitioned by ``day`` (one of ``keys``): of the rows of a key the one with the greatest
    ``order`` (columns of the table) stays, whether it is in the table or in the batch. Late and corrected rows replace loaded
    ones, stale ones and reruns change nothing.

    Only the days of the batch are read. Their rows are compared, before and after, by number and by a sum of row hashes, and only the
    days that differ are overwritten (dynamic partition overwrite), so an unchanged day keeps its files. Rows without a day are a
    partition like others. Returns (day, rows_before, rows_after) of the overwritten days.
    """
    latest = dedup_latest(batch, list(keys), list(order))
    if fill:
        latest = fill_zero(latest, list(fill))
    checkpoint_root(spark)
    new = align_to_table(spark, latest, table, strict=False).checkpoint()
    target = spark.table(table)
    days = new.select(F.col(day).alias("_day")).distinct()
    few = [r["_day"] for r in days.limit(LITERAL_DAYS + 1).collect()]
    if len(few) <= LITERAL_DAYS:
        named = [d for d in few if d is not None]
        touched = F.col(day).isin(*named) if named else F.lit(False)
        old = target.where(touched | F.col(day).isNull() if len(named) < len(few) else touched)
    else:
        old = target.join(days, F.col(day).eqNullSafe(F.col("_day")), "left_semi")
    merged = dedup_latest(old.unionByName(new), list(keys), list(order)).select(*target.columns).checkpoint()

    def prints(df: DataFrame, name: str) -> DataFrame:
        row = [F.to_json(f.name) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`") for f in target.schema.fields]
        return df.groupBy(F.col(day).alias(f"_{name}")).agg(F.count(F.lit(1)).alias(f"rows_{name}"),
                                                           F.sum(F.xxhash64(*row).cast("decimal(38,0)")).alias(f"_sum_{name}"))

    before, after = prints(old, "before"), prints(merged, "after")
    changed = (after.join(before, F.col("_after").eqNullSafe(F.col("_before")), "left")
               .where(~(F.col("_sum_after").eqNullSafe(F.col("_sum_before")) & F.col("rows_after").eqNullSafe(F.col("rows_before"))))
               .select(F.col("_after").alias(day), F.coalesce("rows_before", F.lit(0)).alias("rows_before"), "rows_after").checkpoint())
    if not changed.isEmpty():
        out = merged.join(changed.select(F.col(day).alias("_day")), F.col(day).eqNullSafe(F.col("_day")), "left_semi")
        # only the partitions that have rows here; an insert into a table takes this from the session alone
        setting = "spark.sql.sources.partitionOverwriteMode"
        old_mode = spark.conf.get(setting)
        spark.conf.set(setting, "dynamic")
        try:
            # one group of files a day, split if it is large
            out.hint("rebalance", day).write.insertInto(table, overwrite=True)
        finally:
            spark.conf.set(setting, old_mode)
    return changed
