"""Joins, set operations, deduplication, ordering (groups E and F).

Join strategy is left to Catalyst and AQE (broadcast when a side is measured
small at runtime, skew-join splitting otherwise). An explicit broadcast is only
used for sides whose size is bounded by construction: literal lookup lists,
one-row aggregates, fixed dimensions.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def inline_lookup(spark: SparkSession, mapping: dict, key: str, value: str,
                  key_type: str = "string", value_type: str = "string") -> DataFrame:
    """A literal (member, class) table; its size is the size of the mapping."""
    return spark.createDataFrame(list(mapping.items()), f"{key} {key_type}, {value} {value_type}")


def classify(df: DataFrame, col: str, classes: dict[str, Iterable], out: str = "class") -> DataFrame:
    """Label rows by membership in named lists; unknown members get NULL.

    The lists are literals of the projection (one hashed ``IN`` per class), so no
    join is planned. A member of several lists gets the last one's label.
    """
    label = F.lit(None).cast("string")
    for name, members in classes.items():
        label = F.when(F.col(col).isin(list(members)), F.lit(name)).otherwise(label)
    return df.withColumn(out, label)


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` tuple.

    ``max(struct(order…, rest…))`` is a partial aggregate: a key holding a third
    of all rows is reduced inside every map task before the shuffle, unlike a
    ``row_number`` window that sorts the whole group in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in [*order, *rest]])


def dedup_exact(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """``dropDuplicates`` — only when the other columns agree, else use ``dedup_latest``."""
    return df.dropDuplicates(list(keys) if keys else None)


def set_difference(actual: DataFrame, col: str, expected: DataFrame, expected_col: str) -> DataFrame:
    """Members present on one side only: ``(value, side)``; zero rows means equal sets.

    Compares *sets* both ways (a chained ``!=`` lets equal-sized different sets pass).
    NULL is a member like any other.
    """
    a = actual.select(F.col(col).alias("_av")).distinct().withColumn("_a", F.lit(True))
    e = expected.select(F.col(expected_col).alias("_ev")).distinct().withColumn("_e", F.lit(True))
    j = a.join(e, F.col("_av").eqNullSafe(F.col("_ev")), "full")
    return j.where(F.col("_a").isNull() | F.col("_e").isNull()).select(
        F.coalesce("_av", "_ev").alias("value"), F.when(F.col("_a").isNull(), F.lit("missing")).otherwise(F.lit("unexpected")).alias("side"))


def set_audit(actual: DataFrame, col: str, expected: Iterable[str]) -> DataFrame:
    """:func:`set_difference` against a literal expected list."""
    spark = actual.sparkSession
    exp = spark.createDataFrame([(v,) for v in expected], "value string")
    return set_difference(actual, col, exp, "value")


class AuditError(AssertionError):
    """Value sets differ; ``differences`` is the whole (value, side) frame."""

    def __init__(self, message: str, differences: DataFrame | None = None):
        super().__init__(message)
        self.differences = differences


def raise_if_different(diff: DataFrame, what: str) -> None:
    """Raise with the number of differing values, some of them as examples, and the frame of all."""
    n = diff.count()
    if n:
        some = ", ".join(f"{r.side}:{r.value}" for r in diff.orderBy("side", "value").take(5))
        raise AuditError(f"{what}: {n} values, e.g. {some}", diff)


def assert_same_set(actual: DataFrame, col: str, expected: Iterable[str]) -> None:
    """Raise with the differing values when the value sets differ."""
    raise_if_different(set_audit(actual, col, expected), "value sets differ")


def merge(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
          null_safe: bool = True) -> DataFrame:
    """Join on common key columns like a data-frame ``merge``: one output column
    per key and, with ``null_safe``, missing keys match each other (``<=>``). Other
    columns that both sides have get the suffixes ``_x`` and ``_y``."""
    both = {c for c in left.columns if c in right.columns and c not in on}
    left = left.select(*[F.col(c).alias(f"{c}_x") if c in both else F.col(c) for c in left.columns])
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c).alias(f"{c}_y") if c in both else F.col(c)
                       for c in right.columns])
    cond = [(F.col(c).eqNullSafe(F.col(f"_r_{c}")) if null_safe else F.col(c) == F.col(f"_r_{c}")) for c in on]
    joined = left.join(r, cond, how)
    keys = [F.coalesce(F.col(c), F.col(f"_r_{c}")).alias(c) if how in ("right", "full", "outer") else F.col(c)
            for c in on]
    rest = [c for c in joined.columns if c not in on and not c.startswith("_r_")]
    return joined.select(*keys, *rest)


def anti_join(left: DataFrame, right: DataFrame, on: str | list[str] | Column) -> DataFrame:
    """Rows of ``left`` with no match in ``right`` (``NOT EXISTS``)."""
    return left.join(right, on, "left_anti")


def union_all(*dfs: DataFrame, by_name: bool = True) -> DataFrame:
    """Concatenate rows, duplicates kept; by name unless asked otherwise."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d) if by_name else out.union(d)
    return out


def sort_by(df: DataFrame, spec: Sequence[tuple[str, bool]]) -> DataFrame:
    """Sort by ``(column, ascending)`` pairs; missing values last, as pandas does."""
    return df.orderBy(*[F.col(c).asc_nulls_last() if asc else F.col(c).desc_nulls_last() for c, asc in spec])


def top_k(df: DataFrame, spec: Sequence[tuple[str, bool]], k: int) -> DataFrame:
    """First ``k`` in an explicit order (per-partition top-k, then a merge)."""
    return sort_by(df, spec).limit(k)


def bottom_k(df: DataFrame, spec: Sequence[tuple[str, bool]], k: int) -> DataFrame:
    """Last ``k`` in order: top-k of the reversed order."""
    return sort_by(df, [(c, not asc) for c, asc in spec]).limit(k)


def sample_rows(df: DataFrame, n: int = 1, seed: int = 7) -> DataFrame:
    """``n`` random rows: those with the lowest seeded hash of all their columns. The same rows are picked
    however the table is partitioned and ordered (per-partition bottom-n, then a merge). Rows that repeat are picked together."""
    key = F.xxhash64(F.lit(seed), *[F.to_json(c) if "map<" in t else F.col(f"`{c}`") for c, t in
                                    ((f.name, f.dataType.simpleString()) for f in df.schema.fields)])
    return df.withColumn("_pick", key).orderBy("_pick").limit(n).drop("_pick")


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing → 0 on chosen numeric columns (names resolve case-insensitively)."""
    return df.fillna(0, subset=list(cols))


def drop_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=list(cols) if cols else None)


def null_mask(df: DataFrame, cols: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """``<col>_isnull`` flags for ``cols`` (default: all), beside the ``keep`` columns."""
    cols = list(cols or [c for c in df.columns if c not in keep])
    return df.select(*keep, *[F.isnull(c).alias(f"{c}_isnull") for c in cols])
