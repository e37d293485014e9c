"""Descriptive statistics (group D).

Every statistic here is an aggregate that Spark computes with a partial
(map-side) step followed by a final merge of one small buffer per partition,
so a hot key or a huge table never lands whole in one task. The only
operators whose final state grows with the data — exact quantiles and the mode
— are built so that it does not (see ``quantiles`` and ``most_common``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def global_stats(df: DataFrame, col: str, digits: int = 4) -> DataFrame:
    """Whole-table mean, min, max, sum and count of one numeric column, one pass."""
    c = F.col(col)
    return df.agg(
        F.round(F.avg(c), digits).alias("mean"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
        F.round(F.sum(c), 2).alias("sum"),
        F.count(c).alias("n"),
    )


def shape(df: DataFrame) -> DataFrame:
    """Row count and column count (``COUNT(*)``, ``len``, ``shape``)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def group_agg(df: DataFrame, keys: list[str], aggs: dict[str, Column]) -> DataFrame:
    """General group-by with named aggregates."""
    return df.groupBy(*keys).agg(*[e.alias(n) for n, e in aggs.items()])


def dispersion(df: DataFrame, col: str, digits: int = 4) -> DataFrame:
    """Population and sample variance / standard deviation.

    NumPy and ``STDDEV_POP`` divide by n; pandas ``describe`` by n − 1.
    """
    c = F.col(col)
    return df.agg(
        F.round(F.var_pop(c), digits).alias("var_pop"),
        F.round(F.stddev_pop(c), digits).alias("std_pop"),
        F.round(F.var_samp(c), digits).alias("var_samp"),
        F.round(F.stddev_samp(c), digits).alias("std_samp"),
    )


def argmin_argmax(df: DataFrame, value: str, key: str) -> DataFrame:
    """Key of the first minimum and of the first maximum (lowest key on ties).

    ``min(struct(v, key))`` is an ordinary partial aggregate; NULL values are
    left out so that they do not sort first.
    """
    v, k = F.col(value), F.col(key)
    lo = F.min(F.when(v.isNotNull(), F.struct(v.alias("v"), k.alias("k"))))
    hi = F.min(F.when(v.isNotNull(), F.struct((-v).alias("v"), k.alias("k"))))
    return df.agg(lo.alias("lo"), hi.alias("hi")).select(
        F.col("lo.k").alias("argmin"), F.col("lo.v").alias("min_value"),
        F.col("hi.k").alias("argmax"), (-F.col("hi.v")).alias("max_value"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values (``np.unique``); the sort is range-partitioned."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def most_common(df: DataFrame, col: str) -> DataFrame:
    """Most frequent value, lowest value on ties.

    Counts per value first (a shuffle with map-side combine), then a one-row
    ``min(struct(-count, value))`` — unlike ``mode()``, no single task holds a
    map of every distinct value.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    best = counts.agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col(col).alias("v"))).alias("b"))
    return best.select(F.col("b.v").alias("value"), (-F.col("b.neg")).alias("frequency"))


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, Spark type, non-NULL count (one scan)."""
    aggs = [F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', '{t}', c{i}" for i, (c, t) in enumerate(df.dtypes))
    return wide.selectExpr(f"stack({len(df.columns)}, {pairs}) AS (column_name, data_type, non_null)")


def dot_product(df: DataFrame, a: str, b: str) -> DataFrame:
    """Sum of two-column products."""
    return df.agg(F.round(F.sum(F.col(a) * F.col(b)), 2).alias("dot"))


def last_per_period(df: DataFrame, date_col: str, value_col: str, id_col: str,
                    period: str = "year") -> DataFrame:
    """Collapse a series to one value per period: the last one by (date, id)."""
    per = {"year": F.year, "month": F.month}[period](F.col(date_col))
    last = F.max(F.struct(F.col(date_col).alias("d"), F.col(id_col).alias("i"), F.col(value_col).alias("v")))
    return (df.groupBy(per.alias(period)).agg(last.alias("last"))
            .select(period, F.col("last.v").alias(value_col), F.col("last.d").alias("as_of"))
            .orderBy(period))
