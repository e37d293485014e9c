"""Fixed-width histogram (D11) and standard-deviation filters.

The bounds are a one-row aggregate; joining one row by broadcast is a proven
size bound (exactly one row), so the per-row work stays a map-side expression
and only ``bins`` counters per partition are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Fixed value: the bin count a plotting call uses when none is given.
DEFAULT_BINS = 10


def histogram(df: DataFrame, col: str, bins: int = DEFAULT_BINS, digits: int = 4) -> DataFrame:
    """Counts in ``bins`` equal-width bins between min and max.

    Bins are 1-based, the last bin is closed (the maximum goes into bin
    ``bins``), empty bins are kept with count 0. A column whose values are all
    equal uses the range ``[v - 0.5, v + 0.5]`` as NumPy does. NULL, NaN and
    infinite values have no bin and do not move the bounds.
    """
    if bins < 1:
        raise ValueError("bins must be positive")
    spark = df.sparkSession
    v = F.col(col).cast("double")
    df = df.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    bounds = df.agg(F.min(v).alias("mn"), F.max(v).alias("mx")).select(
        F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
        F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    counts = (df.select(v.alias("_v")).crossJoin(F.broadcast(bounds))
              .select(F.least(F.floor((F.col("_v") - F.col("lo")) / width).cast("int") + 1,
                              F.lit(bins)).alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    all_bins = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin")).crossJoin(F.broadcast(bounds))
    return (all_bins.join(counts, "bin", "left")
            .select("bin",
                    F.round(F.col("lo") + (F.col("bin") - 1) * width, digits).alias("lower"),
                    F.round(F.col("lo") + F.col("bin") * width, digits).alias("upper"),
                    F.coalesce(F.col("n"), F.lit(0)).alias("n")))


def zscore_filter(df: DataFrame, col: str, limit: float = 3.0) -> DataFrame:
    """Keep rows with ``|x - mean| / stddev_pop < limit``, then ``x > 0``.

    Both statistics come from the unfiltered data (one-row aggregate joined by
    broadcast); rows with NULL ``x`` drop out like in the reference, and so does a constant
    column, which has no z-score.
    """
    x = F.col(col)
    st = df.agg(F.avg(x).alias("_mu"), F.stddev_pop(x).alias("_sd"))
    z = F.try_divide(F.abs(x - F.col("_mu")).cast("double"), F.col("_sd"))
    return df.crossJoin(F.broadcast(st)).where((z < limit) & (x > 0)).drop("_mu", "_sd")


def stddev_band_filter(df: DataFrame, col: str, k: float = 3.0) -> DataFrame:
    """Keep ``0 < x < k · stddev_pop(x)`` (strict bounds)."""
    x = F.col(col)
    st = df.agg(F.stddev_pop(x).alias("_sd"))
    return df.crossJoin(F.broadcast(st)).where((x > 0) & (x < F.col("_sd") * k)).drop("_sd")
