"""Exact quantiles with linear interpolation, without one giant task.

``percentile()`` is exact but merges a value->count map of every distinct
value into a single final task: unbounded for a continuous column at scale.
Here a mergeable sketch gives bounds for the wanted ranks and a second pass counts:

1. one aggregate: the number of values, of infinite ones, and the sketch's values around each wanted quantile;
2. one grouped count over the same rows: values between the bounds of a rank by value, all others by the
   stretch they lie in. Tasks combine equal values and whole stretches first, so what is shuffled and what the driver gets is the
   values between bounds, some ``5 / ACCURACY`` of all, and ties cost nothing.

If that is more than ``max_exact`` values, the second pass only counts by stretch, and the sketch
is taken again within each stretch that holds a rank, which shrinks it by about ``ACCURACY / 5``. All ranks are narrowed
in one scan per round, so a 10^12-row column needs three or four scans.
"""

from __future__ import annotations

import bisect
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The sketch's rank error is one part in so many.
ACCURACY = 10_000


def _stretch(x: Column, edges: list[float]) -> Column:
    """Place of a value among sorted ``edges``: 2 i + 1 between the edges i and i + 1 (both open), 2 i at edge i, negative below all."""
    found = F.lit(-1)
    for i, e in enumerate(edges):
        found = F.when(x > F.lit(e), F.lit(2 * i + 1)).when(x == F.lit(e), F.lit(2 * i)).otherwise(found)
    return found


def _ranks(x: DataFrame, n: int, offset: int, ranks: list[int], sketch: list[tuple[float, float]], max_exact: int,
           fanout: int) -> dict[int, float]:
    """Values of the ``ranks`` (from 0, ``offset`` values are below) of the ``n`` finite values ``x``. ``sketch``: bounds that most
    likely hold them."""
    out: dict[int, float] = {}
    edges = sorted({e for pair in sketch for e in pair})
    place = _stretch(F.col("x"), edges)
    few = 5 * len(ranks) * n / fanout <= max_exact
    inside = {2 * i + 1 for i in range(len(edges) - 1) if any(lo <= edges[i] and edges[i + 1] <= hi for lo, hi in sketch)}
    value = F.when(F.col("s").isin(*inside), F.col("x")) if few and inside else F.lit(None).cast("double")
    rows = (x.select("x", place.alias("s")).select("x", "s", value.alias("v")).groupBy("s", "v")
            .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect())
    rows.sort(key=lambda r: (r["s"], r["lo"]))
    at = offset
    for r in rows:
        held = [k for k in ranks if at <= k < at + r["n"]]
        if held and r["lo"] == r["hi"]:
            out.update({k: r["lo"] for k in held})
        elif held:  # the sketch missed, or there was too much to count by value: narrow this stretch
            part = x.where((F.col("x") >= F.lit(r["lo"])) & (F.col("x") <= F.lit(r["hi"])))
            out.update(_narrowed(part, r["n"], at, held, max_exact, fanout))
        at += r["n"]
    return out


def _narrowed(x: DataFrame, n: int, offset: int, ranks: list[int], max_exact: int, fanout: int) -> dict[int, float]:
    if n <= max_exact:
        rows = sorted((r["x"], r["n"]) for r in x.groupBy("x").agg(F.count(F.lit(1)).alias("n")).collect())
        ends, total = [], offset
        for _, k in rows:
            total += k
            ends.append(total)
        return {k: rows[bisect.bisect_right(ends, k)][0] for k in ranks}
    probs = _around([(k - offset) / max(1, n - 1) for k in ranks], fanout)
    got = x.agg(F.percentile_approx("x", probs, fanout).alias("s"), F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    bounds = [tuple(got["s"][2 * i:2 * i + 2]) for i in range(len(ranks))]
    if all(lo <= got["lo"] and hi >= got["hi"] for lo, hi in bounds):  # heavy ties at both ends: halve
        middle = got["lo"] + (got["hi"] - got["lo"]) / 2
        bounds = [(got["lo"], middle), (middle, got["hi"])]
    return _ranks(x, n, offset, ranks, bounds, max_exact, fanout)


def _around(probs: list[float], fanout: int) -> list[float]:
    """Shares below and above each of ``probs`` that the sketch's error does not reach over."""
    return [min(1.0, max(0.0, q + side * 1.5 / fanout)) for q in probs for side in (-1, 1)]


def exact_quantiles(df: DataFrame, col: str, probs: list[float], max_exact: int = 100_000, fanout: int = ACCURACY,
                    extra: dict[str, Column] | None = None) -> list[float | None] | tuple[list[float | None], dict]:
    """Exact quantiles (linear interpolation, as NumPy / ``quantile_cont``). ``extra``: further aggregates over ``df``, taken
    in the same first pass and returned beside the quantiles. ``fanout``: the sketch's accuracy."""
    c = F.col(col).cast("double")
    usable = c.isNotNull() & ~F.isnan(c)
    finite = F.when(usable & (F.abs(c) != F.lit(math.inf)), c)
    extra = extra or {}
    first = df.agg(F.count_if(usable).alias("_n"), F.count_if(c == -math.inf).alias("_low"), F.count_if(c == math.inf).alias("_high"),
                   F.percentile_approx(finite, _around(probs, fanout), fanout).alias("_s"),
                   *[v.alias(k) for k, v in extra.items()]).first()
    rest = {k: first[k] for k in extra}
    n, low, high = first["_n"], first["_low"], first["_high"]
    if not n:
        return ([None for _ in probs], rest) if extra else [None for _ in probs]
    wanted = sorted({k for q in probs for k in (math.floor((n - 1) * q), math.ceil((n - 1) * q))})
    # infinite values hold the outermost ranks; the finite ones between are looked for
    vals = {r: -math.inf if r < low else math.inf for r in wanted if r < low or r >= n - high}
    inner = [r for r in wanted if r not in vals]
    if inner:
        x = df.select(finite.alias("x")).where(F.col("x").isNotNull())
        bounds = [tuple(first["_s"][2 * i:2 * i + 2]) for i in range(len(probs))]
        vals |= _ranks(x, n - low - high, low, inner, bounds, max_exact, fanout)
    res = []
    for q in probs:
        h = (n - 1) * q
        a, b = vals[math.floor(h)], vals[math.ceil(h)]
        res.append(a if a == b else a + (h - math.floor(h)) * (b - a))
    return (res, rest) if extra else res


def approx_quantiles(df: DataFrame, col: str, probs: list[float], accuracy: int = ACCURACY) -> DataFrame:
    """One-pass approximate quantiles (rank error about n / accuracy), lazily, one row."""
    arr = F.percentile_approx(F.col(col).cast("double"), probs, accuracy)
    return df.agg(arr.alias("_q")).select(*[F.col("_q")[i].alias(f"q{i}") for i in range(len(probs))])


def one_row(df: DataFrame, values: dict[str, tuple[str, object]]) -> DataFrame:
    """A frame of one row of literals, ``{name: (type, value)}``."""
    return df.sparkSession.range(1).select(*[F.lit(v).cast(t).alias(k) for k, (t, v) in values.items()])


def quantile_table(df: DataFrame, col: str, probs: dict[str, float], digits: int = 4,
                   method: str = "exact", **kw) -> DataFrame:
    """One-row DataFrame of named quantiles; ``method="approx"`` trades exactness for a single pass."""
    if method == "approx":
        q = approx_quantiles(df, col, list(probs.values()), **kw)
        return q.select(*[F.round(F.col(f"q{i}"), digits).alias(k) for i, k in enumerate(probs)])
    vals = exact_quantiles(df, col, list(probs.values()), **kw)
    return one_row(df, {k: ("double", None if v is None else round(v, digits)) for k, v in zip(probs, vals)})


def describe(df: DataFrame, col: str, digits: int = 4, **kw) -> DataFrame:
    """pandas-style ``describe``: count, mean, std (n−1), min, quartiles, max.

    ``DataFrame.summary()`` uses approximate, non-interpolated percentiles, so
    the quartiles come from :func:`exact_quantiles` instead.
    """
    c = F.col(col)
    q, s = exact_quantiles(df, col, [0.25, 0.5, 0.75], extra={
        "count": F.count(c), "mean": F.avg(c), "std": F.stddev_samp(c), "min": F.min(c), "max": F.max(c)}, **kw)
    r = lambda v: None if v is None else round(float(v), digits)
    return one_row(df, {"count": ("bigint", s["count"]), **{k: ("double", r(v)) for k, v in (
        ("mean", s["mean"]), ("std", s["std"]), ("min", s["min"]), ("q25", q[0]), ("q50", q[1]), ("q75", q[2]), ("max", s["max"]))}})
