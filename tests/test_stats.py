import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoal.operators import histogram as H
from shoal.operators import quantiles as Q
from shoal.operators import stats as S
from shoal.operators import text as TX


def test_exact_quantiles_multi_pass_matches_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.lognormal(3, 1, 4000), np.full(2000, 7.25), rng.integers(0, 50, 1000)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    # force several narrowing rounds: exact only below 50 values, 8 buckets per round
    got = Q.exact_quantiles(df, "x", probs, max_exact=50, fanout=8)
    want = np.quantile(vals, probs)
    assert got == pytest.approx(list(want), rel=1e-12)


def test_quantiles_interpolate_like_numpy(spark):
    df = spark.createDataFrame([(25.0,), (30.0,), (35.0,), (40.0,), (None,)], "x double")
    assert Q.exact_quantiles(df, "x", [0.25])[0] == pytest.approx(28.75)


def test_describe_uses_sample_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    r = Q.describe(df, "x").first()
    assert r["count"] == 4 and r["std"] == pytest.approx(round(np.std([1, 2, 3, 4], ddof=1), 4))
    assert (r["q25"], r["q50"], r["q75"]) == (1.75, 2.5, 3.25)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (5.0,), (10.0,)], "v double")
    rows = {r["bin"]: r["n"] for r in H.histogram(df, "v", 5).collect()}
    assert rows == {1: 2, 2: 0, 3: 1, 4: 0, 5: 1}  # maximum lands in the last (closed) bin
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    rows = H.histogram(same, "v", 4).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [0, 0, 2, 0]  # numpy puts all-equal values in the middle bin
    assert rows[0]["lower"] == 2.5 and rows[-1]["upper"] == 3.5


def test_mode_and_argminmax_ties(spark):
    df = spark.createDataFrame([(1, "b", 5.0), (2, "a", 1.0), (3, "b", 9.0), (4, "a", 1.0), (5, "c", 9.0)],
                               "id int, k string, v double")
    assert S.most_common(df, "k").first().asDict() == {"value": "a", "frequency": 2}
    r = S.argmin_argmax(df, "v", "id").first()
    assert (r["argmin"], r["argmax"]) == (2, 3)  # first position of each extreme


def test_zscore_uses_population_std_of_unfiltered_data(spark):
    vals = [1.0] * 20 + [100.0, -5.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v double")
    mu, sd = np.mean(vals), np.std(vals)
    want = sorted(i for i, v in enumerate(vals) if abs(v - mu) / sd < 3 and v > 0)
    assert sorted(r["id"] for r in H.zscore_filter(df, "v").collect()) == want


def test_word_count_matches_tokenizer(spark):
    lines = ["We are  learning hadoop\tand spark, words.", "words words US\r\n", "US", "\f"]
    df = spark.createDataFrame([(t,) for t in lines], "text string")
    want = {}
    for t in lines:
        for w in t.split():  # StringTokenizer delimiters are a subset of str.split's
            want[w] = want.get(w, 0) + 1
    got = {r["word"]: r["count"] for r in TX.word_count(df).collect()}
    assert got == want
    top = TX.top_words(df, 2).collect()
    assert [(r["word"], r["count"]) for r in top] == [("US", 2), ("words", 2)]  # "words." is its own token


def test_column_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    got = {(r.column_name, r.data_type, r.non_null) for r in S.column_profile(df).collect()}
    assert got == {("a", "int", 2), ("b", "string", 1)}


def test_last_per_period(spark):
    df = spark.createDataFrame([(1, "2020-01-05", 1.0), (2, "2020-12-31", 2.0), (3, "2021-03-01", 3.0),
                                (4, "2020-12-31", 4.0)], "id int, d string, v double")
    df = df.withColumn("d", F.to_date("d"))
    got = [(r["year"], r["v"]) for r in S.last_per_period(df, "d", "v", "id").collect()]
    assert got == [(2020, 4.0), (2021, 3.0)]
    assert not math.isnan(got[0][1])


def test_approx_quantiles_close_to_exact(spark):
    vals = [float(v) for v in range(1, 1001)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = Q.quantile_table(df, "x", {"median": 0.5}, method="approx").first()
    assert abs(r["median"] - float(np.median(vals))) <= 1.0


def test_statistics_on_edge_values(spark):
    from shoal.operators import histogram as H2
    same = spark.createDataFrame([(1, 5.0), (2, 5.0)], "id int, v double")
    assert H2.zscore_filter(same, "v").count() == 0  # no spread, no z-score
    odd = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (float("nan"),), (float("inf"),), (None,)], "v double")
    assert [(r["lower"], r["n"]) for r in H2.histogram(odd, "v", 2).orderBy("bin").collect()] == [(0.0, 1), (1.0, 2)]
    inf = float("inf")
    vals = [-inf, -inf, 1.0, 1.0, 1.0, 2.0, 9.0, inf]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert Q.exact_quantiles(df, "x", [0.0, 0.5, 1.0], max_exact=2, fanout=4) == [-inf, 1.0, inf]
