import random

import pytest

from shoal.operators import keys as K
from shoal.operators import modeling as M
from shoal.operators import relational as R


def test_dedup_latest_keeps_greatest_order(spark):
    rows = [(1, "a", 10, 1, "x"), (1, "a", 12, 2, "y"), (1, "a", 12, 3, "z"), (2, "b", 1, 4, "w")]
    df = spark.createDataFrame(rows, "u int, t string, ts int, id int, payload string")
    got = {(r.u, r.t): (r.ts, r.id, r.payload) for r in R.dedup_latest(df, ["u", "t"], ["ts", "id"]).collect()}
    assert got == {(1, "a"): (12, 3, "z"), (2, "b"): (1, 4, "w")}


def test_set_audit_rejects_equal_sized_different_sets(spark):
    df = spark.createDataFrame([("Queens",), ("Brooklyn",), ("Bronx",)], "b string")
    assert R.set_audit(df, "b", ["Queens", "Brooklyn", "Bronx"]).count() == 0
    diff = {(r.value, r.side) for r in R.set_audit(df, "b", ["Queens", "Brooklyn", "Manhattan"]).collect()}
    assert diff == {("Bronx", "unexpected"), ("Manhattan", "missing")}
    with pytest.raises(R.AuditError):
        R.assert_same_set(df, "b", ["Queens", "Brooklyn", "Manhattan"])


def test_classify_unknown_is_null(spark):
    df = spark.createDataFrame([("dog",), ("eagle",), ("shark",)], "animal string")
    out = {r.animal: r["class"] for r in R.classify(df, "animal", {"mammal": ["dog"], "bird": ["eagle"]}).collect()}
    assert out == {"dog": "mammal", "eagle": "bird", "shark": None}


def test_global_rank_matches_sorted_order(spark):
    random.seed(1)
    rows = [(i, random.choice("abc"), random.random()) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, g string, v double")
    ranked = K.global_rank(df, [("g", True), ("v", False), ("id", True)], partitions=7)
    got = {r.id: r["rank"] for r in ranked.collect()}
    want = {r[0]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (r[1], -r[2], r[0])))}
    assert got == want


def test_surrogate_keys_dense(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "k string")
    assert [(r.id, r.k) for r in K.surrogate_keys(df, ["k"]).orderBy("id").collect()] == [(1, "a"), (2, "b"), (3, "c")]


def test_normalize_is_lossless(spark):
    flat = spark.createDataFrame(
        [("ann", "lee", "dr x", "cardio", "2020-01-01"), ("ann", "lee", "dr y", "derma", "2020-01-02"),
         ("bob", "kim", "dr x", "cardio", "2020-01-03")], "p string, pl string, doc string, spec string, d string")
    tables, fact = M.normalize(flat, {"patient": ["p", "pl"], "doctor": ["doc", "spec"]}, ["d"])
    assert tables["patient"].count() == 2 and tables["doctor"].count() == 2
    r = M.lossless_check(flat, M.denormalize(tables, fact)).first()
    assert (r.n_source, r.n_rebuilt, r.n_diff) == (3, 3, 0)


def test_sort_nulls_last_and_bottom_k(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, 1.0)], "id int, v double")
    assert [r.id for r in R.sort_by(df, [("v", True)]).collect()] == [3, 2, 1]
    assert [r.id for r in R.bottom_k(df, [("id", True)], 2).collect()] == [3, 2]


def test_fill_zero_is_case_insensitive(spark):
    df = spark.createDataFrame([(1, None)], "id int, EUR double")
    assert R.fill_zero(df, ["eur"]).first()["EUR"] == 0.0


def test_merge_matches_missing_keys_and_keeps_one_key_column(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (None, "y"), (4, "z")], "k int, r string")
    inner = {(r.k, r.l, r.r) for r in R.merge(left, right, ["k"]).collect()}
    assert inner == {(None, "b", "y"), (1, "a", "x")}
    full = R.merge(left, right, ["k"], how="full")
    assert full.columns == ["k", "l", "r"]
    assert {(r.k, r.l, r.r) for r in full.collect()} == {(1, "a", "x"), (3, "c", None), (4, None, "z"),
                                                         (None, "b", "y")}
    strict = R.merge(left, right, ["k"], null_safe=False)
    assert strict.count() == 1


def test_set_audit_counts_null_as_a_member(spark):
    df = spark.createDataFrame([("a",), (None,)], "b string")
    assert R.set_audit(df, "b", ["a", None]).count() == 0
    with pytest.raises(R.AuditError) as e:
        R.assert_same_set(df, "b", ["a"])
    assert e.value.differences.count() == 1


def test_merge_suffixes_columns_that_both_sides_have(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (3, "y")], "k int, v string")
    out = R.merge(left, right, ["k"], how="full")
    assert out.columns == ["k", "v_x", "v_y"]
    assert {tuple(r) for r in out.collect()} == {(1, "a", "x"), (None, "b", None), (3, None, "y")}


def test_normalize_keeps_rows_with_null_keys(spark):
    flat = spark.createDataFrame([(1, "a", None), (2, None, None), (3, None, "x"), (3, None, "x")], "d int, p string, q string")
    tables, fact = M.normalize(flat, {"e": ["p", "q"]}, ["d"])
    assert fact.where("e_id is null").count() == 0
    r = M.lossless_check(flat, M.denormalize(tables, fact)).first()
    assert (r["n_source"], r["n_rebuilt"], r["n_diff"]) == (4, 4, 0)
