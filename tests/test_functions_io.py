import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal import functions as X
from shoal import sinks as W
from shoal import sources as S
from shoal.operators.loads import idempotent_append


def test_clock12(spark):
    df = spark.createDataFrame([("2020-01-01", "12:00 AM"), ("2020-01-01", "12:00 PM"), ("2020-01-01", "1:00 PM")],
                               "d string, t string")
    got = [r[0] for r in df.select(X.clock12_timestamp("d", "t")).collect()]
    assert got == [dt.datetime(2020, 1, 1, 0, 0), dt.datetime(2020, 1, 1, 12, 0), dt.datetime(2020, 1, 1, 13, 0)]


def test_safe_ratio_zero_and_null(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, None), (10.0, 4.0)], "a double, b double")
    assert [r[0] for r in df.select(X.safe_ratio("a", "b")).collect()] == [None, None, 2.5]


def test_lenient_casts_and_error_count(spark):
    df = spark.createDataFrame([("x",), ("",), (" 12",), (None,)], "n string")
    out = S.cast_table(df, {"n": "int"}, with_errors=True).collect()
    assert [(r.n, r.cast_errors) for r in out] == [(None, 1), (None, 0), (12, 0), (None, 0)]


def test_threshold_flag_null_is_false(spark):
    df = spark.createDataFrame([(22,), (21,), (None,)], "age int")
    assert [r[0] for r in df.select(X.threshold_flag("age", 21)).collect()] == ["true", "false", "false"]


def test_json_shred_quarantines_python_none_and_keeps_apostrophes(spark):
    docs = [("a", "[{'main': {'temp': 1.5}, 'name': \"O'Hare\"}, {'main': {'temp': 2.0}, 'rain': {'3h': 0.25}}]"),
            ("b", "[{'main': {'temp': None}}]"),
            ("c", "[]")]
    df = spark.createDataFrame(docs, "city string, list string")
    rows, bad = X.json_shred(df, "list", "main struct<temp: double>, name string, rain struct<`3h`: double>",
                             {"temp": "main.temp", "name": "name", "rain": F.col("e.rain").getField("3h")},
                             keep=["city"])
    got = sorted((r.city, r.temp, r.name, r.rain) for r in rows.collect())
    assert got == [("a", 1.5, "O'Hare", None), ("a", 2.0, None, 0.25)]  # the empty array gives no row
    assert [r.city for r in bad.collect()] == ["b"]


def test_csv_quotes_and_escapes_round_trip(spark, tmp):
    df = spark.createDataFrame([(1, 'say "hi", ok'), (2, "plain")], "id int, s string")
    W.write_csv(df, tmp + "/q")
    back = S.read_csv_landing(spark, tmp + "/q", ["id", "s"])
    assert sorted((r.id, r.s) for r in back.collect()) == [("1", 'say "hi", ok'), ("2", "plain")]


def test_reject_threshold(spark, tmp):
    with open(os.path.join(tmp, "x.csv"), "w") as f:
        f.write("a,b\n1,2\nzz,3\n4,5\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    good, bad = S.read_csv_with_rejects(spark, tmp, schema, max_rejects=1)
    assert sorted(r.a for r in good.collect()) == [1, 4]
    assert [(r.a, r.b) for r in bad.collect()] == [(None, 3)]  # the good part of the row is kept
    with pytest.raises(ValueError):
        S.read_csv_with_rejects(spark, tmp, schema, max_rejects=0)


def test_insert_by_name_does_not_swap_columns(spark, tmp):
    spark.sql(f"CREATE TABLE fx_t (base STRING, eur DOUBLE, usd DOUBLE, nzd DOUBLE, gbp DOUBLE, jpy DOUBLE, "
              f"cad DOUBLE) USING parquet LOCATION '{tmp}/fx'")
    batch = spark.createDataFrame([("EUR", 1.0, 2.0, 3.0, 4.0, 5.0, 6.0)],
                                  "base string, eur double, usd double, cad double, gbp double, jpy double, nzd double")
    W.insert_by_name(spark, batch, "fx_t")
    r = spark.table("fx_t").first()
    assert (r.cad, r.nzd) == (3.0, 6.0)  # a positional insert would have swapped them


def test_idempotent_append_latest_rule_fill_and_rerun(spark, tmp):
    spark.sql(f"CREATE TABLE fx2 (base STRING, last_update DATE, eur DOUBLE, usd DOUBLE) USING parquet "
              f"LOCATION '{tmp}/fx2'")
    rows = [("EUR", dt.date(2021, 1, 1), None, 1.1, 1), ("EUR", dt.date(2021, 1, 1), None, 1.2, 2),
            ("USD", dt.date(2021, 1, 1), 0.9, None, 3)]
    batch = spark.createDataFrame(rows, "base string, last_update date, eur double, usd double, seq int")
    for _ in range(2):
        idempotent_append(spark, batch, "fx2", ["base", "last_update"], ["seq"], fill=["eur", "usd"])
    got = sorted((r.base, r.eur, r.usd) for r in spark.table("fx2").collect())
    assert got == [("EUR", 0.0, 1.2), ("USD", 0.9, 0.0)]  # missing self-rate is 0, second run adds nothing


def test_json_round_trip_keeps_microseconds(spark, tmp):
    ts = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    df = spark.createDataFrame([(1, ts)], "id int, ts timestamp_ntz")
    W.write_json(df, tmp + "/j")
    assert S.read_json_lines(spark, tmp + "/j", "id int, ts timestamp_ntz").first().ts == ts


def test_partitioned_write_prunes(spark, tmp):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 5)), (2, dt.datetime(2024, 1, 2, 6))],
                               "id int, ts timestamp_ntz")
    W.write_partitioned(W.with_time_partitions(df, "ts", "day"), tmp + "/p", ["ts_day"])
    back = spark.read.parquet(tmp + "/p").where(F.col("ts_day") == F.lit("2024-01-02").cast("date"))
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ts_day" in plan
    assert [r.id for r in back.collect()] == [2]


def test_epoch_helpers_ignore_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("2024-01-01 00:00:07.5",), ("1969-12-31 23:59:59.5",)], "s string")
        out = df.select(X.epoch_seconds(F.to_timestamp_ntz("s")).alias("e")).collect()
        assert [r.e for r in out] == [1704067207, -1]  # floor, like epoch() in SQL engines
        back = df.select(X.from_epoch(F.lit(1704067207)).alias("t")).first().t
        assert back == dt.datetime(2024, 1, 1, 0, 0, 7)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_string_template_null_propagates(spark):
    df = spark.createDataFrame([("ann", 30), (None, 40)], "name string, age int")
    out = [r[0] for r in df.select(X.string_template("%s is %d", "name", "age")).collect()]
    assert out == ["ann is 30", None]


def test_idempotent_append_loads_rows_without_a_key_or_range_value_once(spark, tmp):
    spark.sql("DROP TABLE IF EXISTS fx_null")
    spark.sql(f"CREATE TABLE fx_null (base string, day date, v double) USING parquet LOCATION '{tmp}/fx_null'")
    batch = spark.createDataFrame([("EUR", None, 1.0, 1), (None, None, 2.0, 1)], "base string, day date, v double, seq int")
    for n in (2, 0):
        got = idempotent_append(spark, batch, "fx_null", ["base", "day"], ["seq"], range_col="day")
        assert got.count() == n and spark.table("fx_null").count() == 2


def test_rejects_do_not_depend_on_what_is_selected(spark, tmp):
    from pyspark.sql import types as T

    from shoal.sources.files import read_csv_with_rejects
    with open(f"{tmp}/r.csv", "w") as f:
        f.write("a,b\n1,2\n2,x\n3,4\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    with pytest.raises(ValueError):
        read_csv_with_rejects(spark, f"{tmp}/r.csv", schema, max_rejects=0)
    good, bad = read_csv_with_rejects(spark, f"{tmp}/r.csv", schema, max_rejects=1)
    assert good.count() == 2 and good.select("a").count() == 2 and [r["a"] for r in good.select("a").orderBy("a").collect()] == [1, 3]
    assert bad.count() == 1 and bad.first()["_corrupt_record"] == "2,x"
