"""Registered queries: aggregations and statistics (group D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoal.operators import histogram as H
from shoal.operators import quantiles as Q
from shoal.operators import stats as S
from shoal.operators import text as TX
from shoal.plans.base import load, query
from shoal.session import scratch_path


@query("group_agg", """
SELECT l_returnflag, l_linestatus,
       sum(l_quantity) AS sum_qty,
       round(sum(l_extendedprice), 2) AS sum_base_price,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
       round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge,
       round(avg(l_quantity), 4) AS avg_qty,
       round(avg(l_extendedprice), 4) AS avg_price,
       round(avg(l_discount), 4) AS avg_disc,
       count(*) AS count_order
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def group_agg(spark, sf):
    li = load(spark, sf, "lineitem")
    disc = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return S.group_agg(li, ["l_returnflag", "l_linestatus"], {
        "sum_qty": F.sum("l_quantity"),
        "sum_base_price": F.round(F.sum("l_extendedprice"), 2),
        "sum_disc_price": F.round(F.sum(disc), 2),
        "sum_charge": F.round(F.sum(disc * (1 + F.col("l_tax"))), 2),
        "avg_qty": F.round(F.avg("l_quantity"), 4),
        "avg_price": F.round(F.avg("l_extendedprice"), 4),
        "avg_disc": F.round(F.avg("l_discount"), 4),
        "count_order": F.count(F.lit(1)),
    })


@query("group_count", """
SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment
""")
def group_count(spark, sf):
    return load(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("global_stats", """
SELECT round(avg(l_extendedprice), 4) AS mean, min(l_extendedprice) AS min, max(l_extendedprice) AS max,
       round(sum(l_extendedprice), 2) AS sum, count(l_extendedprice) AS n
FROM lineitem
""")
def global_stats(spark, sf):
    return S.global_stats(load(spark, sf, "lineitem"), "l_extendedprice")


@query("count_rows", """
SELECT count(*) AS n_rows, 11 AS n_cols FROM lineitem
""")
def count_rows(spark, sf):
    return S.shape(load(spark, sf, "lineitem"))


@query("dispersion", """
SELECT round(var_pop(o_totalprice), 4) AS var_pop, round(stddev_pop(o_totalprice), 4) AS std_pop,
       round(var_samp(o_totalprice), 4) AS var_samp, round(stddev_samp(o_totalprice), 4) AS std_samp
FROM orders
""")
def dispersion(spark, sf):
    return S.dispersion(load(spark, sf, "orders"), "o_totalprice")


@query("median_quartiles", """
SELECT round(quantile_cont(o_totalprice, 0.25), 4) AS q25, round(quantile_cont(o_totalprice, 0.5), 4) AS median,
       round(quantile_cont(o_totalprice, 0.75), 4) AS q75
FROM orders
""")
def median_quartiles(spark, sf):
    return Q.quantile_table(load(spark, sf, "orders"), "o_totalprice", {"q25": 0.25, "median": 0.5, "q75": 0.75})


@query("describe_table", """
SELECT count(o_totalprice) AS count, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std,
       round(min(o_totalprice), 4) AS min, round(quantile_cont(o_totalprice, 0.25), 4) AS q25,
       round(quantile_cont(o_totalprice, 0.5), 4) AS q50, round(quantile_cont(o_totalprice, 0.75), 4) AS q75,
       round(max(o_totalprice), 4) AS max
FROM orders
""")
def describe_table(spark, sf):
    return Q.describe(load(spark, sf, "orders"), "o_totalprice")


@query("argmin_argmax", """
SELECT arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS argmin, min(o_totalprice) AS min_value,
       arg_min(o_orderkey, (-o_totalprice, o_orderkey)) AS argmax, max(o_totalprice) AS max_value
FROM orders
""")
def argmin_argmax(spark, sf):
    return S.argmin_argmax(load(spark, sf, "orders"), "o_totalprice", "o_orderkey")


@query("distinct_values", """
SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL
""")
def distinct_values(spark, sf):
    return S.distinct_values(load(spark, sf, "part"), "p_brand")


@query("count_distinct", """
SELECT l_returnflag, count(DISTINCT l_suppkey) AS n_suppliers, count(DISTINCT l_partkey) AS n_parts
FROM lineitem GROUP BY 1
""")
def count_distinct(spark, sf):
    """Distinct members per group: pairs are made distinct first, so a hot group is spread over its members."""
    li = load(spark, sf, "lineitem")
    counted = [li.select("l_returnflag", c).distinct().groupBy("l_returnflag").agg(F.count(c).alias(n))
               for c, n in (("l_suppkey", "n_suppliers"), ("l_partkey", "n_parts"))]
    return counted[0].join(counted[1], "l_returnflag")


@query("most_common", """
SELECT o_orderpriority AS value, count(*) AS frequency FROM orders
GROUP BY o_orderpriority ORDER BY frequency DESC, value LIMIT 1
""")
def most_common(spark, sf):
    return S.most_common(load(spark, sf, "orders"), "o_orderpriority")


@query("word_count", r"""
SELECT word, count(*) AS count
FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS word FROM documents)
WHERE word <> '' GROUP BY word
""")
def word_count(spark, sf):
    return TX.word_count(load(spark, sf, "documents"))


@query("top_words", r"""
SELECT word, count(*) AS count
FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS word FROM documents)
WHERE word <> '' GROUP BY word ORDER BY count DESC, word LIMIT 25
""")
def top_words(spark, sf):
    return TX.top_words(load(spark, sf, "documents"), 25)


@query("histogram_bins", """
WITH b AS (SELECT CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
                  CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi FROM events),
     c AS (SELECT least(CAST(floor((value - lo) / ((hi - lo) / 22)) AS INTEGER) + 1, 22) AS bin, count(*) AS n
           FROM events, b GROUP BY 1)
SELECT CAST(r.bin AS INTEGER) AS bin, round(lo + (r.bin - 1) * ((hi - lo) / 22), 4) AS lower,
       round(lo + r.bin * ((hi - lo) / 22), 4) AS upper, coalesce(c.n, 0) AS n
FROM (SELECT range AS bin FROM range(1, 23)) r CROSS JOIN b LEFT JOIN c ON c.bin = r.bin
""")
def histogram_bins(spark, sf):
    return H.histogram(load(spark, sf, "events"), "value", 22)


@query("column_profile", """
SELECT * FROM (VALUES
  ('c_custkey', 'bigint', (SELECT count(c_custkey) FROM customer)),
  ('c_name', 'string', (SELECT count(c_name) FROM customer)),
  ('c_nationkey', 'int', (SELECT count(c_nationkey) FROM customer)),
  ('c_acctbal', 'double', (SELECT count(c_acctbal) FROM customer)),
  ('c_mktsegment', 'string', (SELECT count(c_mktsegment) FROM customer))
) AS t(column_name, data_type, non_null)
""")
def column_profile(spark, sf):
    return S.column_profile(load(spark, sf, "customer"))


@query("dot_product", """
SELECT round(sum(l_quantity * l_extendedprice), 2) AS dot FROM lineitem
""")
def dot_product(spark, sf):
    return S.dot_product(load(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")


@query("annual_collapse", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
       arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice,
       max(o_orderdate) AS as_of
FROM orders GROUP BY 1
""")
def annual_collapse(spark, sf):
    return S.last_per_period(load(spark, sf, "orders"), "o_orderdate", "o_totalprice", "o_orderkey", "year")


@query("file_stats")
def file_stats(spark, sf):
    """Per data-file record count, NULL count and bounds of orders written as several files."""
    from shoal.tables.maintenance import file_statistics

    path = scratch_path(spark, "file_stats")
    load(spark, sf, "orders").repartition(4, "o_custkey").write.parquet(path)
    return file_statistics(spark.read.parquet(path), ["o_totalprice", "o_orderdate"])
