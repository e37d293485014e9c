"""Registered queries: projections, predicates and scalar functions (group C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoal import functions as X
from shoal.operators import histogram as H
from shoal.operators import relational as R
from shoal.plans.base import load, query
from shoal.sinks import write_csv
from shoal.sources import cast_table, read_csv_landing
from shoal.session import scratch_path


@query("project_columns", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def project_columns(spark, sf):
    return load(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")


@query("project_by_position", "SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem")
def project_by_position(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.select(*[li.columns[i] for i in (0, 4, 5)])


@query("nested_path", "SELECT event_id, value, user_id AS user FROM events")
def nested_path(spark, sf):
    ev = load(spark, sf, "events")
    nested = ev.select("event_id", F.struct(F.col("value").alias("VALUE"), F.col("user_id").alias("USER")).alias("rates"))
    # lower-case paths resolve against upper-case fields (spark.sql.caseSensitive=false)
    return nested.select("event_id", F.col("rates.value").alias("value"), F.col("rates.user").alias("user"))


@query("derived_sum", """
SELECT l_orderkey, l_linenumber, l_quantity, l_tax, round(l_quantity + l_tax, 4) AS qty_plus_tax FROM lineitem
""")
def derived_sum(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax",
                     F.round(F.col("l_quantity") + F.col("l_tax"), 4).alias("qty_plus_tax"))


@query("safe_ratio", """
SELECT l_orderkey, l_linenumber, l_discount,
       round(l_extendedprice / NULLIF(l_discount, 0), 2) AS price_per_discount,
       CAST(l_extendedprice / NULLIF(l_discount, 0) AS FLOAT) AS ratio_float
FROM lineitem
""")
def safe_ratio(spark, sf):
    li = load(spark, sf, "lineitem")
    r = X.safe_ratio("l_extendedprice", "l_discount")
    return li.select("l_orderkey", "l_linenumber", "l_discount", F.round(r, 2).alias("price_per_discount"),
                     r.cast("float").alias("ratio_float"))


@query("string_template", """
SELECT c_custkey, printf('%s in segment %s (nation %d)', c_name, c_mktsegment, c_nationkey) AS label FROM customer
""")
def string_template(spark, sf):
    cu = load(spark, sf, "customer")
    return cu.select("c_custkey", X.string_template("%s in segment %s (nation %d)", "c_name", "c_mktsegment",
                                                    "c_nationkey").alias("label"))


@query("threshold_flag", """
SELECT p_partkey, p_size, CASE WHEN p_size > 21 THEN 'true' ELSE 'false' END AS large FROM part
""")
def threshold_flag(spark, sf):
    return load(spark, sf, "part").select("p_partkey", "p_size", X.threshold_flag("p_size", 21).alias("large"))


@query("filter_compound", """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag, l_shipdate FROM lineitem
WHERE (l_quantity >= 45 AND l_discount > 0.05) OR (l_returnflag = 'R' AND l_shipdate < TIMESTAMP '1996-01-01')
""")
def filter_compound(spark, sf):
    li = load(spark, sf, "lineitem")
    p = ((F.col("l_quantity") >= 45) & (F.col("l_discount") > 0.05)) | (
        (F.col("l_returnflag") == "R") & (F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz")))
    return li.where(p).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag", "l_shipdate")


@query("filter_time_from", """
SELECT event_id, ts, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'
""")
def filter_time_from(spark, sf):
    ev = load(spark, sf, "events")
    return ev.where(F.col("ts") >= F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")).select(
        "event_id", "ts", "event_type", "value")


@query("date_parts", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day
FROM orders
""")
def date_parts(spark, sf):
    od = load(spark, sf, "orders")
    text = od.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))
    return text.select("o_orderkey", *X.date_parts("d", "yyyy-MM-dd", strict=True))


@query("clock12_parse", """
SELECT event_id, date_trunc('minute', ts) AS parsed FROM events
""")
def clock12_parse(spark, sf):
    ev = load(spark, sf, "events")
    text = ev.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("d"), F.date_format("ts", "h:mm a").alias("t"))
    return text.select("event_id", X.clock12_timestamp("d", "t").alias("parsed"))


@query("epoch_to_timestamp", """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch, date_trunc('second', ts) AS ts_back FROM events
""")
def epoch_to_timestamp(spark, sf):
    ev = load(spark, sf, "events")
    e = X.epoch_seconds("ts")
    return ev.select("event_id", e.alias("epoch"), X.from_epoch(e).alias("ts_back"))


@query("cast_table", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       0 AS cast_errors
FROM orders
""")
def cast_table_q(spark, sf):
    path = scratch_path(spark, "cast_table")
    od = load(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"))
    write_csv(od, path)
    landed = read_csv_landing(spark, path, od.columns)
    schema = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
              "o_totalprice": "double", "o_orderdate": "date"}
    return cast_table(landed, schema, {"o_orderdate": "yyyy-MM-dd HH:mm:ss"}, with_errors=True)


@query("replace_char", "SELECT c_custkey, replace(c_name, '#', '_') AS c_name FROM customer")
def replace_char(spark, sf):
    return load(spark, sf, "customer").select("c_custkey", X.replace_char("c_name", "#", "_").alias("c_name"))


def _event_arrays(spark, sf):
    """Per event a two-element JSON array as text; error events carry Python-style
    text with ``None`` that must be quarantined, not repaired by blanket replace."""
    ev = load(spark, sf, "events")
    good = F.concat(F.lit("["), F.col("props"), F.lit(", {'k': "), F.col("user_id").cast("string"), F.lit("}]"))
    bad = F.concat(F.lit("[{'k': None}, {'k': "), F.col("user_id").cast("string"), F.lit("}]"))
    return ev.select("event_id", F.when(F.col("event_type") == "error", bad).otherwise(good).alias("doc"))


@query("json_shred", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE event_type <> 'error'
UNION ALL
SELECT event_id, CAST(user_id AS INTEGER) AS k FROM events WHERE event_type <> 'error'
""")
def json_shred(spark, sf):
    rows, _quarantine = X.json_shred(_event_arrays(spark, sf), "doc", "k int", {"k": "k"}, keep=["event_id"])
    return rows


@query("json_quarantine", "SELECT event_id FROM events WHERE event_type = 'error'")
def json_quarantine(spark, sf):
    _rows, quarantine = X.json_shred(_event_arrays(spark, sf), "doc", "k int", {"k": "k"}, keep=["event_id"])
    return quarantine.select("event_id")


@query("json_element_rejects", """
WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, user_id, event_type FROM events)
SELECT event_id, CAST(NULL AS INTEGER) AS pos, k, user_id AS u, CAST(NULL AS VARCHAR) AS path, CAST(NULL AS VARCHAR) AS value FROM e
UNION ALL
SELECT event_id, NULL, NULL, user_id, NULL, NULL FROM e WHERE event_type = 'click'
UNION ALL
SELECT event_id, NULL, k + 1, NULL, NULL, NULL FROM e WHERE event_type NOT IN ('click', 'error', 'view')
UNION ALL
SELECT event_id, 1, NULL, NULL, '$.k', 'n/a' FROM e WHERE event_type = 'error'
UNION ALL
SELECT event_id, 1, NULL, NULL, '$.u', 'unknown' FROM e WHERE event_type = 'error'
UNION ALL
SELECT event_id, 1, NULL, NULL, '$.k', '[]' FROM e WHERE event_type = 'view'
""")
def json_element_rejects(spark, sf):
    """Rows of good elements and rejects of bad ones, by place, path and value. Documents have two elements; of the second one value is
    absent for clicks, null for others, wrong in one path for views and in two for errors."""
    ev = load(spark, sf, "events").select("event_id", "user_id", "event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    second = (F.when(F.col("event_type") == "click", F.format_string('{"u": %d}', "user_id"))
              .when(F.col("event_type") == "error", F.lit('{"k": "n/a", "u": "unknown"}'))
              .when(F.col("event_type") == "view", F.format_string('{"k": [], "u": %d}', "user_id"))
              .otherwise(F.format_string('{"k": %d, "u": null}', F.col("k") + 1)))
    docs = ev.select("event_id", F.concat(F.lit("["), F.format_string('{"k": %d, "u": %d}', "k", "user_id"), F.lit(", "), second, F.lit("]")).alias("doc"))
    rows, rejects = X.variant_shred(docs, "doc", {"k": ("$.k", "int"), "u": ("$.u", "bigint")}, keep=["event_id"])
    return rows.unionByName(rejects, allowMissingColumns=True).select("event_id", "pos", "k", "u", "path", "value")


def _left_joined_totals(spark, sf):
    cu = load(spark, sf, "customer").select("c_custkey")
    pend = (load(spark, sf, "orders").where(F.col("o_orderstatus") == "P")
            .groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("pending_total")))
    return cu.join(pend, cu.c_custkey == pend.o_custkey, "left").select("c_custkey", "pending_total")


_LEFT_TOTALS = """
WITH p AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS pending_total FROM orders
           WHERE o_orderstatus = 'P' GROUP BY o_custkey)
"""


@query("fill_zero", _LEFT_TOTALS + """
SELECT c_custkey, coalesce(pending_total, 0) AS pending_total FROM customer LEFT JOIN p ON c_custkey = o_custkey
""")
def fill_zero(spark, sf):
    return R.fill_zero(_left_joined_totals(spark, sf), ["PENDING_TOTAL"])


@query("drop_missing", _LEFT_TOTALS + """
SELECT c_custkey, pending_total FROM customer JOIN p ON c_custkey = o_custkey
""")
def drop_missing(spark, sf):
    return R.drop_missing(_left_joined_totals(spark, sf))


@query("null_mask", _LEFT_TOTALS + """
SELECT c_custkey, pending_total IS NULL AS pending_total_isnull FROM customer LEFT JOIN p ON c_custkey = o_custkey
""")
def null_mask(spark, sf):
    return R.null_mask(_left_joined_totals(spark, sf), ["pending_total"], keep=["c_custkey"])


@query("zscore_filter", """
WITH s AS (SELECT avg(value) AS mu, stddev_pop(value) AS sd FROM events)
SELECT event_id, value FROM events, s WHERE abs(value - mu) / sd < 3 AND value > 0
""")
def zscore_filter(spark, sf):
    return H.zscore_filter(load(spark, sf, "events"), "value").select("event_id", "value")


@query("stddev_band_filter", """
WITH s AS (SELECT stddev_pop(value) AS sd FROM events)
SELECT event_id, value FROM events, s WHERE value > 0 AND value < sd * 3
""")
def stddev_band_filter(spark, sf):
    return H.stddev_band_filter(load(spark, sf, "events"), "value").select("event_id", "value")


# Priority classes used by the lookup query.
PRIORITY_CLASSES = {"expedite": ["1-URGENT", "2-HIGH"], "standard": ["3-MEDIUM", "4-NOT SPECIFIED"]}


@query("classify_lookup", """
SELECT o_orderkey, o_orderpriority,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'expedite'
            WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'standard' END AS class
FROM orders
""")
def classify_lookup(spark, sf):
    od = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return R.classify(od, "o_orderpriority", PRIORITY_CLASSES)


@query("map_lookup", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(NULL AS INTEGER) AS missing FROM events
""")
def map_lookup(spark, sf):
    ev = load(spark, sf, "events")
    m = F.from_json("props", "map<string,int>")
    return ev.select("event_id", F.try_element_at(m, F.lit("k")).alias("k"),
                     F.try_element_at(m, F.lit("absent")).alias("missing"))


@query("array_column", """
SELECT o_orderkey, o_orderstatus || '|' || o_orderpriority AS tags_text, 2 AS n_tags, DATE '2024-01-01' AS as_of
FROM orders
""")
def array_column(spark, sf):
    od = load(spark, sf, "orders")
    tags = F.array("o_orderstatus", "o_orderpriority")
    return od.select("o_orderkey", F.array_join(tags, "|").alias("tags_text"), F.size(tags).alias("n_tags"),
                     F.lit("2024-01-01").cast("date").alias("as_of"))


@query("filter_is_null", _LEFT_TOTALS + """
SELECT c_custkey FROM customer LEFT JOIN p ON c_custkey = o_custkey WHERE pending_total IS NULL
""")
def filter_is_null(spark, sf):
    t = _left_joined_totals(spark, sf)
    return t.where(F.col("pending_total").isNull()).select("c_custkey")
