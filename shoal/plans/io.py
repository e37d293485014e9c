"""Registered queries: sources and sinks as round trips (groups A and B).

Each writes a driver table (or a projection) in the format under test into a
fresh location below the session's checkpoint folder, reads it back with the
reader under test, and returns what was read, so the oracle can state the
expected rows over the source table.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal import sinks as W
from shoal import sources as S
from shoal.plans.base import load, query
from shoal.sinks import layout as L
from shoal.session import scratch_path

_ORDER_TEXT_COLS = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


@query("csv_landing", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority
FROM orders
""")
def csv_landing(spark, sf):
    path = scratch_path(spark, "csv_landing")
    od = load(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"), "o_orderpriority")
    W.write_csv(od, path)
    return S.read_csv_landing(spark, path, _ORDER_TEXT_COLS)


@query("packed_list_explode", """
SELECT p_partkey, word FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part) WHERE word <> ''
""")
def packed_list_explode(spark, sf):
    path = scratch_path(spark, "packed_list")
    W.write_csv(load(spark, sf, "part").select("p_partkey", "p_name"), path, sep=";")
    landed = S.read_csv_landing(spark, path, ["p_partkey", "p_name"], sep=";")
    out = S.split_packed_list(landed, "p_name", "word", " ")
    return out.select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "word")


_CUSTOMER_TYPES = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
                   "c_mktsegment": "string"}


@query("csv_typed_read", "SELECT * FROM customer")
def csv_typed_read(spark, sf):
    path = scratch_path(spark, "csv_typed")
    W.write_csv(load(spark, sf, "customer"), path)
    return S.read_csv_typed(spark, path, _CUSTOMER_TYPES)


@query("csv_reject_split", """
SELECT l_orderkey, l_partkey, l_linenumber,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS l_quantity,
       l_linenumber = 7 AS rejected
FROM lineitem
""")
def csv_reject_split(spark, sf):
    """Lines whose quantity text is not a number are rejected (kept apart with the
    raw line); the rest load typed. The threshold is set above the bad count."""
    path = scratch_path(spark, "csv_rejects")
    li = load(spark, sf, "lineitem")
    text = li.select("l_orderkey", "l_partkey", "l_linenumber",
                     F.when(F.col("l_linenumber") == 7, F.lit("x")).otherwise(F.col("l_quantity").cast("string"))
                     .alias("l_quantity"))
    W.write_csv(text, path)
    schema = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
                           T.StructField("l_linenumber", T.IntegerType()),
                           T.StructField("l_quantity", T.DoubleType())])
    good, rejected = S.read_csv_with_rejects(spark, path, schema, max_rejects=10**12)
    return (good.withColumn("rejected", F.lit(False))
            .unionByName(rejected.drop(S.CORRUPT).withColumn("rejected", F.lit(True))))


@query("csv_reject_lines", """
SELECT o_orderpriority AS folder, CAST(line AS BIGINT) AS line, o_orderkey || ',' || o_custkey || ',x' AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) + 1 AS line FROM orders) WHERE o_custkey % 50 = 0
""")
def csv_reject_lines(spark, sf):
    """The file and line of each rejected line: orders written as one CSV file with a header for each priority, with a price that is no
    number for some customers."""
    path = scratch_path(spark, "csv_reject_lines")
    price = F.when(F.col("o_custkey") % 50 == 0, F.lit("x")).otherwise(F.col("o_totalprice").cast("string"))
    text = load(spark, sf, "orders").select("o_orderpriority", "o_orderkey", "o_custkey", price.alias("o_totalprice"))
    (text.repartition("o_orderpriority").sortWithinPartitions("o_orderpriority", "o_orderkey")
     .write.partitionBy("o_orderpriority").option("header", True).csv(path))
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                           T.StructField("o_totalprice", T.DoubleType())])
    _good, rejects = S.read_csv_numbered(spark, path, schema, max_rejects=None)
    folder = F.replace(F.regexp_extract("file", "o_orderpriority=([^/]+)/", 1), F.lit("%20"), F.lit(" "))
    return rejects.select(folder.alias("folder"), "line", "value")


_EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@query("json_multiline_read", "SELECT event_id, ts, user_id, event_type, value FROM events")
def json_multiline_read(spark, sf):
    """Events as pretty-printed JSON array documents (one document spans many
    lines). Documents hold a bounded number of rows each, so the unsplittable
    multi-line files are many and small."""
    path = scratch_path(spark, "json_multiline")
    ev = load(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    W.write_json_array_documents(ev.withColumn("_spread", F.col("event_id")), path, "_spread")
    back = S.read_json_documents(spark, path, "event_id bigint, ts timestamp_ntz, user_id bigint, "
                                              "event_type string, value double")
    return back.drop("doc")


@query("json_lines_read", "SELECT * FROM events")
def json_lines_read(spark, sf):
    path = scratch_path(spark, "json_lines")
    W.write_json(load(spark, sf, "events"), path)
    return S.read_json_lines(spark, path, _EVENT_SCHEMA)


@query("json_text_rows", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")
def json_text_rows(spark, sf):
    ev = load(spark, sf, "events")
    return ev.select("event_id", F.from_json("props", "struct<k:int>").alias("p")).select("event_id", "p.k")


@query("parquet_read", "SELECT * FROM lineitem")
def parquet_read(spark, sf):
    return S.read_parquet(spark, f"{sf}/lineitem.parquet")


@query("text_lines", r"""
SELECT count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
""")
def text_lines(spark, sf):
    """Documents written as plain text and read back one record per line."""
    path = scratch_path(spark, "text_lines")
    load(spark, sf, "documents").select("text").write.text(path)
    lines = S.read_text_lines(spark, path)
    return lines.agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).cast("bigint").alias("n_chars"))


# Service-level days per order priority (an inline VALUES table).
SLA_DAYS = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 5), ("4-NOT SPECIFIED", 10), ("5-LOW", 20)]


@query("inline_values", """
SELECT o_orderpriority, sla_days, count(*) AS n_orders
FROM orders JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 5), ('4-NOT SPECIFIED', 10), ('5-LOW', 20))
     AS s(priority, sla_days) ON o_orderpriority = priority
GROUP BY o_orderpriority, sla_days
""")
def inline_values(spark, sf):
    # a literal relation: no job, no Python rows, its size is known to the planner
    rows = ", ".join(f"('{p}', {d})" for p, d in SLA_DAYS)
    sla = spark.sql(f"SELECT * FROM VALUES {rows} AS sla(priority, sla_days)")
    counts = load(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"))
    return counts.join(F.broadcast(sla), counts.o_orderpriority == sla.priority).select(
        "o_orderpriority", "sla_days", "n_orders")


@query("csv_roundtrip", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv_roundtrip")
    W.write_csv(load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"), path)
    return S.read_csv_typed(spark, path, {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double",
                                          "o_orderpriority": "string"})


@query("csv_wide_sep", "SELECT event_id, user_id, event_type, value, props FROM events")
def csv_wide_sep(spark, sf):
    path = scratch_path(spark, "csv_wide_sep")
    W.write_csv(load(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "props"), path,
                sep=", ")
    return S.read_csv_typed(spark, path, {"event_id": "bigint", "user_id": "bigint", "event_type": "string",
                                          "value": "double", "props": "string"}, sep=", ")


@query("json_roundtrip", "SELECT event_id, user_id, event_type, value, ts FROM events")
def json_roundtrip(spark, sf):
    path = scratch_path(spark, "json_roundtrip")
    ev = load(spark, sf, "events").select("event_id", F.struct("user_id", "event_type").alias("who"), "value", "ts")
    W.write_json(ev, path)
    back = S.read_json_lines(spark, path, "event_id bigint, who struct<user_id: bigint, event_type: string>, "
                                          "value double, ts timestamp_ntz")
    return back.select("event_id", "who.user_id", "who.event_type", "value", "ts")


@query("nested_to_csv", """
SELECT c_custkey, c_name, c_mktsegment, c_nationkey FROM customer
""")
def nested_to_csv(spark, sf):
    """A struct column written to CSV as JSON text (in parallel) and parsed back."""
    path = scratch_path(spark, "nested_csv")
    cu = load(spark, sf, "customer").select(
        "c_custkey", F.struct("c_name", "c_mktsegment", "c_nationkey").alias("info"))
    W.write_csv(W.flatten_nested_as_json(cu), path)
    back = S.read_csv_landing(spark, path, ["c_custkey", "info"])
    info = F.from_json("info", "c_name string, c_mktsegment string, c_nationkey int")
    return back.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), info.alias("i")).select(
        "c_custkey", "i.c_name", "i.c_mktsegment", "i.c_nationkey")


@query("table_append", "SELECT * FROM orders")
def table_append(spark, sf):
    name = _table_name("orders_t")
    od = load(spark, sf, "orders")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    W.save_table(od.where(F.col("o_orderdate") < cut), name, path=scratch_path(spark, name))
    W.save_table(od.where(F.col("o_orderdate") >= cut), name, mode="append")
    return spark.table(name)


@query("insert_by_name", "SELECT * FROM nation")
def insert_by_name(spark, sf):
    name = _table_name("nation_t")
    spark.sql(f"CREATE TABLE {name} (n_nationkey INT, n_name STRING, n_regionkey INT) USING parquet "
              f"LOCATION '{scratch_path(spark, name)}'")
    permuted = load(spark, sf, "nation").select("n_regionkey", "n_name", "n_nationkey")
    W.insert_by_name(spark, permuted, name)
    return spark.table(name)


@query("external_csv_table", "SELECT * FROM supplier")
def external_csv_table(spark, sf):
    name = _table_name("supplier_ext")
    path = scratch_path(spark, name)
    W.write_csv(load(spark, sf, "supplier"), path, header=False)
    W.create_external_csv_table(spark, name, "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
                                path)
    return spark.table(name)


@query("insert_values", """
SELECT * FROM region UNION ALL SELECT * FROM (VALUES (100, 'ARCTIC'), (101, 'ANTARCTIC')) t(r_regionkey, r_name)
""")
def insert_values(spark, sf):
    name = _table_name("region_t")
    W.save_table(load(spark, sf, "region"), name, path=scratch_path(spark, name))
    spark.sql(f"INSERT INTO {name} VALUES (100, 'ARCTIC'), (101, 'ANTARCTIC')")
    return spark.table(name)


@query("truncate_reload", "SELECT * FROM region")
def truncate_reload(spark, sf):
    db = _table_name("lake_db")
    W.create_database_if_absent(spark, db, scratch_path(spark, db))
    name = f"{db}.region_t"
    W.drop_table_if_exists(spark, name)
    W.save_table(load(spark, sf, "region"), name)
    W.truncate_table(spark, name)
    if spark.table(name).count() != 0:
        raise AssertionError("truncate left rows behind")
    W.insert_by_name(spark, load(spark, sf, "region"), name)
    return spark.table(name)


@query("partitioned_write", """
SELECT CAST(ts AS DATE) AS ts_day, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2
""")
def partitioned_write(spark, sf):
    path = scratch_path(spark, "partitioned")
    ev = W.with_time_partitions(load(spark, sf, "events"), "ts", "day")
    W.write_partitioned(ev, path, ["ts_day", "event_type"])
    back = spark.read.parquet(path)
    return back.groupBy("ts_day", "event_type").agg(F.count(F.lit(1)).alias("n"),
                                                    F.round(F.sum("value"), 2).alias("total"))


@query("partition_pruned_read", """
SELECT event_id, event_type, value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15' AND event_type = 'click'
""")
def partition_pruned_read(spark, sf):
    """Read of one (day, type) partition: both predicates prune directories."""
    path = scratch_path(spark, "pruned")
    ev = W.with_time_partitions(load(spark, sf, "events"), "ts", "day")
    W.write_partitioned(ev, path, ["ts_day", "event_type"])
    back = spark.read.parquet(path)
    return back.where((F.col("ts_day") == F.lit("2024-01-15").cast("date")) & (F.col("event_type") == "click")) \
        .select("event_id", "event_type", "value")


@query("clustered_write", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def clustered_write(spark, sf):
    path = scratch_path(spark, "clustered")
    W.write_clustered(load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), path,
                      ["o_custkey"])
    return spark.read.parquet(path)


@query("single_file_csv", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def single_file_csv(spark, sf):
    """A small aggregated result written as one CSV file (one row per market segment)."""
    path = scratch_path(spark, "single_csv")
    counts = load(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    W.write_single_csv(counts, path)
    files = [f for f in spark.read.text(path).inputFiles()]
    if len(files) != 1:
        raise AssertionError(f"expected one file, got {len(files)}")
    return S.read_csv_typed(spark, path, {"c_mktsegment": "string", "n": "bigint"})


@query("table_by_identifier", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def table_by_identifier(spark, sf):
    """Load a table by identifier and the same data by format + path."""
    name = _table_name("orders_id")
    path = scratch_path(spark, name)
    W.save_table(load(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), name, path=path)
    by_name = S.read_table(spark, name)
    by_path = S.read_table(spark, fmt="parquet", path=path)
    if by_name.count() != by_path.count():
        raise AssertionError("identifier and path disagree")
    return by_name.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("bucketed_join", """
SELECT o_orderkey, o_custkey, count(*) AS n_lines, round(sum(l_extendedprice), 2) AS amount
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_custkey
""")
def bucketed_join(spark, sf):
    """Orders and lines stored in buckets of the order key, joined and summed where they lie: the plan has no exchange."""
    names = {}
    for table, key, columns in (("orders", "o_orderkey", ["o_orderkey", "o_custkey"]), ("lineitem", "l_orderkey", ["l_orderkey", "l_extendedprice"])):
        names[table] = _table_name(f"bucketed_{table}")
        L.save_bucketed(load(spark, sf, table).select(*columns), names[table], 8, [key], path=scratch_path(spark, names[table]))
    orders, lines = spark.table(names["orders"]).hint("merge"), spark.table(names["lineitem"])
    return (orders.join(lines, orders.o_orderkey == lines.l_orderkey).groupBy("o_orderkey", "o_custkey")
            .agg(F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_extendedprice"), 2).alias("amount")))


@query("compact_files", """
SELECT l_returnflag, count(*) AS n_rows, round(sum(l_quantity), 2) AS quantity, true AS fewer_files, true AS none_small FROM lineitem GROUP BY 1
""")
def compact_files(spark, sf):
    """Lines in many small files by return flag, compacted to a tenth of a folder: the rows are the same, files are fewer, and no folder
    has two files left that would fit into one."""
    path = scratch_path(spark, "compact")
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag")
    with L.open_files(spark, 8):
        lines.repartition(24).write.partitionBy("l_returnflag").parquet(path)
    before = L.file_sizes(spark, path).groupBy("folder").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes")).collect()
    target = max(1, max(r["bytes"] for r in before) // 4)
    L.compact_files(spark, path, target)
    after = {r["folder"]: r for r in L.file_sizes(spark, path).groupBy("folder").agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("length")).alias("sizes")).collect()}
    fewer = all(after[r["folder"]]["n"] < r["n"] for r in before)
    none = all(len(r["sizes"]) == 1 or sum(r["sizes"][:2]) > 0.5 * target for r in after.values())
    return (spark.read.parquet(path).groupBy("l_returnflag")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
            .withColumns({"fewer_files": F.lit(fewer), "none_small": F.lit(none)}))


@query("indexed_read", """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1997-03-31'
""")
def indexed_read(spark, sf):
    """Orders clustered by date, a table of their files' bounds, and a month read through it: other files are not opened."""
    path = scratch_path(spark, "indexed")
    W.write_clustered(load(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice"), path, ["o_orderdate"], n_files=16)
    index = L.file_bounds(spark, path, ["o_orderdate"])
    stamp = lambda d: dt.datetime(1997, 3, d)
    return L.read_indexed(spark, path, index, "o_orderdate", stamp(1), stamp(31))
