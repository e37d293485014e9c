"""Registered queries: joins, set operations, ordering, modelling, reports (E, F, I, J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoal.operators import dependencies as D
from shoal.operators import intervals as IV
from shoal.operators import keys as K
from shoal.operators import modeling as M
from shoal.operators import relational as R
from shoal.plans.base import load, query

# ---------------------------------------------------------------- joins (E)


@query("join_inner", """
SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey
""")
def join_inner(spark, sf):
    cu, od = load(spark, sf, "customer"), load(spark, sf, "orders")
    return cu.join(od, cu.c_custkey == od.o_custkey, "inner").select("c_custkey", "c_name", "o_orderkey",
                                                                     "o_totalprice")


_URGENT_1998 = ("o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '1998-01-01'")


def _urgent_1998(spark, sf):
    od = load(spark, sf, "orders")
    return od.where((F.col("o_orderpriority") == "1-URGENT")
                    & (F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")))


@query("join_left", f"""
SELECT c_custkey, c_name, o_orderkey, o_totalprice
FROM customer LEFT JOIN (SELECT * FROM orders WHERE {_URGENT_1998}) o ON c_custkey = o_custkey
""")
def join_left(spark, sf):
    cu, od = load(spark, sf, "customer"), _urgent_1998(spark, sf)
    return cu.join(od, cu.c_custkey == od.o_custkey, "left").select("c_custkey", "c_name", "o_orderkey",
                                                                    "o_totalprice")


@query("join_full", f"""
SELECT c_custkey, c_name, o_orderkey, o_totalprice
FROM (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') c
FULL JOIN (SELECT * FROM orders WHERE {_URGENT_1998}) o ON c_custkey = o_custkey
""")
def join_full(spark, sf):
    cu = load(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING")
    od = _urgent_1998(spark, sf)
    return cu.join(od, cu.c_custkey == od.o_custkey, "full").select("c_custkey", "c_name", "o_orderkey",
                                                                    "o_totalprice")


@query("join_left_all", """
SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer LEFT JOIN orders ON c_custkey = o_custkey
""")
def join_left_all(spark, sf):
    cu, od = load(spark, sf, "customer"), load(spark, sf, "orders")
    return cu.join(od, cu.c_custkey == od.o_custkey, "left").select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


@query("join_right", """
SELECT o_orderkey, o_totalprice, c_custkey, c_name FROM orders RIGHT JOIN customer ON c_custkey = o_custkey
""")
def join_right(spark, sf):
    cu, od = load(spark, sf, "customer"), load(spark, sf, "orders")
    return od.join(cu, cu.c_custkey == od.o_custkey, "right").select("o_orderkey", "o_totalprice", "c_custkey", "c_name")


def _merge_query(how: str):
    """Data-frame style merge on a key that is NULL on both sides for some rows: NULL keys match each other."""
    @query(f"merge_{how}", f"""
WITH l AS (SELECT CASE WHEN c_custkey % 50 <> 0 THEN c_custkey END AS k, count(*) AS n, min(c_name) AS first
           FROM customer GROUP BY 1),
     r AS (SELECT CASE WHEN o_custkey % 70 <> 0 THEN o_custkey END AS k, count(*) AS n, max(o_orderkey) AS last
           FROM orders GROUP BY 1)
SELECT {'l.k' if how in ('inner', 'left') else 'r.k' if how == 'right' else 'coalesce(l.k, r.k)'} AS k,
       l.n AS n_x, first, r.n AS n_y, last FROM l {how} JOIN r ON l.k IS NOT DISTINCT FROM r.k
""")
    def merge(spark, sf):
        key = lambda c, m: F.when(F.col(c) % m != 0, F.col(c)).alias("k")
        left = load(spark, sf, "customer").groupBy(key("c_custkey", 50)).agg(
            F.count(F.lit(1)).alias("n"), F.min("c_name").alias("first"))
        right = load(spark, sf, "orders").groupBy(key("o_custkey", 70)).agg(
            F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last"))
        return R.merge(left, right, ["k"], how)
    return merge


for _how in ("inner", "left", "right", "full"):
    _merge_query(_how)


@query("lookup_join", """
SELECT s_suppkey, s_name, n_name, r_name
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
""")
def lookup_join(spark, sf):
    su, na, re = load(spark, sf, "supplier"), load(spark, sf, "nation"), load(spark, sf, "region")
    # nation (25 rows) and region (5 rows) have a fixed size at every scale: broadcast is bounded
    return (su.join(F.broadcast(na), su.s_nationkey == na.n_nationkey, "left")
            .join(F.broadcast(re), F.col("n_regionkey") == re.r_regionkey, "left")
            .select("s_suppkey", "s_name", "n_name", "r_name"))


@query("union_all", """
SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) <= 1997
UNION ALL
SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) >= 1996
""")
def union_all(spark, sf):
    od = load(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    early = od.where(F.year("o_orderdate") <= 1997)
    late = od.where(F.year("o_orderdate") >= 1996).select("o_orderdate", "o_orderkey")  # other column order
    return R.union_all(early, late, by_name=True)


@query("dedup_latest", """
SELECT user_id, event_type, ts, event_id, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def dedup_latest(spark, sf):
    return R.dedup_latest(load(spark, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"])


# The expected market segments of the audit (one deliberately absent, one extra).
EXPECTED_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "RETAIL"]


@query("set_audit", """
WITH a AS (SELECT DISTINCT c_mktsegment AS value FROM customer),
     e AS (SELECT * FROM (VALUES ('AUTOMOBILE'), ('BUILDING'), ('FURNITURE'), ('HOUSEHOLD'), ('RETAIL')) t(value))
SELECT value, 'unexpected' AS side FROM a WHERE value NOT IN (SELECT value FROM e)
UNION ALL
SELECT value, 'missing' AS side FROM e WHERE value NOT IN (SELECT value FROM a)
""")
def set_audit(spark, sf):
    return R.set_audit(load(spark, sf, "customer"), "c_mktsegment", EXPECTED_SEGMENTS)


@query("anti_join", """
SELECT c_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
""")
def anti_join(spark, sf):
    cu = load(spark, sf, "customer").select("c_custkey", "c_name")
    pend = load(spark, sf, "orders").where(F.col("o_orderstatus") == "P")
    return R.anti_join(cu, pend, cu.c_custkey == pend.o_custkey)


# The packed pair list, one blank-separated text per base.
PAIR_LIST = "click view purchase signup"


@query("pair_rates", """
WITH r AS (SELECT user_id, event_type, max(value) AS rate FROM events GROUP BY user_id, event_type),
     b AS (SELECT DISTINCT user_id FROM events),
     p AS (SELECT user_id, unnest(string_split('click view purchase signup', ' ')) AS pair FROM b)
SELECT p.user_id AS base, p.pair, coalesce(r.rate, 0) AS rate
FROM p LEFT JOIN r ON r.user_id = p.user_id AND r.event_type = p.pair
""")
def pair_rates(spark, sf):
    """Each user is a base with a rate map (largest value per event type); the
    packed pair list expands to one row per (base, pair); a missing pair is 0."""
    ev = load(spark, sf, "events")
    per_type = ev.groupBy("user_id", "event_type").agg(F.max("value").alias("rate"))
    rates = per_type.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("event_type", "rate"))).alias("rates"))  # ≤ #event types
    pairs = rates.select(F.col("user_id").alias("base"), "rates",
                         F.explode(F.split(F.lit(PAIR_LIST), " ")).alias("pair"))
    out = pairs.select("base", "pair", F.try_element_at("rates", F.col("pair")).alias("rate"))
    return R.fill_zero(out, ["rate"])


# ---------------------------------------------------------------- ordering (F)


@query("sort_multi", """
SELECT o_orderkey, o_orderpriority, o_totalprice,
       row_number() OVER (ORDER BY o_orderpriority ASC, o_totalprice DESC, o_orderkey ASC) AS rank
FROM orders
""")
def sort_multi(spark, sf):
    od = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return K.global_rank(od, [("o_orderpriority", True), ("o_totalprice", False), ("o_orderkey", True)])


@query("limit_n", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20")
def limit_n(spark, sf):
    od = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return R.top_k(od, [("o_orderkey", True)], 20)


@query("top_k", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100
""")
def top_k(spark, sf):
    od = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return R.top_k(od, [("o_totalprice", False), ("o_orderkey", True)], 100)


@query("bottom_k", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 5
""")
def bottom_k(spark, sf):
    od = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return R.bottom_k(od, [("o_orderkey", True)], 5)


@query("sample_row")
def sample_row(spark, sf):
    return R.sample_rows(load(spark, sf, "region"), 1, seed=11)


@query("sample_is_member", """
SELECT 25 AS n_rows, 25 AS n_members, 25 AS n_other_layout
""")
def sample_is_member(spark, sf):
    """Properties of a random sample of 25 orders: its size, how many are rows of the table, and how many are picked again
    when the table is dealt out and ordered otherwise."""
    od = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    picked = R.sample_rows(od, 25, seed=11)
    again = R.sample_rows(od.repartition(7, "o_totalprice"), 25, seed=11)
    count = lambda df, name: df.agg(F.count(F.lit(1)).cast("int").alias(name))
    return (count(picked, "n_rows").crossJoin(count(picked.join(od, od.columns, "left_semi"), "n_members"))
            .crossJoin(count(picked.join(again, od.columns, "left_semi"), "n_other_layout")))


# ---------------------------------------------------------------- modelling (I)


@query("surrogate_key", """
SELECT CAST(row_number() OVER (ORDER BY p_brand) AS BIGINT) AS id, p_brand FROM (SELECT DISTINCT p_brand FROM part)
""")
def surrogate_key(spark, sf):
    return K.surrogate_keys(load(spark, sf, "part"), ["p_brand"])


def _flat_appointments(spark, sf):
    """customer ⋈ orders ⋈ nation flattened like the clinic table."""
    cu, od, na = load(spark, sf, "customer"), load(spark, sf, "orders"), load(spark, sf, "nation")
    return (od.join(cu, od.o_custkey == cu.c_custkey).join(F.broadcast(na), cu.c_nationkey == na.n_nationkey)
            .select("o_orderkey", "o_orderdate", "o_totalprice", "c_name", "c_mktsegment", "n_name"))


_ENTITIES = {"customer": ["c_name", "n_name"], "segment": ["c_mktsegment"], "nation": ["n_name"]}


@query("normalize_3nf", """
WITH flat AS (SELECT o_orderkey, o_orderdate, o_totalprice, c_name, c_mktsegment, n_name
              FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
     cu AS (SELECT row_number() OVER (ORDER BY c_name, n_name) AS customer_id, c_name, n_name
            FROM (SELECT DISTINCT c_name, n_name FROM flat)),
     sg AS (SELECT row_number() OVER (ORDER BY c_mktsegment) AS segment_id, c_mktsegment
            FROM (SELECT DISTINCT c_mktsegment FROM flat)),
     na AS (SELECT row_number() OVER (ORDER BY n_name) AS nation_id, n_name FROM (SELECT DISTINCT n_name FROM flat))
SELECT o_orderkey, o_orderdate, o_totalprice, customer_id, segment_id, nation_id
FROM flat JOIN cu USING (c_name, n_name) JOIN sg USING (c_mktsegment) JOIN na USING (n_name)
""")
def normalize_3nf(spark, sf):
    _tables, fact = M.normalize(M.materialize(_flat_appointments(spark, sf)), _ENTITIES,
                                ["o_orderkey", "o_orderdate", "o_totalprice"])
    return fact


@query("normalize_roundtrip", """
SELECT count(*) AS n_source, count(*) AS n_rebuilt, CAST(0 AS BIGINT) AS n_diff
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
""")
def normalize_roundtrip(spark, sf):
    flat = M.materialize(_flat_appointments(spark, sf))  # used by every entity, the fact table and the check
    tables, fact = M.normalize(flat, _ENTITIES, ["o_orderkey", "o_orderdate", "o_totalprice"])
    # the nation entity's key is also carried by the customer entity: rebuild via customer, segment
    rebuilt = M.denormalize({"customer": tables["customer"], "segment": tables["segment"]},
                            fact.drop("nation_id"))
    return M.lossless_check(flat, rebuilt)


_FD_COLUMNS = ["o_orderkey", "o_orderdate", "o_orderstatus", "c_name", "c_mktsegment", "n_name", "r_name"]
_FD_FLAT = """
WITH flat AS (SELECT o_orderkey, o_orderdate, o_orderstatus, c_name, c_mktsegment, n_name, r_name
              FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey)
"""


def _dimensional_orders(spark, sf):
    """The flat table with a second level: a nation's region."""
    re, na = load(spark, sf, "region"), load(spark, sf, "nation")
    cu, od = load(spark, sf, "customer"), load(spark, sf, "orders")
    where = na.join(F.broadcast(re), na.n_regionkey == re.r_regionkey)
    return (od.join(cu, od.o_custkey == cu.c_custkey).join(F.broadcast(where), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(*_FD_COLUMNS))


@query("functional_dependencies", _FD_FLAT + " UNION ALL ".join(
    f"SELECT '{x}' AS determines, '{y}' AS determined FROM flat HAVING count(DISTINCT {x}) = count(DISTINCT ({x}, {y}))"
    for x in _FD_COLUMNS for y in _FD_COLUMNS if x != y))
def functional_dependencies(spark, sf):
    """Which column determines which, measured on the whole flat table."""
    flat = M.materialize(_dimensional_orders(spark, sf))
    found = [(x[0], y) for x, y in D.dependencies(flat) if x]
    names = F.array(*[F.struct(F.lit(x).alias("determines"), F.lit(y).alias("determined")) for x, y in found])
    return spark.range(1).select(F.explode(names).alias("d")).select("d.*")


@query("normalize_found", _FD_FLAT + """
SELECT 'o_orderkey' AS key, 'o_orderkey,o_orderdate,o_orderstatus,c_name' AS columns, count(DISTINCT o_orderkey) AS n_rows FROM flat
UNION ALL SELECT 'c_name', 'c_name,c_mktsegment,n_name', count(DISTINCT c_name) FROM flat
UNION ALL SELECT 'n_name', 'n_name,r_name', count(DISTINCT n_name) FROM flat
""")
def normalize_found(spark, sf):
    """Third normal form from the measured dependencies: key, columns and rows of each table. Segment and nation
    come to sit on the customer, the region on the nation, though nothing declares that."""
    flat = M.materialize(_dimensional_orders(spark, sf))
    tables = D.decompose(flat, D.third_normal_form(flat.columns, D.dependencies(flat)))
    out = None
    for r, table in tables.items():
        one = table.agg(F.lit(",".join(r.key)).alias("key"), F.lit(",".join(r.columns)).alias("columns"), F.count(F.lit(1)).alias("n_rows"))
        out = one if out is None else out.unionByName(one)
    return out


@query("normalize_found_roundtrip", _FD_FLAT + "SELECT DISTINCT * FROM flat")
def normalize_found_roundtrip(spark, sf):
    """The found tables joined again: the distinct rows of the flat table."""
    flat = M.materialize(_dimensional_orders(spark, sf))
    return D.recompose(D.decompose(flat, D.third_normal_form(flat.columns, D.dependencies(flat))), flat.columns)


@query("referential_check", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (
  SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')
""")
def referential_check(spark, sf):
    od = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    parent = load(spark, sf, "customer").where(F.col("c_mktsegment") != "MACHINERY")
    return M.orphans(od, "o_custkey", parent, "c_custkey")


# ---------------------------------------------------------------- reports (J)


@query("report_by_dimension", """
SELECT n_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS amount
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
""")
def report_by_dimension(spark, sf):
    cu, od, na = load(spark, sf, "customer"), load(spark, sf, "orders"), load(spark, sf, "nation")
    # aggregate orders per customer nation key first, then attach the 25 names
    per_nation = (od.join(cu, od.o_custkey == cu.c_custkey).groupBy("c_nationkey")
                  .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("amount")))
    return (per_nation.join(F.broadcast(na), per_nation.c_nationkey == na.n_nationkey)
            .select("n_name", "n_orders", F.round("amount", 2).alias("amount")))


@query("monthly_totals", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n_orders,
       round(sum(o_totalprice), 2) AS amount
FROM orders GROUP BY 1
""")
def monthly_totals(spark, sf):
    od = load(spark, sf, "orders")
    return (od.groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("month"))
            .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("amount")))


# The order status codes pivoted into columns.
STATUSES = ["F", "O", "P"]


@query("pivot_status", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
       round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 2) AS F,
       round(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END), 2) AS O,
       round(sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END), 2) AS P
FROM orders GROUP BY 1
""")
def pivot_status(spark, sf):
    od = load(spark, sf, "orders")
    p = od.groupBy(F.year("o_orderdate").alias("year")).pivot("o_orderstatus", STATUSES).agg(F.sum("o_totalprice"))
    return p.select("year", *[F.round(F.col(s), 2).alias(s) for s in STATUSES])


def status_intervals(spark, sf):
    """Status history per customer derived from orders: from the order date,
    lasting 15 days per priority level."""
    od = load(spark, sf, "orders")
    start = F.to_date("o_orderdate")
    days = F.substring("o_orderpriority", 1, 1).cast("int") * 15
    return od.select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("seq"),
                     F.col("o_orderstatus").alias("status"), start.alias("start_date"),
                     F.date_add(start, days).alias("end_date"))


_INTERVALS = """
WITH iv AS (SELECT o_custkey AS id, o_orderkey AS seq, o_orderstatus AS status,
                   CAST(o_orderdate AS DATE) AS start_date,
                   CAST(CAST(o_orderdate AS DATE) + CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 15 AS DATE)
                     AS end_date
            FROM orders)
"""


@query("interval_overlaps", _INTERVALS + """
SELECT * FROM (
  SELECT id, seq, status, start_date, end_date,
         max(end_date) OVER (PARTITION BY id ORDER BY start_date, end_date, seq
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max_end
  FROM iv) WHERE start_date < prev_max_end
""")
def interval_overlaps(spark, sf):
    return IV.overlaps(status_intervals(spark, sf), "id", "start_date", "end_date", "seq")


@query("interval_islands", _INTERVALS + """
, p AS (SELECT *, max(end_date) OVER (PARTITION BY id, status ORDER BY start_date, end_date, seq
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end FROM iv),
  f AS (SELECT *, CASE WHEN prev_end IS NULL OR start_date > prev_end THEN 1 ELSE 0 END AS new FROM p),
  n AS (SELECT *, CAST(sum(new) OVER (PARTITION BY id, status ORDER BY start_date, end_date, seq
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS island FROM f)
SELECT id, status, island, min(start_date) AS start_date, max(end_date) AS end_date, count(*) AS n_intervals
FROM n GROUP BY id, status, island
""")
def interval_islands(spark, sf):
    return IV.islands(status_intervals(spark, sf), "id", "status", "start_date", "end_date", "seq")


@query("status_as_of", _INTERVALS + """
SELECT id, arg_max(status, (start_date, seq)) AS status, max(start_date) AS start_date
FROM iv WHERE start_date <= DATE '1998-06-30' AND DATE '1998-06-30' < end_date GROUP BY id
""")
def status_as_of(spark, sf):
    return IV.status_as_of(status_intervals(spark, sf), "id", "start_date", "end_date", "status",
                           "1998-06-30", "seq")


@query("interval_pairs", _INTERVALS + """
SELECT a.id, a.seq AS first, b.seq AS second, b.start_date AS overlap_start, least(a.end_date, b.end_date) AS overlap_end
FROM iv a JOIN iv b ON a.id = b.id AND (a.start_date, a.seq) < (b.start_date, b.seq) AND b.start_date < a.end_date
""")
def interval_pairs(spark, sf):
    return IV.overlap_pairs(status_intervals(spark, sf), "id", "start_date", "end_date", "seq")


@query("status_at_transaction", _INTERVALS + """
, tx AS (SELECT o_custkey AS id, CAST(l_shipdate AS DATE) AS day, l_extendedprice AS amount
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT coalesce(s.status, 'none') AS status, coalesce(tx.day < s.end_date, false) AS in_force, count(*) AS n_transactions,
       round(sum(amount), 2) AS amount
FROM tx LEFT JOIN LATERAL (SELECT status, end_date FROM iv WHERE iv.id = tx.id AND iv.start_date <= tx.day
                           ORDER BY start_date DESC, seq DESC LIMIT 1) s ON true
GROUP BY ALL
""")
def status_at_transaction(spark, sf):
    """Amounts by the customer's status at the date of each transaction: the last one that had begun, and whether it was still
    in force."""
    li, od = load(spark, sf, "lineitem"), load(spark, sf, "orders")
    tx = (li.join(od, li.l_orderkey == od.o_orderkey)
          .select(F.col("o_custkey").alias("id"), F.to_date("l_shipdate").alias("day"), F.col("l_extendedprice").alias("amount")))
    met = IV.as_of_join(tx, status_intervals(spark, sf), "id", "day", "start_date", "seq", ["status", "end_date"])
    return (met.groupBy(F.coalesce("status", F.lit("none")).alias("status"),
                        F.coalesce(F.col("day") < F.col("end_date"), F.lit(False)).alias("in_force"))
            .agg(F.count(F.lit(1)).alias("n_transactions"), F.round(F.sum("amount"), 2).alias("amount")))


@query("dedup_exact", "SELECT DISTINCT user_id, event_type FROM events")
def dedup_exact(spark, sf):
    """``dropDuplicates`` on a key when all kept columns agree."""
    return R.dedup_exact(load(spark, sf, "events").select("user_id", "event_type"), ["user_id", "event_type"])
