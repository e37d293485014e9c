"""Mixing sources to target weights by a low-discrepancy schedule. DataFrame operations only.

1. Sizes in words, summed by source. Weighted targets share all words; a target stops at ``most`` times
   its source, and the excess goes to the others by weight until no target is above (solved in closed form over
   the table of sources, which is the only thing a single task ever orders).
2. 2^m slots. Slot n has the van der Corput point of n (its binary digits mirrored), which falls into one
   source's stretch of the cumulative targets. Any run of slots then has the sources in nearly the
   target proportions, and all 2^m of them to within one slot. A source whose stretch holds no point shares the slot of the
   nearest point before it, so every source with a target has a slot.
3. A source is its documents in a hashed order, end to end and again from the start up to ``most`` times, and its target of
   these words is cut into as many blocks of equal words (to within one) as it has slots. Its k-th slot takes its k-th block: a join of
   slots and blocks on (source, k) says what is taken, to the word, and at which slot a document comes in first.

The table of sources is ordered by one task: it is meant for up to some million sources.

Edge cases: NULL or blank text: size 0, nothing taken. NULL source: a source of its own, last. NULL or repeated doc_id: each
row is a document of its own (rows without one are ordered by text). A source without words: target 0. An empty table gives none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoal.llm.common import materialise

WEIGHTS = (5, 2, 1)
MOST = 3
#: Words per block on large tables; blocks per weight unit at least, which bounds a target's error on small ones.
BLOCK_WORDS, SLOTS_PER_WEIGHT = 1024, 256
#: Rows that share one ordering group, on average.
GROUP_ROWS = 2000
WORD = r"[^\x20\x09-\x0D]+"


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size) -> with ``weight`` and ``target``; one row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    t = sources.withColumn("weight", F.element_at(cycle, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    t = t.withColumn("_cap", F.lit(float(most)) * F.col("source_size")).withColumn("_ratio", F.col("_cap") / F.col("weight"))
    # sources by the level at which they stop; the level of all others if the first k have stopped
    by_ratio = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    all_rows = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = t.withColumn("_level", (F.sum("source_size").over(all_rows) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                     / F.sum("weight").over(onward))
    # it rises with k up to the right k and falls after it
    t = t.withColumn("_level", F.max("_level").over(all_rows))
    return t.select("source", "source_size", "weight", F.least("_cap", F.col("weight") * F.col("_level")).alias("target"))


def slot_counts(plan: DataFrame, bits: int) -> DataFrame:
    """``plan`` (sid, target) with lo and hi, its stretch of [0, 1), and slots, the number of its slots (0 without a target)."""
    w = Window.orderBy("sid")
    ends = (plan.withColumn("_to", F.sum("target").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("_all", F.sum("target").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
            .withColumn("lo", F.try_divide(F.col("_to") - F.col("target"), "_all")).withColumn("hi", F.try_divide("_to", "_all")))
    points = F.ceil(F.col("hi") * float(1 << bits)) - F.ceil(F.col("lo") * float(1 << bits))
    return ends.withColumn("slots", F.when(F.col("target") > 0, F.greatest(points, F.lit(1))).otherwise(0)).drop("_to", "_all")


def schedule(plan: DataFrame, bits: int) -> DataFrame:
    """(sid, slot, k): the slots of each source of ``plan`` (:func:`slot_counts`), ranked. ``plan`` has one row per source."""
    spark = plan.sparkSession

    def mirrored(n: str) -> Column:
        return F.conv(F.reverse(F.lpad(F.bin(n), bits, "0")), 2, 10) if bits else F.lit("0")

    ends = plan.filter("target > 0").select("sid", "lo", "hi")
    # stretches are looked up by a coarse cell of [0, 1), so each point meets the few sources of its cell
    cells = 1 << min(bits, 12)
    slots = (spark.range(1 << bits).select(F.col("id").alias("slot"))
             .withColumn("x", mirrored("slot").cast("double") / float(1 << bits)).withColumn("cell", F.floor(F.col("x") * cells)))
    spread = ends.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * cells),
                                                          F.least(F.floor(F.col("hi") * cells), F.lit(cells - 1)))))
    hit = slots.join(spread, "cell").filter("x >= lo and x < hi").select("sid", "slot")
    scale = float(1 << bits)
    shared = (ends.filter(F.ceil(F.col("hi") * scale) <= F.ceil(F.col("lo") * scale))
              .withColumn("n", F.floor(F.least(F.col("lo") * scale, F.lit(scale - 1)))).select("sid", mirrored("n").cast("long").alias("slot")))
    hit = hit.union(shared)
    # ranks within bounded stretches of slots, plus the counts before
    size = 1 << max(0, bits - 8)
    hit = hit.withColumn("_part", F.floor(F.col("slot") / size))
    counts = hit.groupBy("sid", "_part").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("sid").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("sid", "_part", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    within = Window.partitionBy("sid", "_part").orderBy("slot")
    return (hit.withColumn("k", F.row_number().over(within) - 1).join(counts, ["sid", "_part"])
            .select("sid", "slot", (F.col("k") + F.col("_before")).alias("k")))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = "mix",
        keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with size, source_size, target, taken (words, repeats counted) and first_slot, the slot at
    which the document comes in first (-1 if it does not)."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    extra = [c for c in keep if c not in ("doc_id", "source")]
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("|"), F.md5(F.coalesce("text", F.lit("")))))
    base = materialise(docs.select("doc_id", "source", *extra, size.alias("_size"), F.md5(F.concat_ws("|", F.lit(seed), name)).alias("_h")),
                       "mix-sizes")
    found = targets(base.groupBy("source").agg(F.sum("_size").alias("source_size")), weights, most)
    total = found.agg(F.sum("source_size").alias("t"), F.sum("weight").alias("w")).first()
    words = total["t"] or 0
    # two powers: enough slots for small sources, blocks of about BLOCK_WORDS on large tables
    bits = max(0, math.ceil(math.log2(max(1, SLOTS_PER_WEIGHT * (total["w"] or 1), words / BLOCK_WORDS))))
    numbered = found.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    plan = materialise(slot_counts(numbered, bits).withColumn("step", F.try_divide("target", "slots")), "mix-plan")
    slots = schedule(plan, bits)

    rows = base.join(plan.select("sid", "source", "source_size", "target", "slots", "step").withColumnRenamed("source", "_s"),
                     F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    n = base.count()
    groups = max(1, n // GROUP_ROWS)
    rows = rows.withColumn("_g", F.floor(F.conv(F.substring("_h", 1, 8), 16, 10).cast("double") / float(1 << 32) * groups))
    sums = rows.groupBy("sid", "_g").agg(F.sum("_size").alias("_n"))
    upto = Window.partitionBy("sid").orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("sid", "_g", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_base"))
    within = Window.partitionBy("sid", "_g").orderBy("_h", "doc_id", "_size")
    placed = (rows.withColumn("_at", F.sum("_size").over(within.rowsBetween(Window.unboundedPreceding, -1)))
              .withColumn("_row", F.row_number().over(within)).join(sums, ["sid", "_g"])
              .withColumn("_at", F.coalesce("_at", F.lit(0)) + F.col("_base")))
    placed = materialise(placed.drop("_base"), "mix-placed")
    # where each repeat of a document lies, cut at blocks: one row per (document, repeat, block)
    start = lambda k: F.floor(k * F.col("step") + 0.5)
    epochs = F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("_e")
    spans = (placed.filter((F.col("_size") > 0) & (F.col("slots") > 0))
             .select("sid", "_g", "_row", "source_size", "_at", "_size", "slots", "step", epochs)
             .withColumn("_lo", F.col("_e") * F.col("source_size") + F.col("_at"))
             .withColumn("_hi", F.col("_lo") + F.col("_size"))
             .filter(F.col("_lo") < start(F.col("slots")))
             .withColumn("k", F.explode(F.sequence(F.greatest(F.floor(F.col("_lo") / F.col("step")) - 1, F.lit(0)),
                                                   F.least(F.floor(F.col("_hi") / F.col("step")) + 1, F.col("slots") - 1))))
             .withColumn("_words", F.least("_hi", start(F.col("k") + 1)) - F.greatest("_lo", start(F.col("k"))))
             .filter("_words > 0").select("sid", "_g", "_row", "_e", "k", "_words"))
    taken = (spans.join(slots.select("sid", "k", "slot"), ["sid", "k"])
             .groupBy("sid", "_g", "_row").agg(F.sum("_words").alias("taken"), F.min(F.struct("_e", "k", "slot"))["slot"].alias("first_slot")))
    return (placed.join(taken, ["sid", "_g", "_row"], "left")
            .select(*keep, F.col("_size").alias("size"), "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
                    F.coalesce("first_slot", F.lit(-1)).cast("long").alias("first_slot")))


ORACLE = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(concat_ws('|', 'mix', coalesce(CAST(doc_id AS VARCHAR), '|' || md5(coalesce(text, ''))))) AS h FROM documents),
src AS (
  SELECT source, sum(size)::DOUBLE AS s, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS sid
  FROM sized GROUP BY source),
wt AS (SELECT *, CASE (sid - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w FROM src),
fill AS (
  SELECT 0 AS step, sid, source, s, w, 3 * s AS cap, false AS stopped,
         w * sum(s) OVER () / sum(w) OVER () AS target FROM wt
  UNION ALL
  SELECT step + 1, sid, source, s, w, cap, stopped OR target >= cap,
         CASE WHEN stopped OR target >= cap THEN cap ELSE
           w * (sum(s) OVER () - coalesce(sum(cap) FILTER (WHERE stopped OR target >= cap) OVER (), 0))
             / sum(w) FILTER (WHERE NOT (stopped OR target >= cap)) OVER () END
  FROM fill WHERE step < 64),
plan AS (SELECT sid, source, s, target, sum(target) OVER (ORDER BY sid) AS upto, sum(target) OVER () AS whole
         FROM fill WHERE step = 64),
params AS (
  SELECT CAST(ceil(log2(greatest(1, 256 * (SELECT sum(w) FROM wt), (SELECT sum(s) FROM wt) / 1024))) AS INTEGER) AS bits),
stretch AS (
  SELECT sid, source, s, target, bits, (CAST(1 AS BIGINT) << bits)::DOUBLE AS n, (upto - target) / nullif(whole, 0) AS lo, upto / nullif(whole, 0) AS hi
  FROM plan, params),
got AS (SELECT *, CASE WHEN target > 0 THEN greatest(ceil(hi * n) - ceil(lo * n), 1) ELSE 0 END::BIGINT AS slots FROM stretch),
cut AS (SELECT *, CASE WHEN slots > 0 THEN target / slots END AS step FROM got),
point AS (SELECT sid, unnest(range(ceil(lo * n)::BIGINT, ceil(hi * n)::BIGINT)) AS j, bits FROM cut WHERE target > 0
          UNION ALL SELECT sid, floor(least(lo * n, n - 1))::BIGINT, bits FROM cut WHERE target > 0 AND ceil(hi * n) <= ceil(lo * n)),
slot AS (
  SELECT sid, slot, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS k
  FROM (SELECT sid, list_reduce(list_prepend(0::BIGINT, range(bits)), lambda a, i: a * 2 + ((j >> i) & 1)) AS slot FROM point)),
block AS (
  SELECT sid, slot, floor(k * step + 0.5) AS a, floor((k + 1) * step + 0.5) AS b FROM slot JOIN cut USING (sid)),
placed AS (
  SELECT d.doc_id, d.size, g.sid, g.s, g.target, coalesce(floor(g.slots * g.step + 0.5), 0) AS reach,
         sum(d.size) OVER (PARTITION BY g.sid ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) - d.size AS pos
  FROM sized d JOIN cut g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, CAST(s AS BIGINT) AS source_size, target,
       CAST(greatest(0, least(pos + size, reach) - pos) + greatest(0, least(s + pos + size, reach) - s - pos)
            + greatest(0, least(2 * s + pos + size, reach) - 2 * s - pos) AS BIGINT) AS taken, coalesce(b.slot, -1) AS first_slot
FROM placed p LEFT JOIN block b ON b.sid = p.sid AND p.size > 0 AND b.a <= p.pos AND p.pos < b.b
"""
