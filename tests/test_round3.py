"""Normal forms from data, interval pairs, as-of join, numbered rejects, VARIANT rejects, late rows, stable samples, commits that raise."""

import datetime as dt
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal import functions as X
from shoal import sources as S
from shoal.operators import dependencies as D
from shoal.operators import intervals as IV
from shoal.operators import loads, quantiles
from shoal.operators import relational as R
from shoal.tables import maintenance as MT
from shoal.tables.fs import CommitConflict
from shoal.tables.versioned import VersionedTable

# ---------------------------------------------------------------- dependencies


def holds(rows, x, y):
    seen = {}
    return all(seen.setdefault(tuple(r[i] for i in x), r[y]) == r[y] for r in rows)


@pytest.mark.parametrize("seed", range(4))
def test_dependencies_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    names = "abcde"
    rows = []
    for _ in range(120):
        a = rng.choice([None, *range(6)])
        c = rng.randrange(3)
        rows.append((a, None if a is None else a % 2, c, (a or 0) * 3 + c if seed % 2 else rng.randrange(9), 7))
    df = spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names))
    minimal = []
    for size in range(3):
        for x in itertools.combinations(range(5), size):
            for y in set(range(5)) - set(x):
                if holds(rows, x, y) and not any(set(z) <= set(x) and w == y for z, w in minimal):
                    minimal.append((x, y))
    want = {(tuple(names[i] for i in x), names[y]) for x, y in minimal}
    assert set(D.dependencies(df, max_left=2)) == want
    assert set(D.dependencies(df, max_left=2, sample_rows=20)) == want  # refuted by some rows, confirmed on all
    relations = D.third_normal_form(list(names), sorted(want))
    tables = D.decompose(df, relations)
    back = D.recompose(tables, list(names))
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.distinct().collect()))
    for r, t in tables.items():
        assert t.count() == t.select(*r.key).distinct().count()


def test_third_normal_form_chains_and_keys():
    fds = [(("order",), "customer"), (("order",), "segment"), (("order",), "nation"), (("customer",), "segment"), (("customer",), "nation"),
           (("order",), "region"), (("customer",), "region"), (("nation",), "region")]
    got = D.third_normal_form(["order", "customer", "segment", "nation", "region"], fds)
    assert [r.columns for r in got] == [("order", "customer"), ("nation", "region"), ("customer", "segment", "nation")]
    # two names of one thing share a table; a table without a key gets one
    both = D.third_normal_form(["id", "code", "x"], [(("id",), "code"), (("code",), "id")])
    assert {r.columns for r in both} == {("id", "code"), ("id", "x")} or {r.columns for r in both} == {("id", "code"), ("code", "x")}


def test_dependencies_with_a_hot_value(spark):
    rows = [(1, 1, i) for i in range(3000)] + [(i, i % 7, i) for i in range(2, 1500)]
    df = spark.createDataFrame(rows, "k int, v int, n int")
    assert (("k",), "v") in D.dependencies(df)
    broken = df.union(spark.createDataFrame([(1, 2, -1)], df.schema))  # one row among thousands
    assert (("k",), "v") not in D.dependencies(broken, sample_rows=100)


# ---------------------------------------------------------------- intervals


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def intervals(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = 1 if i % 3 == 0 else rng.choice([None, 2, 3, 4])  # one key holds a third
        s = rng.randrange(400)
        out.append((key, i, day(s), day(s + rng.choice([0, 1, 2, 10, 90]))))
    return out


def test_overlap_pairs_equal_brute_force(spark):
    rows = intervals(1, 300)
    df = spark.createDataFrame(rows, "id int, seq int, s date, e date")
    got = sorted(tuple(r) for r in IV.overlap_pairs(df, "id", "s", "e", "seq").collect())
    want = sorted((a[0], a[1], b[1], b[2], min(a[3], b[3])) for a in rows for b in rows
                  if a[0] is not None and a[0] == b[0] and (a[2], a[1]) < (b[2], b[1]) and b[2] < a[3] and b[2] < b[3])
    assert got == want and got
    assert IV.overlap_pairs(df.limit(0), "id", "s", "e", "seq").count() == 0


@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_as_of_join_equals_brute_force(spark, partitions):
    rng = random.Random(2)
    known = [(rng.choice([1, 1, 2, 3, None]), rng.choice([None, *[day(x) for x in range(0, 100, 7)]]), i, rng.choice(["A", "D", None])) for i in range(200)]
    asked = [(rng.choice([1, 1, 1, 2, 4, None]), rng.choice([None, *[day(x) for x in range(-5, 110)]]), i) for i in range(400)]
    left = spark.createDataFrame(asked, "id int, day date, n int")
    right = spark.createDataFrame(known, "id int, start date, seq int, status string")
    got = sorted(map(tuple, IV.as_of_join(left, right, "id", "day", "start", "seq", ["status", "start"], partitions).collect()), key=lambda r: r[2])
    for k, d, n, status, start in got:
        best = max(((s, q, st) for i, s, q, st in known if d is not None and s is not None and i is not None and i == k and s <= d),
                   key=lambda x: x[:2], default=(None, None, None))
        assert (status, start) == (best[2], best[0]), n
    assert len(got) == len(asked)


# ---------------------------------------------------------------- rejects

ROW = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())])


def test_reject_lines_over_many_splits(spark, tmp_path):
    bad = {}
    for f, n in (("x.csv", 4000), ("y.csv", 3), ("z.csv", 0)):
        lines = ["a,b"]
        for i in range(n):
            if i % 500 == 7:
                lines.append("")  # blank lines count
            lines.append(f"{i},oops" if i % 397 == 5 else f"{i},{i}.5")
        bad[f] = [k + 1 for k, x in enumerate(lines) if x.endswith("oops")]
        (tmp_path / f).write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        good, rejects = S.read_csv_numbered(spark, str(tmp_path), ROW, max_rejects=None)
        got = {}
        for r in rejects.collect():
            got.setdefault(r["file"].rsplit("/", 1)[1], []).append(r["line"])
        assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in bad.items() if v}
        assert good.count() == 4003 - sum(map(len, bad.values()))
        with pytest.raises(ValueError, match=r"threshold of 0: .*x\.csv line \d+"):
            S.read_csv_numbered(spark, str(tmp_path), ROW)
        S.read_csv_numbered(spark, str(tmp_path / "y.csv"), ROW)
        with pytest.raises(ValueError, match="threshold of 5"):
            S.read_csv_numbered(spark, str(tmp_path), ROW, max_rejects=5)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_variant_rejects_tell_absent_from_wrong(spark):
    texts = {1: '[{"m": {"t": 1.5}, "n": 3}, {"m": {}, "n": "x"}, {"n": null}]', 2: "[]", 3: None, 4: "not json", 5: "[{'m': {'t': 'warm'}, 'n': []}]",
             6: '[7, null, {"n": "12"}]'}
    df = spark.createDataFrame(list(texts.items()), "id int, doc string")
    rows, rejects = X.variant_shred(df, "doc", {"t": ("$.m.t", "double"), "n": ("$.n", "int")}, keep=["id"])
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted([(1, 1.5, 3), (1, None, None), (6, None, 12)], key=repr)
    assert sorted(map(tuple, rejects.collect()), key=repr) == sorted(
        [(1, 1, "$.n", "x"), (4, None, "$", "not json"), (5, 0, "$.m.t", "warm"), (5, 0, "$.n", "[]"), (6, 0, "$", "7")], key=repr)


# ---------------------------------------------------------------- late rows


def test_late_rows_replace_only_what_changed(spark, tmp_path):
    spark.sql(f"CREATE TABLE late_t (k INT, v DOUBLE, at INT, d DATE) USING parquet PARTITIONED BY (d) LOCATION '{tmp_path}/late'")
    try:
        def put(rows):
            batch = spark.createDataFrame(rows, "k int, at int, d date, v double")
            return {r["d"]: (r["rows_before"], r["rows_after"]) for r in
                    loads.replace_late(spark, batch, "late_t", ["k", "d"], ["at"], "d", fill=["v"]).collect()}

        def files():
            return {str(p) for p in (tmp_path / "late").rglob("*.parquet")}

        a, b = day(0), day(1)
        assert put([(1, 1, a, 1.0), (1, 2, a, None), (2, 1, a, 2.0), (1, 1, b, 3.0), (9, 1, None, 4.0)]) == {a: (0, 2), b: (0, 1), None: (0, 1)}
        before = files()
        assert put([(1, 5, b, 30.0), (2, 1, a, 2.0), (1, 1, a, 99.0), (3, 1, b, 5.0)]) == {b: (1, 2)}  # newer and new; equal and stale
        assert {f for f in before if f"d={a}" in f} <= files()
        want = sorted([(1, 0.0, 2, a), (2, 2.0, 1, a), (1, 30.0, 5, b), (3, 5.0, 1, b), (9, 4.0, 1, None)], key=repr)
        assert sorted(map(tuple, spark.table("late_t").collect()), key=repr) == want
        before = files()
        assert put([(1, 5, b, 30.0), (9, 1, None, 4.0)]) == {} and files() == before  # a rerun
        assert put([(9, 2, None, 7.0)]) == {None: (1, 1)}
        assert put([]) == {}
    finally:
        spark.sql("DROP TABLE late_t")


# ---------------------------------------------------------------- samples and quantiles


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "x").alias("s"), F.create_map(F.lit("k"), "id").alias("m"))
    picks = [{r["id"] for r in R.sample_rows(df.repartition(n), 10, seed=3).collect()} for n in (1, 2, 3, 8)]
    assert len(picks[0]) == 10 and all(p == picks[0] for p in picks)
    assert {r["id"] for r in R.sample_rows(df, 10, seed=4).collect()} != picks[0]


@pytest.mark.parametrize("fanout,most", [(10_000, 100_000), (50, 40), (6, 10)])
def test_quantiles_with_ties_and_infinities(spark, fanout, most):
    import numpy as np
    rng = random.Random(9)
    values = [5.0] * 700 + [rng.choice([1.0, 2.5, float("inf"), -float("inf")]) for _ in range(300)] + [rng.gauss(5, 1) for _ in range(1100)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0]
    got = quantiles.exact_quantiles(df, "x", probs, max_exact=most, fanout=fanout)
    ordered = sorted(values)
    for q, g in zip(probs, got):
        h = (len(ordered) - 1) * q
        a, b = ordered[int(np.floor(h))], ordered[int(np.ceil(h))]
        assert g == (a if a == b else a + (h - np.floor(h)) * (b - a))


# ---------------------------------------------------------------- commits


def test_concurrent_schema_changes_raise(spark, tmp_path, monkeypatch):
    t = VersionedTable.create(spark, f"{tmp_path}/t", spark.range(3))
    other = VersionedTable(spark, f"{tmp_path}/t")
    new_schema = t._new_schema
    monkeypatch.setattr(t, "_new_schema", lambda fields: (other.add_column("b", "int"), new_schema(fields))[1])
    with pytest.raises(CommitConflict):
        t.add_column("a", "int")
    assert "b" in VersionedTable(spark, f"{tmp_path}/t").scan().columns


def test_publish_does_not_lose_a_concurrent_append(spark, tmp_path, monkeypatch):
    from shoal.tables import audit
    t = VersionedTable.create(spark, f"{tmp_path}/t", spark.range(10))
    with audit.wap_session(t, "w"):
        t.append(spark.range(10, 15))
    other = VersionedTable(spark, f"{tmp_path}/t")
    ancestors = t.current_ancestors
    monkeypatch.setattr(t, "current_ancestors", lambda *a: (other.append(spark.range(90, 93)), ancestors(*a))[1])
    with pytest.raises(CommitConflict):
        t.cherry_pick(t.staged_snapshot("w"))
    monkeypatch.undo()
    t.cherry_pick(t.staged_snapshot("w"))
    assert t.scan().count() == 18


def test_an_empty_log_entry_is_tolerated(spark, tmp_path):
    import os
    t = VersionedTable.create(spark, f"{tmp_path}/t", spark.range(3))
    path = f"{tmp_path}/t/_meta/log/{t.state()['seq'] + 1:012d}.json"
    open(path, "w").close()
    t = VersionedTable(spark, f"{tmp_path}/t")
    assert t.scan().count() == 3
    with pytest.raises(CommitConflict):  # it may be a commit in the making
        t.append(spark.range(2))
    os.utime(path, (1, 1))
    t.append(spark.range(2))
    assert t.scan().count() == 5 and json.load(open(path))["kind"]


def test_orphan_search_spares_young_files(spark, tmp_path):
    t = VersionedTable.create(spark, f"{tmp_path}/t", spark.range(3))
    spark.range(4).write.parquet(f"{tmp_path}/t/data/_dir=running")
    assert MT.orphan_files(t).count() == 0 and MT.orphan_files(t, min_age_ms=0).count() > 0


# ---------------------------------------------------------------- layouts


def test_compaction_packs_small_files_only(spark, tmp_path):
    from shoal.sinks import layout as L
    path = f"{tmp_path}/c"
    df = spark.range(20_000).select("id", F.xxhash64("id").alias("h"), (F.col("id") % 2).alias("p"))
    df.where("p = 0").coalesce(1).drop("p").write.parquet(f"{path}/p=0")  # one right-sized file
    df.where("p = 1").repartition(12).drop("p").write.parquet(f"{path}/p=1")
    sizes = {r["file"]: r["length"] for r in L.file_sizes(spark, path).collect()}
    target = max(sizes.values())
    big = {f for f, n in sizes.items() if n >= 0.75 * target}
    replaced = {r["file"] for r in L.compact_files(spark, path, target).collect()}
    after = {r["file"]: r["length"] for r in L.file_sizes(spark, path).collect()}
    assert big <= set(after) and replaced == set(sizes) - big and not replaced & set(after)
    new = [n for f, n in after.items() if f not in sizes]
    assert 1 <= len(new) < len(replaced) / 3 and all(n < 1.5 * target for n in new)
    back = spark.read.parquet(path).select("id", "h", F.col("p").cast("long"))
    assert back.count() == 20_000 and back.exceptAll(df).count() == 0
    assert L.compact_files(spark, path, 1).count() == 0  # nothing is small


def test_compaction_writes_a_bin_a_task_without_a_sort(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from shoal.sinks import layout as L
    path = f"{tmp_path}/b"
    spark.range(24_000).select("id", F.xxhash64("id").alias("h")).repartition(48).write.parquet(path)
    sizes = {r["file"]: r["length"] for r in L.file_sizes(spark, path).collect()}
    before, held, write = spark.conf.get(L.OPEN_FILES), [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, p: (held.append(int(spark.conf.get(L.OPEN_FILES))), write(w, p))[1])
    bins = L.compact_files(spark, path, 4 * max(sizes.values())).select("bin").distinct().count()
    after = [r["file"] for r in L.file_sizes(spark, path).collect()]
    tasks = {f.rsplit("part-", 1)[1][:5] for f in after}
    assert held and min(held) > 0 and spark.conf.get(L.OPEN_FILES) == before  # rows are not sorted by bin
    assert bins >= 10 and len(after) == bins == len(tasks)
    assert spark.read.parquet(path).agg(F.count("id"), F.sum("id")).first() == (24_000, 24_000 * 23_999 // 2)


def test_bucketed_join_has_no_exchange(spark, tmp_path):
    from shoal.plans.io import bucketed_join
    rows = [(1, i, float(i)) for i in range(500)] + [(i, i, 1.0) for i in range(2, 600)]  # a hot key
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber long, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(i, i % 9) for i in range(1, 700)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    out = bucketed_join(spark, str(tmp_path))
    got = {r["o_orderkey"]: (r["n_lines"], r["amount"]) for r in out.collect()}
    assert got[1] == (500, sum(range(500))) and len(got) == 599
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan


def test_index_opens_only_matching_files(spark, tmp_path):
    from shoal import sinks as W
    from shoal.sinks import layout as L
    path = f"{tmp_path}/i"
    W.write_clustered(spark.range(1000).select("id", F.when(F.col("id") % 10 > 0, F.col("id")).alias("v")), path, ["id"], n_files=10)
    index = L.file_bounds(spark, path, ["id", "v"])
    rows = index.collect()
    assert sum(r["n_rows"] for r in rows) == 1000 and sum(r["v_nulls"] for r in rows) == 100
    part = L.read_indexed(spark, path, index, "id", 150, 260)
    assert sorted(r["id"] for r in part.collect()) == list(range(150, 261))
    assert 1 <= len(part.inputFiles()) <= 4 < len(rows)
    assert L.read_indexed(spark, path, index, "id", low=5000).count() == 0
    assert L.read_indexed(spark, path, index, "id").count() == 1000


def test_json_documents_are_framed_by_position(spark, tmp_path):
    from shoal import sinks as W
    df = spark.range(250).select("id", F.array("id").alias("a"), F.lit('x"y').alias("s"))
    W.write_json_array_documents(df, f"{tmp_path}/j", rows_per_doc=100)
    docs = [json.loads(p.read_text()) for p in (tmp_path / "j").glob("part-*") if p.stat().st_size]
    assert sorted(len(d) for d in docs)[-1] <= 100 and sum(map(len, docs)) == 250 and len(docs) == 3
    back = S.read_json_documents(spark, f"{tmp_path}/j", "id bigint, a array<bigint>, s string")
    assert sorted(map(tuple, back.select("id", "s").collect())) == [(i, 'x"y') for i in range(250)]
    W.write_json_array_documents(df.limit(0), f"{tmp_path}/e")
    assert S.read_json_documents(spark, f"{tmp_path}/e", "id bigint").count() == 0
