"""A key holding a third of all rows: results stay exact and the work is split."""

from pyspark.sql import functions as F

from shoal.operators import relational as R
from shoal.operators import stats as S


def _skewed(spark, n=30_000):
    # key 0 holds a third of the rows; the rest spread over 2,000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).alias("k"),
        F.col("id"), (F.col("id") * 7 % 1000).cast("double").alias("v"))


def test_aggregates_on_a_hot_key(spark):
    df = _skewed(spark)
    got = {r.k: r.id for r in R.dedup_latest(df, ["k"], ["v", "id"]).collect()}
    want = {r.k: r.id for r in df.groupBy("k").agg(F.max(F.struct("v", "id")).alias("m"))
            .select("k", F.col("m.id").alias("id")).collect()}
    assert got == want
    assert S.most_common(df, "k").first().asDict() == {"value": 0, "frequency": 10_000}


def test_hot_join_key_is_split_by_aqe(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        facts = _skewed(spark)
        dims = spark.range(0, 2001).select(F.col("id").alias("k"), (F.col("id") % 5).alias("grp"))
        joined = facts.join(dims, "k")
        assert joined.count() == 30_000
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "skew=true" in plan  # the hot partition was split
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_clustered_write_spreads_a_hot_key(spark, tmp):
    from shoal import sinks as W

    df = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"))
    W.write_clustered(df, tmp + "/clustered", ["k"], n_files=8)
    back = spark.read.parquet(tmp + "/clustered")
    assert back.count() == 4000
    hot = back.where("k = 7").groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(hot) >= 3
