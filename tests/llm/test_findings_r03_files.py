"""Small intermediate tables are few files, however many shuffle partitions there are."""

from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

from shoal.llm import minhash
from shoal.llm.common import few_files


def test_small_tables_of_near_duplicates_are_few_files(spark, docs, monkeypatch):
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    root = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"), "scratch")
    old = set(root.glob("*")) if root.exists() else set()
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        texts = spark.range(200).select(F.col("id").alias("doc_id"), F.expr(
            "concat_ws(' ', transform(sequence(1, 40), i -> if(i = 7, concat('x', id % 3), concat('w', i + 100 * (id % 50)))))").alias("text"))
        got = minhash.near_duplicates(docs.select("doc_id", "text").union(texts.selectExpr("doc_id + 1000", "text")), 2)
        assert got.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
        got = {r["doc_id"]: r["component_id"] for r in got.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert all(got[1000 + i] == 1000 + i % 50 for i in range(200)) and got[2] == 1
    files = Counter(p.parent.name for p in root.glob("*/part-*") if p.parent not in old)
    assert files and max(files.values()) <= max(spark.sparkContext.defaultParallelism, 2 * 4), files


def test_files_follow_the_rows(spark):
    wide = spark.range(0, 1000, 1, 60)
    cores = spark.sparkContext.defaultParallelism
    assert few_files(wide, 1000).rdd.getNumPartitions() == cores
    assert few_files(wide, 20 << 16).rdd.getNumPartitions() == 20
    assert few_files(wide, 1 << 30).rdd.getNumPartitions() == 60 and few_files(wide, 5).count() == 1000
