import datetime as dt

import pytest
from pyspark.sql import functions as F

from shoal import sinks as W
from shoal.streaming import incremental_load


def test_incremental_load_picks_only_new_files_and_never_duplicates(spark, tmp):
    spark.sql(f"CREATE TABLE inc_t (base STRING, day DATE, rate DOUBLE) USING parquet LOCATION '{tmp}/table'")
    schema = "base string, day date, rate double, seq int"
    batch1 = spark.createDataFrame([("EUR", dt.date(2021, 1, 1), 1.0, 1), ("EUR", dt.date(2021, 1, 1), 1.5, 2)],
                                   schema)
    batch2 = spark.createDataFrame([("USD", dt.date(2021, 1, 1), 0.9, 3), ("EUR", dt.date(2021, 1, 1), 9.9, 4)],
                                   schema)
    args = dict(schema=schema, fmt="json", table="inc_t", keys=["base", "day"], order=["seq"],
                checkpoint=f"{tmp}/ckpt", options={"recursiveFileLookup": "true"})
    W.write_json(batch1, f"{tmp}/landing/a")
    assert incremental_load(spark, f"{tmp}/landing", **args) == 1
    W.write_json(batch2, f"{tmp}/landing/b")
    assert incremental_load(spark, f"{tmp}/landing", **args) == 1
    assert incremental_load(spark, f"{tmp}/landing", **args) == 0  # nothing new
    got = sorted((r.base, r.rate) for r in spark.table("inc_t").collect())
    # latest within a batch wins; a key already loaded is not appended again
    assert got == [("EUR", 1.5), ("USD", 0.9)]


def test_single_file(spark, tmp):
    df = spark.range(20).withColumn("s", F.struct(F.col("id").alias("a")))
    W.write_single_csv(df, f"{tmp}/one")
    assert len(spark.read.text(f"{tmp}/one").inputFiles()) == 1
