"""Plan shapes that the design relies on (checked on the executed physical plan)."""

import __spark_entry__ as E

from conftest import SF


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_projection_reach_the_scan(spark):
    p = plan(E.queries()["filter_compound"](spark, SF))
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(l_quantity,45.0)" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_discount:double," in p
    assert "l_extendedprice" not in p  # unused columns are never read


def test_aggregates_combine_map_side(spark):
    for name, fn in [("group_agg", "partial_sum"), ("word_count", "partial_count"),
                     ("dedup_latest", "partial_max"), ("most_common", "partial_count")]:
        assert fn in plan(E.queries()[name](spark, SF)), name


def test_only_bounded_sides_are_forced_to_broadcast(spark):
    p = plan(E.queries()["lookup_join"](spark, SF))
    assert p.count("BroadcastExchange") == 2  # nation and region, fixed size
    p = plan(E.queries()["zscore_filter"](spark, SF))
    assert "BroadcastExchange" in p and "BroadcastNestedLoopJoin" in p  # the one-row statistics


def test_report_aggregates_before_attaching_names(spark):
    p = plan(E.queries()["report_by_dimension"](spark, SF))
    # the aggregate over orders sits below the join with nation
    assert p.index("BroadcastHashJoin") < p.index("HashAggregate(keys=[c_nationkey")


def test_global_rank_has_no_single_partition_exchange_of_rows(spark):
    df = E.queries()["sort_multi"](spark, SF)
    p = plan(df)
    # the only window is over the per-partition count table (a handful of rows)
    assert "Window [sum(_n" in p
    assert df.count() == spark.read.parquet(f"{SF}/orders.parquet").count()
