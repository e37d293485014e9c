"""Property tests of the distributed order-dependent operators against brute force."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shoal.operators import intervals as IV
from shoal.operators import keys as K

rows_st = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 20), st.integers(0, 5)), min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st, parts=st.integers(1, 40), inclusive=st.booleans())
def test_prefix_sum_matches_brute_force(spark, rows, parts, inclusive):
    data = [(k, s, v, i) for i, (k, s, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, s int, v int, i int")
    got = {r.i: r.p for r in IV.prefix_aggregate(df, ["k"], ["s", "i"], "v", "sum", out="p", inclusive=inclusive,
                                                 partitions=parts).collect()}
    want, acc = {}, {}
    for k, s, v, i in sorted(data, key=lambda r: (r[0], r[1], r[3])):
        before = acc.get(k)
        acc[k] = v if before is None else before + v
        want[i] = acc[k] if inclusive else before
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st, parts=st.integers(1, 40))
def test_global_rank_is_a_permutation_in_order(spark, rows, parts):
    data = [(k, s, i) for i, (k, s, _v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, s int, i int")
    got = {r.i: r["rank"] for r in K.global_rank(df, [("k", True), ("s", False), ("i", True)],
                                                 partitions=parts).collect()}
    want = {r[2]: n + 1 for n, r in enumerate(sorted(data, key=lambda r: (r[0], -r[1], r[2])))}
    assert got == want
