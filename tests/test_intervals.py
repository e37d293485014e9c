import datetime as dt
import random


from shoal.operators import intervals as IV


def _brute_prefix_max(rows):
    out, best = {}, {}
    for key, start, end, seq in sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3])):
        out[seq] = best.get(key)
        best[key] = end if best.get(key) is None else max(best[key], end)
    return out


def test_prefix_max_with_a_hot_key_spread_over_partitions(spark):
    random.seed(5)
    rows = []
    for seq in range(3000):
        key = 0 if seq % 3 == 0 else random.randint(1, 40)  # key 0 holds a third of the rows
        start = random.randint(0, 500)
        rows.append((key, start, start + random.randint(0, 30), seq))
    df = spark.createDataFrame(rows, "k int, s int, e int, seq int")
    got = IV.prefix_aggregate(df, ["k"], ["s", "e", "seq"], "e", "max", out="prev", partitions=9)
    assert {r.seq: r.prev for r in got.collect()} == _brute_prefix_max(rows)


def _d(s):
    return dt.date.fromisoformat(s)


def test_islands_overlaps_and_as_of(spark):
    hist = [(1, 1, "Active", "2020-01-01", "2020-03-01"), (1, 2, "Active", "2020-02-15", "2020-04-01"),
            (1, 3, "Active", "2020-04-01", "2020-05-01"), (1, 4, "Deleted", "2020-05-01", "2020-06-01"),
            (2, 5, "Active", "2020-01-01", "2020-02-01"), (2, 6, "Active", "2020-03-01", "2020-04-01")]
    df = spark.createDataFrame([(i, q, s, _d(a), _d(b)) for i, q, s, a, b in hist],
                               "id int, seq int, status string, start_date date, end_date date")
    ov = {r.seq for r in IV.overlaps(df, "id", "start_date", "end_date", "seq").collect()}
    assert ov == {2}
    isl = sorted((r.id, r.status, str(r.start_date), str(r.end_date), r.n_intervals)
                 for r in IV.islands(df, "id", "status", "start_date", "end_date", "seq").collect())
    assert isl == [(1, "Active", "2020-01-01", "2020-05-01", 3), (1, "Deleted", "2020-05-01", "2020-06-01", 1),
                   (2, "Active", "2020-01-01", "2020-02-01", 1), (2, "Active", "2020-03-01", "2020-04-01", 1)]
    asof = {r.id: r.status for r in IV.status_as_of(df, "id", "start_date", "end_date", "status", "2020-05-01",
                                                    "seq").collect()}
    assert asof == {1: "Deleted"}  # half-open: the Active interval ended on 2020-05-01
