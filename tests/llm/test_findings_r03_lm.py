"""Lookups and orders of the language model that follow the first bits of hashes, and the packed table of weights."""

import numpy as np
import pyarrow as pa

from shoal.llm import lm


def hashes(rng, n):
    return np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))


def test_finder_agrees_with_a_search():
    rng = np.random.default_rng(3)
    top = np.uint64(2**64 - 1)
    many = hashes(rng, 5000)
    for keys in (many, many[:1], many[:0], np.r_[np.uint64(0), many, top], np.arange(900, dtype=np.uint64), top - np.arange(900, dtype=np.uint64)[::-1]):
        wanted = np.r_[keys, keys + np.uint64(1), hashes(rng, 3000), np.uint64(0), top]
        there, at = lm.finder(keys)(wanted)
        assert there.tolist() == np.isin(wanted, keys).tolist()
        assert not there.any() or (keys[at[there]] == wanted[there]).all()


def test_distinct_and_order():
    rng = np.random.default_rng(4)
    keys = rng.choice(hashes(rng, 300), 4000)
    got, at, n = lm.distinct(keys)
    want, counts = np.unique(keys, return_counts=True)
    assert (got == want).all() and (n == counts).all() and (keys[at] == got).all()
    assert all(len(x) == 0 for x in lm.distinct(keys[:0]))
    for buckets in (1, 7, 5000):
        bucket, last = (keys % np.uint64(buckets)).astype(np.int64), rng.integers(0, 900, 4000)
        order = lm.ordered(bucket, buckets, keys, last, 900)
        rows = list(zip(bucket[order].tolist(), keys[order].tolist(), last[order].tolist()))
        assert rows == sorted(rows)


def test_a_bucket_of_weights_is_one_row():
    rng = np.random.default_rng(5)
    key = rng.permutation(hashes(rng, 1000))
    root, weight, word = -rng.random(len(key)), rng.normal(size=len(key)), rng.integers(0, 2, len(key)).astype(np.int32)
    table = pa.table({"key": key.view(np.int64), "root": root, "weight": weight, "word": word, "bucket": np.full(len(key), 7)})
    row = lm.pack_weights(table)
    assert row.num_rows == 1 and row["bucket"].to_pylist() == [7]
    order = np.argsort(key)
    for got, want in zip(lm.unpack_weights(row), (key, root, weight, word)):
        assert (got == want[order]).all()
    assert all(len(x) == 0 for x in lm.unpack_weights(row.slice(0, 0)))


def test_what_a_bucket_is_asked_for_does_not_grow():
    """A table that grows slower than the texts still gets a bucket for so many tokens of a slice."""
    rows = 1 << 20
    for tokens in (1 << 20, 1 << 26, 1 << 32):
        buckets = lm.weight_buckets(rows, tokens)
        assert rows <= buckets * lm.WEIGHT_BUCKET
        assert tokens <= buckets * lm.SLICES * lm.ASK_BUCKET
    assert lm.weight_buckets(0, 0) == 1


def test_many_buckets_in_small_batches_give_the_scores_of_one(spark, monkeypatch):
    texts = [" ".join(f"w{(i * k) % 37}x" for k in range(1, 60 + i % 40)) for i in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")

    def scores():
        return {r["doc_id"]: r for r in lm.score(docs, lm.fit(docs)).collect()}

    # no word or n-gram is held by every task, so that all weights are asked for
    monkeypatch.setattr(lm, "FREQUENT", 2.0)
    one = scores()
    # packed rows reach Python in batches bounded by bytes, whatever the number of rows
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= 1 << 22
    monkeypatch.setattr(lm, "ASK_BUCKET", 1000)
    monkeypatch.setattr(lm, "BATCH_BYTES", 1 << 10)
    many = scores()
    assert one.keys() == many.keys() == set(range(300))
    for i, r in one.items():
        assert (r["n_tokens"], r["n_known"]) == (many[i]["n_tokens"], many[i]["n_known"])
        assert abs(r["score"] - many[i]["score"]) < 1e-9 and abs(r["base_score"] - many[i]["base_score"]) < 1e-9
        assert r["score"] != r["base_score"]
