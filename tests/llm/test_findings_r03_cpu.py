"""What the language model does with less time: words from bytes, orders from one sort of numbers, packed numbers without empty planes."""

import random
import re

import numpy as np
import pyarrow as pa

from shoal.llm import lm
from shoal.llm.common import Texts

LOW = {c: c + 32 for c in range(65, 91)}


def test_words_are_hashed_from_bytes():
    rng = random.Random(3)
    chars = "aAbBzZ[@é Éß\t\n\x0b\x0c\r\x08\x0e\x1f\xa0 x😀"
    texts = ["".join(rng.choice(chars) for _ in range(rng.choice([0, 1, 3, 9, 40, 200]))) for _ in range(300)]
    n = lm.LONG_WORD
    texts += [None, "", "   ", *(f"{'a' * k} {'A' * k} {'a' * (k - 1)}b" for k in (7, 8, 9, 16, 17, n - 1, n, n + 1, n + 8, 3 * n))]
    for first in (0, 5, 299):
        t = Texts(pa.array(texts).slice(first), 0)
        h, each = lm.word_hashes(t)
        want = [re.findall(r"[^\x20\x09-\x0D]+", (x or "").translate(LOW)) for x in texts[first:]]
        assert each.tolist() == [len(w) for w in want]
        words = [x for w in want for x in w]
        # equal words, and only those, have equal hashes
        assert len(h) == len(words) and len(set(zip(words, h.tolist()))) == len(set(words)) == len(set(h.tolist()))
        token, doc, place = lm.sequence(t)
        assert (token[(token != lm.BEGIN) & (token != lm.END)] == h).all() and (np.bincount(doc) == each + 2).all()
        assert (token[place == 0] == lm.BEGIN).all()
        assert "codes" not in vars(t)  # no array of code points is made for it
    for none in (pa.array([], pa.string()), pa.array([None, ""], pa.string())):
        assert lm.word_hashes(Texts(none, 0))[1].tolist() == [0] * len(none)


def test_order_by_key_keeps_equal_keys_as_they_came():
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 1 << 64, 700, dtype=np.uint64)
    close = keys[:1] + np.arange(700, dtype=np.uint64)[::-1]  # differ in their last bits only
    for some in (keys, rng.choice(keys, 5000), close, rng.choice(close, 5000), keys[:1], keys[:0]):
        order, got = lm.by_key(some)
        assert order.tolist() == np.argsort(some, kind="stable").tolist() and (got == some[order]).all()


def test_packed_numbers_have_no_empty_planes():
    rng = np.random.default_rng(5)
    for bits in (1, 8, 9, 40, 64):
        x = rng.integers(0, 1 << bits, 3000, dtype=np.uint64)
        raw = lm.packed(x)
        assert raw[0] == (bits + 7) // 8 and (lm.unpacked(raw, len(x)) == x).all()
    assert len(lm.unpacked(lm.packed(np.zeros(0, np.int64)), 0)) == 0


def test_buckets_follow_the_order_of_keys_here_and_in_spark(spark):
    rng = np.random.default_rng(6)
    keys = np.r_[np.sort(rng.integers(0, 1 << 64, 500, dtype=np.uint64)), np.uint64(2**64 - 1)]
    for buckets in (1, 7, 5000):
        mine = lm.bucket_of(keys, buckets)
        assert (np.diff(mine) >= 0).all() and mine.min() >= 0 and mine.max() == buckets - 1
        df = spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "key long")
        told = {r["key"]: r["b"] for r in df.select("key", lm.bucket_column("key", buckets).alias("b")).collect()}
        assert [told[int(k)] for k in keys.view(np.int64)] == mine.tolist()
