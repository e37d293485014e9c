"""What the findings of the third round changed: packed counts of n-grams, edges met by level."""

import random

import numpy as np
from pyspark.sql import functions as F

from shoal.llm import lm, spelling


def test_packed_counts_hold_frequent_words_by_number():
    rng = np.random.default_rng(7)
    hashes = np.unique(rng.integers(1, 1 << 63, 500).astype(np.uint64) * np.uint64(2) + np.uint64(1))
    words, rare = hashes[::2], hashes[1::2]
    for tokens, small in ((words, True), (hashes, False), (rare, False)):
        node = rng.choice(hashes[:40], 20_000)
        nxt = rng.choice(tokens, 20_000)
        whole = lm.extend(node, nxt)
        want = {(int(a), int(b)): int(n) for (a, b), n in zip(*np.unique(np.stack([node, nxt], 1), axis=0, return_counts=True))}
        rows = lm.pack_grams(whole, node, nxt, 4, words)
        got = lm.unpack_grams(rows, words)
        assert {(int(a), int(b)): int(n) for a, b, n in zip(*got)} == want and len(got[0]) == len(want)
        if small:  # a hash for each would take eight bytes and those of its context
            assert sum(rows.column(c).nbytes for c in range(2, rows.num_columns)) < 6 * len(want)


def test_edges_stand_on_the_level_at_which_states_meet_them(spark):
    rng = random.Random(5)
    texts = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(6, 11))) for _ in range(300)})
    words = spark.createDataFrame(list(enumerate(texts)), "id long, word string")
    edges = spelling.trie(words).filter("salt = 0").select("node", "child", "label", "level").collect()
    up = {r["child"]: r for r in edges}
    assert len(up) == len(edges) and max(r["level"] for r in edges) > 3

    def above(r):
        return 0 if r["node"] not in up else 1 + above(up[r["node"]])

    assert all(r["level"] == above(r) for r in edges)
    near = spelling.neighbours(words.withColumn("n", F.lit(1).cast("long"))).collect()

    def one_apart(a, b):
        if len(a) > len(b):
            a, b = b, a
        at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a != b and (a[at:] == b[at + 1:] or len(a) == len(b) and a[at + 1:] == b[at + 1:])

    assert sorted(map(tuple, near)) == [(a, b) for a in texts for b in texts if one_apart(a, b)]
