"""Near-duplicate vectors in blocks that meet in waves: disk, and results against plain code."""

import threading
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from shoal.llm import embed_dedup as E


def spread(n, dim, seed, far=0.03):
    """Some vectors alone, some in pairs, a third in one crowd."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    x[n // 3:n // 2] = x[:n // 2 - n // 3] + far * rng.standard_normal((n // 2 - n // 3, dim))
    x[-(n // 3):] = x[0] + far * rng.standard_normal((n // 3, dim))
    return x


def plain(x, node, copies, cosine):
    """Links of each node and the smallest node that it reaches."""
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    near = (u @ u.T >= cosine) & (node[:, None] != node[None])
    links, low = {}, {}
    for k in np.unique(node):
        links[k] = int((near[node == k] * copies[None]).sum())
    root = node.copy()
    while True:
        new = np.array([min([root[i], *root[near[i]], *root[node == node[i]]]) for i in range(len(x))])
        if (new == root).all():
            break
        root = new
    for k, r in zip(node, root):
        low[k] = min(low.get(k, r), r)
    return links, low


@pytest.mark.parametrize("kind, seed, block, cosine", [("<f4", 1, 40, 0.98), ("<f8", 2, 25, 0.98), ("<f4", 3, 1000, 0.98), ("<f8", 4, 7, 0.9)])
def test_blocks_that_meet_find_every_link_once(monkeypatch, kind, seed, block, cosine):
    for name, v in (("CELL", 4), ("TILE", 8), ("WAITING", 16)):
        monkeypatch.setattr(E, name, v)
    rng = np.random.default_rng(seed)
    x = spread(240, 12, seed).astype(kind)
    node, copies = rng.permutation(240), rng.integers(1, 4, 240)
    node[5], node[17] = node[100], node[200]
    u = E.unit(x)
    grid = E.Grid(u[:150], 5, cosine)
    home = grid.home(u)
    cuts = E.Cuts(np.bincount(home, minlength=grid.cells), grid, block)
    own, seen = cuts.block(home, rng.random(240)), cuts.visited(u, home)
    assert cuts.parts == -(-240 // block) and seen[np.arange(240), own].all()
    assert seen.tolist() == [[bool((grid.within(u[r:r + 1], np.arange(f, t)).any())) for f, t in spans(cuts, grid, b)] for r, b in
                             ((r, range(cuts.parts)) for r in range(240))]
    links, edges = dict.fromkeys(node.tolist(), 0), []
    for low in range(cuts.parts):
        for high in range(low, cuts.parts):
            r = np.flatnonzero(((own == low) & seen[:, high]) | ((own == high) & seen[:, low]))
            if not len(r):
                continue
            v = E.packed(pa.ListArray.from_arrays(pa.array(np.arange(len(r) + 1, dtype=np.int32) * 12), pa.array(x[r].ravel())), kind)
            out = E.compare(pa.table({"node": node[r], "copies": copies[r], "home": home[r], "second": own[r] > low, "v": v,
                                      "dim": np.full(len(r), 12), "low": np.full(len(r), low), "high": np.full(len(r), high)}), {12: grid}, kind, cosine)
            for k, n, root in zip(*(c.to_pylist() for c in out.columns)):
                assert root <= k
                links[k] += n
                edges.append((k, root))
    want, low = plain(x, node, copies, cosine)
    assert links == want
    got = {k: k for k in links}
    for _ in range(240):
        for a, b in edges:
            got[a] = got[b] = min(got[a], got[b])
    assert got == low


def spans(cuts, grid, blocks):
    for b in blocks:
        mine = [(i, j, k) for block, i, j, k in cuts.stretches if block == b]
        yield mine[0][0] * grid.width + mine[0][1], mine[-1][0] * grid.width + mine[-1][2]


def test_waves_take_every_distance_once():
    for parts, limit in (([(1, 9)], 1), ([(7, 70), (4, 40), (1, 5)], 150), ([(30, 300)], 0), ([(2, 10), (5, 50)], 10 ** 6)):
        out = E.waves(parts, limit)
        assert [d for a, b in out for d in range(a, b + 1)] == list(range(max(n for n, _ in parts) // 2 + 1))
    assert E.waves([(30, 300)], 0)[1] == (1, 1) and len(E.waves([(30, 300)], 10 ** 6)) == 1


@pytest.mark.parametrize("kind", ["float", "double"])
def test_embedding_dedup_of_many_blocks_equals_brute_force(spark, monkeypatch, kind):
    """Labels of many blocks and of one, lengths 12 and 8, repeated ids and vectors, zeros of both signs."""
    for name, v in (("BLOCK", 24), ("CELL", 6), ("WAVE_BYTES", 0)):
        monkeypatch.setattr(E, name, v)
    rows = [(i, v.tolist(), "a") for i, v in enumerate(spread(150, 12, 5))]
    rows += [(1000 + i, v.tolist(), "b") for i, v in enumerate(spread(15, 12, 6))]
    rows += [(2000 + i, v.tolist(), "a") for i, v in enumerate(spread(60, 8, 7))]
    rows += [(3000 + i, rows[3][1], "a") for i in range(40)] + [(7, rows[9][1], "a"), (7, rows[9][1], "a"), (160, rows[3][1], "b")]
    rows += [(4000, [0.0] * 11 + [1.0], "a"), (4001, [-0.0] * 11 + [1.0], "a"), (4001, [0.0] * 11 + [1.0], "a")]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label string")
    rows = [(r["vec_id"], np.array(r["embedding"]), r["label"]) for r in df.collect()]
    classes = {}
    for i, v, k in rows:
        classes.setdefault((k, tuple((v + 0.0).tolist())), []).append(i)
    pooled, reach = {}, {}
    for k in "ab":
        for d in (8, 12):
            some = [(v, ids) for (key, v), ids in classes.items() if key == k and len(v) == d]
            if some:
                links, low = plain(np.array([v for v, _ in some]), np.array([min(ids) for _, ids in some]), np.array([len(ids) for _, ids in some]), 0.98)
                for n in links:
                    pooled[n] = pooled.get(n, 0) + links[n]
                    reach.setdefault(n, set()).add(low[n])
    assert all(len(v) == 1 for v in reach.values())
    want = []
    for i, v, k in rows:
        ids = classes[k, tuple((v + 0.0).tolist())]
        low = next(iter(reach[min(ids)]))
        want.append((i, pooled[min(ids)] + len(ids) - 1, low, i == low))
    assert sorted(map(tuple, E.near_duplicates(df).collect())) == sorted((int(a), int(b), int(c), bool(d)) for a, b, c, d in want)


def test_embedding_dedup_disk_follows_the_vectors(spark):
    """Shuffle files of 4,000 vectors that visit many cells: a few copies of the vectors at a time."""
    n, dim = 4000, 64
    x = np.random.default_rng(8).standard_normal((n, dim)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), i % 2) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int").cache()
    assert df.count() == n
    spark._jvm.System.gc()
    time.sleep(1)
    top = [Path(f.getPath()) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def used():
        total = 0
        for f in (f for d in top for f in d.rglob("*")):
            try:
                total += f.stat().st_size if f.is_file() else 0
            except OSError:
                pass
        return total

    before, most, over = used(), [0], threading.Event()

    def watch():
        while not over.wait(0.1):
            most[0] = max(most[0], used() - before)

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        found = E.near_duplicates(df).collect()
    finally:
        over.set()
        watcher.join()
        df.unpersist()
    u = x / np.linalg.norm(x, axis=1)[:, None]
    assert len(found) == n and all(r["kept"] for r in found) == ((u @ u.T >= 0.98).sum() == n)
    assert most[0] < 4 * n * dim * 4, most
