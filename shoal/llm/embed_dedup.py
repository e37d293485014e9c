"""Near-duplicate vectors by an inverted multi-index.

Vectors of one label are compared. Equal vectors form a class and are compared once. Unit vectors are halved and each
half has its own codebook, so a vector's home is a cell of the product grid. From a vector, a cell is at least as
far as the bisectors between its nearest centroids and the cell's, one bound per half; it visits the cells whose combined
bound is within ``reach``. The reach is the distance of the furthest link, sqrt(2 - 2 cosine), and the bounds never exceed
the distance, so no link is missed. Of two linked vectors each visits the other's home: a pair is compared only if both do.

Neighbouring cells of a label make up a block, as many as fit a task, a crowded cell several. A vector is sent to each block
that it visits, not to each cell: two blocks meet in one task, where the cells are visited. Blocks meet in waves, those
that lie equally far apart together, so that few copies of the vectors are on disk at a time. Vectors are compared in
single precision and, close to the limit, in double precision. A task gives link counts and a spanning set of its links, never its pairs.

Edge cases: a NULL label, or a vector that is NULL, empty, zero or holds NULL or non-finite components: no link,
its own component. NULL id: takes no part, component NULL, kept false. Rows that repeat an id count as vectors
whose links are pooled; vectors of different length are never linked. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm.common import append_columns, bounded_batches, components, drop_table, hash_sample, lists, materialise
from shoal.llm.vectors import valid

COSINE = 0.98
#: Vectors the codebooks are fitted on, at most about; rounds; vectors of a block, and their bytes, at most about.
SAMPLE, ROUNDS, BLOCK, BLOCK_BYTES = 8192, 8, 1 << 16, 1 << 24
#: Vectors of the largest label in a cell, about; centroids of a half, at most; vectors of a tile's side.
CELL, CENTROIDS, TILE = 1024, 64, 1024
#: A wave sends so many copies of all vectors, or so many bytes if that is more; links that wait to be joined.
WAVE, WAVE_BYTES, WAITING = 2, 1 << 27, 1 << 18


def codebook(x: np.ndarray, k: int) -> np.ndarray:
    """k-means centroids of the rows of ``x``, always the same ones."""
    rng = np.random.default_rng(3)
    c = x[rng.permutation(len(x))[:k]]
    for _ in range(ROUNDS):
        own = ((c * c).sum(1)[None] - 2 * x @ c.T).argmin(1)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        n = np.bincount(own, minlength=len(c))
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return np.unique(c, axis=0)


def bounds(x: np.ndarray, c: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
    """Rows x centroids: least distance from a row to any point nearer that centroid than the row's own."""
    d = (c * c).sum(1)[None] - 2 * x @ c.T
    own = d.argmin(1) if own is None else own
    apart = np.sqrt(np.maximum(((c[:, None] - c[None]) ** 2).sum(2), 0))[own]
    gap = d - d[np.arange(len(x)), own][:, None]
    out = np.divide(gap, 2 * apart, out=np.zeros_like(gap), where=apart > 0)
    out[np.arange(len(x)), own] = 0
    return out


class Grid:
    def __init__(self, x: np.ndarray, k: int, cosine: float):
        self.half = x.shape[1] // 2
        self.books = [codebook(x[:, :self.half], k), codebook(x[:, self.half:], k)]
        self.width = len(self.books[1])
        self.cells = len(self.books[0]) * self.width
        # a vector in a cell is no nearer than the bisectors of the cell's centres, so no link lies beyond its own length
        self.reach = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-6

    def sides(self, x, home=None):
        own = (None, None) if home is None else np.divmod(home, self.width)
        return bounds(x[:, :self.half], self.books[0], own[0]), bounds(x[:, self.half:], self.books[1], own[1])

    def home(self, x: np.ndarray) -> np.ndarray:
        i, j = (((c * c).sum(1)[None] - 2 * v @ c.T).argmin(1)
                for v, c in zip((x[:, :self.half], x[:, self.half:]), self.books))
        return i * self.width + j

    def squares(self, x: np.ndarray, home: np.ndarray | None = None) -> list[np.ndarray]:
        """The bounds of both halves, squared; what single precision loses is far below what ``reach`` adds."""
        return [np.square(v).astype(np.float32) for v in self.sides(x, home)]

    def within(self, x: np.ndarray, cells: np.ndarray, home: np.ndarray | None = None) -> np.ndarray:
        """Rows x ``cells``, which are sorted: whether the row visits the cell."""
        a, b = self.squares(x, home)
        out, limit = np.empty((len(x), len(cells)), bool), np.float32(self.reach ** 2)
        first, cut = np.unique(cells // self.width, return_index=True)
        for i, s, t in zip(first, cut, np.r_[cut[1:], len(cells)]):
            j = cells[s:t] % self.width
            near = b if t - s == self.width else b[:, j[0]:j[-1] + 1] if j[-1] - j[0] + 1 == t - s else b[:, j]
            np.less_equal(near, (limit - a[:, i])[:, None], out=out[:, s:t])
        return out

    def visits(self, x: np.ndarray) -> list[np.ndarray]:
        """Cells to visit per row, nearest first; the home is the first."""
        home, seen = self.home(x), self.within(x, np.arange(self.cells))
        a, b = self.squares(x)
        far = (a[:, :, None] + b[:, None]).reshape(len(x), -1)
        far[np.arange(len(x)), home] = -1
        order = np.argsort(np.where(seen, far, np.inf), axis=1, kind="stable")
        return [o[:n] for o, n in zip(order, seen.sum(1))]


def packed(col: pa.Array, kind: str) -> pa.Array:
    """Lists of numbers as their bytes, NULL for NULL; equal numbers have equal bytes."""
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(kind) + np.zeros((), kind)  # -0.0 becomes 0.0
    there = col.is_valid().to_numpy(zero_copy_only=False)
    off = np.r_[0, np.cumsum(np.where(there, np.diff(col.offsets.to_numpy()), 0))] * flat.itemsize
    return pa.Array.from_buffers(pa.binary(), len(col), [pa.py_buffer(np.packbits(there, bitorder="little")), pa.py_buffer(off.astype(np.int32)),
                                                         pa.py_buffer(flat)])


def unpacked(col: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    """Rows of :func:`packed` vectors of one length as a matrix."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not len(col):
        return np.zeros((0, 0), kind)
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2], np.uint8)[off[0]:off[-1]].view(kind).reshape(len(col), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows in double precision, divided by their length."""
    x = x.astype(np.float64)
    with np.errstate(all="ignore"):
        x /= np.linalg.norm(x, axis=1)[:, None]
    return np.nan_to_num(x, copy=False, nan=0, posinf=0, neginf=0)


class Cuts:
    """How a label's vectors are cut into ``parts`` blocks, by how many of them each cell holds: in order of their cells, those
    of a cell in order of a hash."""

    def __init__(self, counts: np.ndarray, grid: Grid, rows: int):
        self.counts, self.start = counts, np.r_[0, np.cumsum(counts)]
        self.parts = max(1, -(-int(self.start[-1]) // rows))
        self.rows = max(1.0, self.start[-1] / self.parts)
        low = np.minimum(self.start[:-1] // self.rows, self.parts - 1)
        high = np.maximum(low, np.minimum((self.start[1:] - 1) // self.rows, self.parts - 1))
        # first cell of each block and the first beyond it; a cell can lie in several
        first = np.searchsorted(high, np.arange(self.parts))
        beyond = np.searchsorted(low, np.arange(self.parts), "right")
        #: block, centroid of the first half, range of those of the second
        self.stretches = [(b, i, max(f - i * grid.width, 0), min(t - i * grid.width, grid.width))
                          for b, (f, t) in enumerate(zip(first.tolist(), beyond.tolist())) for i in range(f // grid.width, -(-t // grid.width))]
        self.grid = grid

    def block(self, home: np.ndarray, where: np.ndarray) -> np.ndarray:
        """The block of vectors of these cells; ``where``: a hash from 0 to below 1."""
        at = self.start[home] + np.floor(where * self.counts[home])
        return np.minimum(at // self.rows, self.parts - 1).astype(np.int64)

    def visited(self, x: np.ndarray, home: np.ndarray) -> np.ndarray:
        """Rows x blocks: whether the row visits a cell of the block."""
        a, b = self.grid.squares(x, home)
        out, limit = np.zeros((len(x), self.parts), bool), self.grid.reach ** 2
        for block, i, j, k in self.stretches:
            near = a[:, i] if k - j == self.grid.width else a[:, i] + b[:, j:k].min(1)
            out[:, block] |= near <= limit
        return out


class Groups:
    """Connected groups of the numbers below ``n``; ``label`` is the smallest of a number's group."""

    def __init__(self, n: int):
        self.label, self.waiting, self.size = np.arange(n), [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.waiting.append((a, b))
        self.size += len(a)
        if self.size >= WAITING:
            self.join()

    def join(self) -> None:
        if self.waiting:
            a, b = (np.concatenate(v) for v in zip(*self.waiting))
            self.waiting, self.size = [], 0
            while True:
                a, b = self.label[a], self.label[b]
                apart = a != b
                if not apart.any():
                    break
                a, b = a[apart], b[apart]
                np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
                while True:
                    low = self.label[self.label]
                    if (low == self.label).all():
                        break
                    self.label = low


def runs(home: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted homes in runs of ``rows`` rows at least, if there are as many, that never part a cell: the distinct cells, and
    where each run begins and the last ends among the cells and among the rows."""
    cells, first = np.unique(home, return_index=True)
    ends, cut = np.r_[first[1:], len(home)], [0]
    for k, end in enumerate(ends):
        if end - (first[cut[-1]] if cut[-1] < len(first) else 0) >= rows:
            cut.append(k + 1)
    if cut[-1] < len(cells):
        cut.append(len(cells))
    cut = np.array(cut)
    return cells, cut, np.r_[first, len(home)][cut]


def compare(table: pa.Table, grids: dict[int, Grid], kind: str, cosine: float) -> pa.Table:
    """Two blocks, or one with itself: (node, links, root) with the links counted here and a smaller-or-equal node
    that it is linked with through this task."""
    node, copies, home, second = (table.column(c).to_numpy() for c in ("node", "copies", "home", "second"))
    grid, alone = grids[table.column("dim")[0].as_py()], table.column("low")[0] == table.column("high")[0]
    order = np.lexsort((home, second))
    node, copies, home, second = node[order], copies[order], home[order], second[order]
    raw = unpacked(table.column("v"), kind)
    x = np.empty(raw.shape, np.float32)
    for s in range(0, len(x), 8192):
        x[s:s + 8192] = unit(raw[order[s:s + 8192]])
    # single precision is off by less than this
    slack = (raw.shape[1] + 8) * 2.0 ** -23
    links = np.zeros(len(node), np.int64)
    # rows of one node share a label
    names, at = np.unique(node, return_inverse=True)
    again = len(names) < len(node)
    # single precision counts a tile's links exactly up to here
    exact = np.float32 if copies.max() * TILE < 1 << 24 else np.float64
    groups = Groups(len(names))

    def tile(p: np.ndarray, q: np.ndarray, same: bool) -> None:
        s = x.take(p, axis=0) @ x.take(q, axis=0).T
        if s.max() < cosine - slack:
            return
        if s.min() >= cosine + slack and not again and not same:
            links[p] += copies[q].sum()
            links[q] += copies[p].sum()
            groups.add(at[np.r_[p, q]], at[np.r_[np.full(len(p), q[0]), np.full(len(q), p[0])]])
            return
        hit = s >= cosine - slack
        if again or same:
            hit &= node[p][:, None] != node[q][None]
        i, j = np.nonzero(hit & (s < cosine + slack))
        if len(i):
            for f in range(0, len(i), 8192):
                u, w = i[f:f + 8192], j[f:f + 8192]
                hit[u, w] = (unit(raw[order[p[u]]]) * unit(raw[order[q[w]]])).sum(1) >= cosine
        n = np.count_nonzero(hit)
        if not n:
            return
        if n * 16 > hit.size:
            full = hit.astype(exact)
            links[p] += (full @ copies[q].astype(exact)).astype(np.int64)
            if not same:
                links[q] += (copies[p].astype(exact) @ full).astype(np.int64)
            one, two = groups.label[at[p]], groups.label[at[q]]
            if one.max() == two.min() and one.min() == two.max():
                return
            i, j = np.nonzero(hit & (one[:, None] != two[None]))
            a, b = p[i], q[j]
        else:
            i, j = np.nonzero(hit)
            a, b = p[i], q[j]
            np.add.at(links, a, copies[b])
            if not same:
                np.add.at(links, b, copies[a])
        groups.add(at[a], at[b])

    def tiles(p: np.ndarray, q: np.ndarray, same: bool) -> None:
        for s in range(0, len(p), TILE):
            for t in range(s if same else 0, len(q), TILE):
                tile(p[s:s + TILE], q[t:t + TILE], same and s == t)

    split = int(np.searchsorted(second, True))
    ends = [(0, split), (0, split) if alone else (split, len(node))]
    if min(b - a for a, b in ends):
        cut = [runs(home[a:b], CELL // 4) for a, b in ends]

        def seen(side: int, r: int) -> list[np.ndarray]:
            """For each run of the other side the rows of a run that visit one of its cells."""
            (_, _, rows), (cells, first, _) = cut[side], cut[1 - side]
            start = ends[side][0] + rows[r]
            own = slice(start, ends[side][0] + rows[r + 1])
            near = grid.within(unit(raw[order[own]]), cells, home[own])
            if len(first) <= len(cells):
                near = np.logical_or.reduceat(near, first[:-1], axis=1)
            near = np.ascontiguousarray(near.T)
            return np.split((np.nonzero(near)[1] + start).astype(np.int32), np.cumsum(np.count_nonzero(near, axis=1))[:-1])

        back = [seen(1, t) for t in range(len(cut[1][2]) - 1)]
        for r in range(len(cut[0][2]) - 1):
            for t, p in enumerate(back[r] if alone else seen(0, r)):
                q = back[t][r]
                if len(p) and len(q) and not (alone and t < r):
                    tiles(p, q, alone and t == r)
    groups.join()
    root = names[groups.label[at]]
    keep = (links > 0) | (root != node)
    return pa.table({"node": pa.array(node[keep]), "links": pa.array(links[keep]), "root": pa.array(root[keep])})


def waves(parts: list[tuple[int, int]], limit: int) -> list[tuple[int, int]]:
    """First and last distance of the blocks that meet in each wave, from (blocks, vectors) of the labels: a wave sends ``limit``
    vectors at most, or those of one distance."""
    out, sent = [], 0
    for far in range(max(n for n, _ in parts) // 2 + 1):
        now = sum(rows * (2 if 0 < 2 * far < n else 1) for n, rows in parts if 2 * far <= n)
        if out and sent + now <= limit:
            out[-1], sent = (out[-1][0], far), sent + now
        else:
            out.append((far, far))
            sent = now
    return out


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    bounded_batches(spark, 4096)
    single = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    kind, size = ("<f4", 4) if single else ("<f8", 8)
    ok = valid() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    x = F.when(ok, F.col("embedding").cast("array<float>" if single else "array<double>")).alias("x")
    rows = materialise(append_columns(vectors.select("vec_id", "label", x), ["vec_id", "label"], ["x"],
                                      lambda b: [packed(b.column("x"), kind)], "v binary"), "vec-rows")
    digest = F.unhex(F.md5("v"))
    ids = materialise(rows.select("vec_id", "label", digest.alias("key")), "vec-ids")
    vecs = materialise(rows.filter("v is not null").groupBy("label", "v").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
                       .withColumn("dim", F.expr(f"cast(octet_length(v) / {size} as int)")), "vec-vectors", tidy=True)
    drop_table(rows)
    # joined by a digest from here on, never by the vector
    classes = materialise(vecs.select("label", digest.alias("key"), "node", "copies"), "vec-classes")
    labels = materialise(vecs.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
                         .withColumn("code", F.monotonically_increasing_id()), "vec-labels")
    dims = labels.groupBy("dim").agg(F.sum("n").alias("n"), F.max("n").alias("most")).collect()
    if not dims:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    grids, block = {}, {}
    for dim, n, most in dims:
        part = vecs.filter(F.col("dim") == dim)
        found = hash_sample(part, "node", SAMPLE, n, salt=3).orderBy("node", "label").select("v").collect() or [part.select("v").first()]
        x = unit(np.frombuffer(b"".join(r["v"] for r in found), kind).reshape(-1, dim))
        grids[dim] = Grid(x, int(min(CENTROIDS, max(2, np.ceil(np.sqrt(most / CELL))))), cosine)
        block[dim] = max(1, min(BLOCK, BLOCK_BYTES // (size * dim)))

    def matrices(b: pa.RecordBatch):
        """Rows of each length and their unit vectors."""
        dim, v = b.column("dim").to_numpy(zero_copy_only=False), b.column("v")
        for d in np.unique(dim).tolist():
            at = np.flatnonzero(dim == d)
            for s in range(0, len(at), 2048):
                yield grids[d], at[s:s + 2048], unit(unpacked(v.take(pa.array(at[s:s + 2048])), kind))

    def homes(b: pa.RecordBatch):
        home = np.zeros(len(b), np.int64)
        for grid, at, x in matrices(b):
            home[at] = grid.home(x)
        return [pa.array(home)]

    most = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.expr(f"cast({BLOCK_BYTES} div ({size} * dim) as int)")))
    large = F.broadcast(labels.filter(F.col("n") > most).select("label", "dim", "code"))
    held = materialise(append_columns(vecs.join(large, ["label", "dim"]), ["code", "dim"], ["v"], homes, "home long")
                       .groupBy("code", "dim", "home").agg(F.count(F.lit(1)).alias("n")), "vec-sizes").toArrow()
    code, dim, home, n = (held.column(c).to_numpy() for c in ("code", "dim", "home", "n"))
    cuts = {}
    for c in np.unique(code).tolist():
        own = code == c
        d = int(dim[own][0])
        cuts[c] = Cuts(np.bincount(home[own], n[own], grids[d].cells).astype(np.int64), grids[d], block[d])

    def place(b: pa.RecordBatch):
        code, where = (b.column(c).to_numpy(zero_copy_only=False) for c in ("code", "where"))
        home, own, parts = np.zeros(len(b), np.int64), np.zeros(len(b), np.int32), np.ones(len(b), np.int32)
        row, met = [np.flatnonzero(code < 0)], [np.zeros((code < 0).sum(), np.int64)]
        for grid, at, x in matrices(b):
            home[at] = grid.home(x)
            for c in np.unique(code[at][code[at] >= 0]).tolist():
                some = np.flatnonzero(code[at] == c)
                rows, cut = at[some], cuts[c]
                own[rows], parts[rows] = cut.block(home[rows], where[rows]), cut.parts
                r, v = np.nonzero(cut.visited(x[some], home[rows]))
                row.append(rows[r])
                met.append(v)
        row, met = np.concatenate(row), np.concatenate(met)
        return [pa.array(home), pa.array(own), pa.array(parts),
                lists(met[np.argsort(row, kind="stable")].astype(np.int32), np.bincount(row, minlength=len(b)))]

    where = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 31)) / F.lit(float(1 << 31))
    placed = vecs.join(large, ["label", "dim"], "left").withColumn("code", F.coalesce("code", F.lit(-1))).withColumn("where", where)
    cells = materialise(append_columns(placed, ["label", "dim", "node", "copies", "v"], ["code", "where"], place,
                                       "home long, block int, parts int, blocks array<int>"), "vec-cells")
    drop_table(vecs)
    total = sum(r["n"] for r in dims)
    limit = max(WAVE * total, WAVE_BYTES * total // sum(r["n"] * (64 + size * r["dim"]) for r in dims))
    parts = [(r["parts"], r["n"]) for r in cells.groupBy("parts").agg(F.count(F.lit(1)).alias("n")).collect()]
    far = F.least(F.pmod(F.col("other") - F.col("block"), F.col("parts")), F.pmod(F.col("block") - F.col("other"), F.col("parts")))
    meeting = ["label", "dim", "low", "high"]
    compared = reduce(DataFrame.union, [
        materialise(cells.filter(F.col("parts") >= 2 * first).select("*", F.explode("blocks").alias("other")).filter(far.between(first, last))
                    .select("label", "dim", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                            "node", "copies", "home", (F.col("block") > F.col("other")).alias("second"), "v")
                    .groupBy(*meeting).applyInArrow(lambda t: compare(t, grids, kind, cosine), "node long, links long, root long"),
                    "vec-links", tidy=True)
        for first, last in waves(parts, limit)])
    links = compared.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(compared.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = (classes.join(links, "node", "left").join(groups, "node", "left")
             .select(F.col("label").alias("_l"), F.col("key").alias("_k"),
                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "node").alias("component_id")))
    linked = (ids.join(known, (F.col("label") == F.col("_l")) & (F.col("key") == F.col("_k"))).select("vec_id", "n_links", "component_id"))
    rest = ids.filter("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


ORACLE = """
WITH RECURSIVE ok AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x for x in embedding if x <> 0]) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (
  SELECT a AS node, b AS other FROM link
  UNION
  SELECT r.node, l.b FROM reach r JOIN link l ON r.other = l.a)
SELECT e.vec_id, (SELECT count(*) FROM link WHERE a = e.vec_id) AS n_links,
       least(e.vec_id, coalesce((SELECT min(other) FROM reach WHERE node = e.vec_id), e.vec_id)) AS component_id,
       coalesce(e.vec_id <= coalesce((SELECT min(other) FROM reach WHERE node = e.vec_id), e.vec_id), false) AS kept
FROM embeddings e
"""
