"""Near-duplicates by one-permutation MinHash with optimal densification.

1. One pass over the texts: the set of distinct 2- or 5-word shingles as hashes, a 128-bit digest of
   the set, and ``BANDS x ROWS`` one-permutation bins. An empty bin probes other bins in a
   pseudo-random order that depends on the bin and the attempt alone, until it meets a filled one, so
   its value behaves like one more independent minimum even for sets far smaller than the bins.
2. Documents with equal sets form a class; only the class with its smallest id goes on.
3. Classes that agree on a band share a bucket. Each bucket proposes a star: its smallest member
   against every other, so a bucket of m members gives m - 1 pairs.
4. Proposed pairs are confirmed on the full shingle sets of both texts.
5. A star can miss a link between two of its points. Where the members of a bucket are not in one component after
   that, those outside the centre's component are a query set that is compared with all members under that
   centre, block against block inside a task, on whole shingle sets. Only links that join two components leave the task.
6. Components of the confirmed links.

With 40 bands of 5 a pair of similarity 0.8 shares no band with probability 1e-7.

Edge cases: NULL or blank text: no shingle, linked with nothing. Fewer words than a shingle has:
the whole sequence is the one shingle. A NULL doc_id takes no part: component NULL, kept false. Rows
that repeat a doc_id are separate rows of one document: each gets the component of its own text. Extra columns
are ignored; an empty table gives none.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import (MIX1, ODD, Texts, append_columns, bounded_batches, chunks, components, few_files, lists,
                              materialise, splitmix)

BANDS, ROWS = 40, 5
#: Pairs of texts that one Python worker holds at a time while it confirms them.
PAIR_ROWS = 64
#: Documents and shingles of one side of a block, shingles counted at a time.
BLOCK_DOCS, BLOCK_SHINGLES, COLUMNS = 512, 200_000, 4096
#: As many plain rows as one text, or its comparison, counts when a table's files are numbered.
TEXT_ROWS = 16
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text: str | None, width: int) -> set:
    """The distinct shingles of a text as tuples of words: the definition that links are confirmed by."""
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return set()
    if len(words) < width:
        return {tuple(words)}
    return set(zip(*(words[i:] for i in range(width))))


def shingle_hashes(t: Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of the distinct shingles, sorted by document and hash."""
    starts, ends, doc = t.words()
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = t.hashes(t.lowered(), starts, ends)
    first = np.searchsorted(doc, np.arange(t.n))
    size = np.diff(np.r_[first, len(doc)])
    with np.errstate(over="ignore"):
        # the last word of every full shingle, or of a text shorter than one
        last = np.arange(len(doc)) - first[doc] + 1
        at = np.flatnonzero((last >= width) | (last == size[doc]))
        out = np.zeros(len(at), np.uint64)
        for k in range(width):
            there = last[at] > k
            out[there] = out[there] * ODD + h[at[there] - k]
        out = splitmix(out + MIX1)
    own = doc[at]
    order = np.lexsort((out, own))
    out, own = out[order], own[order]
    new = np.r_[True, (out[1:] != out[:-1]) | (own[1:] != own[:-1])]
    return out[new], own[new]


def densified(values: np.ndarray, own: np.ndarray, n: int, bins: int) -> np.ndarray:
    """n x bins minima; rows of documents without a shingle are zero."""
    full = np.full(n * bins, np.iinfo(np.uint64).max, np.uint64)
    # the upper 32 bits choose the bin, the whole remixed hash is compared
    cell = own * bins + ((values >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    with np.errstate(over="ignore"):
        mixed = splitmix(values ^ ODD) >> np.uint64(1)
    order = np.lexsort((mixed, cell))
    first = order[np.r_[True, cell[order][1:] != cell[order][:-1]]] if len(order) else order
    full[cell[first]] = mixed[first]
    full = full.reshape(n, bins)
    empty = full == np.iinfo(np.uint64).max
    some = ~empty.all(1)
    out = full.copy()
    r, b = np.nonzero(empty & some[:, None])
    attempt = 0
    with np.errstate(over="ignore"):
        while len(r):
            attempt += 1
            probe = splitmix(b.astype(np.uint64) * MIX1 + np.uint64(attempt) * ODD)
            probe = ((probe >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
            hit = ~empty[r, probe]
            out[r[hit], b[hit]] = full[r[hit], probe[hit]]
            r, b = r[~hit], b[~hit]
    out[~some] = 0
    return out


def sketch(docs: DataFrame, width: int, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` with n_shingles, the digest (d1, d2) of the shingle set and its band hashes
    (empty array without shingles)."""
    bounded_batches(docs.sparkSession)

    def run(b: pa.RecordBatch):
        size, d1, d2, bands, held = [np.zeros(0, np.int64)], [], [], [], [np.zeros(0, np.int64)]
        for t in chunks(b.column("text")):
            h, own = shingle_hashes(t, width)
            n = np.bincount(own, minlength=t.n)
            first = np.searchsorted(own, np.arange(t.n))
            with np.errstate(over="ignore"):
                for out, x in ((d1, splitmix(h + ODD)), (d2, splitmix(h ^ MIX1))):
                    sums = np.r_[np.uint64(0), np.cumsum(x, dtype=np.uint64)]
                    out.append((sums[first + n] - sums[first]).view(np.int64))
                mins = densified(h, own, t.n, BANDS * ROWS).reshape(t.n, BANDS, ROWS)
                band = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (t.n, BANDS)) * MIX1
                for k in range(ROWS):
                    band = splitmix(band * ODD + mins[:, :, k])
            size.append(n)
            some = n > 0
            bands.append(band[some].ravel().view(np.int64))
            held.append(np.where(some, BANDS, 0))
        cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return [pa.array(cat(size)), pa.array(cat(d1)), pa.array(cat(d2)), lists(cat(bands), cat(held))]

    return append_columns(docs, carry, ["text"], run, "n_shingles long, d1 long, d2 long, bands array<long>")


def confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b) -> (a, b, inter, total) with the size of the intersection and union of the full sets.
    ``texts`` has (node, text)."""
    spark = pairs.sparkSession
    bounded_batches(spark, PAIR_ROWS)
    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b"))

    def run(batches):
        last, held = None, set()
        for x in batches:
            inter, total = [], []
            for ta, tb in zip(x.column("ta"), x.column("tb")):
                if last is None or not last.equals(tb):
                    last, held = tb, shingle_set(tb.as_py(), width)
                own = shingle_set(ta.as_py(), width)
                n = len(own & held)
                inter.append(n)
                total.append(len(own) + len(held) - n)
            yield pa.RecordBatch.from_arrays([x.column("a"), x.column("b"), pa.array(inter, pa.int64()),
                                              pa.array(total, pa.int64())], ["a", "b", "inter", "total"])

    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long, inter long, total long")


def cross_links(table: pa.Table, width: int, percent: int) -> pa.Table:
    """Rows that ask against the others of a block: (a, b) for links between different groups, one per asking
    row and group. Overlaps are counted on hashes and every link is confirmed on the sets of words."""
    asks, node, group = (table.column(c).to_numpy() for c in ("asks", "node", "group"))
    text = table.column("text").combine_chunks()
    pairs = [np.zeros((0, 2), np.int64)]
    if asks.any() and not asks.all():
        found, owner = [], []
        for t in chunks(text.chunk(0) if isinstance(text, pa.ChunkedArray) else text):
            h, own = shingle_hashes(t, width)
            found.append(h)
            owner.append(own + t.first)
        names, at = np.unique(np.concatenate(found), return_inverse=True)
        own = np.concatenate(owner)
        size = np.bincount(own, minlength=len(node))
        left, right = np.flatnonzero(asks), np.flatnonzero(~asks)
        place = np.zeros(len(node), np.int64)
        place[left], place[right] = np.arange(len(left)), np.arange(len(right))
        mine = asks[own]
        both = np.zeros(len(names), bool)  # only shingles on both sides can be shared
        both[at[mine]] = True
        there = np.zeros(len(names), bool)
        there[at[~mine]] = True
        both &= there
        column = np.cumsum(both) - 1
        use = both[at]
        row, col, mine = place[own[use]], column[at[use]], mine[use]
        order = np.argsort(col, kind="stable")
        row, col, mine = row[order], col[order], mine[order]
        inter = np.zeros((len(left), len(right)), np.float32)
        for lo in range(0, int(both.sum()), COLUMNS):
            a, b = np.searchsorted(col, [lo, lo + COLUMNS])
            x, y = (np.zeros((n, COLUMNS), np.float32) for n in inter.shape)
            x[row[a:b][mine[a:b]], col[a:b][mine[a:b]] - lo] = 1
            y[row[a:b][~mine[a:b]], col[a:b][~mine[a:b]] - lo] = 1
            inter += x @ y.T
        whole = size[left][:, None] + size[right][None] - inter
        i, j = np.nonzero((100 * inter >= percent * whole) & (group[left][:, None] != group[right][None]))
        if len(i):
            keys = np.stack([node[left[i]], group[right[j]]])
            _, first = np.unique(keys, axis=1, return_index=True)
            for a, b in zip(left[i[first]], right[j[first]]):
                u, v = (shingle_set(text[int(k)].as_py(), width) for k in (a, b))
                if 100 * len(u & v) >= percent * len(u | v):
                    pairs.append(np.array([[node[a], node[b]]]))
    out = np.concatenate(pairs)
    return pa.table({"a": pa.array(out[:, 0]), "b": pa.array(out[:, 1])})


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).
    Documents are linked when 100 * intersection >= percent * union of their shingle sets."""
    sketched = materialise(sketch(docs, width), "minhash-sets")
    ready = sketched.filter("n_shingles > 0 and doc_id is not null")
    # bounds of the tables' rows, so that small ones become few files
    n = sketched.count()
    classes = materialise(ready.groupBy("d1", "d2").agg(F.min("doc_id").alias("node"),
                                                        F.first("n_shingles").alias("size"),
                                                        F.first("bands").alias("bands")), "minhash-classes", rows=8 * n)
    spread = classes.select(F.explode("bands").alias("bucket"), "node", "size")
    centres = spread.groupBy("bucket").agg(F.min("node").alias("centre"), F.max("node").alias("top")) \
        .filter("centre < top").drop("top")
    members = materialise(spread.join(centres, "bucket"), "minhash-buckets", rows=BANDS * n)
    held = members.count()

    # equal digests again fold repeated ids; a text is looked up once per class
    wanted = members.select("node").distinct()
    texts = materialise(docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("node"), "left_semi")
                        .select(F.col("doc_id").alias("node"), "text").distinct(), "minhash-texts", rows=TEXT_ROWS * min(n, held))
    stars = materialise(members.filter("node <> centre").select("node", "centre").distinct(), "minhash-asked", rows=held)
    first = materialise(confirm(stars.select(F.col("node").alias("a"), F.col("centre").alias("b")), texts, width, percent),
                        "minhash-stars", rows=TEXT_ROWS * stars.count())
    link = f"100 * inter >= {percent} * total"
    groups = components(first.filter(link))

    # buckets whose members are in several components after the first stars, folded by centre
    tagged = materialise(members.join(groups, "node", "left")
                         .select("bucket", "centre", "node", "size", F.coalesce("component", "node").alias("group")),
                         "minhash-tagged")
    mixed = tagged.groupBy("bucket").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).filter("lo < hi")
    rest = (tagged.join(mixed.select("bucket"), "bucket").select("centre", "node", "size", "group").distinct()
            .join(groups.select(F.col("node").alias("centre"), "component"), "centre", "left")
            .withColumn("outside", F.col("group") != F.coalesce("component", "centre")).drop("component"))
    rest = materialise(rest, "minhash-rest", rows=held)
    left = rest.count()
    blocks = lambda when: F.ceil(F.greatest(F.count(when) / BLOCK_DOCS,
                                            F.sum(F.when(when.isNotNull(), F.col("size"))) / BLOCK_SHINGLES)).cast("int")
    sizes = materialise(rest.groupBy("centre").agg(blocks(F.when(F.col("outside"), 1)).alias("ls"),
                                                   blocks(F.lit(1)).alias("rs")), "minhash-sizes", rows=left)
    part = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    sized = rest.join(sizes, "centre").join(texts, "node")
    body = ["centre", "node", "group", "text"]
    asked = sized.filter("outside").select(*body, F.lit(True).alias("asks"), part("ls", 1).alias("lb"), every("rs").alias("rb"))
    there = sized.select(*body, F.lit(False).alias("asks"), every("ls").alias("lb"), part("rs", 2).alias("rb"))
    second = materialise(asked.unionByName(there).groupBy("centre", "lb", "rb")
                         .applyInArrow(lambda t: cross_links(t, width, percent), "a long, b long"), "minhash-rest-links", rows=TEXT_ROWS * left)
    links = first.filter(link).select("a", "b").union(second)
    groups = components(links)

    of_class = classes.select("d1", "d2", "node").join(groups, "node", "left") \
        .select("d1", "d2", F.coalesce("component", "node").alias("component_id"))
    alone = sketched.filter("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = (ready.select("doc_id", "n_shingles", "d1", "d2").join(of_class, ["d1", "d2"])
           .select("doc_id", "n_shingles", "component_id").union(alone))
    return few_files(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))), n)


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 1 THEN w
                      ELSE list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) END AS s FROM w),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT a AS node, b AS other FROM link
  UNION
  SELECT r.node, l.b FROM reach r JOIN link l ON r.other = l.a),
low AS (SELECT node, min(other) AS other FROM reach GROUP BY node)
SELECT d.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(other, d.doc_id)) AS component_id,
       coalesce(d.doc_id = least(d.doc_id, coalesce(other, d.doc_id)), false) AS kept
FROM sets d LEFT JOIN low ON d.doc_id = node
"""
