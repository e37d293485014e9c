"""Merkle manifest of a dataset, with leaf coordinates from bitmap ranks.

Each row is a leaf: the sha256 of its columns in a fixed spelling. The leaves of a group (``lang``) stand in order of ``doc_id``;
every two consecutive nodes become the hash of their digests until one is left, and the groups' last nodes are combined likewise.

A leaf's place is its rank, found without sorting the rows. Per group and stretch of ``IDS`` ids the tasks build bitmaps, merged by
OR and cut to the bytes between the first and the last id, with a directory of popcounts by ``WORD`` bytes. A prefix of row counts
over the stretches (spread over tasks by range, also within one group) gives the rank before each. The rank of an id is that
prefix, the directory's entry and the bits below it. Only rows that share an id, or have none, are ordered among each other.

The levels are reduced ``LEVELS`` at a time: nodes that share a block of 2^LEVELS places fill an array by slot, each array is one
row, and its last node is a slot of the next table, 2^LEVELS times smaller. The way back joins each block with the siblings above
it and derives the proofs of its leaves. No block is larger than 2^LEVELS slots, whatever the group.

Edge cases: a NULL column: ``-``. NULL lang: a group of its own, first. NULL doc_id: before all ids of its group, ordered by leaf;
never tampered with. Rows that repeat a doc_id: each is a leaf, ordered by leaf (equal leaves in any order: their rows have the same
set of results). Empty text: ``0:``. A lone leaf is subroot and, if alone, root, with an empty proof. An empty table gives no rows.
Very long texts are hashed whole. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm.common import crc_mod, materialise
from shoal.operators.intervals import prefix_aggregate
from shoal.operators.keys import global_rank

#: Columns of a leaf, in order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Bits of an id within its stretch, ids of a stretch, bytes of a popcount directory's entry.
ID_BITS = 11
IDS, WORD = 1 << ID_BITS, 32
#: Levels reduced at once; rows are tampered with if this divides the crc32 of their id.
LEVELS, TAMPER = 8, 7


def digest(*inputs: str) -> str:
    """Lowercase hex sha256 of the concatenation."""
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def spelled(value: Column) -> Column:
    """``-`` if NULL, else byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, tampered, row): each row's leaf, the leaf after tampering (one more character claimed) and a number."""
    def leaf(n_chars: Column) -> Column:
        return F.sha2(F.concat(*(spelled(n_chars if c == "n_chars" else F.col(c)) for c in COLUMNS)), 256)

    hit = F.coalesce((crc_mod("doc_id", TAMPER) == 0) & F.col("n_chars").isNotNull(), F.lit(False))
    rows = docs.select(*COLUMNS).withColumn("leaf", leaf(F.col("n_chars")))
    return rows.select("doc_id", "lang", "leaf", F.when(hit, leaf(F.col("n_chars") + 1)).otherwise(F.col("leaf")).alias("tampered"),
                       F.monotonically_increasing_id().alias("row"))


def stretch() -> Column:
    return F.shiftright(F.col("doc_id"), ID_BITS)


def low() -> Column:
    return F.col("doc_id").bitwiseAND(F.lit(IDS - 1).cast("long"))


def bitmaps(rows: DataFrame) -> DataFrame:
    """(lang, stretch, n, least, bits, directory): rows of a stretch, its least id, its bitmap from that id's byte on and the popcounts
    before each word. Rows without id are the stretch NULL."""
    built = (rows.select("lang", stretch().alias("stretch"), low().alias("low")).groupBy("lang", "stretch")
             .agg(F.count(F.lit(1)).alias("n"), F.min("low").cast("int").alias("least"), F.max("low").cast("int").alias("most"),
                  F.bitmap_construct_agg("low").alias("bits")))
    return (built.withColumn("bits", F.expr("substring(bits, least DIV 8 + 1, most DIV 8 - least DIV 8 + 1)"))
            .withColumn("directory", F.expr(f"transform(sequence(0, (most DIV 8 - least DIV 8) DIV {WORD}), "
                                            f"w -> bitmap_count(substring(bits, 1, cast(w AS INT) * {WORD})))"))
            .drop("most"))


def rank() -> Column:
    """Ids of the stretch below this row's, by its bitmap."""
    return F.expr(f"""directory[(low DIV 8 - least DIV 8) DIV {WORD}]
        + bitmap_count(substring(bits, (low DIV 8 - least DIV 8) DIV {WORD} * {WORD} + 1, (low DIV 8 - least DIV 8) % {WORD}))
        + bit_count(cast(conv(hex(substring(bits, low DIV 8 - least DIV 8 + 1, 1)), 16, 10) AS INT) & (shiftleft(1, low % 8) - 1))""")


def coordinates(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((tree, size, place, doc_id, leaf, tampered) of the stored ``rows``, (tree, lang, size)): the group's number in order of lang,
    its leaves and the leaf's place among them, both from 0."""
    marked = materialise(bitmaps(rows), "merkle-bitmaps")
    groups = global_rank(marked.groupBy("lang").agg(F.sum("n").alias("size")), [F.col("lang").asc_nulls_first()], "tree")
    groups = materialise(groups.select((F.col("tree") - 1).cast("long").alias("tree"), "lang", "size"), "merkle-groups")
    same_lang = lambda a, b: a["lang"].eqNullSafe(b["lang"])
    marked = marked.join(groups, same_lang(marked, groups)).drop(groups["lang"])
    spans = materialise(prefix_aggregate(marked, ["tree"], ["stretch"], "n", "sum", "before")
                        .withColumn("before", F.coalesce("before", F.lit(0))), "merkle-stretches")
    # ids of several rows, with the rows that they have beyond one: a few of a stretch's ids at most
    crowded = spans.filter(F.coalesce(F.col("n") > F.bitmap_count("bits"), F.lit(False))).select("tree", "lang", "stretch")
    shared = None
    if not crowded.isEmpty():
        near = rows.select("lang", "doc_id", stretch().alias("stretch"), low().cast("int").alias("low"))
        shared = (near.join(crowded, same_lang(near, crowded) & (near["stretch"] == crowded["stretch"]))
                  .groupBy("tree", crowded["stretch"].alias("_stretch"), "low").agg((F.count(F.lit(1)) - 1).alias("more")).filter("more > 0")
                  .groupBy("tree", "_stretch").agg(F.collect_list(F.struct("low", "more")).alias("shared"))
                  .withColumnRenamed("tree", "_tree"))
        spans = spans.join(shared, (F.col("tree") == F.col("_tree")) & (F.col("stretch") == F.col("_stretch")), "left").drop("_tree", "_stretch")
    else:
        spans = spans.withColumn("shared", F.lit(None).cast("array<struct<low: int, more: bigint>>"))
    spans = spans.withColumnRenamed("stretch", "_stretch").withColumnRenamed("lang", "_lang")
    keyed = rows.withColumn("_s", stretch()).withColumn("low", low().cast("int"))
    met = keyed.join(spans, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("_s").eqNullSafe(F.col("_stretch")))
    skipped = F.coalesce(F.expr("aggregate(filter(shared, s -> s.low < low), 0L, (a, s) -> a + s.more)"), F.lit(0))
    met = met.select("tree", "size", (F.col("before") + F.coalesce(rank(), F.lit(0)) + skipped).cast("long").alias("place"),
                     "doc_id", "leaf", "tampered", "row",
                     F.coalesce(F.expr("doc_id is null or exists(shared, s -> s.low = low)"), F.lit(False)).alias("tied"))
    columns = ["tree", "size", "place", "doc_id", "leaf", "tampered"]
    if shared is None and rows.filter("doc_id is null").isEmpty():
        return met.select(columns), groups
    tied = global_rank(met.filter("tied"), ["tree", "place", "leaf", "row"], "_rank")
    first = tied.groupBy(F.col("tree").alias("_t"), F.col("place").alias("_p")).agg(F.min("_rank").alias("_first"))
    tied = (tied.join(first, (F.col("tree") == F.col("_t")) & (F.col("place") == F.col("_p")))
            .withColumn("place", F.col("place") + F.col("_rank") - F.col("_first")))
    return met.filter("not tied").select(columns).union(tied.select(columns)), groups


def steps(size: int, done: int) -> int:
    """Levels that a table of a tree of ``size`` leaves still reduces after ``done`` levels."""
    return max(0, min(LEVELS, (size - 1).bit_length() - done))


def reduced(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of a block by level; the last list has one."""
    out = [nodes]
    for _ in range(levels):
        nodes = [digest(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def sibling(levels: list[list[str]], slot: int) -> list[str]:
    """Per level below the last: the other node of the pair, after ``<`` if it stands left and ``>`` if right; empty if there is none."""
    out = []
    for nodes in levels[:-1]:
        other = slot ^ 1
        out.append(("<" if other < slot else ">") + nodes[other] if other < len(nodes) else "")
        slot >>= 1
    return out


def fold(leaf: str, path: list[str]) -> str:
    for side in path:
        leaf = digest(leaf) if not side else digest(side[1:], leaf) if side[0] == "<" else digest(leaf, side[1:])
    return leaf


def _arrays(b: pa.RecordBatch, name: str, field: str) -> list[list]:
    col = b.column(name)
    flat, at = col.flatten().field(field).to_pylist(), col.offsets.to_pylist()
    return [flat[i - at[0]:j - at[0]] for i, j in zip(at, at[1:])]


def tables(nodes: DataFrame, longest: int, payload: tuple[str, ...] = ()) -> list[DataFrame]:
    """From (tree, size, place, leaf, payload) up: stored tables (tree, size, block, slots, top), the last with one block a tree."""
    out = []
    while True:
        done = LEVELS * len(out)
        block, slot = F.shiftright("place", LEVELS), F.col("place").bitwiseAND(F.lit((1 << LEVELS) - 1)).cast("int")
        held = (nodes.groupBy("tree", "size", block.alias("block"))
                .agg(F.array_sort(F.collect_list(F.struct(slot.alias("slot"), "leaf", *payload))).alias("slots")))
        schema = T.StructType([*held.schema.fields, T.StructField("top", T.StringType())])

        def tops(batches, done=done, names=tuple(schema.names)):
            for b in batches:
                top = [reduced(x, steps(n, done))[-1][0] for x, n in zip(_arrays(b, "slots", "leaf"), b.column("size").to_pylist())]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(top, pa.string())], list(names))

        out.append(materialise(held.mapInArrow(tops, schema), f"merkle-level-{done}"))
        if steps(longest, done + LEVELS) == 0:
            return out
        nodes, payload = out[-1].select("tree", "size", F.col("block").alias("place"), F.col("top").alias("leaf")), ()


def descend(stored: list[DataFrame], above: DataFrame, keep: list[str]) -> DataFrame:
    """The lowest of ``stored`` with each block's ``path`` and the ``keep`` columns, from the (tree, path, keep) of the trees' roots."""
    above = above.withColumn("block", F.lit(0).cast("long"))
    for level in range(len(stored) - 1, 0, -1):
        done = LEVELS * level
        met = stored[level].join(above, ["tree", "block"])
        schema = met.select("tree", "block", "path", *keep).schema

        def spread(batches, done=done, names=tuple(schema.names)):
            for b in batches:
                own, place, path = [], [], []
                blocks = zip(_arrays(b, "slots", "leaf"), b.column("size").to_pylist(), b.column("block").to_pylist(),
                             b.column("path").to_pylist())
                for i, (x, n, at, up) in enumerate(blocks):
                    levels = reduced(x, steps(n, done))
                    own += [i] * len(x)
                    place += [(at << LEVELS) + s for s in range(len(x))]
                    path += [sibling(levels, s) + up for s in range(len(x))]
                own = pa.array(own, pa.int64())
                yield pa.RecordBatch.from_arrays([b.column("tree").take(own), pa.array(place, pa.int64()), pa.array(path, pa.list_(pa.string())),
                                                  *(b.column(c).take(own) for c in names[3:])], list(names))

        above = materialise(met.mapInArrow(spread, schema), f"merkle-paths-{done}")
    return stored[0].join(above, ["tree", "block"])


RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of ``docs``."""
    spark = docs.sparkSession
    rows = materialise(leaves(docs), "merkle-leaves")
    placed, groups = coordinates(rows)
    most = groups.agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("n")).first()
    if not most["n"]:
        return spark.createDataFrame([], RESULT)
    stored = tables(placed, most["size"], ("doc_id", "tampered"))
    subroots = stored[-1].select("tree", F.col("top").alias("subroot"))
    joined = tables(subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(most["n"]).alias("size"), F.col("tree").alias("place"),
                                    F.col("subroot").alias("leaf")), most["n"])
    root = joined[-1].first()["top"]
    # each subroot's own path to the root, then down its tree
    start = joined[-1].select("tree", F.array().cast("array<string>").alias("path")).distinct()
    over = descend(joined, start, [])
    schema = "tree long, path array<string>, subroot string"

    def paths(batches):
        for b in batches:
            tree, path, own = [], [], []
            for x, n, at, up in zip(_arrays(b, "slots", "leaf"), b.column("size").to_pylist(), b.column("block").to_pylist(),
                                    b.column("path").to_pylist()):
                levels = reduced(x, steps(n, 0))
                tree += [(at << LEVELS) + s for s in range(len(x))]
                path += [sibling(levels, s) + up for s in range(len(x))]
                own += x
            yield pa.RecordBatch.from_arrays([pa.array(tree, pa.int64()), pa.array(path, pa.list_(pa.string())), pa.array(own, pa.string())],
                                             ["tree", "path", "subroot"])

    above = materialise(over.mapInArrow(paths, schema), "merkle-subroots")

    def proofs(batches):
        for b in batches:
            out = {c: [] for c in ("doc_id", "leaf", "subroot", "proof", "folded")}
            for ids, x, bad, n, up, sub in zip(*(_arrays(b, "slots", c) for c in ("doc_id", "leaf", "tampered")),
                                               *(b.column(c).to_pylist() for c in ("size", "path", "subroot"))):
                levels = reduced(x, steps(n, 0))
                for s in range(len(x)):
                    path = sibling(levels, s) + up
                    out["proof"].append(digest(*(p[1:] for p in path)))
                    out["folded"].append(fold(bad[s], path))
                out["doc_id"] += ids
                out["leaf"] += x
                out["subroot"] += [sub] * len(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["doc_id"], pa.int64()), pa.array(out["leaf"], pa.string()), pa.array(out["subroot"], pa.string()),
                 pa.array([root] * len(out["leaf"]), pa.string()), pa.array(out["proof"], pa.string()), pa.array(out["folded"], pa.string()),
                 pa.array([f == root for f in out["folded"]], pa.bool_())],
                ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return descend(stored, above, ["subroot"]).mapInArrow(proofs, RESULT)


#: DuckDB has no crc32: its table by rule, and the checksum of a list of bytes.
CRC_SQL = """
crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def crc_sql(values: str) -> str:
    """SQL for the unsigned crc32 of a list of bytes, beside the table ``t`` of :data:`CRC_SQL`."""
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {values}), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)")


def _part(value: str) -> str:
    return f"coalesce(octet_length(encode(({value})::VARCHAR)) || ':' || ({value})::VARCHAR, '-')"


def _leaf_sql(n_chars: str) -> str:
    return f"sha256(concat({', '.join(_part(n_chars if c == 'n_chars' else c) for c in COLUMNS)}))"


def _tree_sql(name: str, source: str) -> str:
    """Nodes of all levels over the (tree, place, digest) of ``source``."""
    return f"""
{name} AS (
  SELECT tree, 0::BIGINT AS level, place, digest, count(*) OVER (PARTITION BY tree) AS n FROM {source}
  UNION ALL
  SELECT tree, level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 1) // 2
  FROM {name} WHERE n > 1 GROUP BY tree, level, place // 2)"""


ORACLE = f"""
WITH RECURSIVE {CRC_SQL},
hashed AS (
  SELECT doc_id, lang, {_leaf_sql('n_chars')} AS leaf,
         CASE WHEN {crc_sql("list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)")} % 7 = 0
              AND n_chars IS NOT NULL THEN {_leaf_sql('n_chars + 1')} ELSE {_leaf_sql('n_chars')} END AS tampered
  FROM documents, crc_table),
leaf AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM hashed),
low AS (SELECT tree, place, leaf AS digest FROM leaf),
{_tree_sql('node', 'low')},
subroot AS (SELECT 0 AS tree, tree AS place, digest FROM node WHERE n = 1),
{_tree_sql('upper', 'subroot')},
height AS (SELECT tree, max(level) AS h FROM node GROUP BY tree),
side AS (
  SELECT l.tree, l.place, s.step, (l.place >> s.step) & 1 AS right_hand, node.digest
  FROM leaf l JOIN height USING (tree), unnest(range(h)) AS s(step)
  LEFT JOIN node ON node.tree = l.tree AND node.level = s.step AND node.place = xor(l.place >> s.step, 1)
  UNION ALL
  SELECT l.tree, l.place, h + s.step, (l.tree >> s.step) & 1, upper.digest
  FROM leaf l JOIN height USING (tree), unnest(range((SELECT max(level) FROM upper))) AS s(step)
  LEFT JOIN upper ON upper.level = s.step AND upper.place = xor(l.tree >> s.step, 1)),
proof AS (SELECT tree, place, coalesce(string_agg(digest, '' ORDER BY step), '') AS siblings FROM side GROUP BY tree, place),
fold AS (
  SELECT tree, place, 0::BIGINT AS step, tampered AS digest FROM leaf
  UNION ALL
  SELECT f.tree, f.place, f.step + 1, sha256(CASE WHEN s.digest IS NULL THEN f.digest
         WHEN s.right_hand = 1 THEN s.digest || f.digest ELSE f.digest || s.digest END)
  FROM fold f JOIN side s USING (tree, place, step)),
folded AS (SELECT tree, place, arg_max(digest, step) AS digest FROM fold GROUP BY tree, place),
root AS (SELECT digest AS root FROM upper WHERE n = 1)
SELECT l.doc_id, l.leaf, s.digest AS subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, f.digest AS folded_root,
       f.digest = root AS verified
FROM leaf l JOIN subroot s ON s.place = l.tree JOIN folded f ON f.tree = l.tree AND f.place = l.place
LEFT JOIN proof p ON p.tree = l.tree AND p.place = l.place CROSS JOIN root
"""
