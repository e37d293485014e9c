"""LM scoring with a probabilistic suffix tree over words.

A text is a begin, its words (A-Z lowered) and one end token. The root of the tree is the add-one unigram
distribution over the V training tokens and one unknown. Contexts of one to ``DEPTH`` preceding tokens are
candidates if they occur at least ``MIN_CONTEXT`` times, a number that does not follow the corpus, so more data
admit more and longer contexts. A candidate stays if its next-token distribution diverges enough from that of its
longest kept suffix (Kullback-Leibler, and as total gain). A kept context lists the next tokens seen at least
``MIN_COUNT`` times in it with discounted probabilities; the mass left over is spread as its suffix spreads it over the
others, so every state is a distribution. A token is scored in the longest kept suffix of what precedes it.

The tree is a Spark table of weights by n-gram: a kept context weighs the share it leaves to its suffix, a listed
token what it gains over that. All kept suffixes of what precedes a token form a chain, so its log probability is that
of the root and the weights of the n-grams that end before and at it; a text's score is a sum over its n-grams.

Words and n-grams with a share of at least ``FREQUENT`` (at most ``1 / FREQUENT`` a length) are held by every task and summed there, so
no key is hot. For the others a task gathers some million tokens of documents and asks each bucket of the table, dealt by hash, for
what it needs in one row: the distinct keys, and which document has which key how often, as compressed byte planes. The bucket
answers with sums by document, and the answers meet again by gathering. Counting works alike: tasks send each bucket of n-grams one
row of counts, frequent words by number. So n-grams never become rows of a shuffle, and no bucket grows with the corpus. A bitmap of bounded
size keeps n-grams away from the shuffles that the table cannot hold; what it lets through in error is not found
in the table. Words and n-grams are identified by 64-bit hashes.

Edge cases: NULL or blank text: the end token alone. NULL doc_id: scored, not learned from, held_out false. Repeated rows
count and are scored one by one. No training rows: every probability is 1, score 0. Extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shoal.llm.common import MIX1, MIX2, ODD, Texts, bounded_batches, chunks, crc_mod, materialise

#: Share of training tokens from which a word or an n-gram is held by every task.
FREQUENT = 4e-6
#: Words in the longest contexts; occurrences from which a context is a candidate.
DEPTH, MIN_CONTEXT = 3, 64
#: Occurrences from which a next token is listed; its discount.
MIN_COUNT, DISCOUNT = 4, 0.75
#: Divergence in nats per token, and total gain in nats, from which a context stays.
MIN_DIVERGENCE, MIN_GAIN = 0.02, 30.0
#: Words, or n-grams, that a task gathers before it counts them; tokens that it gathers before it asks for their weights.
GATHER, GATHER_TOKENS = 1 << 20, 1 << 19
#: Parts of the documents that are scored one after the other.
SLICES = 4
#: Tokens whose n-grams share one bucket of counts; rows of the table of weights that share one bucket at scoring, and training tokens
#: for each of its buckets and each slice, at most: the tokens a slice asks for grow faster than the table.
COUNT_BUCKET, WEIGHT_BUCKET, ASK_BUCKET = 1 << 20, 1 << 18, 1 << 20
#: Bytes of packed rows that go to a Python worker at once: a group of them is some tens of MB, rows times BATCH_ROWS no bound.
BATCH_BYTES = 1 << 21
#: Bits of a bitmap for each key that it is to hold, at least; powers of two of its bits at least and at most (32 MB).
KEY_BITS, LEAST_BITS, MOST_BITS = 8, 20, 28
#: Bytes of texts that become arrays at once; bytes from which a word is hashed apart; what a word of 0 to 8 bytes keeps of eight.
CHUNK_BYTES, LONG_WORD = 1 << 18, 512
MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Bits of a held word's number in a packed context, for inspection.
CONTEXT_BITS = 20
#: Tokens that are no words, and the key of the empty context.
BEGIN, END, EMPTY = np.uint64(0xB5297A4D3F84D5A1), np.uint64(0x68E31DA4C2B7596F), np.uint64(0)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches bounded by rows and by bytes."""
    bounded_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def signed(key: np.uint64) -> int:
    return int(np.array([key], np.uint64).view(np.int64)[0])


def word_hashes(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(hash, number of words by document) of all words, in order; of their bytes, eight at a time, as each word has but a few eights."""
    raw = np.frombuffer(t.raw, np.uint8)
    inside = (raw != 32) & (raw - np.uint8(9) > 4)
    edge = np.zeros(len(raw) + 1, bool)  # where a document starts or ends
    edge[t.places] = True
    edge[1:-1] |= inside[1:] != inside[:-1]
    edge[[0, -1]] = True
    starts, ends = np.flatnonzero(inside & edge[:-1]), np.flatnonzero(inside & edge[1:]) + 1
    each = np.diff(np.searchsorted(starts, t.places))
    size = ends - starts
    low = np.zeros(len(raw) + 8, np.uint8)
    low[:-8] = raw
    low[:-8] += (raw - np.uint8(65) < 26).view(np.uint8) << np.uint8(5)
    eights = np.ndarray((len(raw) + 1,), "<u8", low, strides=(1,))
    with np.errstate(over="ignore"):
        h = eights[starts] & MASKS[np.minimum(size, 8)]
        h = _splitmix(h + size.astype(np.uint64) * ODD)
        i, at = np.flatnonzero(size > 8), 8
        while len(i) and at < LONG_WORD:
            h[i] = _splitmix(h[i] * MIX1 + (eights[starts[i] + at] & MASKS[np.minimum(size[i] - at, 8)]))
            at += 8
            i = i[size[i] > at]
    for k in i.tolist():
        h[k] = int.from_bytes(blake2b(low[starts[k]:ends[k]], digest_size=8).digest(), "little")
    return h, each


def extend(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Key of the n-gram of a context and the token after it."""
    with np.errstate(over="ignore"):
        return _splitmix(context * MIX1 + token * ODD)


def _splitmix(x: np.ndarray) -> np.ndarray:
    """:func:`splitmix` in place."""
    for step, by in ((30, MIX1), (27, MIX2), (31, None)):
        x ^= x >> np.uint64(step)
        if by is not None:
            x *= by
    return x


def sequence(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, document, place in it) of a chunk's documents, begin and end included."""
    h, each = word_hashes(t)
    size = each + 2
    first = np.cumsum(size) - size
    own = np.repeat(np.arange(t.n), size)
    place = np.arange(len(own)) - np.repeat(first, size)
    token = np.empty(len(own), np.uint64)
    token[np.arange(len(h)) + np.repeat(2 * np.arange(t.n) + 1, each)] = h
    token[first], token[first + size - 1] = BEGIN, END
    return token, own, place


def grams(token: np.ndarray, longest: int):
    """Keys of the n-grams that end at each token, by length; those of length d are n-grams from place d - 1 on."""
    key = extend(np.zeros(len(token), np.uint64), token)
    yield key
    for _ in range(1, longest):
        key = extend(np.r_[EMPTY, key[:-1]], token)
        yield key


def by_key(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, sorted keys) of hashes; equal ones as they came. Sorts numbers of a key's first bits and its place, which takes a third of the time
    of an ``argsort``; that is left for keys that differ only in bits without room."""
    n = len(keys)
    low = np.uint64(max(1, n - 1).bit_length())
    x = keys >> low
    x <<= low
    x |= np.arange(n, dtype=np.uint64)
    x.sort()
    x &= (np.uint64(1) << low) - np.uint64(1)
    order = x.view(np.int64)
    got = keys[order]
    if (got[1:] < got[:-1]).any():
        order = np.argsort(keys, kind="stable")
        got = keys[order]
    return order, got


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in order, a place and the number of each."""
    order, keys = by_key(keys)
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[at], order[at], np.diff(np.r_[at, len(keys)])


def word_counts(batches):
    """Rows (key, n): the words of many chunks, counted."""
    held, n = [], 0

    def flush():
        keys = np.sort(np.concatenate(held))
        at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        return pa.RecordBatch.from_arrays([pa.array(keys[at].view(np.int64)), pa.array(np.diff(np.r_[at, len(keys)]))], ["key", "n"])

    for b in batches:
        for t in chunks(b.column("text"), CHUNK_BYTES):
            held.append(word_hashes(t)[0])
            n += len(held[-1])
            if n >= GATHER:
                yield flush()
                held, n = [], 0
    if n:
        yield flush()


def bitmap(keys: DataFrame) -> np.ndarray:
    """A bit for each value of the column ``key``, by its low bits, in a bitmap sized by their number. The tasks set the bits; the driver
    gets the words that are not zero, as Arrow batches."""
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, KEY_BITS * keys.count())))))
    slot = F.col("key").bitwiseAND(F.lit((1 << bits) - 1))
    bit = F.expr("shiftleft(1L, cast(key & 63L AS INT))")
    got = keys.select(F.shiftright(slot, 6).alias("w"), bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[got["w"].to_numpy()] = got["b"].to_numpy()
    return out.view(np.uint64)


def marked(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Has each key a bit? True for every key that was given one."""
    slot = keys & np.uint64(len(bits) * 64 - 1)
    word = bits.take((slot >> np.uint64(6)).view(np.int64))
    slot &= np.uint64(63)
    word >>= slot
    word &= np.uint64(1)
    return word.astype(bool)


def finder(keys: np.ndarray):
    """A function that tells (is it there, where) of wanted keys among sorted ones. Keys are hashes, so their first bits, as many as
    tell about twice as many keys apart, lead to one a few places before it at most."""
    bits = len(keys).bit_length() + 1
    shift = np.uint64(64 - bits)
    start = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << shift).astype(np.int32)
    ended = np.r_[keys, np.uint64(2**64 - 1)]

    def find(wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = start.take((wanted >> shift).view(np.int64))
        got = ended.take(at)
        i = np.flatnonzero(got < wanted)
        while len(i):
            at[i] += 1
            got[i] = ended[at[i]]
            i = i[got[i] < wanted[i]]
        there = got == wanted
        there &= at < len(keys)
        return there, np.minimum(at, max(0, len(keys) - 1))

    return find


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is it there, where) of each wanted key among sorted ones. For few wanted keys, or sorted ones; else :func:`finder`."""
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key, by its first 31 bits, so that buckets follow the order of the keys."""
    return ((keys >> np.uint64(33)) * np.uint64(buckets) >> np.uint64(31)).view(np.int64)


def bucket_column(key: str, buckets: int) -> Column:
    """:func:`bucket_of` in Spark."""
    return F.shiftright(F.shiftrightunsigned(key, 33) * F.lit(buckets).cast("long"), 31)


def ordered(bucket: np.ndarray, buckets: int, key: np.ndarray, last: np.ndarray, most: int) -> np.ndarray:
    """An order by bucket, key and ``last`` (``most`` at most), from one sort: as many of a key's first bits as have room
    count. Keys that agree in those may stand mixed, which only makes more rows of the same counts."""
    low, high, place = (max(1, int(x).bit_length()) for x in (most, buckets - 1, len(key) - 1))
    if low + high + place > 48:
        place = 0
    key = key >> np.uint64(low + high + place)
    key <<= np.uint64(low)
    key |= last.astype(np.uint64)
    key <<= np.uint64(place)
    key |= bucket.astype(np.uint64) << np.uint64(64 - high)
    if not place:
        return np.argsort(key)
    key |= np.arange(len(key), dtype=np.uint64)
    key.sort()
    return (key & np.uint64((1 << place) - 1)).view(np.int64)


def _sorted(table: DataFrame, *cols: str) -> tuple[np.ndarray, ...]:
    """Key and columns of a small table, by unsigned key."""
    got = table.select("key", *cols).toArrow()
    key = got["key"].to_numpy().view(np.uint64)
    order = np.argsort(key)
    return key[order], *(got[c].to_numpy()[order] for c in cols)


@dataclass
class Model:
    total: int  # training tokens
    distinct: int
    docs: int
    depth: int
    words: np.ndarray  # hashes of the frequent words, sorted; their number is their place
    log_count: np.ndarray  # log10(count + 1) of each, then of the end token
    contexts: DataFrame  # (node, before, last, suffix, size, weight) of kept contexts
    tree: DataFrame  # (key, n, weight) of n-grams

    @property
    def log_total(self) -> float:
        return float(np.log10(self.total + self.distinct + 1))

    @cached_property
    def nodes(self) -> tuple[np.ndarray, np.ndarray]:
        """For inspection of small trees, never for scoring: packed numbers, plus one, (older, newer) of the kept contexts of up to
        two frequent words (the last number is a text's begin); log10 of the mass left over."""
        tokens = np.r_[self.words, BEGIN]
        order = np.argsort(tokens)
        single = extend(np.zeros(len(tokens), np.uint64), tokens)
        by_key = np.argsort(single)
        got = self.contexts.select("before", "last", "weight").toArrow()
        before, last = (got[c].to_numpy().view(np.uint64) for c in ("before", "last"))
        new, at = _find(tokens[order], last)
        old, to = _find(single[by_key], before)
        keep = new & (old | (before == EMPTY))
        packed = np.where(old, by_key[to] + 1, 0) << CONTEXT_BITS | order[at] + 1
        return packed[keep], got["weight"].to_numpy()[keep]

    @cached_property
    def weights(self) -> tuple[np.ndarray, np.ndarray]:
        """For inspection of small trees: sorted keys and weights."""
        return _sorted(self.tree, "weight")

    @cached_property
    def left_over(self) -> tuple[np.ndarray, np.ndarray]:
        """For inspection of small trees: the part of the weights that an n-gram has as a context."""
        return _sorted(self.contexts.withColumnRenamed("node", "key"), "weight")


def fit(docs: DataFrame, depth: int = DEPTH) -> tuple[Model, DataFrame]:
    """Learn from (doc_id, text) rows: one pass over the texts for the words and one for each length of context up to ``depth``.
    The driver gets the frequent words and bitmaps, all of bounded size. Returns the model and the table of all word counts."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("text")

    counts = materialise(docs.mapInArrow(word_counts, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "lm-words", tidy=True)
    row = counts.agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n")).first()
    n_docs = docs.count()
    total, distinct = (row["n"] or 0) + n_docs, row["v"] + (n_docs > 0)
    words, count = _sorted(counts.filter(F.col("n") >= F.lit(FREQUENT * total)), "n")
    log_count = np.log10(np.r_[count.astype(np.int64), n_docs] + 1.0)

    def one(token: np.uint64) -> DataFrame:
        return spark.createDataFrame([(signed(token), n_docs)], "key long, n long")

    # state: log10 probability of a next token after a candidate, kept or not; at first that of the root, for tokens that may be listed
    state = (counts.filter(F.col("n") >= MIN_COUNT).union(one(END))
             .select(F.lit(0).cast("long").alias("node"), F.col("key").alias("nxt"),
                     (F.log10(F.col("n") + 1.0) - F.lit(float(np.log10(total + distinct + 1)))).alias("lp")))
    grown = counts.union(one(BEGIN)).select(F.lit(0).cast("long").alias("node"), F.col("key").alias("nxt"), "n",
                                            F.lit(0).cast("long").alias("suffix"))
    # n-grams of as many tokens as the contexts have, seen often enough; single tokens by their own hash
    often = counts.filter(F.col("n") >= MIN_COUNT).select("key").union(one(END).select("key"))
    kept_nodes, kept_grams = [], []
    n_rows, n_tree = distinct + 1, 0  # bounds of the tables' rows, so that small ones become few files
    for length in range(1, depth + 1):
        candidates = materialise(_named(grown.filter(F.col("n") >= MIN_CONTEXT), length), f"lm-candidates-{length}", tidy=True, rows=n_rows)
        n_nodes = candidates.count()
        if not n_nodes:
            break
        # a token that follows a candidate MIN_COUNT times follows its suffix as often, so the others need no counting
        bits = spark.sparkContext.broadcast((bitmap(candidates.select(F.col("node").alias("key"))), bitmap(often), words))
        pairs = materialise(following(docs, length, bits, max(1, total // COUNT_BUCKET)).join(candidates.select("node", "suffix", "size"), "node"),
                            f"lm-pairs-{length}", tidy=True)
        bits.destroy()
        n_rows = pairs.count()
        n_tree += n_rows + n_nodes
        # each row has its parent's, for the same reason
        rows = (pairs.join(state.select(F.col("node").alias("suffix"), "nxt", F.col("lp").alias("parent")), ["suffix", "nxt"])
                .withColumn("p", (F.col("n") - F.lit(DISCOUNT)) / F.col("size")))
        rows = materialise(rows, f"lm-rows-{length}", tidy=True, rows=n_rows)
        free, parent_free = 1 - F.col("p"), F.greatest(F.lit(1e-12), 1 - F.col("parent"))
        tested = (rows.groupBy("node", "size").agg(
            F.sum("p").alias("p"), F.sum(F.pow(F.lit(10.0), "parent")).alias("parent"), F.sum("n").alias("n"),
            F.sum(F.col("n") * (F.ln("p") - F.col("parent") * F.lit(float(np.log(10))))).alias("gain"))
            .withColumn("gain", F.col("gain") + (F.col("size") - F.col("n")) * F.ln(free / parent_free))
            .filter((F.col("gain") >= MIN_GAIN) & (F.col("gain") >= F.col("size") * MIN_DIVERGENCE))
            .select("node", F.log10(free / parent_free).alias("weight")))
        kept = materialise(candidates.join(tested, "node"), f"lm-kept-{length}", tidy=True, rows=n_nodes)
        rows = rows.join(kept.select("node", "weight"), "node", "left")
        stays = F.col("weight").isNotNull()
        kept_nodes.append(kept)
        kept_grams.append(materialise(_keyed(rows.filter(stays).select(
            "node", "nxt", "n", (F.log10("p") - F.col("parent") - F.col("weight")).alias("weight"))), f"lm-grams-{length}", tidy=True, rows=n_rows))
        state = rows.select("node", "nxt", F.when(stays, F.log10("p")).otherwise(F.col("parent")).alias("lp"))
        # a context one longer is a candidate and the token after it
        grown = pairs.filter(F.col("nxt") != F.lit(signed(END))).select("node", "nxt", "n", "suffix")
        often = _keyed(pairs.select("node", "nxt", "n", F.lit(0.0).alias("weight"))).select("key")

    contexts = spark.createDataFrame([], "node long, before long, last long, suffix long, size long, weight double")
    tree = spark.createDataFrame([], "key long, n long, weight double")
    for kept, listed in zip(kept_nodes, kept_grams):
        contexts = contexts.unionByName(kept)
        tree = tree.unionByName(listed).unionByName(kept.select(F.col("node").alias("key"), F.col("size").alias("n"), "weight"))
    tree = materialise(tree.groupBy("key").agg(F.max("n").alias("n"), F.sum("weight").alias("weight")), "lm-tree", tidy=True, rows=n_tree)
    return Model(total, distinct, n_docs, depth, words, log_count, contexts, tree), counts


def packed(x: np.ndarray) -> bytes:
    """Numbers as compressed byte planes, as many as the largest has: small or similar ones take little."""
    x = x.astype("<u8")
    planes = np.empty((max(1, (int(x.max(initial=0)).bit_length() + 7) // 8), len(x)), np.uint8)
    each = x.view(np.uint8).reshape(-1, 8)
    for k, plane in enumerate(planes):
        plane[:] = each[:, k]
    return bytes([len(planes)]) + pa.compress(planes.data if planes.size else b"", codec="zstd", asbytes=True)


def unpacked(raw: bytes, n: int) -> np.ndarray:
    k = raw[0]
    planes = pa.decompress(memoryview(raw)[1:], decompressed_size=k * n, codec="zstd", asbytes=True)
    out = np.zeros((n, 8), np.uint8)
    for i in range(k):
        out[:, i] = np.frombuffer(planes, np.uint8, n, i * n)
    return out.view("<u8").ravel()


def rising(x: np.ndarray) -> bytes:
    """:func:`packed` for sorted numbers: their differences."""
    return packed(np.r_[x[:1], np.diff(x)])


def unrisen(raw: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpacked(raw, n), dtype=np.uint64)


def _cuts(sorted_ids: np.ndarray):
    """(id, start, end) of each run of equal ids."""
    at = np.flatnonzero(np.r_[True, sorted_ids[1:] != sorted_ids[:-1], True]) if len(sorted_ids) else np.zeros(1, int)
    return zip(sorted_ids[at[:-1]].tolist(), at[:-1].tolist(), at[1:].tolist())


def _rows(table: pa.Table | pa.RecordBatch, absent: str | None = None):
    """The rows as dicts, a batch at a time; only those without a value in column ``absent``, if given."""
    for b in table.to_batches() if isinstance(table, pa.Table) else [table]:
        yield from (b.filter(b.column(absent).is_null()) if absent else b).to_pylist()


def pack_grams(whole: np.ndarray, node: np.ndarray, nxt: np.ndarray, buckets: int, words: np.ndarray) -> pa.RecordBatch:
    """The n-grams ``whole`` (of a context and a token) counted, one row for each bucket that has some: its contexts and how many
    n-grams each has; the tokens by their number, plus one, among the sorted ``words``, or 0 and their hash apart; the counts."""
    whole, first, n = distinct(whole)
    bucket, node, nxt = bucket_of(whole, buckets), node[first], nxt[first]
    there, at = finder(words)(nxt)
    number = np.where(there, at + 1, 0)
    order = ordered(bucket, buckets, node, number, len(words))
    bucket, node, nxt, n, there, number = (x[order] for x in (bucket, node, nxt, n, there, number))
    rows = {c: [] for c in ("bucket", "size", "nodes", "node", "each", "number", "others", "n")}
    for k, i, j in _cuts(bucket):
        new = np.flatnonzero(np.r_[True, node[i + 1:j] != node[i:j - 1]])
        for c, x in (("bucket", k), ("size", j - i), ("nodes", len(new)), ("node", rising(node[i:j][new])),
                     ("each", packed(np.diff(np.r_[new, j - i]))), ("number", packed(number[i:j])),
                     ("others", packed(nxt[i:j][~there[i:j]])), ("n", packed(n[i:j]))):
            rows[c].append(x)
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64() if c in ("bucket", "size", "nodes") else pa.binary()) for c, x in rows.items()], list(rows))


def unpack_grams(table: pa.Table, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, nxt, n) of rows by :func:`pack_grams`."""
    out = []
    for r in _rows(table.select(["size", "nodes", "node", "each", "number", "others", "n"])):
        node = np.repeat(unrisen(r["node"], r["nodes"]), unpacked(r["each"], r["nodes"]).astype(np.int64))
        number = unpacked(r["number"], r["size"]).astype(np.int64)
        held = number > 0
        nxt = np.empty(len(number), np.uint64)
        nxt[held] = words[number[held] - 1]
        nxt[~held] = unpacked(r["others"], int((~held).sum()))
        out.append((node, nxt, unpacked(r["n"], r["size"]).astype(np.int64)))
    node, nxt, n = (np.concatenate(x) for x in zip(*out))
    return node, nxt, n


def pack_weights(table: pa.Table) -> pa.Table:
    """A bucket of (key, root, weight, word) in one row, by key."""
    key = table["key"].to_numpy().view(np.uint64)
    order, key = by_key(key)
    root, weight, word = (table[c].to_numpy()[order] for c in ("root", "weight", "word"))
    row = [rising(key), packed(root.view(np.uint64)), packed(weight.view(np.uint64)), packed(word)]
    return pa.table([pa.array([table["bucket"][0].as_py()], pa.int64()), pa.array([len(key)], pa.int64()), *(pa.array([x], pa.binary()) for x in row)],
                    ["bucket", "size", "keys", "root", "weight", "word"])


def unpack_weights(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, root, weight, word) of no row or one by :func:`pack_weights`, by key."""
    if not table.num_rows:
        return np.zeros(0, np.uint64), *[np.zeros(0)] * 3
    r = table.to_pylist()[0]
    return (unrisen(r["keys"], r["size"]), *(unpacked(r[c], r["size"]).view(np.float64) for c in ("root", "weight")),
            unpacked(r["word"], r["size"]).astype(np.float64))


def following(docs: DataFrame, length: int, bits, buckets: int) -> DataFrame:
    """(node, nxt, n) for the contexts of ``length`` tokens and the n-grams of that length at the token that ``bits`` lets through, counted
    over all ``docs``, from MIN_COUNT on. ``bits``: both bitmaps and the frequent words."""
    def found(t: Texts):
        token, _, place = sequence(t)
        *_, suffix = grams(token, length)
        contexts, often, _ = bits.value
        # the token before ends the context
        i = np.flatnonzero((place[1:] >= length) & marked(contexts, suffix[:-1])) + 1
        i = i[marked(often, (token if length == 1 else suffix)[i])]
        context, token = suffix[i - 1], token[i]
        return extend(context, token), context, token

    def ask(held):
        return pack_grams(*(np.concatenate(x) for x in zip(*held)), buckets, bits.value[2])

    def run(batches):
        held, n = [], 0
        for b in batches:
            for t in chunks(b.column("text"), CHUNK_BYTES):
                held.append(found(t))
                n += len(held[-1][0])
                if n >= GATHER:
                    yield ask(held)
                    held, n = [], 0
        if n:
            yield ask(held)

    def merge(table: pa.Table) -> pa.Table:
        node, nxt, n = unpack_grams(table, bits.value[2])
        order, _ = by_key(extend(node, nxt))
        node, nxt = node[order], nxt[order]
        at = np.flatnonzero(np.r_[True, (node[1:] != node[:-1]) | (nxt[1:] != nxt[:-1])])
        n = np.add.reduceat(n[order], at)
        keep = n >= MIN_COUNT
        at, n = at[keep], n[keep]
        return pa.table([pa.array(x) for x in (node[at].view(np.int64), nxt[at].view(np.int64), n)], ["node", "nxt", "n"])

    asked = docs.mapInArrow(run, "bucket long, size long, nodes long, node binary, each binary, number binary, others binary, n binary")
    return asked.groupBy("bucket").applyInArrow(merge, "node long, nxt long, n long")


def _keyed(rows: DataFrame) -> DataFrame:
    """(node, nxt, n, weight) -> (key, n, weight) of the n-gram of both."""
    def run(batches):
        for b in batches:
            node, nxt = (b.column(c).to_numpy().view(np.uint64) for c in ("node", "nxt"))
            yield pa.RecordBatch.from_arrays([pa.array(extend(node, nxt).view(np.int64)), b.column("n"), b.column("weight")],
                                             ["key", "n", "weight"])

    return rows.mapInArrow(run, "key long, n long, weight double")


def _named(rows: DataFrame, length: int) -> DataFrame:
    """(node, nxt, n, suffix) of a context and the token after it -> that context one longer: (node, before, last, suffix, size)."""
    def run(batches):
        for b in batches:
            before, last, suffix = (b.column(c).to_numpy().view(np.uint64) for c in ("node", "nxt", "suffix"))
            shorter = extend(suffix, last) if length > 1 else np.zeros(len(last), np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (extend(before, last), before, last, shorter)]
                                             + [b.column("n")], ["node", "before", "last", "suffix", "size"])

    return rows.mapInArrow(run, "node long, before long, last long, suffix long, size long")


def tree_part(model: Model, number: np.ndarray, older: np.ndarray, newer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log10 of the tree's part, must the root's be added: always) of tokens after contexts of up to two frequent words, numbered as
    in ``Model.nodes``. For inspection: :func:`score` meets the same weights in a join."""
    tokens = np.r_[EMPTY, model.words, BEGIN]
    nxt = np.r_[model.words, END, EMPTY][number]
    out = np.zeros(len(number))
    empty = np.zeros(len(number), np.uint64)
    one, two = extend(empty, tokens[newer]), extend(extend(empty, tokens[older]), tokens[newer])
    for context, usable in ((one, newer > 0), (two, (older > 0) & (newer > 0))):
        whole = extend(context, nxt)
        # the n-gram with the token weighs as a listed token, and as a context of what follows, which is not this token's
        for (keys, weight), key, sign in ((model.left_over, context, 1), (model.weights, whole, 1), (model.left_over, whole, -1)):
            there, at = _find(keys, key)
            i = there & usable
            out[i] += sign * weight[at[i]]
    return out, np.ones(len(number), bool)


def weight_buckets(rows: int, tokens: int) -> int:
    """Buckets of a table of weights of so many rows, learned from so many tokens."""
    return max(1, -(-rows // WEIGHT_BUCKET), -(-tokens // (SLICES * ASK_BUCKET)))


def score(docs: DataFrame, model: tuple[Model, DataFrame], carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` with n_tokens, n_known, train_tokens, base_score and score, for every row of ``docs`` (text)."""
    spark = docs.sparkSession
    small_batches(spark)
    m, counts = model
    frequent = F.col("n") >= F.lit(FREQUENT * m.total)
    held = spark.sparkContext.broadcast((m.words, m.log_count, *_sorted(m.tree.filter(frequent), "weight"), bitmap(m.tree)))
    learned, depth, log_total, total = m.docs > 0, m.depth, m.log_total, m.total
    table = (counts.filter(~frequent).select("key", F.log10(F.col("n") + 1.0).alias("root"), F.lit(0.0).alias("weight"), F.lit(1).alias("word"))
             .union(m.tree.filter(~frequent).select("key", F.lit(0.0), "weight", F.lit(0))))
    buckets = weight_buckets(table.count(), total)
    # a word and an n-gram, or two rows of a rare word, never share a key: an n-gram's is mixed once more
    table = table.withColumn("bucket", bucket_column("key", buckets))
    # a bucket becomes one row, once, and each slice meets it so: no slice moves or sorts the table's rows again
    table = materialise(table.groupBy("bucket").applyInArrow(pack_weights, "bucket long, size long, keys binary, root binary, weight binary, word binary"),
                        "lm-weights", tidy=True)

    own = [docs.schema[c] for c in carry]
    heads = T.StructType([*(T.StructField(f"_{i}", f.dataType) for i, f in enumerate(own)),
                          *(T.StructField(c, t) for c, t in (("n_tokens", T.LongType()), ("known", T.LongType()), ("base", T.DoubleType()),
                                                             ("tree", T.DoubleType())))])
    asked = T._parse_datatype_string("bucket long, part long, doc long, size long, keys binary, each binary, docs binary, times binary")
    told = T._parse_datatype_string("part long, doc long, size long, docs binary, more_base binary, more_tree binary, more_known binary")
    asked, told = (T.StructType([*x.fields, *heads.fields]) for x in (asked, told))

    def table_of(schema, columns: dict, n: int) -> pa.RecordBatch:
        """A batch of ``schema`` with NULL in the columns that are not given."""
        arrow = to_arrow_schema(schema)
        return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in arrow], schema=arrow)

    def ask(part: int, keys: list[np.ndarray], docs: list[np.ndarray]) -> pa.RecordBatch:
        """One row for each bucket that has keys of this part's documents."""
        gathered = keys, docs
        keys, docs = (np.concatenate(x) for x in gathered)
        for x in gathered:
            x.clear()  # no second copy while they are sorted
        if not len(keys):
            return table_of(asked, {}, 0)
        order, keys = by_key(keys)  # and by document, as the documents of a key came in order
        docs = docs[order]
        del order
        new = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])])
        times = np.diff(np.r_[new, len(keys)])
        keys, docs = keys[new], docs[new]
        rows = {c: [] for c in ("bucket", "size", "keys", "each", "docs", "times")}
        for bucket, i, j in _cuts(bucket_of(keys, buckets)):
            at = np.flatnonzero(np.r_[True, keys[i + 1:j] != keys[i:j - 1]])
            rows["bucket"].append(bucket)
            rows["size"].append(len(at))
            rows["keys"].append(rising(keys[i:j][at]))
            rows["each"].append(packed(np.diff(np.r_[at, j - i])))
            rows["docs"].append(packed(docs[i:j]))
            rows["times"].append(packed(times[i:j]))
        n = len(rows["size"])
        return table_of(asked, {"part": pa.array([part] * n), **{c: pa.array(x, pa.binary() if c not in ("bucket", "size") else pa.int64())
                                                                for c, x in rows.items()}}, n)

    def run(batches):
        words, log_count, often, weight, bits = held.value
        find_word, find_often = finder(words), finder(often)
        part, doc0, n, open_keys, open_docs = TaskContext.get().partitionId() << 32, 0, 0, [], []
        for b in batches:
            for t in chunks(b.column("text"), CHUNK_BYTES):
                token, doc, place = sequence(t)
                there, at = find_word(token)
                is_end, is_begin = token == END, place == 0
                common = there | is_end
                base = np.where(is_end, log_count[-1], np.where(there, log_count[at], 0.0))
                i = np.flatnonzero(~common & ~is_begin)
                open_keys.append(token[i])
                open_docs.append((doc[i] + doc0).astype(np.int32))
                tree = np.zeros(t.n)
                for length, key in enumerate(grams(token, depth + 1), 1):
                    some = np.flatnonzero(marked(bits, key) & (place >= length - 1))
                    key, whose = key[some], doc[some]
                    there, at = find_often(key)
                    if there.any():
                        tree += np.bincount(whose[there], weight[at[there]], t.n)
                    open_keys.append(key[~there])
                    open_docs.append((whose[~there] + doc0).astype(np.int32))
                known = np.bincount(doc, common & learned, t.n).astype(np.int64)
                carried = {f"_{k}": b.column(c).slice(t.first, t.n) for k, c in enumerate(carry)}
                # a head goes to a bucket of its part's own, below those of the table
                yield table_of(asked, {**carried, "bucket": pa.array(np.full(t.n, -1 - part)), "part": pa.array(np.full(t.n, part)),
                                       "doc": pa.array(np.arange(doc0, doc0 + t.n)), "n_tokens": pa.array(np.bincount(doc, minlength=t.n) - 1),
                                       "known": pa.array(known), "base": pa.array(np.bincount(doc, base, t.n)), "tree": pa.array(tree)}, t.n)
                doc0, n = doc0 + t.n, n + len(token)
                if n >= GATHER_TOKENS:
                    yield ask(part, open_keys, open_docs)
                    part, doc0, n, open_keys, open_docs = part + 1, 0, 0, [], []
        if n:
            yield ask(part, open_keys, open_docs)

    def answer(weights: pa.Table, requests: pa.Table) -> pa.Table:
        """Heads as they came; for each request the sums of its documents."""
        is_head = requests["doc"].is_valid()
        kept = requests.select([c for c in requests.column_names if c in told.names]).filter(is_head).combine_chunks()
        out = [table_of(told, {c: kept[c].combine_chunks() for c in kept.column_names}, kept.num_rows)]
        key, root, weight, word = unpack_weights(weights)
        rows = {c: [] for c in ("part", "size", "docs", "more_base", "more_tree", "more_known")}
        for r in _rows(requests.select(["part", "size", "keys", "each", "docs", "times", "doc"]), "doc"):
            there, at = _find(key, unrisen(r["keys"], r["size"]))
            if not there.any():
                continue
            each = unpacked(r["each"], r["size"]).astype(np.int64)
            n = int(each.sum())
            hit = np.repeat(there, each)
            at = np.repeat(at, each)[hit]
            docs, times = unpacked(r["docs"], n)[hit].astype(np.int64), unpacked(r["times"], n)[hit].astype(np.int64)
            some = np.flatnonzero(np.bincount(docs))
            rows["part"].append(r["part"])
            rows["size"].append(len(some))
            rows["docs"].append(rising(some))
            for c, x in (("more_base", root), ("more_tree", weight)):
                rows[c].append(packed(np.bincount(docs, x[at] * times)[some].view(np.uint64)))
            rows["more_known"].append(packed(np.bincount(docs, word[at] * times)[some]))
        n = len(rows["size"])
        out.append(table_of(told, {c: pa.array(x, pa.int64() if c in ("part", "size") else pa.binary()) for c, x in rows.items()}, n))
        return pa.Table.from_batches(out)

    result = T.StructType([*own, *T._parse_datatype_string("n_tokens long, n_known long, train_tokens long, base_score double, score double").fields])

    def add(table: pa.Table) -> pa.Table:
        """The documents of a part with the sums of all answers."""
        table = table.combine_chunks()
        is_head = table["doc"].is_valid()
        head = table.filter(is_head)
        doc = head["doc"].to_numpy()
        more = np.zeros((3, int(doc.max()) + 1 if len(doc) else 0))
        for r in table.filter(pa.compute.invert(is_head)).select(["size", "docs", "more_base", "more_tree", "more_known"]).to_pylist():
            docs = unrisen(r["docs"], r["size"]).astype(np.int64)
            for k, c in enumerate(("more_base", "more_tree")):
                more[k, docs] += unpacked(r[c], r["size"]).view(np.float64)
            more[2, docs] += unpacked(r["more_known"], r["size"])
        size = head["n_tokens"].to_numpy()
        base = head["base"].to_numpy() + more[0, doc] - size * log_total
        columns = [*(head[f"_{i}"].combine_chunks() for i in range(len(own))), pa.array(size),
                   pa.array(head["known"].to_numpy() + np.round(more[2, doc]).astype(np.int64)), pa.array(np.full(len(doc), total, np.int64)), pa.array(base),
                   pa.array(base + head["tree"].to_numpy() + more[1, doc])]
        arrow = to_arrow_schema(result)
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    # slice by slice, so that what is asked and answered never lies on disk for all documents at once
    docs = docs.select(*dict.fromkeys([*carry, "text"]))
    mine = F.pmod(F.xxhash64(*docs.columns), F.lit(SLICES))
    out = None
    for i in range(SLICES):
        requests = docs.filter(mine == i).mapInArrow(run, asked)
        answers = table.groupBy("bucket").cogroup(requests.groupBy("bucket")).applyInArrow(answer, told)
        scored = materialise(answers.groupBy("part").applyInArrow(add, result), f"lm-scores-{i}", tidy=True)
        out = scored if out is None else out.union(scored)
    held.destroy()
    return out


def split(docs: DataFrame) -> DataFrame:
    return docs.withColumn("held_out", F.coalesce(crc_mod("doc_id", 7) == 2, F.lit(False)))


def train_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(crc_mod("doc_id", 7) != 2)
