"""Shortest-pack-first packing over the length histogram.

Documents become token ids (a byte-level BPE vocabulary given by path) and an end id, and are cut at
multiples of the sequence length. The histogram of piece lengths, at most ``seq_len`` numbers, is all
the driver sees. It places lengths longest first, each piece on the shortest pack, the pattern with the most
room, counted in patterns, never in single sequences. Then each
piece gets its rank among the pieces of its length, and the rank says its sequence and offset.

Edge cases: NULL and empty text: one piece with the end id alone. Every row is packed, also rows that repeat a doc_id
or have none. An empty table gives none. Extra columns are ignored unless carried.
"""

from __future__ import annotations

import heapq
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm.common import bounded_batches, materialise

SEQ_LEN, END_ID = 2048, 1
#: Pieces that share one ranking group, on average; words that a worker's token cache holds.
GROUP_ROWS, CACHE_WORDS = 2000, 200_000

OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of a text as little-endian uint32 bytes.

    The byte-level pre-tokenizer never joins characters across a space that stands between two
    others, so a text is encoded word by word through a bounded cache; text with other white space around a
    space goes through the tokenizer whole. Equal to ``tokenizers`` on the same vocabulary (tested).
    """

    def __init__(self, vocabulary: str):
        import json

        import tiktoken
        model = json.loads(Path(vocabulary).read_text("utf-8"))
        # byte-level vocabularies spell each byte as a printable character
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        spelled = {chr(b): b for b in keep}
        spelled |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(keep))}
        self.special = {x["content"]: x["id"] for x in model["added_tokens"] if x["special"]}
        ranks = {bytes(spelled[c] for c in w): i for w, i in model["model"]["vocab"].items() if w not in self.special}
        import public_tokenizers
        self.encoding = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cache = _Cache(self.encoding)

    def plain(self, text: str) -> bytes:
        # every space must stand between two characters that are no white space
        if not (text.startswith(" ") or text.endswith(" ") or "  " in text or " \n" in text or "\n " in text
                or any(c in text for c in OTHER_SPACE)):
            words = text.split(" ")
            if len(self.cache) > CACHE_WORDS:
                self.cache.clear()
            return (self._ids(words[0]) if words[0] else b"") + b"".join(map(self.cache.__getitem__, words[1:]))
        return self._ids(text)

    def _ids(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        out = b""
        while text:
            hits = [(at, -len(s), s) for s in self.special if (at := text.find(s)) >= 0]
            if not hits:
                return out + self.plain(text)
            at, _, s = min(hits)
            out += self.plain(text[:at]) + np.array([self.special[s]], "<u4").tobytes()
            text = text[at + len(s):]
        return out


class _Cache(dict):
    def __init__(self, encoding):
        self.encoding = encoding

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = np.array(self.encoding.encode_ordinary(" " + word), "<u4").tobytes()
        return ids


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


def pieces(docs: DataFrame, vocabulary: str, seq_len: int = SEQ_LEN, with_ids: bool = False,
           carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows (carry, start, length, ids_crc32, doc_tokens[, ids]): each document's ids cut at multiples of ``seq_len``."""
    bounded_batches(docs.sparkSession)
    fields = [docs.schema[c] for c in carry] + [T.StructField(c, T.LongType()) for c in
                                                ("start", "length", "ids_crc32", "doc_tokens")]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    names = [f.name for f in fields]

    def run(batches):
        enc, end = encoder(vocabulary), np.array([END_ID], "<u4").tobytes()
        for b in batches:
            row, start, length, crc, total, ids = [], [], [], [], [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                raw = enc.encode(text or "") + end
                n = len(raw) // 4
                for at in range(0, n, seq_len):
                    part = raw[4 * at:4 * (at + seq_len)]
                    row.append(i)
                    start.append(at)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(n)
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            at = pa.array(row, pa.int64())
            cols = [b.column(c).take(at) for c in carry] + [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select(*dict.fromkeys([*carry, "text"])).mapInArrow(run, T.StructType(fields))


def shortest_pack_first(histogram: dict[int, int], seq_len: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """[(sequences, ((length, pieces), ...))]: how many sequences hold which lengths, longest first.

    A length goes on top of the shortest packs, those with the most room, one piece a sequence and as many
    sequences at once as the pattern counts; the rest of a pattern's sequences keeps its old pattern. If not even
    the shortest pack has room, a new one is opened; it is the shortest, so it takes the length until it is full.
    """
    room: dict[int, list[tuple[int, tuple | None]]] = {}  # a pattern is (pattern below, length, pieces)
    most: list[int] = []  # a heap of the rooms with patterns, negative
    done: list[tuple[int, tuple | None]] = []

    def put(left: int, n: int, pattern: tuple) -> None:
        if not left:
            done.append((n, pattern))
            return
        if left not in room:
            room[left] = []
            heapq.heappush(most, -left)
        room[left].append((n, pattern))

    for length in sorted(histogram, reverse=True):
        todo = histogram[length]
        while todo:
            left = -most[0] if most else 0
            if left < length:
                per = seq_len // length
                n, many = (todo // per, per) if todo >= per else (1, todo)
                put(seq_len - many * length, n, (None, length, many))
                todo -= n * many
                continue
            have, pattern = room[left].pop()
            if not room[left]:
                del room[left]
                heapq.heappop(most)
            n = min(have, todo)
            if have > n:
                put(left, have - n, pattern)
            put(left - length, n, (pattern, length, 1))
            todo -= n

    def unrolled(pattern: tuple | None) -> tuple[tuple[int, int], ...]:
        out = []
        while pattern:
            pattern, length, many = pattern
            out.append((length, many))
        return tuple(reversed(out))

    return [(n, unrolled(p)) for n, p in done + [x for left in sorted(room) for x in room[left]]]


def plan(histogram: dict[int, int], seq_len: int) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: where ranks start that go to one slot of one pattern, the first sequence there, the offset of
    the slot. Its size depends on ``seq_len`` and the number of patterns alone."""
    slots: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    first = 0
    for n, pattern in shortest_pack_first(histogram, seq_len):
        offset = 0
        for length, many in pattern:
            for _ in range(many):
                rank = used.get(length, 0)
                slots.setdefault(length, []).append((rank, first, offset))
                used[length] = rank + n
                offset += length
        first += n
    return {k: tuple(np.array(x, np.int64) for x in zip(*v)) for k, v in slots.items()}


def pack(cut: DataFrame, seq_len: int = SEQ_LEN, id_col: str = "doc_id") -> DataFrame:
    """``cut`` (rows with ``length``) with sequence_id and offset.

    ``cut`` should be a stored table: it is read three times. Ranks come from (length, hash) groups of bounded size,
    so a length that a third of all pieces have is ranked by many tasks.
    """
    by_length = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = plan(by_length, seq_len)
    groups = max(1, sum(by_length.values()) // GROUP_ROWS)
    ties = [id_col, "start", "ids_crc32"]
    keyed = cut.withColumn("_group", F.pmod(F.xxhash64(*ties), F.lit(groups)))
    before = keyed.groupBy("length", "_group").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    before = before.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0))).drop("_n")
    within = Window.partitionBy("length", "_group").orderBy(*ties)
    ranked = (keyed.withColumn("_rank", F.row_number().over(within) - 1).join(before, ["length", "_group"])
              .withColumn("_rank", F.col("_rank") + F.col("_before")).drop("_before", "_group"))
    columns = list(cut.columns)
    names = [*columns, "sequence_id", "offset"]
    schema = T.StructType([*cut.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def place(batches):
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("_rank").to_numpy()
            seq, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for k in np.unique(length):
                start, first, at = slots[int(k)]
                own = length == k
                i = np.searchsorted(start, rank[own], "right") - 1
                seq[own], offset[own] = first[i] + rank[own] - start[i], at[i]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in columns] + [pa.array(seq), pa.array(offset)], names)

    return ranked.select(*columns, "_rank").mapInArrow(place, schema)


def pack_documents(docs: DataFrame, vocabulary: str | None = None, seq_len: int = SEQ_LEN) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) for every piece of ``docs``."""
    return pack(materialise(pieces(docs, vocabulary or default_vocabulary(), seq_len), "pieces"), seq_len)


def sequences(docs: DataFrame, vocabulary: str | None = None, seq_len: int = SEQ_LEN) -> DataFrame:
    """(sequence_id, ids, used): the packed sequences themselves, ``used`` ids followed by nothing (pad when batching).
    A sequence holds at most ``seq_len`` ids, which bounds its group."""
    placed = pack(materialise(pieces(docs, vocabulary or default_vocabulary(), seq_len, with_ids=True), "pieces"), seq_len)
    parts = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    ids = F.flatten(F.col("parts.ids"))
    return parts.select("sequence_id", ids.alias("ids"), F.size(ids).alias("used"))


__all__ = ["Encoder", "pack", "pack_documents", "pieces", "plan", "sequences", "shortest_pack_first"]
