"""Spelling variants by a frontier of states in a relational trie.

Words are the maximal runs of letters of all texts, with their counts; one occurrence in ``DROP`` loses a letter, picked by the
checksum of document and run. Words seen often enough make up a trie, held as a table of edges: its nodes are the prefixes after
which words differ or end, an edge carries the letters up to the next node, so a long word costs a few edges.

All words walk the trie at once. A state is (word, position, node, edits). A level joins the states with the edges of their
nodes, reading only the edges that stand as many edges below the root: an edge takes its letters unchanged, or with one letter inserted, deleted or replaced if nothing was edited before. A state
that has been edited meets only the one edge that goes on with its next letter. States that cannot end (remaining letters fewer or more
than any word below the node has, a next letter that no edge has) are dropped. A word's end reached after one edit is a neighbour.
An edit in the first half of a word is found by the words read backwards, which stand in the same trie after a mark, so only second
halves are edited and no word branches at the top. The edges of crowded nodes (the root, common beginnings) are dealt to up to ``SALTS`` copies, so no node is one task's key.

A word's form is its most frequent neighbour, if it is ``TIMES`` times as frequent; roots follow the forms by pointer doubling
(a form is at least five times as frequent, so chains are short).

Edge cases: NULL or empty text: no words. NULL doc_id: its words count, none loses a letter. Repeated rows count each. Ties between
forms: the smallest word. Very long runs are words like others. No words: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import chunks, drop_table, materialise
from shoal.llm.merkle import CRC_SQL, crc_sql

#: Runs of letters (here in UTF-8, after A-Z are lowered), which occurrences lose a letter.
RUN = re.compile(rb"[a-z]+(?:\xc3[\x80-\xbf][a-z]*)*|(?:\xc3[\x80-\xbf][a-z]*)+")
DROP = 199
#: Code points and occurrences of a word at least; how much more frequent a form is.
LENGTH, COUNT, TIMES = 6, 5, 5
#: Bytes to split a text by if no letters of others follow: A-Z are lowered, what is no letter in ASCII is a space. The first bytes
#: of characters that are no letters.
SPLIT = bytes(c if c >= 128 else 32 if not chr(c).isalpha() else ord(chr(c).lower()) for c in range(256))
FOREIGN = bytes(c for c in range(0xC0, 256) if c != 0xC3)
NATIVE = bytes(c for c in range(256) if c not in FOREIGN)
#: Stands before a word that is read backwards; no letter.
MARK = "<"
#: Distinct words that a task gathers before it hands them on.
GATHER = 1 << 18
#: Copies of a crowded node's edges, and the states that one copy is meant for.
SALTS, CROWD = 64, 8192
#: States that one state becomes on a level, about: for the number of files.
STEPS = 4


def letter_runs(raw: bytes) -> list[bytes]:
    """The maximal runs of letters of a text in UTF-8, A-Z lowered."""
    if raw.translate(None, NATIVE):
        return RUN.findall(raw.lower())
    return raw.translate(SPLIT).split()


def occurrences(docs: DataFrame, shortest: int = LENGTH) -> DataFrame:
    """(word, n): the words of all texts after the loss of letters. Words that are too short for every use are left out."""
    def run(batches):
        held: Counter = Counter()
        crc = zlib.crc32
        for b in batches:
            for doc_id, raw in zip(b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()):
                if not raw:
                    continue
                found = [w for w in letter_runs(raw) if len(w) >= shortest]
                held.update(found)
                if doc_id is not None:
                    begin = crc(f"{doc_id}:".encode())
                    for w in [w for w in found if not crc(w, begin) % DROP]:
                        s = w.decode()
                        at = crc(w, begin) % len(s)
                        held[w] -= 1
                        held[(s[:at] + s[at + 1:]).encode()] += 1
            if len(held) >= GATHER:
                yield _rows(held)
                held = Counter()
        if held:
            yield _rows(held)

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _rows(held: Counter) -> pa.RecordBatch:
    held = +held  # not those of which every occurrence lost a letter
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(held.values(), pa.int64())],
                                      ["word", "n"])


def prefixes(words: DataFrame) -> DataFrame:
    """(id, depth, node, next, rest): each prefix of each word by hash, the letter after it (-1: the end), the letters left."""
    def run(batches):
        for b in batches:
            for t in chunks(b.column("word")):
                size = np.diff(t.offsets)
                own = np.repeat(np.arange(t.n), size + 1)
                depth = np.arange(len(own)) - np.repeat(np.cumsum(size + 1) - size - 1, size + 1)
                start = t.offsets[:-1][own]
                end = depth == size[own]
                nxt = np.where(end, -1, t.codes[np.minimum(start + depth, len(t.codes) - 1)].astype(np.int64))
                node = t.hashes(t.codes, start, start + depth).view(np.int64)
                ids = b.column("id").slice(t.first, t.n).to_numpy(zero_copy_only=False)[own]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, depth.astype(np.int32), node, nxt.astype(np.int32),
                                                                       (size[own] - depth).astype(np.int32))],
                                                 ["id", "depth", "node", "next", "rest"])

    return words.select("id", "word").mapInArrow(run, "id long, depth int, node long, next int, rest int")


def trie(words: DataFrame) -> DataFrame:
    """Edges (node, salt, first, label, child, salts, least, most, ends, nexts, level): the letters to the next node, the copies its own edges
    have, the fewest and most letters that words have below it, the id of the word that ends there, the letters that go on from there, the
    edges that lead from the root to ``node``. One row for each copy of the edge."""
    every = materialise(prefixes(words), "trie-prefixes", tidy=True)
    nodes = (every.groupBy("node").agg(F.count(F.lit(1)).alias("words"), F.min("next").alias("lo"), F.max("next").alias("hi"),
                                       F.min("rest").alias("least"), F.max("rest").alias("most"), F.min("depth").alias("depth"),
                                       F.min(F.when(F.col("rest") == 0, F.col("id"))).alias("ends"))
             .filter("lo <> hi or lo < 0 or depth = 0").select("node", "words", "least", "most", "ends"))
    # the nodes on a word's way: at most its length
    ways = (every.select("id", "depth", "node").join(nodes, "node")
            .groupBy("id").agg(F.array_sort(F.collect_list(F.struct("depth", "node", "words", "least", "most", "ends"))).alias("way")))
    steps = (words.select("id", "word").join(ways, "id")
             .select("word", F.posexplode(F.expr("transform(sequence(1, size(way) - 1), i -> struct(way[i - 1] as a, way[i] as b))")).alias("level", "s")))
    crowd = F.least(F.lit(SALTS), F.ceil(F.greatest("s.b.words", 4 * F.col("s.a.words")) / CROWD)).cast("int")
    edges = materialise(steps.select(F.col("s.a.node").alias("node"), F.col("s.b.node").alias("child"),
                                     F.expr("substring(word, s.a.depth + 1, s.b.depth - s.a.depth)").alias("label"),
                                     F.col("s.b.least").alias("least"), F.col("s.b.most").alias("most"), F.col("s.b.ends").alias("ends"),
                                     crowd.alias("salts"), "level")
                        .groupBy("node", "child", "label", "level").agg(F.max("salts").alias("salts"), F.min("least").alias("least"),
                                                               F.max("most").alias("most"), F.min("ends").alias("ends"))
                        .withColumn("first", F.substring("label", 1, 1)), "trie-edges", tidy=True)
    drop_table(every)
    # a node's copies stand on the edge that leads to it; none leads to the root, which has them all
    here = edges.groupBy(F.col("child").alias("node")).agg(F.max("salts").alias("here"))
    ahead = edges.groupBy(F.col("node").alias("child")).agg(F.concat_ws("", F.collect_set("first")).alias("nexts"))  # an alphabet at most
    return materialise(edges.join(here, "node", "left").join(ahead, "child", "left")
                       .withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("here", F.lit(SALTS)) - 1)))
                       .select("node", "salt", "first", "label", "child", "salts", "least", "most", "ends", F.coalesce("nexts", F.lit("")).alias("nexts"), "level")
                       .sortWithinPartitions("level"), "trie-copies", tidy=True)


def walk(words: DataFrame, hold: str) -> DataFrame:
    """(id, ends): words and the words that they reach with one edit after their first ``hold`` letters (an expression)."""
    all_edges = trie(words).withColumn("size", F.char_length("label"))
    states = words.select("id", "word", F.char_length("word").alias("whole"), F.lit(0).alias("pos"), F.lit(0).cast("long").alias("node"),
                          F.lit(0).alias("edits"), F.lit(SALTS).alias("salts"))
    same = "substring(word, pos + 1, size) = label"
    # letters of this edge that must still be taken as they are; an edit lies behind them
    due = f"({hold} - pos)"
    apart = f"{due} < size and ({due} <= 0 or substring(word, pos + 1, {due}) = substring(label, 1, {due}))"

    def alive(pos: str, edits: int) -> str:
        """Can a state after the edge still end? By the letters left, or by the next one."""
        if not edits:
            return f"whole - ({pos}) between least - 1 and most + 1"
        return (f"whole - ({pos}) between least and most and (ends is not null and whole = {pos} "
                f"or whole > {pos} and contains(nexts, substring(word, {pos} + 1, 1)))")

    # what is cheap is asked first: hardly any edge needs its letters compared
    moves = [f"struct({alive('pos + size', 0)} and {same} as ok, pos + size as pos, 0 as edits)"]
    for more in (0, -1, 1):
        taken = f"substring(word, pos + 1, size + {more})"
        moves.append(f"struct({alive(f'pos + size + {more}', 1)} and whole >= pos + size + {more} and {apart} "
                     f"and levenshtein({taken}, label, 1) = 1 as ok, pos + size + {more} as pos, 1 as edits)")

    # what each of these needs, without a look at the label: most edges of a crowded node end here, before they become a row for each move
    cheap = (f"({alive('pos + size', 0)} and substring(word, pos + 1, 1) = first or "
             f"{due} < size and ({' or '.join(alive(f'pos + size + {more}', 1) for more in (0, -1, 1))}))")

    columns = ["id", "word", "whole", "pos", "child", "edits", "salts", "most", "ends"]
    reached, level, rows = [], 0, states.count()
    while True:
        # every state has taken one edge a level: only the edges that stand there are met
        edges = all_edges.filter(F.col("level") == level).drop("level")
        dealt = states.withColumn("salt", F.pmod(F.xxhash64("word"), F.col("salts")).cast("int")).drop("salts")
        free = F.expr(f"edits = 0 and pos >= {hold}")
        # one edge each, by its first letter: edited states, and those whose next letter is to be taken as it is
        one = dealt.filter(~free).withColumn("first", F.expr("substring(word, pos + 1, 1)")).join(edges, ["node", "salt", "first"])
        edited = (one.filter(f"edits = 1 and {alive('pos + size', 1)} and {same}").withColumn("pos", F.expr("pos + size")).select(columns))
        first = (one.filter("edits = 0").unionByName(dealt.filter(free).join(edges, ["node", "salt"]))
                 .filter("whole - pos - size between least - 1 and most + 1").filter(cheap))
        spread = (first.select("id", "word", "whole", "child", "salts", "most", "ends", F.explode(F.expr(f"array({', '.join(moves)})")).alias("m"))
                  .filter("m.ok").select("id", "word", "whole", F.col("m.pos").alias("pos"), "child", F.col("m.edits").alias("edits"), "salts", "most", "ends"))
        # the few states met twice do no harm: the pairs are made distinct
        now = materialise(edited.unionByName(spread), f"trie-level-{level}", tidy=True, rows=STEPS * rows)
        # an end one edit away, or one letter short of the word
        reached.append(now.filter("ends is not null and whole - pos = 1 - edits").select("id", "ends"))
        level += 1
        states = now.filter("most > 0").select("id", "word", "whole", "pos", F.col("child").alias("node"), "edits", "salts")
        rows = states.count()
        if not rows:
            break
    pairs = reached[0]
    for r in reached[1:]:
        pairs = pairs.union(r)
    return pairs


def neighbours(words: DataFrame) -> DataFrame:
    """(word, other): all pairs of the stored ``words`` (id, word, n) that differ by one letter, in both directions.

    The edit lies in the second half of a word or, read backwards, in its second half. So the words and, after a mark, the words read
    backwards make up one trie and walk it together, each with its first half taken as it is: no word branches at the crowded top."""
    both = materialise(words.select((F.col("id") * 2).alias("id"), "word")
                       .union(words.select(F.col("id") * 2 + 1, F.concat(F.lit(MARK), F.reverse("word")))), "spelling-both", tidy=True)
    size = "char_length(word)"
    hold = f"if(startswith(word, '{MARK}'), {size} - ({size} - 1) DIV 2, {size} DIV 2)"
    pairs = walk(both, hold).select(F.shiftright("id", 1).alias("id"), F.shiftright("ends", 1).alias("ends")).distinct()
    # prefixes are told apart by hash: a last look at the words themselves
    return materialise(pairs.join(words.select("id", "word"), "id")
                       .join(words.select(F.col("id").alias("ends"), F.col("word").alias("other")), "ends")
                       .filter("levenshtein(word, other, 1) = 1").select("word", "other"), "trie-pairs", tidy=True)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last form from each ``word`` on, for the stored (word, form) of words that have one."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = materialise(now.join(ahead, "root", "left")
                            .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        now = after.drop("moved")
        if after.filter("moved").isEmpty():
            return now


def group_variants(docs: DataFrame, shortest: int = LENGTH, least: int = COUNT, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``docs`` (doc_id, text)."""
    words = materialise(occurrences(docs, shortest).filter((F.length("word") >= shortest) & (F.col("n") >= least))
                        .withColumn("id", F.monotonically_increasing_id()), "spelling-words", tidy=True)
    pairs = neighbours(words)
    best = (pairs.join(words.select(F.col("word").alias("other"), F.col("n").alias("m")), "other")
            .groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                 F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("b")))
    known = words.join(best, "word", "left")
    is_form = F.coalesce(-F.col("b.m") >= times * F.col("n"), F.lit(False))
    known = materialise(known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                     F.when(is_form, F.col("b.other")).alias("form"), F.when(is_form, -F.col("b.m")).alias("form_n")),
                        "spelling-forms")
    last = roots(known.filter("form is not null").select("word", "form"))
    return (known.join(last, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


#: DuckDB's levenshtein compares bytes: letters of two bytes become other single ones first.
_ONE_BYTE = "translate({0}, '%s', '%s')" % ("".join(map(chr, range(0xC0, 0x100))), "".join(map(chr, range(33, 97))).replace("'", "''"))

ORACLE = f"""
WITH RECURSIVE {CRC_SQL},
run AS (
  SELECT doc_id, r, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[a-zÀ-ÿ]+')) AS r FROM documents)
  WHERE length(r) >= {LENGTH} GROUP BY doc_id, r),
summed AS (
  SELECT r, n, {crc_sql("list_concat(list_transform(string_split(doc_id || ':', ''), lambda x: ascii(x)::BIGINT), flatten(list_transform("
                        "string_split(r, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE "
                        "[(192 + unicode(x) // 64)::BIGINT, (128 + unicode(x) % 64)::BIGINT] END)))")} AS h
  FROM run, crc_table),
word AS (
  SELECT CASE WHEN h % {DROP} = 0 THEN left(r, (h % length(r))::BIGINT) || substr(r, (h % length(r) + 2)::BIGINT) ELSE r END AS word, sum(n)::BIGINT AS n
  FROM summed GROUP BY 1 HAVING length(word) >= {LENGTH} AND sum(n) >= {COUNT}),
near AS (
  SELECT a.word, b.word AS other, b.n AS m
  FROM (SELECT *, {_ONE_BYTE.format('word')} AS x FROM word) a JOIN (SELECT *, {_ONE_BYTE.format('word')} AS x FROM word) b
  ON length(b.x) BETWEEN length(a.x) - 1 AND length(a.x) + 1 AND levenshtein(a.x, b.x) = 1),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-m, encode(other))) AS other, max(m) AS m FROM near GROUP BY word),
known AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= {TIMES} * w.n THEN other END AS form,
         CASE WHEN m >= {TIMES} * w.n THEN m END AS form_n
  FROM word w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root, 0 AS step FROM known
  UNION ALL
  SELECT c.word, k.form, step + 1 FROM chain c JOIN known k ON k.word = c.root AND k.form IS NOT NULL)
SELECT word, form, arg_max(root, step) AS root, any_value(n) AS n, any_value(n_near) AS n_near, any_value(form_n) AS form_n
FROM known JOIN chain USING (word) GROUP BY word, form
"""
