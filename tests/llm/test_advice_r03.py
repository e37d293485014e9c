"""What the third round changed: the choice of packs, stretches drawn by hash, one rule for all sources."""

import random

import pytest
from pyspark.sql import functions as F

from shoal.llm import mixing, packing, pii


def one_by_one(lengths, seq_len):
    """Each piece, longest first, on the shortest pack if that has room, else on a new one: lengths per pack."""
    packs = []
    for n in sorted(lengths, reverse=True):
        at = min(range(len(packs)), key=lambda i: sum(packs[i]), default=None)
        if at is None or sum(packs[at]) + n > seq_len:
            packs.append([n])
        else:
            packs[at].append(n)
    return sorted(tuple(sorted(p)) for p in packs)


def counted(histogram, seq_len):
    return sorted(tuple(sorted(x for x, k in pattern for _ in range(k)))
                  for n, pattern in packing.shortest_pack_first(histogram, seq_len) for _ in range(n))


def test_shortest_pack_takes_the_piece():
    assert counted({6: 1, 5: 1, 3: 1}, 10) == [(3, 5), (6,)]


@pytest.mark.parametrize("seed", range(20))
def test_packs_equal_one_by_one(seed):
    """Whole patterns at a time give the room left over that single pieces give."""
    rng = random.Random(seed)
    lengths = [min(32, int(rng.paretovariate(0.8))) for _ in range(rng.randrange(1, 300))]
    histogram = {n: lengths.count(n) for n in set(lengths)}
    got, want = counted(histogram, 32), one_by_one(lengths, 32)
    assert sorted(map(sum, got)) == sorted(map(sum, want))
    assert sorted(x for p in got for x in p) == sorted(lengths)


def test_pii_learns_from_texts_anywhere_in_the_alphabet(spark):
    """Texts full of numbers at the front of the alphabet do not use up the sample; long texts take part."""
    front = [("a " + " x ".join(f"{i} {j} 12 34 56" for j in range(40)),) for i in range(300)]
    back = [(f"z{i} " + "lorem ipsum " * 2500 + f" write to person{i}@mail.example.com now",) for i in range(120)]
    docs = spark.createDataFrame([(i, *t) for i, t in enumerate(front + back)], "doc_id long, text string")
    field = pii.fit(docs, sample=400, parts=200)
    assert any(f.startswith("sign") for _, f in field.weights)
    found = pii.find(spark.createDataFrame([(1, "please write to someone [at] mail.example.org today")], "doc_id long, text string"), field)
    assert "email" in found.first()["spans"]


def by_sql(spark, docs, oracle, tmp):
    """(rows of the query's columns, of the SQL) as sorted tuples over the same table."""
    import duckdb
    path = f"{tmp}/documents.parquet"
    docs.coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    res = con.execute(oracle)
    return [d[0] for d in res.description], sorted(map(repr, res.fetchall()))


def test_mix_of_very_unequal_sources_equals_the_sql(spark, tmp_path):
    """Sources of 600,000, 100, 20 and 1 words and rows without id: each target is met to the word, as in the SQL."""
    rows = [(i, "big", "w " * 1000) for i in range(600)] + [(1000 + i, "c100", "a b c d e f g h i j") for i in range(10)]
    rows += [(2000, "d20", "x " * 20), (2001, "e1", "one"), (2002, None, "none of it"), (2003, "f0", None)]
    rows += [(None, "big", f"word{i % 7} and more") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = mixing.mix(docs)
    columns, want = by_sql(spark, docs, mixing.ORACLE, tmp_path)
    assert sorted(repr(tuple(r)) for r in out.select(columns).collect()) == want
    full = mixing.mix(docs, keep=("doc_id", "source")).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"),
                                                                           F.max("first_slot").alias("s")).collect()
    for r in full:
        assert abs(r["t"] - r["g"]) <= 0.5 and (r["s"] >= 0) == (r["t"] > 0)


def test_first_slots_interleave_sources(spark):
    """Any run of slots has the sources in nearly the proportions of their targets."""
    rows = [(i, "abc"[i % 3], "w " * 50) for i in range(3000)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), keep=("doc_id", "source"))
    early = out.filter("first_slot >= 0").orderBy("first_slot", "doc_id").limit(400).groupBy("source").count().collect()
    share = {r["source"]: r["count"] / 400 for r in early}
    target = {r["source"]: r["target"] for r in out.select("source", "target").distinct().collect()}
    assert all(abs(share[s] - target[s] / sum(target.values())) < 0.1 for s in target)


def test_mixture_stage_loses_no_source(spark):
    import corpus_pipeline
    rows = [(i, "w " * 400, "en", "big", 800) for i in range(50)] + [(100 + i, "a b c", "en", f"s{i}", 5) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.mixture(spark, docs, "")
    taken = mixing.mix(docs, keep=("source",)).groupBy("source").agg(F.sum("taken").alias("t")).filter("t > 0")
    assert {r["source"] for r in out.select("source").distinct().collect()} == {r["source"] for r in taken.collect()}
    assert corpus_pipeline.mixture(spark, docs.limit(0), "").count() == 0
