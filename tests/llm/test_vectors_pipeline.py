"""Vector operators, the corpus pipeline, and the registered queries with SQL."""

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from shoal.llm import ann, embed_dedup
from shoal.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def family(n, noise, seed, dim=16):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((max(1, n // 8), dim))
    return np.repeat(centre, 8, axis=0)[:n] + noise * rng.standard_normal((n, dim))


@pytest.fixture()
def odd(spark):
    good = family(64, 0.04, 1).tolist()
    rows = [(i, v, i % 3 if i % 9 else None, "extra") for i, v in enumerate(good)]
    rows += [(100, good[3], 0, "x"), (101, good[3], 0, "x"), (101, good[3], 0, "x"), (102, None, 0, "x"), (103, [], 0, "x"),
             (104, [0.0] * 16, 0, "x"), (105, [float("nan")] + [1.0] * 15, 0, "x"), (106, [None] + [1.0] * 15, 0, "x"),
             (107, [float("inf")] + [1.0] * 15, 0, "x"), (108, [1.0, 2.0], 0, "x"), (None, good[3], 0, "x"), (200, good[5], 1, "x")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, kept string")


def test_embedding_dedup_equals_brute_force(spark, odd):
    got = {}
    for r in embed_dedup.near_duplicates(odd).collect():
        got.setdefault(r["vec_id"], []).append((r["n_links"], r["component_id"], r["kept"]))
    rows = [(r["vec_id"], r["label"], np.array(r["embedding"], float)) for r in odd.collect()
            if r["vec_id"] is not None and r["label"] is not None and r["embedding"] and None not in r["embedding"]]
    rows = [(i, k, v / np.linalg.norm(v)) for i, k, v in rows if np.isfinite(v).all() and v.any()]
    near = [[a != b and rows[a][1] == rows[b][1] and len(rows[a][2]) == len(rows[b][2]) and rows[a][2] @ rows[b][2] >= 0.98
             for b in range(len(rows))] for a in range(len(rows))]
    low = [r[0] for r in rows]
    for _ in rows:
        low = [min([low[a], *(low[b] for b in range(len(rows)) if near[a][b])]) for a in range(len(rows))]
    for a, (i, _, _) in enumerate(rows):
        assert (sum(near[a]), low[a], low[a] == i) in got[i], i
    assert got[102] == [(0, 102, True)] and got[None] == [(0, None, False)] and len(got[101]) == 2
    assert embed_dedup.near_duplicates(odd.limit(0)).count() == 0


def test_embedding_dedup_crowded_cell(spark, monkeypatch):
    """A cell split into many blocks counts every link once."""
    monkeypatch.setattr(embed_dedup, "BLOCK", 16)
    x = family(160, 0.05, 2)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    links = (u @ u.T >= 0.98).sum(1) - 1
    got = {r["vec_id"]: r["n_links"] for r in embed_dedup.near_duplicates(df).collect()}
    assert [got[i] for i in range(160)] == links.tolist()


def test_nearest_is_exact_at_factor_one_and_close_above(spark):
    x = np.random.default_rng(3).standard_normal((600, 8)).round(2)
    x[50:60] = x[40]  # ties
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    asked = df.filter("vec_id % 20 = 0")
    d = np.sqrt(((x[::20][:, None] - x[None]) ** 2).sum(2))
    truth = {}
    for k, i in enumerate(range(0, 600, 20)):
        d[k, i] = np.inf
        truth[i] = np.lexsort((np.arange(600), d[k]))[:10].tolist()
    got = {i: [] for i in truth}
    for r in ann.nearest(df, asked).orderBy("query_id", "rank").collect():
        assert abs(r["score"] - d[r["query_id"] // 20, r["vec_id"]]) < 1e-12
        got[r["query_id"]].append(r["vec_id"])
    assert got == truth
    rough = ann.nearest(df, asked, factor=1.3).collect()
    assert sum(r["vec_id"] in truth[r["query_id"]] for r in rough) >= 0.9 * 10 * len(truth)


def test_tree_prunes(spark):
    x = family(4000, 0.01, 4, 4)
    tree = ann.Tree(x, np.arange(4000))
    tree.search(x[:20], np.arange(20), 10)
    assert tree.visited < 20 * 4000 / 3


def test_nearest_edges(odd):
    out = ann.nearest(odd, odd.filter("vec_id in (100, 104, 108)")).collect()
    assert {r["query_id"] for r in out} == {100} and len(out) == 10  # no vector as long as 108's, 104 is zero
    top = sorted((r for r in out if r["rank"] <= 4), key=lambda r: r["rank"])
    assert [r["vec_id"] for r in top[:2]] == [3, 101] and top[0]["score"] == 0
    assert ann.nearest(odd.limit(0), odd.limit(0)).count() == 0


def test_pipeline_stages(spark, docs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, docs, "").collect()}
    assert not kept & {3, 4, 5, 7} and {1, 2, 8, 10, 12} <= kept
    once = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    ids = [r["doc_id"] for r in once]
    assert 1 in ids and 2 not in ids and 9 not in ids and ids.count(None) == 1 and len(ids) == len(set(ids))
    assert all(f(spark, docs, "").columns == corpus_pipeline.COLUMNS for _, f in corpus_pipeline.STAGES[:-1])
    mixed = [r["doc_id"] for r in corpus_pipeline.mixture(spark, docs, "").collect()]
    assert max(map(mixed.count, mixed)) <= 6 and set(mixed) <= {r["doc_id"] for r in docs.collect()}


def test_pipeline_run_equals_its_stages(spark):
    """Each stage by plain means from the stored rows of the one before, then the packed rows against those."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF).toPandas()
    step = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        step = corpus_pipeline.materialise(stage(spark, step, SF), "test")
    rows = step.toPandas()
    from shoal.llm import packing
    enc = packing.Encoder(packing.default_vocabulary())
    want = sorted((r.doc_id, len(enc.encode(r.text)) // 4 + 1) for r in rows.itertuples())
    assert sorted((r.doc_id, r.doc_tokens) for r in out[out.start == 0].itertuples()) == want
    assert out.groupby("sequence_id").length.sum().max() <= 2048
    languages = corpus_pipeline.language(spark, docs, SF)
    assert languages.count() >= 0.99 * docs.filter("text rlike '[[:alpha:]]|[a-z]'").count()


#: The results of these are no numbers: test_new_operators.py compares them.
TEXTS = {"op11_url_rules", "op12_spelling_variants", "op13_merkle_manifest"}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - TEXTS))
def test_queries_match_sql(spark, name):
    for t in ("documents", "embeddings"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = duckdb.sql(ORACLES[name]).df()
    got = QUERIES[name](spark, SF).toPandas()[list(want.columns)]
    keys = list(want.columns[:2])
    want, got = (x.sort_values(keys).reset_index(drop=True) for x in (want, got))
    for c in want.columns:
        assert np.allclose(want[c].astype(float), got[c].astype(float), rtol=1e-12), c


def test_registered():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())
