"""Toxicity and language ID against plain loops; the pipeline's stages against plain code; empty tables through every stage."""

import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from shoal.llm import langid, pii, toxicity
from shoal.llm.common import Texts

TEXTS = ["Der Hund und die Katze im Haus", "das Haus, der Hund", "the dog and the cat in a house", "a house and a dog.", "le chien et le chat",
         "la maison, le chat", "Ünder der Brücke", "x", "", None, "12 34", "the the the cat", "der die das der die das", "chat\nchien  maison"]
LANGS = ["de", "de", "en", "en", "fr", "fr", "de", "en", "fr", "en", "de", "en", "de", "fr"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def one_hash(word):
    t = Texts(pa.array([word]), 0)
    return int(t.hashes(t.codes, np.array([0]), np.array([len(word)]))[0])


# ---------------------------------------------------------------- language ID

def plain_ngrams(text):
    """Buckets of all n-grams of a text, by loops over characters."""
    c = [0]
    for x in text or "":
        low = x.lower() if x.isalpha() else ""
        v = (ord(low) if len(low) == 1 else ord(x)) if x.isalpha() else 0
        if v or c[-1]:
            c.append(v)
    if c[-1]:
        c.append(0)
    M = (1 << 32) - 1

    def s(v):
        v = v * 2654435761 & M
        return v ^ v >> 15

    out = []
    for i in range(len(c)):
        g = 0
        for n in range(1, langid.ORDERS + 1):
            if i + n > len(c):
                break
            g = (g * 16777619 + s(c[i + n - 1]) + n) & M
            if any(v == 0 for v in c[i + 1:i + n - 1]):
                break
            if (c[i + n - 1] if n == 1 else c[i] or c[i + n - 1]):
                out.append((g * 2246822519 & M) >> (32 - langid.BITS))
    return out


def plain_langid(train, asked):
    langs = sorted({g for _, g in train})
    code = langid.codebook(len(langs))
    counts = {g: Counter() for g in langs}
    for text, g in train:
        counts[g].update(plain_ngrams(text))
    size = 1 << langid.BITS
    p = {g: np.array([counts[g][b] + 0.5 for b in range(size)]) for g in langs}
    p = np.array([p[g] / p[g].sum() for g in langs])
    w = np.array([np.log(p[code[:, b] > 0].mean(0)) - np.log(p[code[:, b] < 0].mean(0)) for b in range(code.shape[1])]).astype(np.float32)

    def margins(text):
        grams = plain_ngrams(text)
        return [sum(float(w[b][g]) for g in grams) / max(1, len(grams)) for b in range(len(w))], len(grams)

    wrong, n = [0] * len(w), 0
    for text, g in train:
        m, k = margins(text)
        if k:
            n += 1
            for b in range(len(w)):
                wrong[b] += m[b] * code[langs.index(g)][b] <= 0
    trust = [max(0.1, math.log((1 - (x + 1) / (n + 2)) / ((x + 1) / (n + 2)))) for x in wrong]
    out = []
    for text in asked:
        m, k = margins(text)
        loss = [sum(trust[b] / sum(trust) * math.log1p(math.exp(-langid.SLOPE * m[b] * code[i][b])) for b in range(len(w))) for i in range(len(langs))]
        best = min(range(len(langs)), key=loss.__getitem__)
        score = 1 / sum(math.exp(-langid.SHARP * (x - loss[best])) for x in loss)
        out.append((langs[best], score) if k else ("und", 0.0))
    return out


@pytest.mark.parametrize("partitions", [1, 5])
def test_langid_equals_plain_loops(spark, partitions):
    docs = spark.createDataFrame(list(zip(range(len(TEXTS)), TEXTS, LANGS)), "doc_id long, text string, lang string").repartition(partitions)
    got = {r["doc_id"]: r for r in langid.identify(docs, langid.fit(docs)).collect()}
    for i, (lang, score) in enumerate(plain_langid(list(zip(TEXTS, LANGS)), TEXTS)):
        assert got[i]["lang_pred"] == lang and abs(got[i]["score"] - score) < 1e-6, TEXTS[i]


# ---------------------------------------------------------------- toxicity

def plain_features(text):
    words = ["".join(y if len(y := x.lower()) == 1 else x for x in w) for w in re.findall(r"[^\W\d_]+", text or "")]
    h = [one_hash(w) for w in words]
    out = set(x >> (64 - toxicity.BITS) for x in h)

    def mix(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2 ** 64
        x = (x ^ x >> 27) * 0x94D049BB133111EB % 2 ** 64
        return x ^ x >> 31

    for gap in (1, 2, 3):
        for a, b in zip(h, h[gap:]):
            out.add(mix((a * 0x9E3779B97F4A7C15 + b + gap * 0xBF58476D1CE4E5B9) % 2 ** 64) >> (64 - toxicity.BITS))
    return sorted(out)


def plain_ftrl(rows):
    """FTRL-proximal with one accumulator pair a weight, feature by feature."""
    z, n, bz, bn = defaultdict(float), defaultdict(float), 0.0, 0.0
    a, b, l1, l2 = toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2

    def weight(f):
        return 0.0 if abs(z[f]) <= l1 else (math.copysign(l1, z[f]) - z[f]) / ((b + math.sqrt(n[f])) / a + l2)

    for _ in range(toxicity.EPOCHS):
        for features, y in rows:
            w = {f: weight(f) for f in features}
            bias = -bz / ((b + math.sqrt(bn)) / a)
            p = 1 / (1 + math.exp(-max(-30, min(30, bias + sum(w.values())))))
            g = (p - y) * (toxicity.TOXIC_WEIGHT if y else 1.0)
            for f in features:
                z[f] += g - (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / a * w[f]
                n[f] += g * g
            bz += g - (math.sqrt(bn + g * g) - math.sqrt(bn)) / a * bias
            bn += g * g
    return {f: weight(f) for f in z}, -bz / ((b + math.sqrt(bn)) / a)


def test_toxicity_equals_plain_loops(spark):
    rows = [(i, t, int("haus" in (t or "").lower() or "cat" in (t or ""))) for i, t in enumerate(t for t in TEXTS * 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    order = sorted(rows, key=lambda r: (r[0] * 0x9E3779B97F4A7C15 % 2 ** 64) ^ r[0] >> 7)
    w, bias = plain_ftrl([(plain_features(t), float(y)) for _, t, y in order])
    model = toxicity.fit(df)
    got = dict(zip(model[0].tolist(), model[1].tolist()))
    assert abs(model[2] - bias) < 1e-9 and {f for f, x in w.items() if x} == set(got)
    assert all(abs(got[f] - w[f]) < 1e-9 for f in got)
    out = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    for i, t, _ in rows:
        assert abs(out[i] - 1 / (1 + math.exp(-max(-30, min(30, bias + sum(w.get(f, 0.0) for f in plain_features(t))))))) < 1e-9


def test_copies_of_one_id_do_not_thin_out_the_sample(spark):
    rows = [(1, "the same", 0)] * 20_000 + [(i, f"word{i} {'bad' if i % 2 else 'good'} house", i % 2) for i in range(2, 600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    assert len(toxicity.fit(df, sample=600)[0]) > 0


# ---------------------------------------------------------------- pipeline

def plain_groups(rows):
    """Near-duplicates by all pairs: documents that stay."""
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {i for i in parent if parent[i] == i}


def test_stages_equal_plain_code(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*corpus_pipeline.COLUMNS)
    rows = docs.collect()
    model = langid.fit(langid.train_rows(docs))
    kept = corpus_pipeline.language(spark, docs, "").collect()
    want = {r["doc_id"] for r in langid.identify(docs, model).collect() if r["lang_pred"] != "und" and not r["ambiguous"]}
    assert {r["doc_id"] for r in kept} == want
    assert {r["doc_id"]: r["lang"] for r in kept if r["lang"]} == {r["doc_id"]: r["lang"] for r in kept}
    once = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(r["doc_id"] for r in once) == sorted(plain_groups([(r["doc_id"], r["text"]) for r in rows]))
    field = pii.fit(docs)
    for r in corpus_pipeline.personal_data(spark, docs, "").collect():
        old = next(x["text"] for x in rows if x["doc_id"] == r["doc_id"])
        marks, at, new = sorted(pii.spans_of(old or "", field)[1], key=lambda s: (s[1], -s[2])), 0, ""
        for k, a, b in marks:
            if a >= at:
                new += old[at:a] + f"[{k.upper()}]"
            at = max(at, b)
        assert r["text"] == (None if old is None else new + old[at:]) and r["n_chars"] == (len(r["text"]) if r["text"] is not None else r["n_chars"])


def test_stages_take_an_empty_table(spark):
    step = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, step, "")
        assert out.count() == 0, name
        step = out if name != "pack" else step


