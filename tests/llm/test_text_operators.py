"""Operators on documents: edge cases, and results against plain Python on the small tables."""

import base64
import collections
import itertools
import json
import math
import random
import re
import zlib

import numpy as np
import pytest

from shoal.llm import langid, lm, minhash, mixing, packing, pii, secret_scan, toxicity

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- toxicity -----------------------------------------------------------------

def test_toxicity_ranks_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(toxicity.labelled(docs, labels))
    assert len(model[0]) < 5000  # L1 keeps few weights
    got = toxicity.score(toxicity.split(docs), model, ("doc_id", "held_out")).toPandas().merge(labels.toPandas(), on="doc_id")
    got = got[got.held_out]
    rank, y = got.score.rank().to_numpy(), got.toxic.to_numpy()
    auc = (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (1 - y).sum())
    assert auc > 0.95 and got.predicted[y == 0].mean() < 0.01


def test_toxicity_edges(spark, docs, none):
    labels = spark.createDataFrame([(1, 0, "x"), (2, 1, "x"), (2, 0, "x"), (3, None, "x"), (None, 1, "x"), (99, 1, "x")],
                                   "doc_id long, toxic int, text string")
    model = toxicity.fit(toxicity.labelled(docs, labels))
    out = toxicity.score(toxicity.split(docs), model, ("doc_id", "held_out")).collect()
    assert len(out) == 15 and all(0 < r["score"] < 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    bias = 1 / (1 + math.exp(-model[2]))
    assert {round(r["score"], 12) for r in out if r["doc_id"] in (3, 4, 5, 7)} == {round(bias, 12)}
    assert toxicity.score(toxicity.split(none), model).count() == 0
    assert toxicity.fit(toxicity.labelled(none, labels))[2] == 0.0


# --- packing ------------------------------------------------------------------

def test_packing_places_every_id_once(spark, real):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_vocabulary())
    rows = {r["doc_id"]: np.array(tok.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4")
            for r in real.select("doc_id", "text").collect()}
    out = packing.pack_documents(real).toPandas()
    for i, ids in rows.items():
        at = 0
        for r in out[out.doc_id == i].sort_values("start").itertuples():
            assert r.start == at and r.doc_tokens == len(ids)
            assert zlib.crc32(ids[at:at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    out = out.sort_values(["sequence_id", "offset"])
    size = out.groupby("sequence_id").length.sum()
    assert (out.offset == out.groupby("sequence_id").length.cumsum() - out.length).all() and size.max() <= 2048
    assert size.sum() / (2048 * len(size)) > 0.98
    seq = packing.sequences(real).toPandas().set_index("sequence_id")
    assert (seq.used.sort_index() == size.sort_index()).all()
    first = out.iloc[0]
    assert list(seq.ids[first.sequence_id][:first.length]) == list(rows[first.doc_id][first.start:first.start + first.length])


def test_encoder_equals_tokenizer():
    from tokenizers import Tokenizer
    vocabulary = packing.default_vocabulary()
    enc, tok, rng = packing.Encoder(vocabulary), Tokenizer.from_file(vocabulary), random.Random(3)
    parts = [*"ab'sé ñ1 2.,\n\t   　中\x1c", "the ", " of", "<|endoftext|>"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("seed", range(5))
def test_shortest_pack_first_keeps_counts(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 64): rng.randint(1, 500) for _ in range(40)}
    used = collections.Counter()
    sequences = 0
    for n, pattern in packing.shortest_pack_first(histogram, 64):
        assert n > 0 and sum(k * m for k, m in pattern) <= 64
        sequences += n
        for k, m in pattern:
            used[k] += n * m
    assert used == collections.Counter(histogram)
    assert sequences * 64 <= 1.2 * sum(k * m for k, m in histogram.items()) + 64 or max(histogram) > 32


def test_packing_edges(docs, none):
    out = packing.pack_documents(docs).toPandas()
    assert len(out[out.doc_id == 2]) == 2 and out[out.doc_id == 4].length.tolist() == [1]
    assert out.doc_id.isna().sum() == 1 and out.groupby("sequence_id").length.sum().max() <= 2048
    assert packing.pack_documents(none).count() == 0


# --- mixing -------------------------------------------------------------------

def test_mixing_edges(spark, docs, none):
    out = mixing.mix(docs, keep=("doc_id", "source")).toPandas()
    assert len(out) == 15 and (out.taken <= 3 * out["size"]).all()
    by = out.assign(source=out.source.fillna("~")).groupby("source").agg(
        target=("target", "first"), size=("source_size", "first"), taken=("taken", "sum"), words=("size", "sum"))
    assert (by["size"] == by.words).all() and (by.target <= 3 * by["size"] + 1e-6).all()
    assert abs(by.target.sum() - by["size"].sum()) < 1e-6 and (abs(by.taken - by.target) <= 0.01 * by["size"].sum()).all()
    assert mixing.mix(none).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r["size"], r["target"], r["taken"]) for r in mixing.mix(blank).collect()] == [(0, 0.0, 0)] * 2


def test_mixing_targets_fill_up(spark):
    rows = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 30), (None, 500)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    # weights 5, 2, 1, 5: a stops at 30; 1510 left over 8 parts: none of the others stops but c at 90
    assert got["a"] == 30 and got["c"] == 90 and abs(got["b"] / got[None] - 2 / 5) < 1e-9 and abs(sum(got.values()) - 1540) < 1e-6


def test_mixing_reruns_agree(real):
    a, b = (mixing.mix(real.repartition(n)).toPandas().sort_values("doc_id").reset_index(drop=True) for n in (1, 5))
    assert a.equals(b)


# --- personal data ------------------------------------------------------------

def plain_pii(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
            if 16 <= len(d := re.sub("[^0-9]", "", m.group())) <= 19 and pii.luhn(d)]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
                  if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_pii_base_spans_equal_the_patterns(real):
    rng = random.Random(2)
    for _ in range(8000):
        t = "".join(rng.choice("a@.1 2-+(0)9b_5") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == plain_pii(t), t
    for r in real.select("text").collect():
        assert pii.base_spans(r["text"] or "") == plain_pii(r["text"] or "")


def test_pii_field_generalises(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("text rlike '[0-9@]'").collect()]
    field = pii.train([(part, set(gold)) for t in sorted(texts) for part, gold in pii.stretches(t)])
    assert ("phone", 5, 17) in field.decode("call 555-123-4567 now")
    assert field.decode("mail joe.smith [at] example [dot] com") == [("email", 5, 37)]
    assert field.decode("in 1999 we had 12345 things") == []
    # boundaries and kinds are chosen jointly: two entities side by side stay two
    assert pii.base_spans("4111111111111111 5500005555555559") == []
    assert field.decode("4111111111111111 5500005555555559") == [("card", 0, 16), ("card", 17, 33)]


def test_pii_decoder_finds_the_best_segmentation():
    """Dynamic programming against every set of non-overlapping candidates."""
    rng = random.Random(1)
    field = pii.Field()
    for text in ("1.2.3.4 555-123-4567", "a@b.c 10.0.0.1 1234567", "+1 (017) 555-7713 8005550199"):
        found = pii.candidates(text)[:12]
        for a, b, k in found:
            for f in pii.segment_features(text, a, b, k):
                field.weights.setdefault((k, f), rng.uniform(-1, 1.5))
        found, _, scores = field.lattice(text)
        if len(found) > 14:
            continue
        best = 0.0
        for n in range(1, 4):
            for pick in itertools.combinations(range(len(found)), n):
                s = sorted((found[i] for i in pick))
                if all(x[1] <= y[0] for x, y in zip(s, s[1:])):
                    best = max(best, sum(scores[i] for i in pick) + field.touch * sum(x[1] == y[0] for x, y in zip(s, s[1:])))
        got = field.decode(text)
        value = sum(scores[found.index((a, b, pii.KINDS.index(k)))] for k, a, b in got)
        value += field.touch * sum(x[2] == y[1] for x, y in zip(got, got[1:]))
        assert abs(value - best) < 1e-9


def test_pii_edges(spark, docs, none):
    field = pii.fit(docs)
    assert not field.weights  # no base span to learn from
    out = pii.find(docs, field).collect()
    assert len(out) == 15 and all(r["spans"] == "" and r["n_email"] == 0 for r in out)
    assert pii.find(none, pii.fit(none)).count() == 0
    one = spark.createDataFrame([(1, "at a@b.co, 1.2.3.4!"), (2, None)], "doc_id long, text string")
    assert [r["text"] for r in pii.redact(one, field).orderBy("doc_id").collect()] == ["at [EMAIL], [IP]!", None]
    assert pii.base_spans("0" * 6000 + ".1.1.1") == [("ip", 0, 6006)]
    assert pii.base_spans("1" * 50_000 + "a" * 50_000) == []


# --- language -----------------------------------------------------------------

def test_langid_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(langid.train_rows(docs))
    got = langid.identify(langid.split(docs), model, ("doc_id", "lang", "held_out")).toPandas()
    got = got[got.held_out]
    assert (got.lang == got.lang_pred).mean() > 0.98 and got.score.between(0, 1).all() and got.ambiguous.mean() < 0.01


def test_langid_edges(docs, none):
    model = langid.fit(langid.train_rows(docs))
    assert model.langs == ["de", "en"] and model.code.shape == (2, 1)
    out = langid.identify(docs, model).collect()
    assert len(out) == 15
    assert {r["doc_id"] for r in out if r["lang_pred"] == "und"} == {3, 4, 5, 7} and all(r["score"] == 0 for r in out if r["lang_pred"] == "und")
    empty = langid.fit(none)
    assert {r["lang_pred"] for r in langid.identify(docs, empty).collect()} == {"und"}
    single = langid.fit(docs.filter("lang = 'en'"))
    assert {r["lang_pred"] for r in langid.identify(docs, single).collect()} == {"und", "en"}
    assert langid.identify(none, model).count() == 0


@pytest.mark.parametrize("k", [2, 3, 4, 7, 12])
def test_codewords_differ(k):
    code = langid.codebook(k)
    assert len({tuple(r) for r in code}) == k and (abs(code.sum(0)) < k).all()


# --- secrets ------------------------------------------------------------------

def plain_secrets(t):
    out = [(*m.span(), "assign") for m in re.finditer(
        r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 6]
    out += [(*m.span(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(*m.span(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[0], secret_scan.BASE.index(s[2])))


def test_secret_base_spans_equal_the_patterns(real):
    rng = random.Random(2)
    parts = ["token", "Secret", "API_KEY", "apikey", " = ", "=", ":", '"', "'", "abc123", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", " ", "x"]
    for _ in range(6000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert secret_scan.base_spans(t) == plain_secrets(t), t
    for r in real.select("text").collect():
        assert secret_scan.base_spans(r["text"] or "") == plain_secrets(r["text"] or "")


def test_secret_structures():
    body = b"\x02\x01\x00" + b"\x02\x20" + bytes(range(1, 33))
    der = b"\x30" + bytes([len(body)]) + body
    url = lambda x: base64.urlsafe_b64encode(x).rstrip(b"=").decode()
    jwt = ".".join([url(json.dumps({"alg": "HS256"}).encode()), url(json.dumps({"sub": "1234567890"}).encode()), url(bytes(32))])
    blob = b"".join(len(x).to_bytes(4, "big") + x for x in (b"ssh-ed25519", bytes(range(32))))
    for text, kind in ((base64.b64encode(der).decode(), "der"), (der.hex(), "der"), (jwt, "jwt"), (base64.b64encode(blob).decode(), "ssh")):
        assert secret_scan.confirmed(f"see {text} there") == [(4, 4 + len(text.rstrip("=") if kind == "jwt" else text), kind)], kind
    assert secret_scan.confirmed("x " + base64.b64encode(der[:-1] + b"").decode()) == []  # a length that does not fill it
    rng = random.Random(4)
    for _ in range(300):
        assert secret_scan.confirmed(base64.b64encode(rng.randbytes(48)).decode()) == []


def test_secret_edges(docs, none):
    out = secret_scan.scan(docs).collect()
    assert len(out) == 15 and all(r["spans"] == "" for r in out) and secret_scan.scan(none).count() == 0


# --- scoring ------------------------------------------------------------------

def test_lm_base_score_and_gain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    words = {r["doc_id"]: WORD.findall((r["text"] or "").translate(LOW)) for r in docs.collect()}
    c = collections.Counter()
    for i, w in words.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            c.update(w)
            c[None] += 1
    n, v = sum(c.values()), len(c)
    model = lm.fit(lm.train_rows(docs))
    got = lm.score(lm.split(docs), model, ("doc_id", "held_out")).toPandas().set_index("doc_id")
    for i, w in words.items():
        r = got.loc[i]
        assert r.train_tokens == n and r.n_tokens == len(w) + 1 and r.n_known == sum(c[x] > 0 for x in [*w, None])
        assert abs(r.base_score - sum(math.log10((c[x] + 1) / (n + v + 1)) for x in [*w, None])) < 1e-6
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum() and len(model[0].nodes[0]) > 0


def test_lm_states_are_distributions(spark):
    """Every kept context, and the root, spreads a mass of one over all tokens and the unknown one."""
    docs = spark.createDataFrame([(i, "a b a b a c d " * 30 + f"r{i}") for i in range(40)], "doc_id long, text string")
    model, counts = lm.fit(docs)
    assert len(model.nodes[0]) > 0 and counts.count() == model.distinct - 1
    n = len(model.words)
    assert n == model.distinct - 1  # all words are frequent here, so all tokens can be tried
    number = np.arange(n + 1)
    root = 10 ** (model.log_count - model.log_total)
    unknown = 10 ** -model.log_total
    assert abs(root.sum() + unknown - 1) < 1e-9
    for key in model.nodes[0]:
        older, newer = np.full(n + 1, key >> lm.CONTEXT_BITS), np.full(n + 1, key & ((1 << lm.CONTEXT_BITS) - 1))
        part, falls = lm.tree_part(model, number, older, newer)
        p = 10 ** (part + np.where(falls, model.log_count - model.log_total, 0))
        rest, _ = lm.tree_part(model, np.array([-1]), older[:1], newer[:1])
        assert abs(p.sum() + 10 ** (rest[0] - model.log_total) - 1) < 1e-6


def test_lm_edges(docs, none):
    model = lm.fit(lm.train_rows(docs))
    out = lm.score(lm.split(docs), model).collect()
    assert len(out) == 15 and all(r["n_tokens"] >= 1 and r["score"] <= 0 for r in out)
    assert all(r["n_tokens"] == 1 for r in out if r["doc_id"] in (3, 4, 5))
    assert lm.score(none, model).count() == 0
    assert {r["score"] for r in lm.score(docs.filter("doc_id = 4"), lm.fit(none)).collect()} == {0.0}


# --- near-duplicates ----------------------------------------------------------

@pytest.mark.parametrize("width", [2, 5])
def test_minhash_equals_brute_force(spark, width):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sets = {r["doc_id"]: minhash.shingle_set(r["text"], width) for r in docs.collect()}
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)):
            n = len(x & y)
            if 100 * n >= 80 * (len(x) + len(y) - n):
                lo, hi = sorted((top(a), top(b)))
                parent[hi] = lo
    got = minhash.near_duplicates(docs, width).collect()
    assert {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in got} == {i: (top(i), len(s)) for i, s in sets.items()}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_minhash_finds_links_between_points_of_a_star(spark):
    """A family in which many members are linked with others but not with the smallest one."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(2, 7)):
            words[rng.randrange(120)] = f"e{i}x{rng.random()}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: minhash.shingle_set(t, 2) for i, t in rows}
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        n = len(sets[a] & sets[b])
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            lo, hi = sorted((top(a), top(b)))
            parent[hi] = lo
    assert {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, 2).collect()} == {i: top(i) for i in sets}


def test_minhash_edges(docs, none):
    out = {(r["doc_id"], r["component_id"], r["kept"], r["n_shingles"]) for r in minhash.near_duplicates(docs, 2).collect()}
    assert {(1, 1, True, 11), (2, 1, False, 11), (3, 3, True, 0), (6, 6, True, 1), (9, 8, False, 20_000), (None, None, False, 4)} <= out
    assert minhash.near_duplicates(none, 2).count() == 0


def test_copies_of_one_text_do_not_fill_the_learning_task(spark):
    """Any number of copies in the hashed sample trains the same field as one."""
    texts = [f"write to user{i}@mail.example or call +1 555 010 {1000 + i}" for i in range(12)]
    once = spark.createDataFrame([(t,) for t in texts], "text string")
    often = spark.createDataFrame([(t,) for t in texts + texts[:1] * 300], "text string")
    assert pii.fit(often).weights == pii.fit(once).weights
    rows = [(i, f"{'vile' if i % 3 == 0 else 'kind'} words number {i}", int(i % 3 == 0)) for i in range(30)]
    one, many = (toxicity.fit(spark.createDataFrame(r, "doc_id long, text string, toxic int")) for r in (rows, rows + rows[:1] * 300))
    assert (one[0] == many[0]).all() and (one[1] == many[1]).all() and one[2] == many[2]
