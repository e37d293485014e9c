"""The whole job where it was cut short: contexts, secrets beside other text, small sources."""

import base64
import json
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shoal.llm import embed_dedup, lm, mixing, secret_scan
from shoal.llm.common import Texts


def test_lm_contexts_follow_the_corpus(spark):
    """Contexts far below any share of the corpus are learned once seen often enough, also long ones; scores equal the chain rule."""
    rng = random.Random(5)
    filler = [" ".join(f"f{rng.randrange(3000)}" for _ in range(300)) for _ in range(4500)]
    # after "k l m" comes what came before it, which no shorter context knows; each makes up 1e-4 of all tokens
    marked = [f"{a} k l m {b}" for a, b in (("p", "x"), ("q", "y")) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(filler + marked)), "doc_id long, text string")
    probe = spark.createDataFrame([(1, "p k l m x"), (2, "p k l m y")], "doc_id long, text string")
    gains = {}
    for depth in (1, 3, 4):
        model, counts = lm.fit(docs, depth)
        assert model.total * 2e-4 > 270 and model.tree.count() > 0
        out = {r["doc_id"]: r["score"] - r["base_score"] for r in lm.score(probe, (model, counts)).collect()}
        gains[depth] = out[1] - out[2]
    assert abs(gains[1]) < 0.1 and abs(gains[3]) < 0.1 and gains[4] > 1
    # every n-gram of a text is met once, whether held by the tasks or joined
    weight = {r["key"]: r["weight"] for r in model.tree.collect()}
    token, _, place = lm.sequence(Texts(pa.array(["p k l m x"]), 0))
    want = sum(weight.get(lm.signed(k), 0.0) for d, key in enumerate(lm.grams(token, 5), 1) for k in key[place >= d - 1])
    assert abs(out[1] - want) < 1e-9


def der(n):
    body = b"\x02\x01\x00" + b"\x04\x81" + bytes([n]) + bytes(i % 251 for i in range(n))
    return b"\x30\x81" + bytes([len(body)]) + body


def blob(*parts):
    return b"".join(len(p).to_bytes(4, "big") + p for p in parts)


@pytest.mark.parametrize("n", [129, 130, 131])
def test_secret_spans_end_where_the_structure_ends(n):
    """Padded and unpadded bodies between armour, words and other keys."""
    key = base64.b64encode(der(n)).decode()
    lines = "\n".join(key[i:i + 64] for i in range(0, len(key), 64))
    for before, after in (("-----BEGIN PRIVATE KEY-----\n", "\n-----END PRIVATE KEY-----"), ("key: ", "\nNext line"),
                          ("anordinarylongword0\n", "\nanotherlongword00"), ("-----BEGIN KEY-----", "-----END KEY-----")):
        for body in (lines, key, key.rstrip("=")):
            assert secret_scan.confirmed(before + body + after) == [(len(before), len(before + body), "der")]
    two = secret_scan.confirmed(lines + "\n" + lines)
    assert two == [(0, len(lines), "der"), (len(lines) + 1, 2 * len(lines) + 1, "der")]


def test_secret_blobs_of_all_types():
    sk = blob(b"sk-ecdsa-sha2-nistp256@openssh.com", b"nistp256", bytes(65), b"ssh:")
    sign = blob(blob(b"ssh-ed25519", bytes(32)), blob(b"ssh-ed25519", bytes(64)))
    cert = (blob(b"ssh-rsa-cert-v01@openssh.com", bytes(32), b"\1\0\1", bytes(257)) + (7).to_bytes(8, "big") + (1).to_bytes(4, "big")
            + blob(b"me", blob(b"root")) + bytes(16) + blob(b"", b"", b"") + sign)
    for raw in (sk, cert, blob(b"ssh-ed25519", bytes(32))):
        text = base64.b64encode(raw).decode()
        assert secret_scan.confirmed(f"x\n{text}\nNextword {text}") == [
            (2, 2 + len(text), "ssh"), (12 + len(text), 12 + 2 * len(text), "ssh")]


def test_token_ends_with_its_line():
    url = lambda x: base64.urlsafe_b64encode(x).rstrip(b"=").decode()
    jwt = ".".join([url(json.dumps({"alg": "HS256"}).encode()), url(json.dumps({"sub": "1"}).encode()), url(bytes(32))])
    for before in ("", "averylongwordbefore\n", "x "):
        assert secret_scan.confirmed(f"{before}{jwt}\nNext") == [(len(before), len(before + jwt), "jwt")]
    assert secret_scan.confirmed(jwt[:-9] + "\n" + jwt[-9:] + "\nNext") == [(0, len(jwt) + 1, "jwt")]


def test_mixing_small_sources_reach_their_targets(spark):
    """Sources of 100 words beside ten million: a slot of the schedule is longer than their targets."""
    large = spark.range(1000).select(F.col("id").alias("doc_id"), F.concat(F.lit("a"), F.col("id") % 3).alias("source"),
                                     F.repeat(F.lit("w "), 10_000).alias("text"))
    small = spark.range(24).select((F.col("id") + 5000).alias("doc_id"), F.format_string("s%02d", F.floor(F.col("id") / 2)).alias("source"),
                                   F.repeat(F.lit("v "), 50).alias("text"))
    out = mixing.mix(large.union(small), keep=("doc_id", "source")).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"))
    for r in out.collect():
        if r["source"][0] == "s":
            assert r["target"] == 300 and r["taken"] == 300, r
        else:
            assert abs(r["taken"] / r["target"] - 1) < 0.01, r


def test_embedding_cells_hold_links_along_the_axis_of_two_centres():
    """Vectors moved straight towards the second nearest centre, by the largest distance that still links."""
    x = np.random.default_rng(3).standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    grid = embed_dedup.Grid(x, 14, 0.98)
    book, half = grid.books[0], grid.half
    near = np.argsort(((x[:, None, :half] - book[None]) ** 2).sum(2), axis=1)
    side = np.zeros_like(x)
    side[:, :half] = book[near[:, 1]] - book[near[:, 0]]
    side -= (side * x).sum(1)[:, None] * x
    side /= np.linalg.norm(side, axis=1)[:, None]
    moved = 0.9801 * x + np.sqrt(1 - 0.9801 ** 2) * side
    assert grid.reach >= np.sqrt(2 - 2 * 0.98)
    assert all(h in v for h, v in zip(grid.home(moved), grid.visits(x)))


@pytest.mark.parametrize("line", ["eyebrow", "MIT/////", base64.b64encode(blob(b"ssh-unlisted", b"x" * 30)).decode(),
                                  "eyJhbGciOiJIUzI1NiJ9", "MIIBCgKCAQEA" + "A" * 52, "AAAAB3NzaC1yc2EAAAAD"])
@pytest.mark.parametrize("end", ["", "."])
def test_secret_scan_time_follows_the_text(line, end):
    """Lines that each look like the start of a structure reaching over all further lines: a megabyte in under two seconds."""
    import time
    text = "\n".join([line] * ((1 << 20) // (len(line) + 1))) + end
    began = time.perf_counter()
    secret_scan.confirmed(text)
    assert time.perf_counter() - began < 2


def test_secret_scan_nested_starts():
    """A token whose header starts inside a run of lookalikes, and its lines broken; keys one after another in one run."""
    enc = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).rstrip(b"=").decode()
    head, body = enc({"alg": "HS256", "typ": "JWT"}), enc({"sub": "a", "n": [1, 2, {"x": "y"}]})
    token = f"{head}.{body}.{'s' * 43}"
    for before in ("", "eyebrow\n" * 3, "eyJ\n", "eyJhbGci\n"):
        found = [x for x in secret_scan.confirmed(f"{before}{token} end") if x[2] == "jwt"]
        assert found == [(len(before), len(before) + len(token), "jwt")]
    broken = f"{head[:12]}\n{head[12:]}.{body[:7]}\r\n{body[7:]}.{'s' * 20}\n{'s' * 23}\nnext"
    assert [x[:2] for x in secret_scan.confirmed(broken)] == [(0, len(broken) - 5)]
