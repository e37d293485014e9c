"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a document are the distinct hashed words, word pairs and pairs with one or two words between
(lower-cased words of letters). FTRL-proximal keeps a step size per coordinate and an L1 bar that holds most
weights at exactly zero, so the model is a short list of (bucket, weight) that every task can hold.

Edge cases: NULL, empty or letterless text: the bias alone. NULL label or NULL doc_id: not learned from; NULL doc_id is
scored, held_out false. Several labels for a document: toxic if one says so. One class or no labels: the bias alone, near the
smoothed share. Repeated rows are learned from once and scored alike, extra columns ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import (MIX1, ODD, Texts, append_columns, bounded_batches, chunks, crc_mod, hash_sample, lists,
                              materialise, splitmix)
from shoal.llm.langid import _letters

BITS = 20
#: Documents learned from, at most about; passes over them.
SAMPLE, EPOCHS = 12_000, 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.1
#: How much a toxic document counts against a clean one.
TOXIC_WEIGHT = 2.0


def features(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of every word, pair and skip-pair, repeats included."""
    letter, lower = _letters()
    inside = letter[t.codes]
    left = np.r_[False, inside[:-1]] if len(inside) else inside
    left[t.offsets[:-1][t.offsets[:-1] < len(inside)]] = False
    starts = np.flatnonzero(inside & ~left)
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    right = np.r_[inside[1:], False]
    last = t.offsets[1:] - 1
    right[last[last >= 0]] = False
    ends = np.flatnonzero(inside & ~right) + 1
    doc = np.searchsorted(t.offsets, starts, "right") - 1
    h = t.hashes(lower[t.codes], starts, ends)
    out, own = [h], [doc]
    with np.errstate(over="ignore"):
        for gap in (1, 2, 3):
            same = doc[gap:] == doc[:-gap]
            out.append(splitmix(h[:-gap][same] * ODD + h[gap:][same] + np.uint64(gap) * MIX1))
            own.append(doc[gap:][same])
    return (np.concatenate(out) >> np.uint64(64 - BITS)).astype(np.int32), np.concatenate(own)


def ftrl(offsets: np.ndarray, buckets: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights by bucket, and the bias, which has no penalty."""
    n, z = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias_n, bias_z = 0.0, 0.0
    for _ in range(EPOCHS):
        for i, y in enumerate(labels):
            at = buckets[offsets[i]:offsets[i + 1]]
            zi, ni = z[at], n[at]
            w = np.where(np.abs(zi) <= L1, 0.0, (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
            bias = -bias_z / ((BETA + np.sqrt(bias_n)) / ALPHA)
            p = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -30, 30)))
            g = (p - y) * (TOXIC_WEIGHT if y else 1.0)
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[at] = ni + g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / ALPHA * bias
            bias_n += g * g
    w = np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    return w, -bias_z / ((BETA + np.sqrt(bias_n)) / ALPHA)


def fit(rows: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, float]:
    """(buckets, weights, bias) from (doc_id, text, toxic) rows. ``sample`` bounds what one task learns from: about that many
    documents, picked by hashed doc_id; the rest of the labelled rows is not needed for a classifier."""
    bounded_batches(rows.sparkSession)
    rows = rows.filter("toxic is not null and doc_id is not null")
    # the rate follows the ids, not the rows: copies of one must not thin out the others
    rows = hash_sample(rows, "doc_id", sample, rows.select("doc_id").distinct().count(), salt=1)

    def extract(batches):
        for b in batches:
            for t in chunks(b.column("text")):
                at, own = features(t)
                keys = np.unique(own << BITS | at)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(t.first, t.n), b.column("toxic").slice(t.first, t.n),
                     lists((keys & ((1 << BITS) - 1)).astype(np.int32), np.bincount(keys >> BITS, minlength=t.n))],
                    ["doc_id", "toxic", "at"]).append_column("all", pa.array(np.zeros(t.n, np.int32)))

    def learn(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table.column("doc_id").to_numpy()
        order = np.argsort((ids.astype(np.uint64) * ODD) ^ (ids.astype(np.uint64) >> np.uint64(7)), kind="stable")
        table = table.take(order).combine_chunks()
        at = table.column("at").combine_chunks()
        at = at.chunk(0) if isinstance(at, pa.ChunkedArray) else at
        w, bias = ftrl(at.offsets.to_numpy(), at.values.to_numpy(), table.column("toxic").to_numpy().astype(float))
        k = np.flatnonzero(w)
        return pa.table({"at": pa.array(np.r_[-1, k]), "w": pa.array(np.r_[bias, w[k]])})

    # a repeated row is learned from once, so copies of one cannot fill the learning task
    sampled = rows.select("doc_id", F.col("toxic").cast("int").alias("toxic"), "text").distinct()
    got = (sampled.mapInArrow(extract, "doc_id long, toxic int, at array<int>, all int").groupBy("all").applyInArrow(learn, "at long, w double").toPandas())
    at, w = got["at"].to_numpy(np.int64), got["w"].to_numpy()
    return at[at >= 0], w[at >= 0], float(w[at < 0].sum())


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` with score and predicted, for every row of ``docs`` (text)."""
    bounded_batches(docs.sparkSession)
    buckets, weights, bias = model

    def run(b: pa.RecordBatch):
        dense = _dense(buckets, weights)
        out = [np.zeros(0)]
        for t in chunks(b.column("text")):
            at, own = features(t)
            w = dense[at]
            some = np.flatnonzero(w)  # distinct features count once; only the few with a weight matter
            keys = np.unique(own[some] << BITS | at[some])
            s = bias + np.bincount(keys >> BITS, dense[keys & ((1 << BITS) - 1)], t.n)
            out.append(1 / (1 + np.exp(-np.clip(s, -30, 30))))
        p = np.concatenate(out)
        return [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]

    return append_columns(docs, carry, ["text"], run, "score double, predicted int")


_weights: list = []


def _dense(buckets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The weights by bucket, laid out once per worker and model."""
    key = (buckets.tobytes(), weights.tobytes())
    if not _weights or _weights[0] != key:
        dense = np.zeros(1 << BITS)
        dense[buckets] = weights
        _weights[:] = [key, dense]
    return _weights[1]


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of the rows learned from: crc32 of the id modulo 5 is not 0."""
    marks = (labels.filter("toxic is not null and doc_id is not null").filter(crc_mod("doc_id", 5) != 0)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    return materialise(marks, "labels").join(docs.select("doc_id", "text"), "doc_id")


def split(docs: DataFrame) -> DataFrame:
    return docs.withColumn("held_out", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)))
