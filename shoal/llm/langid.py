"""Language ID with error-correcting output codes.

Each learned language gets a codeword; each bit of the code has its own binary
classifier over hashed character n-grams (orders 1-3 of lower-cased letters, runs
of anything else being one boundary). A bit's classifier is the log-odds of its
two groups of languages, languages weighing alike. A document's mean log-odds per
bit goes through a logistic loss, each bit weighted by how well it separates the
training documents, and the codeword with the least loss is chosen; a close
second flags the document as ambiguous.

Edge cases: NULL text, or text without a letter: ``und``, score 0. NULL or
repeated doc_id: the row is scored like any other (held_out is false for a NULL id).
No training rows: every row is ``und``. One learned language: it is predicted
wherever there is a letter. Extra columns are ignored, an empty table gives none.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import Texts, append_columns, bounded_batches, chunks, crc_mod, materialise

BITS = 15
ORDERS = 3
#: Sharpness of the logistic loss on a mean log-odds, and of the confidence on the losses.
SLOPE, SHARP = 4.0, 8.0
#: Loss between the two nearest codewords below which a document is ambiguous.
AMBIGUOUS = 0.01

_tables: list[np.ndarray] = []


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: is it a letter, and its lower case where that is one code point."""
    if not _tables:
        letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        lower = np.arange(0x110000, dtype=np.uint32)
        for i in np.flatnonzero(letter):
            low = chr(i).lower()
            if len(low) == 1:
                lower[i] = ord(low)
        _tables.extend([letter, lower])
    return _tables[0], _tables[1]


def ngrams(t: Texts):
    """Yields (bucket, document) arrays per order. Letters are lower-cased; every run of other
    characters, and each end of a document, is one boundary 0, allowed at an n-gram's ends only."""
    letter, lower = _letters()
    doc = np.repeat(np.arange(t.n, dtype=np.int32), np.diff(t.offsets))
    c = np.where(letter[t.codes], lower[t.codes], 0)
    # a boundary of its own before and after every document
    ends = np.repeat(t.offsets, 2)[1:-1]
    c = np.insert(c, ends, 0)
    doc = np.insert(doc, ends, np.repeat(np.arange(t.n, dtype=np.int32), 2))
    keep = (c != 0) | np.r_[True, (c[:-1] != 0) | (doc[1:] != doc[:-1])]
    c, doc = c[keep], doc[keep]
    g = np.zeros(len(c), np.uint32)
    with np.errstate(over="ignore"):
        s = c * np.uint32(2654435761)
        s ^= s >> np.uint32(15)
        inner = None  # what must not be a boundary: all but the first and the last character
        for n in range(1, ORDERS + 1):
            m = len(c) - n + 1
            if m <= 0:
                return
            g = g[:m] * np.uint32(16777619) + s[n - 1:] + np.uint32(n)
            last = c[n - 1:]
            if n == 1:
                ok = last != 0
                inner = np.ones(m, bool)
            else:
                same = doc[:m] == doc[n - 1:]
                if n > 2:
                    inner = inner[:m] & (c[n - 2:n - 2 + m] != 0)
                else:
                    inner = inner[:m]
                ok = inner & same & ((c[:m] != 0) | (last != 0))
            yield ((g[ok] * np.uint32(2246822519)) >> np.uint32(32 - BITS)).astype(np.int32), doc[:m][ok]


def codebook(k: int) -> np.ndarray:
    """Codewords (k x bits, +1/-1): every split of the languages for k up to 7, else the best of
    some seeded random codes of about 10 log2 k bits by the smallest distance between two words."""
    if k < 2:
        return np.ones((k, 0))
    if k <= 7:
        cols = [[1, *bits] for bits in itertools.product((1, -1), repeat=k - 1) if -1 in bits]
        return np.array(cols, float).T
    rng, best, far = np.random.default_rng(7), None, -1
    for _ in range(40):
        m = rng.choice([-1.0, 1.0], (k, int(np.ceil(10 * np.log2(k)))))
        m = m[:, np.abs(m.sum(0)) < k]
        d = ((m[:, None, :] != m[None, :, :]).sum(2) + np.eye(k) * 10**6).min()
        if d > far:
            best, far = m, d
    return best


class Model:
    def __init__(self, langs: list[str], code: np.ndarray, weights: np.ndarray, trust: np.ndarray):
        self.langs, self.code, self.weights, self.trust = langs, code, weights, trust

    def margins(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Mean log-odds per document and bit; number of n-grams per document."""
        total, count = np.zeros((t.n, self.code.shape[1])), np.zeros(t.n)
        for bucket, doc in ngrams(t):
            count += np.bincount(doc, minlength=t.n)
            for b in range(total.shape[1]):
                total[:, b] += np.bincount(doc, self.weights[b][bucket], t.n)
        return total / np.maximum(count, 1)[:, None], count

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest codeword, confidence, and the lead in loss over the second."""
        if self.code.shape[1] == 0:
            n = len(margins)
            return np.zeros(n, int), np.ones(n), np.full(n, np.inf)
        loss = np.logaddexp(0, -SLOPE * margins[:, None, :] * self.code[None]) @ (self.trust / self.trust.sum())
        order = np.sort(loss, axis=1)
        p = np.exp(-SHARP * (loss - order[:, :1]))
        return loss.argmin(1), 1 / p.sum(1), order[:, 1] - order[:, 0]


def fit(train: DataFrame, per_lang: int = 3000) -> Model:
    """Learn from (text, lang, doc_id) rows with a language. ``per_lang`` bounds the sample: about
    that many documents of each language, picked by hashed doc_id. Only count tables of
    languages x 2^15 buckets and one error rate per bit come to the driver."""
    bounded_batches(train.sparkSession)
    train = train.filter(F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    code = codebook(len(langs))
    if len(langs) < 2:
        return Model(langs, code, np.zeros((0, 1 << BITS)), np.zeros(0))
    rate = F.create_map(*[F.lit(x) for g in langs for x in (g, min(1.0, per_lang / sizes[g]))])
    picked = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(1 << 31)) < rate[F.col("lang")] * F.lit(float(1 << 31))
    sample = materialise(train.filter(picked).select("text", "lang"), "langid-sample")
    index = {g: i for i, g in enumerate(langs)}

    def count(batches):
        seen = np.zeros((len(langs), 1 << BITS))
        for b in batches:
            own = np.array([index[x] for x in b.column("lang").to_pylist()], int)
            for t in chunks(b.column("text")):
                for bucket, doc in ngrams(t):
                    seen += np.bincount(own[t.first + doc] * (1 << BITS) + bucket,
                                        minlength=seen.size).reshape(seen.shape)
        where = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(seen.ravel()[where])], ["at", "n"])

    counts = np.zeros(len(langs) << BITS)
    got = sample.mapInArrow(count, "at long, n double").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    counts[got["at"].to_numpy(np.int64)] = got["n"].to_numpy()
    counts = counts.reshape(len(langs), -1) + 0.5
    p = counts / counts.sum(1, keepdims=True)
    weights = np.stack([np.log(p[code[:, b] > 0].mean(0)) - np.log(p[code[:, b] < 0].mean(0))
                        for b in range(code.shape[1])]).astype(np.float32)
    model = Model(langs, code, weights, np.ones(code.shape[1]))

    def errors(batches):
        wrong, n = np.zeros(code.shape[1]), 0
        for b in batches:
            own = np.array([index[x] for x in b.column("lang").to_pylist()], int)
            for t in chunks(b.column("text")):
                m, seen = model.margins(t)
                truth = code[own[t.first:t.first + t.n]]
                wrong += ((m * truth <= 0) & (seen > 0)[:, None]).sum(0)
                n += int((seen > 0).sum())
        yield pa.RecordBatch.from_arrays([pa.array(range(len(wrong)), pa.int32()), pa.array(wrong),
                                          pa.array([float(n)] * len(wrong))], ["bit", "wrong", "n"])

    seen = (sample.mapInArrow(errors, "bit int, wrong double, n double")
            .groupBy("bit").agg(F.sum("wrong").alias("wrong"), F.sum("n").alias("n")).collect())
    trust = np.ones(code.shape[1])
    for r in seen:
        e = (r["wrong"] + 1) / (r["n"] + 2)
        trust[r["bit"]] = max(0.1, np.log((1 - e) / e))
    return Model(langs, code, weights, trust)


def identify(docs: DataFrame, model: Model, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns with (lang_pred, score, ambiguous) for every row of ``docs``."""
    bounded_batches(docs.sparkSession)

    def run(b: pa.RecordBatch):
        names, scores, close = [], [np.zeros(0)], [np.zeros(0, bool)]
        for t in chunks(b.column("text")):
            m, seen = model.margins(t)
            if not model.langs:
                seen, best, score, lead = np.zeros(t.n), np.zeros(t.n, int), np.zeros(t.n), np.ones(t.n)
            else:
                best, score, lead = model.decode(m)
            names += [model.langs[i] if s else "und" for i, s in zip(best, seen)]
            scores.append(np.where(seen > 0, score, 0.0))
            close.append((seen > 0) & (lead < AMBIGUOUS))
        return [pa.array(names, pa.string()), pa.array(np.concatenate(scores)), pa.array(np.concatenate(close))]

    return append_columns(docs, carry, ["text"], run, "lang_pred string, score double, ambiguous boolean")


def split(docs: DataFrame) -> DataFrame:
    """``docs`` with held_out: crc32 of the id modulo 3 is 1."""
    return docs.withColumn("held_out", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)))


def train_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(crc_mod("doc_id", 3) != 1).select("doc_id", "text", "lang")


__all__ = ["Model", "codebook", "fit", "identify", "ngrams", "split", "train_rows"]
