"""Personal data by patterns plus a semi-Markov conditional random field.

Base spans of four kinds come from fixed patterns and always stay. The field then looks at the
stretches of text around digits and at-signs: every admissible segment up to ``MAX_CHARS`` characters is scored as a whole
(shape, digit count, checksum, octets, separators, what stands left and right of it), and dynamic
programming over segment boundaries picks the boundaries and kinds of all entities of the stretch jointly. Its spans are
added where no base span lies.

The field is trained on a bounded sample of stretches, drawn by hash, whose base spans are the truth, on copies with the
spans rewritten as people write them (no plus sign, ``[at]``, ``[.]``, dotted cards), and on spoilt copies that are not personal
data (wrong checksum, octet over 255, too few digits).

Edge cases: NULL or empty text: no span. Repeated rows and NULL ids: every row is scanned. No base span in the sample: the field adds
nothing. Extra columns are ignored unless carried. Texts are scanned whole, in linear time.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm.common import append_columns, bounded_batches, hash_sample, materialise

KINDS = ("email", "ip", "card", "phone")
#: Longest entity, text kept around an anchor, documents the field learns from (at most about) and passes over them.
MAX_CHARS, MARGIN, SAMPLE, EPOCHS = 64, 64, 1500, 4
#: Training stretches at most about; characters from which one is no training stretch.
STRETCHES, STRETCH_CHARS = 3000, 4096

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def emails(text: str) -> list[Span]:
    """Each at-sign with the run of address characters before it (none of an earlier match) and a dotted domain."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            free = m.end()
        else:
            free = at + 1
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[Span]:
    """Base spans by kind as listed, then start."""
    out = emails(text)
    # a chain of dotted numbers gives its first four parts, its next four, and so on
    for m in DOTTED.finditer(text):
        if m.group().count(".") >= 3:
            parts, at, ends = m.group().split("."), m.start(), []
            for part in parts:
                ends.append((at, at + len(part)))
                at += len(part) + 1
            for i in range(0, len(parts) - 3, 4):
                if all(map(octet, parts[i:i + 4])):
                    out.append(("ip", ends[i][0], ends[i + 3][1]))
    for m in CARD.finditer(text):
        d = digits_of(m.group())
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(digits_of(m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


# --- the field -----------------------------------------------------------------------------------

ANCHOR = re.compile(r"[0-9@]+")
AT = re.compile(r"@|\x20?[\[({]at[\])}]\x20?|\x20at\x20", re.I)
DOMAIN_SPOKEN = re.compile(
    r"[A-Za-z0-9-]+(?:(?:\.|\x20?[\[({](?:dot|\.)[\])}]\x20?|\x20dot\x20)[A-Za-z0-9-]+)+", re.I)
SPOKEN = re.compile(r"[\[({]at[\])}]|\x20dot\x20", re.I)
NUMBER = re.compile(r"[0-9]+")
#: Between the numbers of one entity: one separator, or a bracketed dot, or a closing bracket and a space.
GLUE = re.compile(r"[\x20.\-/]|\[\.\]|\)\x20?|\x20\(|-\(|\)-")


def islands(text: str) -> list[tuple[int, int]]:
    """Stretches around digits, at-signs and spoken addresses; everything else can hold no entity."""
    out: list[list[int]] = []
    hits = [m.span() for m in ANCHOR.finditer(text)]
    if SPOKEN.search(text):
        hits = sorted(hits + [m.span() for m in SPOKEN.finditer(text)])
    for a, b in hits:
        lo, hi = max(0, a - MARGIN), min(len(text), b + MARGIN)
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def candidates(text: str) -> list[tuple[int, int, int]]:
    """Admissible (start, end, kind index), whole-number and whole-label boundaries, bounded length."""
    out = set()
    numbers = [m.span() for m in NUMBER.finditer(text)]
    for i, (a, b) in enumerate(numbers):
        if b - a > 19:
            continue
        starts = [a]
        if a and text[a - 1] in "+(":
            starts.append(a - 1)
            if a > 1 and text[a - 2] == "+":
                starts.append(a - 2)
        digits, groups, seps, end = b - a, 1, [], b
        j = i
        while True:
            for s in starts:
                if 7 <= digits <= 15:
                    out.add((s, end, 3))
                if s == a and 13 <= digits <= 19:
                    out.add((s, end, 2))
                if s == a and groups == 4 and digits <= 12 and len(set(seps)) == 1 and "." in seps[0]:
                    out.add((s, end, 1))
            j += 1
            if j == len(numbers) or groups == 8 or not GLUE.fullmatch(text, end, numbers[j][0]):
                break
            seps.append(text[end:numbers[j][0]])
            digits += numbers[j][1] - numbers[j][0]
            groups, end = groups + 1, numbers[j][1]
            if digits > 19 or end - a > MAX_CHARS:
                break
    for m in AT.finditer(text):
        start = m.start()
        lefts = []
        while start > 0 and text[start - 1] in LOCAL and m.start() - start < MAX_CHARS:
            start -= 1
            if (start == 0 or text[start - 1] not in LOCAL or text[start - 1] in "._%+-") and len(lefts) < 6:
                lefts.append(start)
        d = DOMAIN_SPOKEN.match(text, m.end()) if lefts else None
        if d and d.end() - d.start() <= MAX_CHARS:
            for s in lefts:
                out.add((s, d.end(), 0))
    return sorted(out)


def _class(c: str) -> str:
    return "-" if not c else "a" if c.isalpha() else "9" if c.isdigit() else "s" if c.isspace() else c


def segment_features(text: str, start: int, end: int, kind: int) -> list[str]:
    """What the field knows of a whole span."""
    x = text[start:end]
    d = digits_of(x)
    shape = re.sub(r"[0-9]+", lambda m: str(min(len(m.group()), 20)), re.sub(r"[^\W\d_]+", "a", x)) if kind else ""
    left = text[start - 1] if start else ""
    right = text[end] if end < len(text) else ""
    out = ["bias", "left" + _class(left), "right" + _class(right), "around" + _class(left) + _class(right)]
    if kind:
        groups = NUMBER.findall(x)
        out += ["shape" + shape[:24], f"digits{len(d)}", f"groups{len(groups)}", "first" + x[0] if x[0] in "+(" else "plain",
                "seps" + "".join(sorted(set(re.sub(r"[0-9]", "", x))))[:6], "round" if x.count("(") == x.count(")") else "torn"]
        if kind == 2:
            out.append("check" if luhn(d) else "nocheck")
            out.append(f"check{len(d)}" if luhn(d) else "nocheck" + str(len(groups)))
        if kind == 1:
            out.append("octets" if all(map(octet, groups)) else "big")
    else:
        sign = AT.search(x)
        out += ["sign" + sign.group().strip().lower() if sign else "sign", f"labels{len(re.split('[.]| dot |dot', x[sign.end():] if sign else x))}",
                "whole" if not left or left not in LOCAL else "part"]
    return out


class Field:
    """Weights by (kind, feature), and ``touch``: the score of an entity that starts where another ends."""

    def __init__(self, weights: dict[tuple[int, str], float] | None = None, touch: float = -2.0):
        self.weights, self.touch = weights or {}, touch

    def lattice(self, text: str):
        found = candidates(text)
        feats = [segment_features(text, a, b, k) for a, b, k in found]
        scores = [sum(self.weights.get((k, f), 0.0) for f in fs) for (_, _, k), fs in zip(found, feats)]
        return found, feats, scores

    def decode(self, text: str) -> list[Span]:
        """The best non-overlapping set of entities: states are (boundary, does an entity end here)."""
        found, _, scores = self.lattice(text)
        if not found:
            return []
        points = sorted({p for a, b, _ in found for p in (a, b)})
        index = {p: i for i, p in enumerate(points)}
        ending = defaultdict(list)
        for (a, b, k), s in zip(found, scores):
            ending[index[b]].append((index[a], a, b, k, s))
        free, entity = [0.0] + [0.0] * (len(points) - 1), [-math.inf] * len(points)
        by: list = [None] * len(points)
        for i in range(len(points)):
            if i:
                free[i] = max(free[i - 1], entity[i - 1])
            for at, a, b, k, s in ending[i]:
                v = max(free[at], entity[at] + self.touch) + s
                if v > entity[i]:
                    entity[i], by[i] = v, (at, a, b, k)
        out, i = [], len(points) - 1
        ends = entity[i] > free[i]
        while i >= 0:
            if ends:
                at, a, b, k = by[i]
                out.append((KINDS[k], a, b))
                i, ends = at, entity[at] + self.touch > free[at]
            else:
                ends = i > 0 and entity[i - 1] > free[i - 1]
                i -= 1
        return out[::-1]

    def gradient(self, text: str, gold: set[tuple[int, int, int]]):
        """(features with expected minus seen counts, is the stretch's likelihood already near one)."""
        found, feats, scores = self.lattice(text)
        if not found:
            return {}
        points = sorted({p for a, b, _ in found for p in (a, b)})
        index = {p: i for i, p in enumerate(points)}
        n = len(points)
        ending, starting = defaultdict(list), defaultdict(list)
        for j, (a, b, _) in enumerate(found):
            ending[index[b]].append((index[a], j))
            starting[index[a]].append((index[b], j))
        add = np.logaddexp
        free, entity = np.full(n, -np.inf), np.full(n, -np.inf)
        free[0] = 0.0
        for i in range(n):
            if i:
                free[i] = add(free[i - 1], entity[i - 1])
            for at, j in ending[i]:
                entity[i] = add(entity[i], add(free[at], entity[at] + self.touch) + scores[j])
        z = add(free[-1], entity[-1])
        after_free, after_entity = np.full(n, -np.inf), np.full(n, -np.inf)
        after_free[-1] = after_entity[-1] = 0.0
        for i in range(n - 1, -1, -1):
            if i < n - 1:
                after_free[i] = after_entity[i] = after_free[i + 1]
            for to, j in starting[i]:
                after_free[i] = add(after_free[i], scores[j] + after_entity[to])
                after_entity[i] = add(after_entity[i], self.touch + scores[j] + after_entity[to])
        out: dict[tuple[int, str], float] = defaultdict(float)
        for j, (a, b, k) in enumerate(found):
            at, to = index[a], index[b]
            p = math.exp(min(0.0, add(free[at], entity[at] + self.touch) + scores[j] + after_entity[to] - z))
            p -= (a, b, k) in gold
            if abs(p) > 1e-4:
                for f in feats[j]:
                    out[k, f] += p
        return out


def rewritten(text: str, span: Span, rng: random.Random) -> tuple[str, tuple[int, int, int] | None]:
    """A copy of ``text`` with one span written another way, or spoilt, and the entity there now (None: none)."""
    kind, a, b = span
    x = text[a:b]
    good = rng.random() < 0.6
    if kind == "email":
        new = rng.choice([x.replace("@", s) for s in (" [at] ", "[at]", " (at) ", " at ")]) if good else x.split("@")[0]
        if good and " at " in new or rng.random() < 0.5 and good:
            user, sign, domain = re.split(r"( ?[\[(]?at[\])]? ?)", new, maxsplit=1) if "at" in new else (new, "", "")
            new = user + sign + domain.replace(".", " dot " if " at " in new else "[.]")
    elif kind == "ip":
        new = x.replace(".", "[.]") if good else re.sub(r"^[0-9]+", str(rng.randint(300, 999)), x)
    elif kind == "card":
        d = digits_of(x)
        if good:
            new = rng.choice((".", "/", " ")).join(d[i:i + 4] for i in range(0, len(d), 4))
        else:
            new = d[:-1] + str((int(d[-1]) + rng.randint(1, 9)) % 10)
    else:
        d = digits_of(x)
        if good:
            new = rng.choice((x[1:], f"({d[-10:-7]}) {d[-7:-4]}-{d[-4:]}", f"{d[-10:-7]}-{d[-7:-4]}-{d[-4:]}",
                              f"{d[-10:-7]}.{d[-7:-4]}.{d[-4:]}"))
        else:
            new = rng.choice((d[-7:], d[-8:], d))
    whole = text[:a] + new + text[b:]
    return whole, (a, a + len(new), KINDS.index(kind)) if good else None


def stretches(text: str) -> list[tuple[str, list[Span]]]:
    """The parts of a document that have candidates, with the base spans in them as (start, end, kind number)."""
    base = sorted((a, b, KINDS.index(k)) for k, a, b in base_spans(text))
    starts, out = [a for a, _, _ in base], []
    for lo, hi in islands(text):
        part = text[lo:hi]
        if len(part) < STRETCH_CHARS and candidates(part):
            inside = base[bisect.bisect_left(starts, lo):bisect.bisect_left(starts, hi)]
            out.append((part, [(a - lo, b - lo, k) for a, b, k in inside if b <= hi]))
    return out


def examples(part: str, gold: set, rng: random.Random) -> list[tuple[str, set]]:
    """A stretch as it stands, and once rewritten if it has an entity."""
    out = [(part, gold)]
    if gold:
        a, b, k = rng.choice(sorted(gold))
        new, entity = rewritten(part, (KINDS[k], a, b), rng)
        moved = len(new) - len(part)
        rest = {(s + moved * (s >= b), e + moved * (s >= b), k2) for s, e, k2 in gold if e <= a or s >= b}
        out.append((new, rest | ({entity} if entity else set())))
    return out


def train(parts: list[tuple[str, set]]) -> Field:
    """Maximum likelihood by per-weight adaptive steps over the stretches ``parts`` (text, spans), in a fixed order."""
    rng = random.Random(5)
    data = [x for part, gold in parts for x in examples(part, gold, rng)]
    field, seen = Field(), defaultdict(float)
    if not any(gold for _, gold in data):
        return field
    for _ in range(EPOCHS):
        rng.shuffle(data)
        for text, gold in data:
            for f, g in field.gradient(text, gold).items():
                seen[f] += g * g
                field.weights[f] = field.weights.get(f, 0.0) * 0.9995 - 0.5 * g / math.sqrt(seen[f] + 1e-6)
    return field


def fit(docs: DataFrame, sample: int = SAMPLE, parts: int = STRETCHES) -> Field:
    """Train in one task on about ``parts`` distinct stretches of less than ``STRETCH_CHARS`` characters, picked by hash, out of
    about ``sample`` distinct texts with a digit or an at-sign, picked by hash too, of any length. Copies are folded before they are
    counted. The model (a few thousand named weights) comes to the driver."""
    spark = docs.sparkSession
    bounded_batches(spark)
    some = docs.select("text").filter(F.col("text").rlike("@|[0-9]"))
    texts = some.select(F.xxhash64("text", F.lit(5)).alias("h")).distinct().count()
    schema = "part string, gold array<struct<a: int, b: int, k: int>>"

    def cut(batches):
        for b in batches:
            for text in b.column("text"):
                found = stretches(text.as_py())
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p for p, _ in found]),
                         pa.array([[dict(zip("abk", g)) for g in gold] for _, gold in found],
                                  pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("k", pa.int32())])))], ["part", "gold"])

    picked = hash_sample(some, "text", sample, texts, salt=5).distinct()
    found = materialise(picked.mapInArrow(cut, schema).distinct(), "pii-stretches")
    few = hash_sample(found, "part", parts, found.count(), salt=6)

    def learn(table: pa.Table) -> pa.Table:
        rows = sorted((r["part"], [(g["a"], g["b"], g["k"]) for g in r["gold"]]) for r in table.to_pylist())
        w = train([(part, set(gold)) for part, gold in rows]).weights
        return pa.table({"kind": pa.array([k for k, _ in w], pa.int32()), "feature": pa.array([f for _, f in w], pa.string()),
                         "weight": pa.array(list(w.values()), pa.float64())})

    rows = (few.withColumn("all", F.length("part") * 0).groupBy("all")
            .applyInArrow(learn, "kind int, feature string, weight double").collect())
    return Field({(r["kind"], r["feature"]): r["weight"] for r in rows})


def added_spans(text: str, base: list[Span], field: Field) -> list[Span]:
    """What the field finds where no base span lies."""
    if not field.weights:
        return []
    taken = sorted((a, b) for _, a, b in base)
    out = []
    for lo, hi in islands(text):
        for k, a, b in field.decode(text[lo:hi]):
            a, b = a + lo, b + lo
            if not any(s < b and a < e for s, e in taken):
                out.append((k, a, b))
    return out


def digest(found: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def spans_of(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans, each by kind as listed, then start."""
    base = base_spans(text)
    return base, sorted(base + added_spans(text, base, field), key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _texts(col: pa.Array):
    """Each text, or None where no digit and no address can be: those need no Python work."""
    maybe = pc.fill_null(pc.match_substring_regex(col, r"[0-9@]|[\[({][aA][tT][\])}]|(?i: dot )"), False).to_pylist()
    for x, go in zip(col, maybe):
        yield x.as_py() if go else None


def find(docs: DataFrame, field: Field, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` with n_email, n_ip, n_card, n_phone (base spans), base_sha256 and spans, for every row."""
    bounded_batches(docs.sparkSession)

    def run(b: pa.RecordBatch):
        counts, sha, out = {k: [] for k in KINDS}, [], []
        for text in _texts(b.column("text")):
            base, every = spans_of(text, field) if text else ([], [])
            for k in KINDS:
                counts[k].append(sum(s[0] == k for s in base))
            sha.append(hashlib.sha256(digest(base).encode()).hexdigest())
            out.append(digest(every))
        return [*(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(sha, pa.string()), pa.array(out, pa.string())]

    return append_columns(docs, carry, ["text"], run,
                          "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with every span of its text replaced by its kind in brackets; overlapping spans become one."""
    bounded_batches(docs.sparkSession)
    columns, schema = list(docs.columns), docs.schema

    def run(batches):
        for b in batches:
            col, new = b.column("text"), []
            for i, text in enumerate(_texts(col)):
                if not text:
                    new.append(col[i].as_py())
                    continue
                parts, at = [], 0
                for k, a, e in sorted(spans_of(text, field)[1], key=lambda s: (s[1], -s[2])):
                    if a >= at:
                        parts += [text[at:a], f"[{k.upper()}]"]
                    at = max(at, e)
                new.append("".join(parts) + text[at:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(new, pa.string()) if c == "text" else b.column(c) for c in columns], columns)

    return docs.mapInArrow(run, T.StructType(schema.fields))
