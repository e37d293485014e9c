"""Normal forms from measured dependencies.

A dependency X -> y holds in a table if no value of X occurs with two values of y. That is one grouped
minimum and maximum per X, combined inside each map task, so a value of X that a third of all rows have costs no more than
others. A hashed sample refutes most candidates first: a violation among some rows is one among all, so only what the sample
leaves open is checked on the whole table. NULL is a value like any other.

The third normal form is synthesised from a minimal cover of the found dependencies: one table per left side, left sides that
determine each other share one, constant columns are a table of one row, and a table with a key of the whole is added if no other has
one. Its size depends on the number of columns alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that refute dependencies before the whole table is read, at most about.
SAMPLE_ROWS = 100_000


@dataclass(frozen=True)
class Relation:
    """A table of the decomposition: the columns of its key and all its columns."""
    key: tuple[str, ...]
    columns: tuple[str, ...]


def _refuted(df: DataFrame, x: Sequence[str], ys: Sequence[str]) -> set[str]:
    """Those of ``ys`` that some value of ``x`` occurs with two values of."""
    def two(y: str) -> Column:
        value = F.struct(F.col(f"`{y}`"))  # a struct orders and compares NULL like a value
        return (F.min(value) != F.max(value)).alias(y)

    grouped = df.groupBy(*[F.col(f"`{c}`") for c in x]).agg(*map(two, ys))
    row = grouped.agg(*[F.max(F.col(f"`{y}`")).alias(y) for y in ys]).first()
    return {y for y in ys if row[y]}


def dependencies(df: DataFrame, columns: Sequence[str] | None = None, max_left: int = 1,
                 sample_rows: int = SAMPLE_ROWS) -> list[tuple[tuple[str, ...], str]]:
    """Minimal dependencies (left side of at most ``max_left`` columns, right column) that hold in all of ``df``, in order of the
    columns. An empty left side means a constant column. Pass a stored frame: it is read once per left side that the sample leaves open."""
    columns = list(columns or df.columns)
    df = df.select(*[F.col(f"`{c}`") for c in columns])
    total = df.count()
    sample = df
    if total > sample_rows:
        share = max(1, int(sample_rows / total * (1 << 31)))
        sample = df.where(F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(1 << 31)) < F.lit(share))
    found: list[tuple[tuple[str, ...], str]] = []
    for size in range(max_left + 1):
        for x in combinations(columns, size):
            ys = [y for y in columns if y not in x and not any(set(z) <= set(x) and y == w for z, w in found)]
            if not ys:
                continue
            open_ys = [y for y in ys if y not in _refuted(sample, x, ys)] if sample is not df else ys
            if open_ys:
                no = _refuted(df, x, open_ys)
                found += [(x, y) for y in open_ys if y not in no]
    return found


def closure(of: Iterable[str], fds: Sequence[tuple[tuple[str, ...], str]]) -> set[str]:
    """All columns that ``of`` determines."""
    out = set(of)
    while True:
        more = {y for x, y in fds if set(x) <= out} - out
        if not more:
            return out
        out |= more


def third_normal_form(columns: Sequence[str], fds: Sequence[tuple[tuple[str, ...], str]]) -> list[Relation]:
    """Tables in third normal form that lose nothing and keep every dependency, widest key last."""
    place = {c: i for i, c in enumerate(columns)}
    cover = list(fds)
    for fd in sorted(fds, key=lambda f: (-len(f[0]), [place[c] for c in f[0]], place[f[1]])):
        rest = [f for f in cover if f != fd]
        if fd[1] in closure(fd[0], rest):  # follows from the others
            cover = rest
    lefts = sorted({x for x, _ in cover}, key=lambda x: (len(x), [place[c] for c in x]))
    groups: list[list[tuple[str, ...]]] = []
    for x in lefts:
        home = next((g for g in groups if set(x) <= closure(g[0], fds) and set(g[0]) <= closure(x, fds)), None)
        groups.append([x]) if home is None else home.append(x)
    out = []
    for g in groups:
        inside = {c for x in g for c in x} | {y for x, y in cover if x in g}
        out.append(Relation(g[0], tuple(sorted(inside, key=place.__getitem__))))
    whole = set(columns)
    if not any(closure(r.columns, fds) >= whole for r in out):
        key = list(columns)
        for c in reversed(columns):
            if closure([k for k in key if k != c], fds) >= whole:
                key.remove(c)
        out.append(Relation(tuple(key), tuple(key)))
    out = [r for r in out if not any(r is not o and set(r.columns) < set(o.columns) for o in out)]
    return sorted(out, key=lambda r: (len(r.columns), [place[c] for c in r.columns]))


def decompose(df: DataFrame, relations: Sequence[Relation]) -> dict[Relation, DataFrame]:
    """The table of each relation: one row per value of its key, combined inside each map task."""
    out = {}
    for r in relations:
        rest = [c for c in r.columns if c not in r.key]
        grouped = df.groupBy(*[F.col(f"`{c}`") for c in r.key])
        # the key determines the rest, so any of its rows will do; a struct keeps NULL
        table = grouped.agg(F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_r")).select(
            *[F.col(f"`{c}`") for c in r.key], *[F.col(f"_r.`{c}`").alias(c) for c in rest]) if rest else df.select(*r.key).distinct()
        out[r] = table.select(*r.columns)
    return out


def recompose(tables: dict[Relation, DataFrame], columns: Sequence[str]) -> DataFrame:
    """All tables joined again, NULL-safe on the columns they share: distinct rows of the decomposed table. Starts from a table whose
    columns determine all others, and follows keys that are already there."""
    left = dict(tables)
    start = max(left, key=lambda r: (len(_reach(r, left)), len(r.columns)))
    out, have = left.pop(start), set(start.columns)
    while left:
        nxt = next(r for r in left if set(r.key) <= have)
        table = left.pop(nxt)
        common = [c for c in nxt.columns if c in have]
        right = table.select(*[F.col(f"`{c}`").alias(f"_{c}" if c in common else c) for c in nxt.columns])
        if common:
            out = out.join(right, [F.col(f"`{c}`").eqNullSafe(F.col(f"`_{c}`")) for c in common]).drop(*[f"_{c}" for c in common])
        else:  # constant columns: a table of one row
            out = out.crossJoin(F.broadcast(right))
        have |= set(nxt.columns)
    return out.select(*columns)


def _reach(r: Relation, tables: Iterable[Relation]) -> set[str]:
    return closure(r.columns, [(t.key, c) for t in tables for c in t.columns])
