"""Normalisation of a flat table into entity tables.

Each entity is ``select(natural key).distinct()`` numbered by
:func:`shoal.operators.keys.surrogate_keys`; the fact table gets the
surrogate keys by joining back on the natural keys (shuffle joins — entity
tables grow with the data, so nothing is broadcast by assumption).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.operators.keys import surrogate_keys
from shoal.session import checkpoint_root


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it from there:
    for inputs used many times (one pass per entity, joins back, checks) that
    would otherwise recompute their joins each time. Survives executor loss."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def normalize(flat: DataFrame, entities: dict[str, Sequence[str]], fact_cols: Sequence[str]
              ) -> tuple[dict[str, DataFrame], DataFrame]:
    """Split ``flat`` into ``{entity: table}`` and a fact table with ``<entity>_id`` columns.

    ``flat`` is read once per entity and once more for the fact table; pass a
    :func:`materialize`-d frame when it is an expensive join. A NULL in a natural
    key is a value like any other: such rows get their entity's id too."""
    tables = {name: surrogate_keys(flat, cols, out=f"{name}_id") for name, cols in entities.items()}
    fact = flat
    for name, cols in entities.items():
        entity = tables[name].select(f"{name}_id", *[F.col(c).alias(f"_{name}_{c}") for c in cols])
        fact = fact.join(entity, [F.col(c).eqNullSafe(F.col(f"_{name}_{c}")) for c in cols], "left")
    keep = [*fact_cols, *[f"{n}_id" for n in entities]]
    return tables, fact.select(*keep)


def denormalize(tables: dict[str, DataFrame], fact: DataFrame) -> DataFrame:
    """Join the fact table back to every entity (inverse of :func:`normalize`)."""
    out = fact
    for name, t in tables.items():
        out = out.join(t, f"{name}_id", "left").drop(f"{name}_id")
    return out


def lossless_check(flat: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """One row: source rows, rebuilt rows and rows on one side only (0 = lossless)."""
    cols = flat.columns
    rebuilt = rebuilt.select(*cols)
    diff = flat.exceptAll(rebuilt).unionByName(rebuilt.exceptAll(flat))
    n_src = flat.agg(F.count(F.lit(1)).alias("n_source"))
    n_reb = rebuilt.agg(F.count(F.lit(1)).alias("n_rebuilt"))
    n_diff = diff.agg(F.count(F.lit(1)).alias("n_diff"))
    return n_src.crossJoin(n_reb).crossJoin(n_diff)


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Referential check: child rows whose foreign key has no parent."""
    return child.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")
