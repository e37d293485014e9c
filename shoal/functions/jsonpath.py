"""Parsing and shredding of JSON held in text columns.

Parsing is ``from_json`` with an explicit schema — never inference, which would
scan the data twice and guess optional fields differently per batch. A missing
path becomes NULL (lax mode); a document that does not parse at all is sent to
a quarantine output instead of silently vanishing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LAX = {"mode": "PERMISSIVE", "allowSingleQuotes": "true"}


def parse_json_rows(df: DataFrame, text_col: str, schema: str, alias: str = "doc",
                    options: dict[str, str] | None = None) -> DataFrame:
    """Add the parsed document of ``text_col`` as struct/array column ``alias``."""
    opts = {**_LAX, **(options or {})}
    return df.withColumn(alias, F.from_json(F.col(text_col), schema, opts))


def json_shred(df: DataFrame, text_col: str, element_schema: str,
               paths: dict[str, Column | str], keep: list[str] | None = None,
               array: bool = True) -> tuple[DataFrame, DataFrame]:
    """Shred JSON text into typed rows, one per array element.

    ``element_schema`` is the DDL of one element, ``paths`` maps an output
    name to a path (``"main.temp"``) or column expression over the element
    struct ``e``. Returns ``(rows, quarantine)``: quarantine holds the input
    rows whose non-NULL text did not parse.
    """
    keep = keep or []
    schema = f"array<struct<{element_schema}>>" if array else f"struct<{element_schema}>"
    parsed = parse_json_rows(df, text_col, schema, alias="_doc")
    bad = F.col(text_col).isNotNull() & F.col("_doc").isNull()
    quarantine = parsed.where(bad).drop("_doc")
    good = parsed.where(~bad)
    if array:
        # one row per element: an empty array yields no rows (it is not an error)
        good = good.select(*keep, F.explode("_doc").alias("e"))
    else:
        good = good.select(*keep, F.col("_doc").alias("e"))
    cols = [(F.col(f"e.{p}") if isinstance(p, str) else p).alias(name) for name, p in paths.items()]
    return good.select(*keep, *cols), quarantine


def variant_shred(df: DataFrame, text_col: str, paths: dict[str, tuple[str, str]], keep: list[str] | None = None
                  ) -> tuple[DataFrame, DataFrame]:
    """Shred a JSON array held as text into typed rows, element by element: ``(rows, rejects)``.

    ``paths`` maps an output name to a path and a type (``{"temp": ("$.main.temp", "double")}``). Elements are VARIANT values, so a path
    tells a missing or null value (NULL in the row) from one that is there and does not fit its type. An element with such a value gives no
    row but a reject for each: ``keep``, pos (place in the array, from 0), path, value (as text). Text that is no JSON array is
    one reject with pos NULL and path ``$``. NULL text and empty arrays give neither.
    """
    keep = keep or []
    doc = F.from_json(F.col(text_col), "array<variant>", _LAX)
    parsed = df.select(*keep, F.col(text_col).alias("_text"), doc.alias("_doc"))
    unparsed = parsed.where(F.col("_text").isNotNull() & F.col("_doc").isNull())
    elements = parsed.select(*keep, F.posexplode("_doc").alias("pos", "_e"))

    def wrong(path: str, kind: str) -> Column:
        there = F.try_variant_get(F.col("_e"), path, "variant")
        bad = there.isNotNull() & ~F.is_variant_null(there) & F.try_variant_get(F.col("_e"), path, kind).isNull()
        return F.when(bad, F.struct(F.lit(path).alias("path"), F.try_variant_get(F.col("_e"), path, "string").alias("value")))

    # an element that is no object at all has none of the paths: it is wrong as a whole
    plain = F.col("_e").isNull() | F.is_variant_null("_e")
    scalar = F.when(~plain & ~F.startswith(F.schema_of_variant("_e"), F.lit("OBJECT")),
                    F.struct(F.lit("$").alias("path"), F.try_variant_get(F.col("_e"), "$", "string").alias("value")))
    tested = elements.withColumn("_bad", F.array_compact(F.array(scalar, *[wrong(p, k) for p, k in paths.values()])))
    rows = tested.where((F.size("_bad") == 0) & ~plain).select(
        *keep, *[F.try_variant_get(F.col("_e"), p, k).alias(name) for name, (p, k) in paths.items()])
    rejects = (tested.select(*keep, "pos", F.explode("_bad").alias("_b")).select(*keep, "pos", "_b.path", "_b.value")
               .unionByName(unparsed.select(*keep, F.lit(None).cast("int").alias("pos"), F.lit("$").alias("path"), F.col("_text").alias("value"))))
    return rows, rejects
