"""Column-level helpers (group C) built from ``pyspark.sql.functions``; no Python row functions."""

from shoal.functions.scalar import (
    CLOCK12_PATTERN, cast_failed, clock12_timestamp, date_parts, epoch_seconds, from_epoch,
    replace_char, safe_ratio, string_template, threshold_flag, typed,
)
from shoal.functions.jsonpath import json_shred, parse_json_rows, variant_shred

__all__ = [
    "CLOCK12_PATTERN", "cast_failed", "clock12_timestamp", "date_parts", "epoch_seconds",
    "from_epoch", "json_shred", "parse_json_rows", "replace_char", "safe_ratio",
    "string_template", "threshold_flag", "typed", "variant_shred",
]
