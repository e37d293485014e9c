"""Column expressions for cleaning and deriving values (group C).

All helpers return ``Column`` objects built from ``pyspark.sql.functions`` so
they stay inside whole-stage codegen; none is a Python row function.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den`` that is NULL when the divisor is 0 or NULL (ANSI ``/`` raises)."""
    return F.try_divide(_c(num), _c(den))


def threshold_flag(c: ColumnOrName, threshold, true_text: str = "true",
                   false_text: str = "false") -> Column:
    """Text flag for ``c > threshold`` (strict); NULL compares as false."""
    return F.when(_c(c) > F.lit(threshold), F.lit(true_text)).otherwise(F.lit(false_text))


def string_template(fmt: str, *cols: ColumnOrName) -> Column:
    """``printf``-style template over columns; NULL when any input is NULL (as
    ``concat``), not the text ``null`` that ``format_string`` alone would print."""
    args = [_c(c) for c in cols]
    if not args:
        return F.format_string(fmt)
    present = args[0].isNotNull()
    for a in args[1:]:
        present = present & a.isNotNull()
    return F.when(present, F.format_string(fmt, *args))


def replace_char(c: ColumnOrName, old: str, new: str) -> Column:
    """Replace every occurrence of ``old`` by ``new`` (literal, not a pattern)."""
    return F.replace(_c(c), F.lit(old), F.lit(new))


def date_parts(c: ColumnOrName, fmt: str = "yyyy-MM-dd", strict: bool = True) -> list[Column]:
    """``[date, year, month, day]`` of a text or timestamp column.

    ``strict`` parses with ``to_date`` (bad text raises, as the pandas job
    does); otherwise ``try_to_date`` turns it into NULL.
    """
    col = _c(c)
    d = F.to_date(col, fmt) if strict else F.try_to_date(col, fmt)
    return [d.alias("date"), F.year(d).alias("year"), F.month(d).alias("month"),
            F.dayofmonth(d).alias("day")]


# Fixed value: the 12-hour clock text pattern, e.g. "10:00 AM", "12:00 PM".
CLOCK12_PATTERN = "yyyy-MM-dd h:mm a"


def clock12_timestamp(date_col: ColumnOrName, time_col: ColumnOrName) -> Column:
    """Combine a ``yyyy-MM-dd`` date text and ``h:mm AM/PM`` text into a local timestamp."""
    return F.to_timestamp_ntz(F.concat_ws(" ", _c(date_col), _c(time_col)), F.lit(CLOCK12_PATTERN))


_EPOCH_NTZ = "1970-01-01 00:00:00"


def epoch_seconds(ts: ColumnOrName) -> Column:
    """Whole epoch seconds (floor) of a wall-clock UTC timestamp (``timestamp_ntz``).

    Computed as a difference of local timestamps, so the result does not depend
    on the session time zone (a cast to ``timestamp`` would shift it).
    """
    micros = F.timestamp_diff("MICROSECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), _c(ts).cast("timestamp_ntz"))
    return F.floor(micros / F.lit(1_000_000)).cast("bigint")


def from_epoch(seconds: ColumnOrName) -> Column:
    """Epoch seconds → wall-clock UTC ``timestamp_ntz``, independent of the session time zone."""
    return F.timestamp_add("SECOND", _c(seconds), F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))


def typed(c: ColumnOrName, spark_type: str, fmt: str | None = None) -> Column:
    """Lenient cast of landing text: text that does not parse becomes NULL.

    Dates and timestamps take an explicit per-source format.
    """
    col = _c(c)
    t = spark_type.lower()
    if t == "date":
        return F.try_to_date(F.trim(col), fmt) if fmt else F.try_to_date(F.trim(col))
    if t in ("timestamp", "timestamp_ntz"):
        parsed = F.try_to_timestamp(F.trim(col), F.lit(fmt)) if fmt else F.try_to_timestamp(F.trim(col))
        # parse and cast back in the same session zone: the wall-clock text is kept
        return parsed.cast("timestamp_ntz") if t == "timestamp_ntz" else parsed
    return F.trim(col).try_cast(spark_type)


def cast_failed(text: ColumnOrName, typed_col: Column) -> Column:
    """True when non-blank text did not survive the cast."""
    col = _c(text)
    return F.when(col.isNull() | (F.trim(col) == ""), F.lit(False)).otherwise(typed_col.isNull())
