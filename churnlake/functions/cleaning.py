"""Column expressions for cleaning raw string feeds (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnlake.schema import DROP_SENTINELS, NUMBER_PATTERN

# Integer part of a decimal text: '5.7' -> '5', ' 12 ' -> '12', 'abc' -> ''.
_INT_TEXT = r"^([+-]?[0-9]+)([.][0-9]*)?$"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_present(col: str | Column) -> Column:
    """Not null and not a drop sentinel ('not specified' / 'unknown', any case, untrimmed)."""
    c = _c(col)
    return c.isNotNull() & ~F.lower(c).isin(DROP_SENTINELS)


def yes_no_int(col: str | Column, yes: int = 1, no: int = 0) -> Column:
    """'yes' -> 1, 'no' -> 0 (case-insensitive), everything else (incl. 'unknown') -> null."""
    low = F.lower(_c(col))
    return F.when(low == "yes", F.lit(yes)).when(low == "no", F.lit(no)).cast("int")


def collapse_to_no(col: str | Column, phrase: str) -> Column:
    """Map a 'no <service>' phrase (case-insensitive) to 'No', keep other values."""
    c = _c(col)
    return F.when(F.lower(c) == phrase, F.lit("No")).otherwise(c)


def sentinel_to_unknown(col: str | Column) -> Column:
    """null or 'not specified' (any case) -> 'Unknown'."""
    c = _c(col)
    return F.when(c.isNull() | (F.lower(c) == "not specified"), F.lit("Unknown")).otherwise(c)


def text_to_int(col: str | Column) -> Column:
    """Lenient integer parse: integer part of a decimal text, else null (never raises under ANSI)."""
    digits = F.regexp_extract(F.trim(_c(col)), _INT_TEXT, 1)
    return digits.try_cast("int")


def extract_number(col: str | Column) -> Column:
    """First unsigned decimal number inside a text ('$56.95' -> 56.95, '-5.0' -> 5.0), '' -> null."""
    extracted = F.regexp_extract(_c(col), NUMBER_PATTERN, 1)
    return F.nullif(F.trim(extracted), F.lit("")).try_cast("double")


def text_to_date(col: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Lenient date parse, unparsable -> null."""
    return F.try_to_date(_c(col), fmt)


def text_to_double(col: str | Column) -> Column:
    return _c(col).try_cast("double")
