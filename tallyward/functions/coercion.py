"""Column expressions that turn loosely typed input into typed values with defaults."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "UNKNOWN"

# The spellings accepted as booleans, after trim and lower.
TRUE_TEXT = ["true", "t", "1", "yes", "y"]
FALSE_TEXT = ["false", "f", "0", "no", "n"]


def blank_to_null(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))


def to_double(col: Column, dtype: T.DataType, default: float | None = 0.0) -> Column:
    """Double, or the default for null, blank and unparseable input."""
    value = blank_to_null(col).try_cast("double") if isinstance(dtype, T.StringType) else col.cast("double")
    return value if default is None else F.coalesce(value, F.lit(default))


def to_int(col: Column, dtype: T.DataType, default: int | None = 0) -> Column:
    """Int, or the default. Text goes through double, so that ``'1.0'`` is 1."""
    if isinstance(dtype, T.StringType):
        value = blank_to_null(col).try_cast("double").try_cast("int")
    else:
        value = col.try_cast("int")
    return value if default is None else F.coalesce(value, F.lit(default))


def to_text(col: Column, default: str | None = UNKNOWN) -> Column:
    value = blank_to_null(col.cast("string"))
    return value if default is None else F.coalesce(value, F.lit(default))


def to_type_code(col: Column) -> Column:
    """Transaction type with ``CASH-OUT`` and ``CASH_OUT`` read as the same code."""
    return F.coalesce(F.translate(blank_to_null(col.cast("string")), "-", "_"), F.lit(UNKNOWN))


def moment(as_of: datetime | Column | None) -> Column:
    """The reference moment of a run: now unless the caller pins it."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def event_time(col: Column, as_of: datetime | Column | None = None) -> Column:
    """ISO text as a timestamp; blank or unparseable text falls back to ``as_of``."""
    return F.coalesce(F.try_to_timestamp(blank_to_null(col)), moment(as_of))


def to_bool(col: Column, dtype: T.DataType) -> Column:
    """True, false or null from mixed encodings. Numbers count only when they are 1 or 0."""
    if isinstance(dtype, T.BooleanType):
        return col
    if isinstance(dtype, T.NumericType):
        return F.when(col == 1, F.lit(True)).when(col == 0, F.lit(False))
    text = F.lower(F.trim(col.cast("string")))
    return F.when(text.isin(TRUE_TEXT), F.lit(True)).when(text.isin(FALSE_TEXT), F.lit(False))


def plain_number(col: Column) -> Column:
    """Text of a double without an exponent, for people to read."""
    size = F.abs(col)
    # A double has 17 digits; both types hold all of them within their range.
    exact = F.when(size < 1e-3, col.try_cast("decimal(38,37)").cast("string")).otherwise(col.try_cast("decimal(38,9)").cast("string"))
    digits = F.regexp_replace(exact, "0+$", "")
    return F.when((size == 0) | size.between(1e-3, 9999999.0), col.cast("string")).otherwise(
        F.coalesce(F.regexp_replace(digits, r"\.$", ".0"), col.cast("string")))
