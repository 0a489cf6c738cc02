"""Surrogate keys, hour truncation and deterministic split buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def timestamp_text(col: Column) -> Column:
    return F.date_format(col, TIMESTAMP_TEXT)


def hour_of(col: Column) -> Column:
    return F.date_trunc("hour", col)


def natural_key(col: Column) -> Column:
    """Hex md5 of one business value; null stays null."""
    return F.md5(col)


def joined_key(*parts: Column) -> Column:
    """Hex md5 over ``|``-joined parts, where a null part counts as empty text."""
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def split_name(bucket: Column) -> Column:
    """70 / 15 / 15 split over a bucket number from 0 to 99."""
    return (
        F.when(bucket < 70, F.lit("train"))
        .when(bucket < 85, F.lit("validation"))
        .otherwise(F.lit("test"))
    )


def exact_text(col: Column) -> Column:
    """Text of a double, one for each value and the same for both zeros. As a key it is grouped and joined as it stands, while
    Spark normalises doubles first, so that no stored bucketing by them is of use."""
    return (col + F.lit(0.0)).cast("string")


def cents(col: Column) -> Column:
    """Whole cents of an amount: a spelling of a double that every engine writes alike."""
    return F.floor(col * F.lit(100.0)).cast("bigint")
