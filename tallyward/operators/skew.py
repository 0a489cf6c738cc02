"""Equi-joins that keep their balance when a few keys hold much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The key space is cut into this many hash buckets. The histogram over them, and so
# whatever is broadcast from it, has at most this many rows at any data size.
HASH_BUCKETS = 65_536
# Below this many rows a bucket is never split.
HOT_ROWS = 1_000_000


def hash_bucket(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(HASH_BUCKETS)).cast("int")


def key_load(df: DataFrame, keys: list[str], rows: Column | None = None) -> DataFrame:
    """Rows per hash bucket. Each map task sends at most one row per bucket."""
    weight = F.count(F.lit(1)) if rows is None else F.sum(rows)
    return df.groupBy(hash_bucket(keys).alias("_bucket")).agg(weight.alias("_rows"))


def hot_buckets(load: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Buckets holding over twice an even share, with the number of pieces to cut them into."""
    # One unpartitioned window over the histogram, that is over at most 65,536 rows.
    total = F.sum("_rows").over(Window.partitionBy())
    piece = F.greatest(F.lit(float(hot_rows)), F.lit(2.0) * total / F.lit(HASH_BUCKETS))
    return (
        load.select("_bucket", "_rows", piece.alias("_piece"))
        .where(F.col("_rows") > F.col("_piece"))
        .select("_bucket", F.ceil(F.col("_rows") / F.col("_piece")).cast("int").alias("_pieces"))
    )


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    load: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``left JOIN right USING (on)`` with the hot part of ``left`` cut into salted pieces.

    Left rows of a hot bucket are spread over its pieces by a hash of their other columns
    (repeatable, so a retried task writes the same rows), and the matching right rows are
    copied once per piece. A bucket is one 65,536th of the key space and the pieces of all
    hot buckets number at most half of 65,536, so for a ``right`` whose keys are spread out
    the copies stay below its own size. ``load`` may come from a cheaper frame than ``left``,
    since it only sets the number of pieces, never the result.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"spread_join keeps only left-driven joins exact, got {how!r}")
    if load is None:
        load = key_load(left, on)
    hot = F.broadcast(hot_buckets(load, hot_rows))
    rest = [c for c in left.columns if c not in on]
    piece = F.pmod(F.xxhash64(*[F.col(c) for c in rest]), F.col("_pieces")) if rest else F.lit(0)
    salted_left = (
        left.withColumn("_bucket", hash_bucket(on))
        .join(hot, "_bucket", "left")
        .withColumn("_salt", F.when(F.col("_pieces").isNull(), F.lit(0)).otherwise(piece.cast("int")))
        .drop("_bucket", "_pieces")
    )
    salted_right = (
        right.withColumn("_bucket", hash_bucket(on))
        .join(hot, "_bucket", "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)))
        .drop("_bucket", "_pieces")
    )
    columns = left.columns
    if how in ("left", "inner"):
        columns = columns + [c for c in right.columns if c not in on]
    return salted_left.join(salted_right, on + ["_salt"], how).select(*columns)


def bucketed_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    load: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``spread_join`` for a ``right`` that is stored in buckets of ``on``, which is then not shuffled.

    ``left`` goes to the buckets of ``right``. Its hot parts would all go to the same few, so these are joined by
    ``spread_join`` with the right rows of their keys alone; ``right`` is read a second time for that, unless nothing is hot.
    """
    if load is None:
        load = key_load(left, on)
    hot = F.broadcast(hot_buckets(load, hot_rows))
    marked = left.withColumn("_bucket", hash_bucket(on)).join(hot, "_bucket", "left")
    cold = marked.where(F.col("_pieces").isNull()).drop("_bucket", "_pieces")
    crowded = marked.where(F.col("_pieces").isNotNull()).drop("_bucket", "_pieces")
    theirs = right.withColumn("_bucket", hash_bucket(on)).join(hot, "_bucket", "left_semi").drop("_bucket")
    columns = left.columns + ([c for c in right.columns if c not in on] if how in ("left", "inner") else [])
    spread = spread_join(crowded, theirs, on, how, load, hot_rows)
    return cold.join(right, on, how).select(*columns).unionByName(spread)
