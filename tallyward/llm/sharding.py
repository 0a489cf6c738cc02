"""Sharding by jump consistent hashing, in Spark's own expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import table
from tallyward.plans.durable import durable

# The multiplier of the published generator, 2862933555777941757, as four 16-bit limbs from the lowest.
_LIMBS = [2862933555777941757 >> shift & 0xFFFF for shift in (0, 16, 32, 48)]
_LOW32 = 0xFFFFFFFF


def _times_low(half: Column, low: int, high: int) -> tuple[Column, Column]:
    """``half * (high << 16 | low)`` for a 32-bit ``half``: the low 32 bits with a carry, and what lies above."""
    p, q = half * F.lit(low), half * F.lit(high)
    return p + F.shiftleft(q.bitwiseAND(F.lit(0xFFFF)), 16), F.shiftright(q, 16)


def _next_state(hi: Column, lo: Column) -> tuple[Column, Column]:
    """state * multiplier + 1 modulo 2**64 on 32-bit halves, so that no product overflows a long."""
    a, above = _times_low(lo, _LIMBS[0], _LIMBS[1])
    a = a + F.lit(1)
    b, _ = _times_low(hi, _LIMBS[0], _LIMBS[1])
    c, _ = _times_low(lo, _LIMBS[2], _LIMBS[3])
    return (F.shiftright(a, 32) + above + b + c).bitwiseAND(F.lit(_LOW32)), a.bitwiseAND(F.lit(_LOW32))


def jump_shard(key: Column, shards: int) -> Column:
    """Shard 0 to ``shards - 1`` of a long ``key``; null keys go with key 0.

    With one shard more, a key stays or moves into the new shard. Each jump lands on a higher
    shard, so ``shards`` steps always suffice.
    """
    if shards < 1:
        raise ValueError("shards must be >= 1")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(F.shiftright(key, 32).bitwiseAND(F.lit(_LOW32)).alias("hi"), key.bitwiseAND(F.lit(_LOW32)).alias("lo"),
                     F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("to"))

    def step(s: Column, _: Column) -> Column:
        hi, lo = _next_state(s["hi"], s["lo"])
        # The top 31 bits of the state, plus one, divide 2**31.
        to = F.floor((s["to"] + 1).cast("double") * (F.lit(2.0 ** 31) / (F.shiftright(hi, 1) + 1).cast("double")))
        moved = F.struct(hi.alias("hi"), lo.alias("lo"), s["to"].alias("at"), to.cast("long").alias("to"))
        return F.when(s["to"] < F.lit(shards), moved).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda s: s["at"]).cast("int")


def _spare(wanted: str, taken: list[str]) -> str:
    while wanted.lower() in {t.lower() for t in taken}:
        wanted += "_"
    return wanted


def shard(df: DataFrame, key: str, shards: int) -> DataFrame:
    """Add shard, slot and grown_shard to ``df``; ``slot`` counts from 0 within each shard.

    Slots follow the key; rows with equal keys, also null keys and repeated rows, follow one another
    in the order in which they were stored. A column of ``df`` with one of these names is replaced.
    An empty table stays empty.

    The rows are range-sorted by (shard, key, place), so a shard or a key with a third of the rows
    spans many tasks. Only one count per shard and task is then added up to find where each task's
    slots begin.
    """
    own = ["shard", "slot", "grown_shard"]
    base = df.drop(*own)
    names = base.columns
    place, at, piece, first, begin = (_spare(n, names + own) for n in ("_place", "_at", "_piece", "_first", "_begin"))
    placed = durable(base.select(
        "*", jump_shard(F.col(key), shards).alias("shard"), jump_shard(F.col(key), shards + 1).alias("grown_shard"),
        F.monotonically_increasing_id().alias(place)), "placed")
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written down, because the slots below need two looks at the same partitions.
    ordered = durable(
        placed.repartitionByRange(width, "shard", key, place).sortWithinPartitions("shard", key, place)
        .select("*", F.monotonically_increasing_id().alias(at))
        .withColumn(piece, F.shiftright(F.col(at), 33)).drop(place), "ordered")
    from pyspark.sql import Window

    runs = ordered.groupBy("shard", piece).agg(F.min(at).alias(first), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("shard").orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("shard", piece, first, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias(begin))
    return (
        ordered.join(runs, ["shard", piece])
        .select(*names, "shard", (F.col(at) - F.col(first) + F.col(begin)).alias("slot"), "grown_shard")
    )


def op3_sharding(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"))
    return shard(docs, "doc_id", 8)
