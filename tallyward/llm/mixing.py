"""Sources mixed to target weights by a multivariate-hypergeometric splitting tree, in Spark's own expressions.

The texts of a source, one after the other, are a stream of words, cut into blocks. How many blocks the mix takes of each
source is settled exactly. A tree then splits these quotas among the output shards: at each node a hypergeometric
draw per source says how many of its blocks go left, so that all shards get their exact number of blocks and all sources
keep theirs. Each shard's draws are places in a keyed permutation of the source's blocks, so they are disjoint within a pass over the
source; within its shard a block goes to a random place. What is written down are spans of documents.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import table
from tallyward.llm.ranking import numbered
from tallyward.plans.durable import durable

WORD = r"[^\x20\x09-\x0D]+"
# Weights of the sources in order, and how often a source may be read at most.
WEIGHTS = [5, 2, 1]
MOST_PASSES = 3
BLOCK_WORDS = 512
SHARDS = 64
# Sources whose quotas stand in one row; the sums of such bundles are split first, then each bundle.
BUNDLE = 1_024
ROUNDS = 48
# So many draws are made from one row.
RUN = 4_096
SEED = 17


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _long(n: int) -> Column:
    return F.lit(n).cast("long")


def _uniform(*key: Column) -> Column:
    """From 0 up to 1, by a hash of ``key``."""
    return F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") * F.lit(2.0 ** -53)


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` out of ``total`` are among the ``good`` ones: the inverse of the distribution at ``u``.

    Weights start at the lower end of twelve standard deviations around the mode, beyond which lies less than 1e-30, and each
    follows from the one before it. So a draw takes as many steps as the square root of the counts.
    """
    least = F.greatest(_long(0), drawn + good - total)
    most = F.least(drawn, good)
    n, k, size = drawn.cast("double"), good.cast("double"), F.greatest(total, _long(1)).cast("double")
    mode = F.least(most, F.greatest(least, F.floor((n + 1) * (k + 1) / (size + 2))))
    variance = n * (k / size) * F.greatest(F.lit(0.0), 1 - k / size) * F.greatest(F.lit(0.0), size - n) / F.greatest(F.lit(1.0), size - 1)
    reach = F.ceil(12 * F.sqrt(variance)) + 12
    span = F.struct(F.greatest(least, mode - reach).alias("a"), F.least(most, mode + reach).alias("b"))

    def ratio(x: Column) -> Column:
        x = x.cast("double")
        return (k - x) * (n - x) / ((x + 1) * (size - k - n + x + 1))

    def draw(s: Column) -> Column:
        whole = F.aggregate(
            F.sequence(s["a"], s["b"]), F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum")),
            lambda acc, x: F.struct((acc["w"] * ratio(x)).alias("w"), (acc["sum"] + acc["w"]).alias("sum")), lambda acc: acc["sum"])
        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), s["a"].alias("at"))
        return _let(whole * u, lambda goal: F.least(s["b"], F.aggregate(
            F.sequence(s["a"], s["b"]), start, lambda acc, x: F.struct(
                (acc["w"] * ratio(x)).alias("w"), (acc["sum"] + acc["w"]).alias("sum"),
                (acc["at"] + (acc["sum"] + acc["w"] <= goal).cast("long")).alias("at")), lambda acc: acc["at"])))

    return _let(span, draw)


def _drawn_left(counts: Column, slots: Column, key: list[Column]) -> Column:
    """Of ``counts`` how many each gives to the left, ``slots`` together: a multivariate hypergeometric draw, one count at a time."""
    start = F.struct(slots.alias("slots"), F.aggregate(counts, _long(0), lambda a, x: a + x).alias("rest"), F.array().cast("array<long>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        h = hypergeometric(acc["rest"], x["c"], acc["slots"], _uniform(*key, x["i"]))
        return _let(h, lambda v: F.struct((acc["slots"] - v).alias("slots"), (acc["rest"] - x["c"]).alias("rest"), F.concat(acc["out"], F.array(v)).alias("out")))

    indexed = F.transform(counts, lambda c, i: F.struct(c.alias("c"), i.alias("i")))
    return F.aggregate(indexed, start, step, lambda acc: acc["out"])


def split_quotas(quotas: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """(key, shard, counts): the ``counts`` of each row of ``quotas`` (key, counts, slots) split among the shards, which take ``slots``
    each. Both are array<long> of one sum; the results keep both sums."""
    rows = quotas.select("key", "counts", "slots", F.lit(0).alias("lo"), F.lit(shards).alias("hi"))
    for _ in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        middle = F.expr("(lo + hi) div 2").cast("int")
        rows = rows.withColumn("mid", middle)
        slots = F.aggregate(F.slice("slots", F.col("lo") + 1, F.col("mid") - F.col("lo")), _long(0), lambda a, x: a + x)
        rows = rows.withColumn("left", _drawn_left(F.col("counts"), slots, [F.lit(seed), F.col("key"), F.col("lo"), F.col("hi")]))
        right = F.zip_with("counts", "left", lambda c, x: c - x)
        halves = F.array(F.struct(F.col("lo"), F.col("mid").alias("hi"), F.col("left").alias("counts")),
                         F.struct(F.col("mid").alias("lo"), F.col("hi"), right.alias("counts")))
        rows = rows.select("key", "slots", F.explode(F.filter(halves, lambda h: h["lo"] < h["hi"])).alias("h")).select("key", "slots", "h.*")
    return rows.select("key", F.col("lo").alias("shard"), "counts")


def permuted(place: Column, size: Column, *key: Column) -> Column:
    """Where ``place`` stands in a keyed permutation of 0 to ``size`` - 1: in every round a place is swapped with its mirror, or not."""
    size = F.greatest(size, _long(1))

    def swap(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(*key, r), size) - x, size)
        return _let(mirror, lambda y: F.when(F.pmod(F.xxhash64(*key, r, F.greatest(x, y)), F.lit(2)) == 1, y).otherwise(x))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), place, swap)


def targets(sources: DataFrame, weights: list[int] = WEIGHTS) -> DataFrame:
    """``sources`` (idx, source_size, others) with ``target``: shares of all words by weight, the excess over three times
    a source's size shared anew by weight until none is above. Only sums come to the driver."""
    weighted = sources.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("idx") % len(weights) + 1).cast("int")).cast("double"))
    limit, rate = F.col("source_size") * MOST_PASSES, 0.0
    total = weighted.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    while True:
        full = limit <= F.lit(rate) * F.col("_weight")
        held, left = weighted.agg(F.coalesce(F.sum(F.when(full, limit)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0.0))).first()
        if not left or (total - held) / left <= rate:
            break
        rate = (total - held) / left
    return weighted.withColumn("target", F.least(limit.cast("double"), F.lit(rate) * F.col("_weight"))).drop("_weight")


def plan(sources: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """``sources`` with their numbers of blocks and draws and the length of the last draw, 0 for a whole block.

    Draws go through the source's blocks pass after pass; its last block, which may be short, ends every pass.
    """
    words = F.least(F.round("target").cast("long"), F.col("source_size") * MOST_PASSES)
    counted = targets(sources).withColumns({"words": words, "blocks": F.expr(f"(source_size + {block - 1}) div {block}")})
    rest = F.when(F.col("source_size") > 0, F.col("words") % F.greatest(F.col("source_size"), F.lit(1))).otherwise(0)
    passes = F.expr("words div greatest(source_size, 1)")
    return counted.withColumns({"last": rest % block, "draws": passes * F.col("blocks") + F.ceil(rest / F.lit(float(block)))}).drop("words")


def quotas_by_shard(planned: DataFrame, shards: int, seed: int) -> DataFrame:
    """(idx, shard, quota, begin): how many draws of each source a shard takes, and which is the first."""
    bundled = planned.groupBy(F.expr(f"idx div {BUNDLE}").alias("bundle")).agg(
        F.sum("draws").alias("total"), F.sort_array(F.collect_list(F.struct("idx", "draws")))["draws"].alias("counts"))
    share = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda j: F.expr(f"`all` div {shards}") + (j < F.expr(f"`all` % {shards}")).cast("long"))
    top = (bundled.agg(F.sum("total").alias("all"), F.sort_array(F.collect_list(F.struct("bundle", "total")))["total"].alias("counts"))
           .where(F.col("all").isNotNull()).select(_long(-1).alias("key"), "counts", share.alias("slots")))
    bundles = durable(split_quotas(top, shards, seed), "bundles")
    slots = bundles.select("shard", F.posexplode("counts").alias("bundle", "n")).groupBy("bundle").agg(
        F.sort_array(F.collect_list(F.struct("shard", "n")))["n"].alias("slots"))
    rows = bundled.join(slots, "bundle").select(F.col("bundle").alias("key"), "counts", "slots")
    each = durable(split_quotas(rows, shards, seed), "quotas").select("key", "shard", F.posexplode("counts").alias("at", "quota"))
    each = each.select((F.col("key") * BUNDLE + F.col("at")).alias("idx"), "shard", "quota")
    before = Window.partitionBy("idx").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return each.withColumn("begin", F.coalesce(F.sum("quota").over(before), F.lit(0))).where(F.col("quota") > 0)


def draws(planned: DataFrame, quotas: DataFrame, block: int, seed: int) -> DataFrame:
    """(idx, shard, draw, pass, block, words): one row per draw; ``words`` is how much of the block it takes."""
    run = F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("quota") - 1, F.lit(RUN).cast("long"))).alias("first")
    runs = quotas.select("idx", "shard", "begin", "quota", run).join(planned.select("idx", "source_size", "blocks", "draws", "last"), "idx")
    width = int(planned.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = F.least(F.col("first") + RUN, F.col("begin") + F.col("quota")) - 1
    each = runs.repartition(width, "idx", "shard", "first").select(
        "idx", "shard", "source_size", "blocks", "draws", "last", F.explode(F.sequence("first", ends)).alias("draw"))
    each = each.withColumns({"pass": F.expr("draw div blocks"), "place": F.col("draw") % F.col("blocks")})
    inner = F.col("blocks") - 1
    at = F.when(F.col("place") == inner, inner).otherwise(permuted(F.col("place"), inner, F.lit(seed), F.col("idx"), F.col("pass")))
    words = (F.when((F.col("draw") == F.col("draws") - 1) & (F.col("last") > 0), F.col("last"))
             .when(F.col("place") == inner, F.col("source_size") - inner * block).otherwise(_long(block)))
    return each.select("idx", "shard", "draw", "pass", at.alias("block"), words.alias("words"))


def placed(docs: DataFrame, block: int = BLOCK_WORDS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Documents (row, doc_id, size, idx, source_size, target, begin) with their places in their sources' streams, and the sources' plan."""
    base = durable(docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.col("source").isNull().alias("nameless"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name"),
        F.xxhash64("text").alias("tie")), "sizes")
    # Pieces of a source and rows of a piece both grow with the root of the rows, so neither is ever large.
    pieces = max(1, math.isqrt(base.count()))
    key = ["nameless", "name"]
    cut = base.withColumn("piece", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "tie"), F.lit(pieces)))
    sums = durable(cut.groupBy(*key, "piece").agg(F.sum("size").alias("words")), "pieces")
    sources = numbered(sums.groupBy(*key).agg(F.sum("words").alias("source_size")).withColumn("all", F.lit(0)), ["all"], key)
    planned = durable(plan(sources.select(*key, "idx", "source_size"), block), "plan")
    before = Window.partitionBy(*key).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*key, "piece", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset")).join(
        planned.select(*key, "idx", "source_size", "target"), key)
    inside = Window.partitionBy(*key, "piece").orderBy("doc_id", "tie", "row").rowsBetween(Window.unboundedPreceding, -1)
    rows = cut.withColumn("begin", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(offsets, [*key, "piece"])
    return durable(rows.select("row", "doc_id", "size", "idx", "source_size", "target", (F.col("begin") + F.col("offset")).alias("begin")), "placed"), planned


def spans_of(rows: DataFrame, planned: DataFrame, shards: int = SHARDS, block: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """(shard, place, row, doc_id, idx, pass, first, words): what the mix holds, ``words`` words of a document from its word ``first``.
    ``place`` is random by block; the order within a shard is that of (place, block, begin)."""
    quotas = quotas_by_shard(planned, shards, seed)
    taken = draws(planned, quotas, block, seed)
    pieces = rows.where("size > 0").select("row", "doc_id", "idx", "size", "begin", F.explode(
        F.sequence(F.expr(f"begin div {block}"), F.expr(f"(begin + size - 1) div {block}"))).alias("block"))
    first = F.greatest(F.col("begin"), F.col("block") * block)
    end = F.least(F.col("begin") + F.col("size"), F.col("block") * block + F.col("words"))
    both = pieces.join(taken, ["idx", "block"]).where(end > first)
    return both.select("shard", F.xxhash64(F.lit(seed), "idx", "draw").alias("place"), "row", "doc_id", "idx", "pass", "block",
                       (first - F.col("begin")).alias("first"), (end - first).alias("words"), "begin")


def write_mix(docs: DataFrame, path: str, shards: int = SHARDS, block: int = BLOCK_WORDS, seed: int = SEED) -> None:
    """The mix as one folder of spans per shard, in shuffled order over as many files as Spark needs."""
    rows, planned = placed(docs, block, seed)
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["shard", "place", "block", "begin", "row"]
    (spans_of(rows, planned, shards, block, seed).repartitionByRange(width, *order).sortWithinPartitions(*order)
     .select("shard", "doc_id", "pass", "first", "words").write.partitionBy("shard").mode("overwrite").parquet(path))


def mix(docs: DataFrame, shards: int = SHARDS, block: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target and taken, the words the mix takes, of every row of ``docs`` (doc_id, text, source).

    A null or wordless text has size 0 and is not taken; null is a source of its own, the last. Rows that repeat one another are
    documents of their own, and which of them is taken more often is open. The words taken of a source are its
    target, rounded. An empty table gives an empty result.
    """
    rows, planned = placed(docs, block, seed)
    taken = spans_of(rows, planned, shards, block, seed).groupBy("row").agg(F.sum("words").alias("taken"))
    return rows.join(taken, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def op11_source_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
