"""Near-duplicate documents by SetSketch registers.

Every shingle gets an exponentially distributed value per register. A register keeps the least value
on an exponentially spaced, truncated scale, so the registers of a union are the larger of each pair,
and two registers agree about as often as the sets are alike. Bands of registers propose pairs, the
joint likelihood of larger, smaller and equal registers estimates their similarity, and pairs that may
reach the threshold are decided on their full sets.

Equal shingle sets are one class from the start. In a crowded band the member whose bands are the most
crowded is the centre, and all others are compared with it. Members of a band that are still in different
components are compared with one another, in blocks and with a finer sketch, and only pairs within reach of
the threshold leave a block. So no link between candidates is missed, and no group of copies is ever
expanded into all its pairs.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import batches, mixed, sorted_distinct, spare_name, table, word_hashes
from tallyward.llm.graph import components, merged
from tallyward.plans.durable import durable

WORDS = 5
REGISTERS = 96
BAND = 4
# Of the scale: its base, the rate of the exponential values, the largest register.
BASE = 1.02
RATE = 20.0
TOP = 2_000
# Pairs in a crowded band are compared in blocks of about so many by so many.
BLOCK = 2048
# A band with at most so many pairs to compare lists them; others are compared in blocks.
FEW = 400
# Registers, of 8 bits, that settle which pairs of a crowded band need their full sets.
FINE = 2048


def shingle_hashes(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of hashed words; fewer words than ``size`` make one shingle."""
    if not len(words):
        return np.empty(0, np.uint64)
    span = min(size, len(words))
    total = np.full(len(words) - span + 1, span, np.uint64)
    for i in range(span):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += words[i:len(words) - span + 1 + i]
    return sorted_distinct(mixed(total))


@functools.cache
def _lines_of_registers(m: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20_230_911)  # one family of hash functions, the same in every task
    return (draw.integers(0, 1 << 32, m, dtype=np.uint32) | np.uint32(1)), draw.integers(0, 1 << 32, m, dtype=np.uint32)


def registers(shingles: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """SetSketch registers of a set of hashes, as 16-bit integers."""
    factor, shift = (x[:, None] for x in _lines_of_registers(m))
    low = np.full(m, 0xFFFFFFFF, np.uint32)
    half = (shingles >> np.uint64(32)).astype(np.uint32)
    room = np.empty((m, min(len(half), 1024)), np.uint32)
    for begin in range(0, len(half), 1024):
        some = half[begin:begin + 1024]
        values = np.multiply(factor, some, out=room[:, :len(some)])
        values += shift
        np.minimum(low, values.min(axis=1), out=low)
    least = -np.log1p(-(low + 0.5) / 2.0 ** 32) / RATE
    return np.clip(np.floor(1.0 - np.log(least) / math.log(BASE)), 0, TOP + 1).astype("<u2")


def likely_similarity(size_a: np.ndarray, size_b: np.ndarray, larger: np.ndarray, smaller: np.ndarray, m: int) -> np.ndarray:
    """Maximum-likelihood similarity from how many of ``m`` registers are larger and smaller in a."""
    u = size_a / (size_a + size_b)
    v = 1.0 - u

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    def log_likelihood(j: np.ndarray) -> np.ndarray:
        up, down = p(u - v * j), p(v - u * j)
        tiny = 1e-12
        return (larger * np.log(np.maximum(up, tiny)) + smaller * np.log(np.maximum(down, tiny))
                + (m - larger - smaller) * np.log(np.maximum(1 - up - down, tiny)))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(30):  # the likelihood is concave in j
        third = (high - low) / 3
        left = log_likelihood(low + third) > log_likelihood(high - third)
        low, high = np.where(left, low, low + third), np.where(left, high - third, high)
    return (low + high) / 2


def estimate_floor(similarity: float, m: int = REGISTERS) -> float:
    """Six deviations below the threshold: one in a billion true pairs is estimated lower."""
    return max(0.0, similarity - 6 * math.sqrt(similarity * (1 - similarity) / m))


def equal_floor(size_a: np.ndarray, size_b: np.ndarray, similarity: float, m: int) -> np.ndarray:
    """Equal registers of ``m`` that pairs at the threshold have, less six deviations."""
    u = size_a / (size_a + size_b)
    v = 1.0 - u
    equal = 1.0 + (np.log1p(-np.clip(u - v * similarity, 0, 1) * (BASE - 1) / BASE)
                   + np.log1p(-np.clip(v - u * similarity, 0, 1) * (BASE - 1) / BASE)) / math.log(BASE)
    return m * equal - 6 * np.sqrt(m * equal * (1 - equal))


def _may_link(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int) -> np.ndarray:
    fits = 100 * np.minimum(size_a, size_b) >= percent * np.maximum(size_a, size_b)
    ok = np.zeros(len(a), bool)
    at = np.flatnonzero(fits)
    if len(at):
        x, y = a[at], b[at]
        value = likely_similarity(size_a[at].astype(float), size_b[at].astype(float), (x > y).sum(axis=1), (x < y).sum(axis=1), a.shape[1])
        ok[at] = value >= estimate_floor(percent / 100, a.shape[1])
    return ok


def sketches(docs: DataFrame, size: int = WORDS, m: int = REGISTERS) -> DataFrame:
    """doc_id, loc (hash of doc_id and text), n_shingles, h1 and h2 (together the set's fingerprint), registers."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sketch(frames: Iterator) -> Iterator:
        for batch in frames:
            n, h1, h2, regs = [], [], [], []
            for words in word_hashes(batch.column("text").to_pylist()):
                found = shingle_hashes(words, size)
                n.append(len(found))
                h1.append(int(found.sum(dtype=np.uint64).view(np.int64)))
                h2.append(int(np.bitwise_xor.reduce(mixed(found), initial=np.uint64(0)).view(np.int64)))
                regs.append(registers(found, m).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("loc"), pa.array(n, pa.int64()), pa.array(h1, pa.int64()),
                 pa.array(h2, pa.int64()), pa.array(regs, pa.binary())],
                ["doc_id", "loc", "n_shingles", "h1", "h2", "registers"])

    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("loc")).mapInArrow(
        sketch, f"doc_id {kind}, loc long, n_shingles long, h1 long, h2 long, registers binary")


def _bands(classes: DataFrame, m: int) -> DataFrame:
    width = 2 * BAND  # bytes of a band
    # The low byte of a band's name is its place.
    keys = F.transform(F.sequence(F.lit(0), F.lit(m // BAND - 1)), lambda i: F.shiftleft(
        F.xxhash64(i, F.substring("registers", i * width + 1, F.lit(width))), 8).bitwiseOR(i.cast("long")))
    return classes.select("node", F.explode(keys).alias("band"))


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and registers leave the threshold within reach."""
    side = classes.select("node", "n_shingles", "registers")
    both = pairs.join(side.toDF("a", "na", "ra"), "a").join(side.toDF("b", "nb", "rb"), "b").where(
        100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))

    def keep(frames: Iterator) -> Iterator:
        for batch in frames:
            if batch.num_rows:
                ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, -1) for c in ("ra", "rb"))
                ok = _may_link(ra, rb, batch.column("na").to_numpy(), batch.column("nb").to_numpy(), percent)
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(ok)) for c in ("a", "b")], ["a", "b"])

    return both.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(keep, "a long, b long")


def _full_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(node, set): the whole shingle set of every one of ``nodes``."""
    where = classes.select("node", "loc").join(nodes, "node")

    def full(frames: Iterator) -> Iterator:
        for batch in frames:
            sets = [shingle_hashes(w, size).tobytes() for w in word_hashes(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], ["node", "set"])

    # The hashed side is a pair of longs per wanted class, never a text.
    texts = docs.select("text", F.xxhash64("doc_id", "text").alias("loc")).join(where.hint("shuffle_hash"), "loc")
    found = durable(texts.select("node", "text").mapInArrow(full, "node long, set binary"), "sets")
    return found.dropDuplicates(["node"])


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold."""

    def decide(frames: Iterator) -> Iterator:
        for names_a, names_b, sets_a, sets_b in batches(frames, ["a", "b", "sa", "sb"]):
            out = []
            for a, b, x, y in zip(names_a, names_b, sets_a, sets_b):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (len(x) + len(y) - common):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in (0, 1)], ["a", "b"])

    # A centre may have very many partners: the join on the partner comes first, and the one on the
    # centre is a sort-merge join, whose large partitions Spark splits.
    both = pairs.join(sets.toDF("b", "sb").hint("merge"), "b").join(sets.toDF("a", "sa").hint("merge"), "a")
    return durable(both.select("a", "b", "sa", "sb").mapInArrow(decide, "a long, b long"), "linked")


def _across(rooted: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Plausible pairs (a, b) that share a band and have different roots. ``rooted``: band, node, root."""
    per_root = rooted.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"))
    shape = per_root.groupBy("band").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.max_by("root", "n").alias("main"),
                                         F.count(F.lit(1)).alias("roots")).where("roots > 1").select(
        "band", "main", (F.col("n") * (F.col("n") - F.col("most"))).alias("work"),
        F.ceil(F.col("n") / BLOCK).cast("int").alias("cols"), F.ceil((F.col("n") - F.col("most")) / BLOCK).cast("int").alias("rows"))
    shared = durable(rooted.join(shape, "band"), "shared")

    few = shared.where(F.col("work") <= FEW)
    sides = few.where("root != main").select("band", F.col("node").alias("x"), F.col("root").alias("rx")).join(
        few.select("band", F.col("node").alias("y"), F.col("root").alias("ry")), "band").where("rx != ry")
    plain = _plausible(sides.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), classes, percent)

    crowds = shared.where(F.col("work") > FEW)

    def sharpen(frames: Iterator) -> Iterator:
        for batch in frames:
            fine = [(registers(np.frombuffer(s, np.uint64), FINE) & 0xFF).astype(np.uint8).tobytes() for s in batch.column("set").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fine, pa.binary())], ["node", "n_shingles", "registers", "fine"])

    unsettled = classes.select("node", "n_shingles", "registers").join(crowds.select("node").distinct(), "node").join(sets, "node")
    sharp = durable(unsettled.mapInArrow(sharpen, "node long, n_shingles long, registers binary, fine binary"), "sharp")
    held = crowds.join(sharp.hint("merge"), "node")
    # Pairs within the main root are of no use: rows are the other members, columns are all members.
    col, row = (F.pmod(F.xxhash64("node"), F.col(c)).cast("int") for c in ("cols", "rows"))
    about = ["node", "root", "n_shingles", "registers", "fine"]
    left = held.where("root != main").select("band", row.alias("i"), F.explode(F.sequence(F.lit(0), F.col("cols") - 1)).alias("j"), *about)
    right = held.select("band", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), col.alias("j"), *about)

    def compare(key: tuple, x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        found_a, found_b = [], []
        if len(x) and len(y):
            rx, ry = (np.frombuffer(b"".join(f.registers), "<u2").reshape(len(f), -1) for f in (x, y))
            fx, fy = (np.frombuffer(b"".join(f.fine), np.uint8).reshape(len(f), -1) for f in (x, y))
            bands_x, bands_y = (r.reshape(len(r), -1, BAND) for r in (rx, ry))
            least = (estimate_floor(percent / 100, rx.shape[1]) - 0.02) * rx.shape[1]
            for k in range(len(x)):
                other = np.flatnonzero(y.root.to_numpy() != x.root.iat[k])
                # At least as many registers are equal as the sets are alike.
                other = other[(rx[k] == ry[other]).sum(axis=1) >= least]
                if not len(other):
                    continue
                size_x, size_y = np.full(len(other), x.n_shingles.iat[k]), y.n_shingles.to_numpy()[other]
                other = other[_may_link(np.broadcast_to(rx[k], (len(other), rx.shape[1])), ry[other], size_x, size_y, percent)]
                size_x, size_y = size_x[:len(other)], y.n_shingles.to_numpy()[other]
                other = other[(fx[k] == fy[other]).sum(axis=1) >= equal_floor(size_x, size_y, percent / 100, fx.shape[1])]
                # A pair that shares several bands is reported in the first of them.
                common = (bands_x[k] == bands_y[other]).all(axis=2)
                if len(other):
                    other = other[common.argmax(axis=1) == key[0] & 0xFF]
                hit = y.node.to_numpy()[other]
                found_a.append(np.minimum(hit, x.node.iat[k]))
                found_b.append(np.maximum(hit, x.node.iat[k]))
        a, b = (np.concatenate(f) if f else np.empty(0, np.int64) for f in (found_a, found_b))
        return pd.DataFrame({"a": a, "b": b}).drop_duplicates()

    keys = ["band", "i", "j"]
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)
    crowded = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, "a long, b long")
    return plain.union(crowded).distinct()


def near_duplicates(docs: DataFrame, percent: int = 85, size: int = WORDS, m: int = REGISTERS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept, class_id.

    Documents are linked if 100 * intersection >= percent * union of their shingle sets. component_id is
    the smallest doc_id reachable, kept tells whether it is the row's own. A document without words or text
    has an empty set, is linked with nothing and kept. Null ids: a component's smallest id is that of its
    rows with an id; without any it is null, and the row is kept. Rows that repeat an id stay rows of their
    own. class_id names the shingle set (null: empty). An empty table gives an empty result.
    """
    if not 50 <= percent <= 100 or m % BAND:
        raise ValueError(f"percent must be 50 to 100 and the number of registers a multiple of {BAND}")
    docs = docs.select("doc_id", "text")
    own = durable(sketches(docs, size, m), "sketches")
    classes = durable(
        own.where("n_shingles > 0").groupBy("h1", "h2", "n_shingles")
        .agg(F.min("doc_id").alias("low"), F.min("loc").alias("loc"), F.any_value("registers").alias("registers"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    bands = _bands(classes, m)
    crowded = bands.groupBy("band").agg(F.count(F.lit(1)).alias("crowd")).where("crowd > 1")
    members = durable(bands.join(crowded, "band"), "members")
    fame = members.groupBy("node").agg(F.sum("crowd").alias("fame"))
    centre = members.join(fame, "node").groupBy("band").agg(F.max(F.struct("fame", "node")).getField("node").alias("centre"))
    stars = members.join(centre, "band").where("node != centre").select(
        F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    tried = durable(_plausible(stars, classes, percent), "stars")
    sets = _full_sets(members.select("node").distinct(), classes, docs, size)
    links = _linked(tried, sets, percent)
    roots = components(links)
    # What still shares a band across roots is compared further.
    rooted = members.select("band", "node").join(roots, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
    more = durable(_across(rooted, classes, sets, percent).join(tried, ["a", "b"], "left_anti"), "across")
    roots = merged(roots, _linked(more, sets, percent))
    named = classes.join(roots, "node", "left").select("h1", "h2", "n_shingles", "low", "node", F.coalesce("root", "node").alias("root"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    names = durable(named.join(lowest, "root").select("h1", "h2", "n_shingles", "component_id", F.col("root").alias("class_root"), F.col("node").alias("class_id")), "names")
    # A class may hold a third of all rows: a sort-merge join, whose large partitions Spark splits.
    return own.drop("registers").join(names.hint("merge"), ["h1", "h2", "n_shingles"], "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n_shingles") > 0, F.col("doc_id").eqNullSafe(F.col("component_id"))).otherwise(F.lit(True)).alias("kept"),
        "class_id", F.col("class_root").alias("component"), "loc")


def representatives(docs: DataFrame, percent: int = 85, size: int = WORDS) -> DataFrame:
    """``docs`` (doc_id, text, any other columns) with one row of each group: that with the smallest doc_id,
    among equal ids the one whose (doc_id, text) hash is the smallest; of rows that repeat both, one stays.
    Rows without a word all stay."""
    loc = spare_name("_loc", docs.columns)
    found = near_duplicates(docs, percent, size)
    stay = durable(found.where("kept AND component IS NOT NULL").groupBy("component").agg(F.min("loc").alias(loc)).select(loc), "stay")
    rows = docs.withColumn(loc, F.xxhash64("doc_id", "text"))
    empty = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = rows.where(~empty).join(stay.hint("shuffle_hash"), loc, "left_semi")
    # Nothing but rows that repeat id and text can still be in one group.
    twice = kept.groupBy(loc).agg(F.count(F.lit(1)).alias("times")).where("times > 1").select(loc)
    if twice.isEmpty():
        return kept.unionByName(rows.where(empty)).select(*docs.columns)
    return kept.dropDuplicates([loc]).unionByName(rows.where(empty)).select(*docs.columns)


def op7_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept", "class_id")
