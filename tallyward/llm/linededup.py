"""Removes repeated runs of lines: a suffix array over line ids, built by prefix doubling.

Lines become ids. A suffix is a line with all that follow it in its document. Round k ranks every
suffix by its first 2**k lines, from the pair of ranks that round k-1 gave to it and to the suffix
2**(k-1) lines on. The suffixes that share their first L lines form one LCP interval; its name is the
pair of ranks of the two overlapping stretches of 2**k lines, 2**k <= L < 2**(k+1), that cover those
L lines. The interval's first member stays and all later members are copies.

A run is removed if it has at least ``min_words`` words. Whatever a maximal repeated run covers is also
covered by its stretches that just reach ``min_words``, counted forwards or backwards from a line.
So only the intervals of these stretches are looked up, doubling ends at their length, and a line
that occurs once, or a suffix that is alone in its rank, is left out from then on.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import batches, row_key, spare_name, table
from tallyward.plans.durable import durable

MIN_WORDS = 50
_WORD = r"[^\x20\x09-\x0D]+"
_KEY = ["row_a", "row_b"]


def _lines(docs: DataFrame) -> DataFrame:
    """Lines that hold a word: row, place among such lines, hashes, words."""
    listed = docs.select("doc_id", *row_key(), F.filter(F.split("text", "\n"), lambda x: x.rlike(_WORD)).alias("lines"))
    return listed.select("doc_id", *_KEY, F.posexplode("lines").alias("seq", "line")).select(
        "doc_id", *_KEY, F.col("seq").cast("long").alias("seq"), F.xxhash64("line").alias("h1"),
        F.xxhash64(F.lit(1), "line").alias("h2"), F.regexp_count("line", F.lit(_WORD)).alias("words"))


def _ranked(df: DataFrame, by: list[str]) -> DataFrame:
    """Distinct values of ``by`` that occur at least twice, with a rank in their order."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    return durable(values.repartitionByRange(width, *by).sortWithinPartitions(*by)
                   .select(*by, F.monotonically_increasing_id().alias("rank")), "ranks")


def _stretches(sequences: DataFrame, min_words: int) -> DataFrame:
    """For each line the shortest stretch of ``min_words`` words that begins, or ends, with it."""

    def find(frames: Iterator) -> Iterator:
        for a, b, seqs, words in batches(frames, ["row_a", "row_b", "seqs", "words"]):
            out: list[list] = [[], [], [], []]
            for key_a, key_b, seq, count in zip(a, b, seqs, words):
                seq = np.array(seq)
                total = np.concatenate([[0], np.cumsum(count)])
                # A stretch may not reach over a line that occurs once.
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(seq) != 1) + 1, [len(seq)]])
                island = np.searchsorted(cuts, np.arange(len(seq)), side="right")
                ends = np.searchsorted(total, total[:-1] + min_words, side="left")
                forward = np.flatnonzero(ends <= cuts[island])
                begins = np.searchsorted(total, total[1:] - min_words, side="right") - 1
                backward = np.flatnonzero(begins >= cuts[island - 1])
                found = {(int(i), int(ends[i])) for i in forward} | {(int(begins[i]), int(i) + 1) for i in backward}
                for begin, end in sorted(found):
                    for values, value in zip(out, (key_a, key_b, int(seq[begin]), end - begin)):
                        values.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out], ["row_a", "row_b", "seq", "length"])

    return sequences.select(*_KEY, "seqs", "words").mapInArrow(find, "row_a long, row_b long, seq long, length long")


def suffix_ranks(active: DataFrame, depth: int) -> list[DataFrame]:
    """Ranks (row, seq, rank) by the first 1, 2, 4, ... lines, up to ``depth`` lines; ranks held by one
    suffix are left out. ``active``: row, seq, h1, h2."""
    levels = [durable(active.join(_ranked(active, ["h1", "h2"]), ["h1", "h2"]).select("doc_id", *_KEY, "seq", "rank"), "level")]
    half = 1
    while 2 * half <= depth:
        ahead = Window.partitionBy(*_KEY).orderBy("seq").rangeBetween(half, half)
        pairs = levels[-1].select("doc_id", *_KEY, "seq", F.col("rank").alias("head"), F.first("rank").over(ahead).alias("tail"))
        pairs = durable(pairs.where("tail IS NOT NULL"), "pairs")
        levels.append(durable(
            pairs.join(_ranked(pairs, ["head", "tail"]), ["head", "tail"]).select("doc_id", *_KEY, "seq", "rank"), "level"))
        half *= 2
    return levels


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Stretches of lines (row, seq, length) that a document earlier in order, or the same document
    earlier on, has as well. The order is doc_id (null first), then row, then line."""
    lines = _lines(docs)
    repeated = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("h1", "h2")
    active = durable(lines.join(repeated, ["h1", "h2"], "left_semi"), "lines")
    # Repeated rows are one document: their lines stand at the same place and are listed once.
    sequences = active.groupBy(*_KEY).agg(F.sort_array(F.collect_set(F.struct("seq", "words"))).alias("s")).select(
        *_KEY, F.col("s.seq").alias("seqs"), F.col("s.words").alias("words"))
    stretches = durable(_stretches(sequences, min_words), "stretches")
    depth = stretches.agg(F.max("length")).first()[0] or 1
    found = []
    for level, ranks in enumerate(suffix_ranks(active, depth)):
        span = 1 << level
        ranks = ranks.distinct()
        own = stretches.where((F.col("length") >= span) & (F.col("length") < 2 * span))
        covered = own.join(ranks.withColumnRenamed("rank", "head"), [*_KEY, "seq"]).withColumn("over", F.col("seq") + F.col("length") - span)
        tails = ranks.select(*_KEY, F.col("seq").alias("over"), F.col("rank").alias("tail"))
        found.append(covered.join(tails, [*_KEY, "over"]).select(
            "length", "head", "tail", F.struct("doc_id", *_KEY, "seq").alias("at")))
    members = durable(reduce(DataFrame.unionByName, found), "members")
    interval = ["length", "head", "tail"]
    first = members.groupBy(*interval).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return members.join(first, interval).where("first < at").select("at.row_a", "at.row_b", "at.seq", "length")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (doc_id, text, any other columns) without later copies of repeated runs of lines of at
    least ``min_words`` words, and with the number of ``removed_lines``.

    Lines are separated by ``\\n`` and compared as they stand. Lines without a word are neither
    compared nor removed. Rows with equal doc_id and text count as one document and get equal results.
    Null texts stay null; an empty table stays empty; a column named removed_lines is replaced.
    """
    if min_words < 1:
        raise ValueError("min_words must be >= 1")
    docs = docs.drop("removed_lines")
    *row, own = (spare_name(n, docs.columns) for n in ("_row_a", "_row_b", "_cuts"))
    # A document's own stretches: bounded by its lines.
    cuts = durable(later_copies(docs.select("doc_id", "text"), min_words).groupBy(*_KEY).agg(
        F.collect_set(F.struct("seq", "length")).alias(own)).toDF(*row, own), "cuts")
    # Both joins read one shuffle of the texts; the hashed side never holds texts.
    keyed = docs.select("*", *(c.alias(n) for c, n in zip(row_key(), row)))
    tell = keyed.join(cuts.hint("shuffle_hash"), row).drop(*row)
    schema = tell.drop(own).withColumn("removed_lines", F.lit(0)).schema

    def rewrite(frames: Iterator) -> Iterator:
        for batch in frames:
            texts, removed = [], []
            for text, cuts in zip(batch.column("text").to_pylist(), batch.column(own).to_pylist()):
                gone = {i for c in cuts for i in range(c["seq"], c["seq"] + c["length"])}
                kept, seq = [], -1
                for line in text.split("\n"):
                    worded = bool(line.encode("utf-8", "surrogatepass").split())
                    seq += worded
                    if not (worded and seq in gone):
                        kept.append(line)
                texts.append("\n".join(kept))
                removed.append(len(gone))
            columns = [pa.array(texts, batch.schema.field("text").type) if n == "text" else batch.column(n)
                       for n in batch.schema.names if n != own]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(removed, pa.int32())], schema.names)

    untouched = keyed.join(cuts.select(*row).hint("shuffle_hash"), row, "left_anti").drop(*row).withColumn("removed_lines", F.lit(0))
    return untouched.unionByName(tell.mapInArrow(rewrite, schema))


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "text", F.col("removed_lines").cast("long"))
