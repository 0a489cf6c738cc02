"""Score percentiles of any period and set of types, merged from stored sketches instead of computed from rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.keys import hour_of
from tallyward.schemas import HOUR

# Size of a sketch, and the error in rank that its percentiles stay within: 95 asked for may be 94 to 96. Merging keeps it.
SIZE, RANK_ERROR = 800, 0.01


def score_sketches(reconciled: DataFrame) -> DataFrame:
    """One sketch of the scores per hour and type: some ten kilobytes at most, whatever the number of rows. Null scores count as rows only."""
    return reconciled.groupBy(hour_of(F.col("event_ts")).alias(HOUR), "type").agg(
        F.count(F.lit(1)).alias("txn_count"), F.kll_sketch_agg_double("fraud_score", F.lit(SIZE)).alias("score_sketch"))


def merged_percentile(sketches: DataFrame, share: float, *by: Column | str) -> DataFrame:
    """The ``share`` percentile per ``by`` and its row count, from sketches of parts. Groups without any score have null."""
    merged = sketches.groupBy(*by).agg(
        F.sum("txn_count").alias("txn_count"), F.kll_merge_agg_double("score_sketch", F.lit(SIZE)).alias("_sketch"))
    return merged.withColumn("score_percentile", F.when(
        F.kll_sketch_get_n_double("_sketch") > 0, F.kll_sketch_get_quantile_double("_sketch", F.lit(share)))).drop("_sketch")
