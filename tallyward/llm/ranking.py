"""Places of rows within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.plans.durable import durable


def numbered(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``df`` with ``idx``, a row's place from 0 in its group by ``order``, and ``n``, the group's rows.

    The columns of ``group`` hold no null; in ``order`` nulls come first. ``df`` has no column idx, n or one that
    begins with an underscore. Rows are range-sorted, so a group with a third of the rows spans many tasks; one count
    per group and task is then added up.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = durable(
        df.repartitionByRange(width, *group, *order).sortWithinPartitions(*group, *order)
        .select("*", F.monotonically_increasing_id().alias("_at")), "ordered").withColumn("_piece", F.shiftright("_at", 33))
    runs = ordered.groupBy(*group, "_piece").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*group, "_piece", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
                       F.sum("_rows").over(whole).alias("n"))
    return ordered.join(runs, [*group, "_piece"]).select(
        *df.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias("idx"), "n")
