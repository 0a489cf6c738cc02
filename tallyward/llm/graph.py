"""Connected components of a link table that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.plans.durable import durable


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node in ``links`` (a, b: long); ``root`` is the smallest node reachable.

    Each round every node takes the smallest root among its neighbours and then its root's root, so
    paths halve. Rounds go on until no root changes; each is written down before the next.
    """
    both = durable(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    roots = durable(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), "roots")
    total = None
    while True:
        near = both.join(roots, both.b == roots.node).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lower = roots.join(near, "node").select("node", F.least("root", "near").alias("root"))
        above = lower.select(F.col("node").alias("root"), F.col("root").alias("above"))
        roots = durable(lower.join(above, "root").select("node", F.least("root", "above").alias("root")), "roots")
        new = roots.agg(F.sum(F.col("root").cast("decimal(38,0)"))).first()[0]
        if new == total:
            return roots
        total = new


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``components`` of the links that made ``roots`` and of ``links`` (a, b) together; only the roots that
    the new links name are gone through again."""
    side = links
    for end in ("a", "b"):
        named = roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
        side = side.join(named, end, "left").withColumn(f"root_{end}", F.coalesce(f"root_{end}", end))
    between = side.where("root_a != root_b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct()
    above = components(between).toDF("root", "above")
    # A node without earlier links is its own root, and has no row in ``roots``.
    fresh = above.join(roots.select(F.col("node").alias("root")), "root", "left_anti").toDF("node", "root")
    return roots.join(above, "root", "left").select("node", F.coalesce("above", "root").alias("root")).unionByName(fresh)
