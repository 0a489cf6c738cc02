"""Merkle manifest of a dataset by lag and lead windows.

Rows are leaves, numbered within their source. On every level a node stands at its first leaf's place, so the nodes
beside it are a fixed number of rows away: ``lag`` and ``lead`` columns, masked by the node's slot in its run and by the
run's length, supply the siblings, and the rows of first children hash the parents. Windows hold 3**6 leaves: six
levels need one sort, and a source with a third of all rows is spread over as many windows as it has such chunks. The
chunks' tops are the leaves of the next six levels. Paths are then put together from the top down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import table
from tallyward.llm.ranking import numbered
from tallyward.plans.durable import durable

FAN = 3
LEVELS = 6  # climbed in one window
CHUNK = FAN ** LEVELS
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the texts one after the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(values: list[Column]) -> Column:
    """Each value as ``-`` where it is null, else its UTF-8 byte count, a colon and the value."""
    texts = [v.cast("string") for v in values]
    return digest(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def tampered(doc_id: Column) -> Column:
    """Every row whose id has an even crc32; a null id has none."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.lit(False))


def climb(nodes: DataFrame, group: list[str]) -> DataFrame:
    """``nodes`` (group columns, idx, n, hash, others) with ``chunk``, ``path``, the texts left and right of each ancestor on
    up to six levels, and ``top``, at a chunk's first row what the chunk ends in."""
    spot = Window.partitionBy(*group, "chunk").orderBy("idx")
    ancestors = spot.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    idx, n, empty = F.col("idx"), F.col("n"), F.lit("")
    rows = nodes.withColumns({"chunk": F.expr(f"idx div {CHUNK}"), "_h": F.col("hash")})
    for level in range(LEVELS):
        step = FAN ** level
        rows = rows.withColumns({
            "_lag1": F.lag("_h", step).over(spot), "_lag2": F.lag("_h", 2 * step).over(spot),
            "_lead1": F.lead("_h", step).over(spot), "_lead2": F.lead("_h", 2 * step).over(spot)})
        node = F.expr(f"idx div {step}")
        slot = node % FAN
        run = F.least(F.lit(FAN), F.expr(f"(n + {step - 1}) div {step}") - (node - slot))
        left = F.when(slot == 1, F.col("_lag1")).when(slot == 2, F.concat("_lag2", "_lag1")).otherwise(empty)
        right = (F.when((slot == 0) & (run == 3), F.concat("_lead1", "_lead2")).when((slot == 0) & (run == 2), F.col("_lead1"))
                 .when((slot == 1) & (run == 3), F.col("_lead1")).otherwise(empty))
        # With one node left the source has its root, and the levels above are none of its own.
        several = n > step
        rows = rows.withColumn(f"_side{level}", F.when(several & (idx % step == 0), F.struct(left.alias("left"), right.alias("right"))))
        first = F.when(several, digest(F.col("_h"), F.col(f"_side{level}.right"))).otherwise(F.col("_h"))
        rows = rows.withColumn("_h", F.when(idx % (FAN * step) == 0, first))
    sides = [F.last(f"_side{level}", ignorenulls=True).over(ancestors) for level in range(LEVELS)]
    return rows.select(*nodes.columns, "chunk", F.array_compact(F.array(*sides)).alias("path"), F.col("_h").alias("top"))


def tops(rows: DataFrame, group: list[str]) -> DataFrame:
    """The nodes that the chunks of ``rows`` end in."""
    return rows.where(F.col("idx") % CHUNK == 0).select(
        *group, F.col("chunk").alias("idx"), F.expr(f"(n + {CHUNK - 1}) div {CHUNK}").alias("n"), F.col("top").alias("hash"))


def climbed(leaves: DataFrame, group: list[str]) -> list[DataFrame]:
    """Rows of six levels at a time, until every group has one top."""
    stages, nodes = [], leaves
    while True:
        rows = durable(climb(nodes, group), "levels")
        stages.append(rows)
        most = rows.agg(F.max("n")).first()[0]
        if most is None or most <= CHUNK:
            return stages
        nodes = tops(rows, group)


def descended(stages: list[DataFrame], group: list[str], above: DataFrame, carried: list[str]) -> DataFrame:
    """The leaves of ``stages`` with their whole paths and the ``carried`` columns of ``above`` (group columns, idx, path), the rows
    of their groups. A parent has at most 3**6 children, so no key of these joins is hot."""
    for rows in reversed(stages):
        up = above.select(*group, F.col("idx").alias("chunk"), F.col("path").alias("_above"), *carried)
        above = rows.join(up, [*group, "chunk"]).withColumn("path", F.concat("path", "_above")).drop("_above")
    return above


def manifest(docs: DataFrame, fields: list[str] = FIELDS, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root and verified of every row of ``docs``.

    A leaf is the digest of ``fields``. Leaves of a source ascend by ``key``, null first; rows with equal keys by leaf.
    Null is a source of its own, the first. Each three nodes that follow one another become one until a source has one,
    its subroot; subroots, by source, become the root in the same way. ``proof_sha256`` is the digest of all siblings on
    the way up, ``folded_root`` what that way gives from the leaf as it is found when rows are checked: rows
    that ``tampered`` chooses have lost the line feeds of ``text``. An empty table has no leaves and an empty result.
    """
    values = [F.col(c) for c in fields]
    forged = [F.replace(F.col(c), F.lit("\n"), F.lit("")) if c == text else F.col(c) for c in fields]
    name = F.col(source)
    # Texts end here; all that follows moves digests.
    leaves = durable(docs.select(
        F.col(key).alias("key"), name.isNotNull().alias("known"), F.coalesce(name.cast("string"), F.lit("")).alias("name"),
        leaf_digest(values).alias("hash"), F.when(tampered(F.col(key)), leaf_digest(forged)).alias("forged")), "leaves")
    by_source, whole = ["known", "name"], ["all"]
    stages = climbed(numbered(leaves, by_source, ["key", "hash"]), by_source)
    subroots = tops(stages[-1], by_source).select(*by_source, "hash", F.lit(0).alias("all"))
    above = climbed(numbered(subroots, whole, by_source), whole)
    end = tops(above[-1], whole).select(
        "all", "idx", F.col("hash").alias("root"), F.lit(None).cast(above[-1].schema["path"].dataType).alias("path"))
    end = end.withColumn("path", F.coalesce("path", F.array().cast(above[-1].schema["path"].dataType)))
    sources = durable(descended(above, whole, end, ["root"]).select(
        *by_source, F.lit(0).cast("long").alias("idx"), F.col("hash").alias("subroot"), "root", "path"), "subroots")
    rows = descended(stages, by_source, sources, ["subroot", "root"])
    siblings = F.array_join(F.transform("path", lambda x: F.concat(x["left"], x["right"])), "")
    folded = F.aggregate("path", F.coalesce("forged", "hash"), lambda node, x: digest(x["left"], node, x["right"]))
    found = rows.select(F.col("key").alias(key), F.col("hash").alias("leaf"), "subroot", "root",
                        F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))
