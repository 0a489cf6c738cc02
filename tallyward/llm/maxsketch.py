"""Ranked lexical search with hashed max-sketches.

A forward index holds of each document its terms, by 64-bit hash, and how often each occurs.
The impacts of a document's terms fold into a sketch: coordinate ``hash mod WIDTH`` holds the largest impact of the terms that
fall there, rounded up. What a query finds at its terms' coordinates is an upper bound of the document's score.
Queries are looked up in batches, in some documents' sketches at a time; these documents are rescored exactly from the highest
bound down, until no bound reaches the query's threshold, its k-th best score so far. A sixteenth of the documents, by
a hash of their place, is searched first, so that the search of all others begins with its thresholds. What the tasks keep is merged by one ranking; document counts and lengths are
those of the whole table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import table, word_hashes
from tallyward.plans.durable import durable, scratch

TOP = 20
WIDTH = 4_096  # coordinates of a sketch, a power of two
CHUNK_DOCUMENTS, CHUNK_TERMS = 1_024, 250_000
LEADING = 16  # one document in so many is searched first
# Terms of all queries of a batch: some 16 bytes each on the driver and in every task.
BATCH_TERMS = 2_000_000
# The formula's constants.
SCALE, STEADY, FREE, BY_LENGTH = 1_000_000_000, 12, 100 - 25, 25
_UNIT = SCALE // 1000 // 255 + 1  # an impact is less than SCALE / 1000

# Bytes below 128 that are no digit or letter part terms; of the others A-Z are lower-cased later.
_PARTED = bytes(b if b >= 128 or chr(b).isalnum() else 0x20 for b in range(256))


def term_hashes(texts: list[str | None]) -> Iterator[np.ndarray]:
    """For each text the hashes of its terms, runs of letters, digits and all that is not ASCII, in order."""
    return word_hashes([None if t is None else t.encode("utf-8", "surrogatepass").translate(_PARTED).decode("utf-8", "surrogatepass") for t in texts])


def counted(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of all texts, text after text in ascending order; how often each occurs there; where each text begins."""
    sizes = np.array([len(f) for f in found], np.int64)
    terms, owner = np.concatenate([np.empty(0, np.uint64), *found]), np.repeat(np.arange(len(found)), sizes)
    order = np.lexsort((terms, owner))
    terms, owner = terms[order], owner[order]
    new = np.flatnonzero(np.append(True, (terms[1:] != terms[:-1]) | (owner[1:] != owner[:-1]))) if len(terms) else np.empty(0, np.int64)
    times = np.diff(np.append(new, len(terms)))
    return terms[new], times, np.searchsorted(owner[new], np.arange(len(found) + 1))


def build_index(docs: DataFrame) -> DataFrame:
    """(doc_id, size, terms, times) of each document with a term: how many terms it has, the distinct ones in ascending order and how
    often each is there. ``leading`` marks the documents that are searched first."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def index(frames: Iterator) -> Iterator:
        for batch in frames:
            names, texts = batch.column("doc_id"), batch.column("text")
            for begin in range(0, batch.num_rows, CHUNK_DOCUMENTS):
                found = list(term_hashes(texts.slice(begin, CHUNK_DOCUMENTS).to_pylist()))
                cells = [[c.tobytes() for c in (terms, times.astype(np.uint32))] for terms, times, _ in (counted([f]) for f in found)]
                sizes = [len(f) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [names.slice(begin, CHUNK_DOCUMENTS), pa.array(sizes, pa.int64()), *(pa.array([c[i] for c in cells], pa.binary()) for i in (0, 1))],
                    ["doc_id", "size", "terms", "times"]).filter(pa.array([n > 0 for n in sizes], pa.bool_()))

    found = docs.select("doc_id", "text").mapInArrow(index, f"doc_id {kind}, size long, terms binary, times binary")
    marked = found.withColumn("leading", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(LEADING)) == 0)
    path = scratch(docs.sparkSession, "index")
    # By folder, so that neither search reads the other's documents.
    marked.write.partitionBy("leading").parquet(path)
    return docs.sparkSession.read.schema(marked.schema).parquet(path)


def chunks_of(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """doc_ids, sizes, starts, terms and times of some documents at a time."""
    sizes = batch.column("size").to_numpy()
    many = np.cumsum([len(t.as_buffer()) // 8 for t in batch.column("terms")])
    begin = 0
    while begin < batch.num_rows:
        before = many[begin - 1] if begin else 0
        end = min(begin + CHUNK_DOCUMENTS, max(begin + 1, int(np.searchsorted(many, before + CHUNK_TERMS, side="right"))))
        cells = [b"".join(v.as_buffer() for v in batch.column(c).slice(begin, end - begin)) for c in ("terms", "times")]
        starts = np.append(0, many[begin:end] - before)
        yield batch.column("doc_id").slice(begin, end - begin), sizes[begin:end], starts, np.frombuffer(cells[0], np.uint64), np.frombuffer(cells[1], np.uint32)
        begin = end


class Chunk:
    """Some documents with their impacts and sketches."""

    def __init__(self, sizes: np.ndarray, starts: np.ndarray, terms: np.ndarray, times: np.ndarray, documents: int, words: int):
        self.starts, self.terms = starts, terms
        owner = np.repeat(np.arange(len(sizes)), np.diff(starts))
        slow = FREE + BY_LENGTH * sizes * documents // words
        times = times.astype(np.int64)
        self.impact = SCALE * times // (1000 * times + STEADY * slow[owner])
        level = -(-self.impact // _UNIT)
        self.sketch = np.zeros((WIDTH, len(sizes)), np.uint8)
        np.maximum.at(self.sketch.reshape(-1), (terms % np.uint64(WIDTH)).astype(np.int64) * len(sizes) + owner, level.astype(np.uint8))

    def bounds(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """At least the score of each document; whole numbers, exact in doubles."""
        return weights.astype(np.float64) @ self.sketch[(terms % np.uint64(WIDTH)).astype(np.int64)] * _UNIT

    def scores(self, some: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of ``some`` documents: each term is looked for in each document's ascending terms, all at once."""
        low = np.repeat(self.starts[some][:, None], len(terms), axis=1)
        high = np.repeat(self.starts[some + 1][:, None], len(terms), axis=1)
        end = high.copy()
        while (open_ := low < high).any():
            middle = (low + high) // 2
            less = open_ & (self.terms[np.minimum(middle, len(self.terms) - 1)] < terms)
            low, high = np.where(less, middle + 1, low), np.where(open_ & ~less, middle, high)
        at = np.minimum(low, len(self.terms) - 1)
        hit = (low < end) & (self.terms[at] == terms)
        return (np.where(hit, self.impact[at], 0) * weights).sum(axis=1)

    def best(self, terms: np.ndarray, weights: np.ndarray, floor: int, k: int) -> list[tuple[int, int]]:
        """(score, document) of all that can be among the ``k`` best and score ``floor`` at least, and above 0."""
        bound = self.bounds(terms, weights)
        able = np.flatnonzero(bound >= max(1, floor))
        able = able[np.argsort(-bound[able], kind="stable")]
        found, places, step = np.empty(0, np.int64), np.empty(0, np.int64), 2 * k
        while len(able) and bound[able[0]] >= max(1, floor):
            some, able = able[:step], able[step:]
            found, places = np.append(found, self.scores(some, terms, weights)), np.append(places, some)
            if len(found) >= k:
                floor = max(floor, int(np.partition(found, len(found) - k)[len(found) - k]))
            step *= 2
        good = found >= max(1, floor)
        return list(zip(found[good].tolist(), places[good].tolist()))


def weighted_queries(queries: DataFrame, index: DataFrame, documents: int) -> DataFrame:
    """(query, item_id, terms, weights): each query's terms that documents hold, its repeats in their weights."""
    kind = queries.schema["item_id"].dataType.simpleString()

    def listed(frames: Iterator) -> Iterator:
        for batch in frames:
            terms, times, starts = counted(list(term_hashes(batch.column("text").to_pylist())))
            lists = [pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(c.astype(np.int64))) for c in (terms.view(np.int64), times)]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), *lists], ["item_id", "terms", "times"])

    def held(frames: Iterator) -> Iterator:
        for batch in frames:
            for _, _, _, terms, _ in chunks_of(batch):
                terms, n = np.unique(terms, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(n.astype(np.int64))], ["term", "df"])

    asked = durable(queries.select("item_id", "text").mapInArrow(listed, f"item_id {kind}, terms array<long>, times array<long>")
                    .select(F.monotonically_increasing_id().alias("query"), "*"), "asked")
    each = asked.select("query", F.explode(F.arrays_zip("terms", "times")).alias("t")).select("query", F.col("t.terms").alias("term"), F.col("t.times").alias("times"))
    frequency = (index.select("doc_id", "size", "terms", "times").mapInArrow(held, "term long, df long").join(each.select("term").distinct(), "term", "left_semi")
                 .groupBy("term").agg(F.sum("df").alias("df")))
    weight = F.floor(1000 * F.log(F.lit(float(2 * documents + 2)) / (2 * F.col("df") + 1)))
    found = each.join(frequency, "term").groupBy("query").agg(F.sort_array(F.collect_list(F.struct("term", (F.col("times") * weight).alias("weight")))).alias("t"))
    return durable(found.join(asked.select("query", "item_id"), "query").select(
        "query", "item_id", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights")), "weighted")


def _searched(index: DataFrame, batch: DataFrame, documents: int, words: int, top: int) -> DataFrame:
    """(query, doc_id, score): per task what can be among the ``top`` of each query of ``batch`` (query, terms, weights, floor)."""
    kind = index.schema["doc_id"].dataType.simpleString()
    rows = batch.select("query", "terms", "weights", "floor").toArrow()
    sent = index.sparkSession.sparkContext.broadcast(
        [(q, np.array(t, np.int64).view(np.uint64), np.array(w, np.int64), f) for q, t, w, f in zip(*(c.to_pylist() for c in rows.columns))])

    def find(frames: Iterator) -> Iterator:
        best: dict[int, list[tuple]] = {}
        floors = {q: f for q, _, _, f in sent.value}
        element = None
        for batch in frames:
            element = batch.schema.field("doc_id").type
            for names, *cells in chunks_of(batch):
                chunk = Chunk(*cells, documents, words)
                for q, terms, weights, _ in sent.value:
                    found = chunk.best(terms, weights, floors[q], top)
                    if found:
                        named = [(-s, n is None, n, s) for s, n in zip([s for s, _ in found], names.take(pa.array([d for _, d in found])).to_pylist())]
                        best[q] = sorted(best.get(q, []) + named, key=lambda x: x[:2] if x[1] else x[:3])[:top]
                        if len(best[q]) == top:
                            floors[q] = max(floors[q], best[q][-1][3])
        if element is not None:
            flat = [(q, n, s) for q, some in best.items() for _, _, n, s in some]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in flat], t) for i, t in enumerate((pa.int64(), element, pa.int64()))], ["query", "doc_id", "score"])

    found = index.select("doc_id", "size", "terms", "times").mapInArrow(find, f"query long, doc_id {kind}, score long")
    found = durable(found, "found")
    sent.unpersist()
    return found


def ranked_search(queries: DataFrame, docs: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` documents of ``docs`` (doc_id, text) for each row of ``queries`` (item_id, text): item_id, rank, doc_id, score.

    Only scores above 0 count; equal scores go by doc_id, null last. A null text has no term, finds nothing and is not
    found; so is one without any. Each row is a query or a document of its own, also one that repeats another. Without
    queries or documents the result is empty. Terms are told apart by 64-bit hashes.
    """
    index = build_index(docs)
    documents, words = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    weighted = weighted_queries(queries, index, documents)
    terms = weighted.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    batches = max(1, -(-terms // BATCH_TERMS))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = []
    for i in range(batches):
        batch = weighted.where(F.pmod(F.xxhash64("query"), F.lit(batches)) == i)
        first = _searched(index.where("leading"), batch.withColumn("floor", F.lit(0).cast("long")), documents, words, top)
        last = first.withColumn("place", F.row_number().over(order)).where(F.col("place") == top).select("query", F.col("score").alias("floor"))
        rest = batch.join(last, "query", "left").withColumn("floor", F.coalesce("floor", F.lit(0)).cast("long"))
        found += [first, _searched(index.where("NOT leading"), rest, documents, words, top)]
    merged = found[0]
    for some in found[1:]:
        merged = merged.unionByName(some)
    ranked = merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(weighted.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")


def op12_sketch_search(spark, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))
