"""Exact top-k search by BM25: an inverted index per shard, pruned by what blocks of like documents can score.

Every run of documents of a task is a shard with an index of its own, in which like documents are neighbours, short before long. Cut into parts, a shard
knows the largest impact of each word in a part. By levels of words, the sum of a query's largest impacts, and no more than the largest sum
of a block's documents, bounds what the block can score; long texts ask for much, and short documents do not have it. Only blocks whose bound
reaches the k-th best score are looked at, many queries at once: words that many of the queries and documents share in a matrix product, others by
their postings. Documents that may be among the best are then scored exactly. Parts with long documents come first, and a few shards before all others:
their k-th best score, and that of the parts that a task read before, bound what is looked for. Document counts and lengths are those of the whole table,
so scores of all shards compare and the best of all shards are the best of the table. Queries are sent to the shards in blocks of bounded size.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyward.llm.common import table, word_hashes
from tallyward.plans.durable import durable

K1, B = 1.2, 0.75
TOP = 10
BLOCK = 64
SHARD_DOCUMENTS = 4_000
QUERIES_AT_ONCE = 16_000
# Query blocks whose broadcasts live at the same time.
BLOCKS_AT_ONCE = 4
# One of so many shards is searched first, then some more of these, up to so many.
SHARDS_PER_FIRST, TURNS = 16, (1, 4)
# Words in at least one of so many documents of a shard tell kinds of documents apart; at most so many words do, and have a row in a matrix.
FREQUENT, MOST_FREQUENT = 16, 1024
# Kinds of documents in a shard, rounds in which they are found, documents of a part.
KINDS, ROUNDS, PART = 8, 6, 512
# Words that meet in at least one of so many pairs of a query and a document have a row in a matrix.
DENSE = 700
# Words are told apart by level: in more than one of so many documents of the table, or in fewer.
LEVELS = np.log([3.0, 6.0, 12.0])
# Queries that a shard reads at once, and postings that are read at once for some of these.
AT_ONCE, POSTINGS_AT_ONCE = 256, 1 << 15
# Sums of at most MOST_FREQUENT positive 32-bit numbers, and of any number with 36 bits, are off by less than this share of them.
SLACK = 1e-4
# Texts that an index is given at once.
TEXTS_AT_ONCE = 500
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def build_index(docs: DataFrame) -> DataFrame:
    """One row per shard: document names and lengths, terms, where their postings begin, documents and counts, where runs of like documents end."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def index(frames: Iterator) -> Iterator:
        found, held = [], []
        for batch in frames:
            found += word_hashes(batch.column("text").to_pylist())
            held += batch.column("doc_id").to_pylist()
            name = batch.schema.field("doc_id").type
            while 2 * len(found) >= 3 * SHARD_DOCUMENTS:
                yield shard(found[:SHARD_DOCUMENTS], held[:SHARD_DOCUMENTS], name)
                del found[:SHARD_DOCUMENTS], held[:SHARD_DOCUMENTS]
        if found:
            yield shard(found, held, name)

    def shard(found: list, held: list, name: pa.DataType) -> pa.RecordBatch:
        sizes = np.array([len(f) for f in found])
        words, owner = np.concatenate(found), np.repeat(np.arange(len(found), dtype="<u2"), sizes)
        # Documents ascend already.
        order = np.argsort(words, kind="stable")
        words, owner = words[order], owner[order]
        del order
        first = np.flatnonzero(np.append(True, (words[1:] != words[:-1]) | (owner[1:] != owner[:-1]))) if len(words) else np.empty(0, np.int64)
        times = np.diff(np.append(first, len(words)))
        words, owner = words[first], owner[first]
        del first
        starts = np.flatnonzero(np.append(True, words[1:] != words[:-1])) if len(words) else np.empty(0, np.int64)
        order, ends = _alike(words, owner, times, sizes)
        place = np.empty(len(order), "<u2")
        place[order] = np.arange(len(order))
        cells = [words[starts].tobytes(), np.append(starts, len(words)).astype("<i8").tobytes(), place[owner].tobytes(), _small(times).tobytes(),
                 ends.astype("<i8").tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([[held[i] for i in order.tolist()]], pa.list_(name)),
                                           pa.array([sizes[order].tolist()], pa.list_(pa.int64())), *(pa.array([c], pa.binary()) for c in cells)], names)

    names = ["names", "sizes", "terms", "starts", "places", "times", "ends"]
    return docs.select("doc_id", "text").mapInArrow(
        index, f"names array<{kind}>, sizes array<long>, terms binary, starts binary, places binary, times binary, ends binary")


def _small(counts: np.ndarray) -> np.ndarray:
    """The same counts, unsigned, in as few bytes each as the largest needs."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))).newbyteorder("<"))


def _alike(words: np.ndarray, owner: np.ndarray, times: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The documents in an order in which like ones, short before long, are neighbours, and where each run of such ends.

    ``words`` ascend; ``owner`` has the document of each. Documents are told apart by their frequent words, by a few rounds of
    spherical k-means. Any order gives the same results.
    """
    n = len(sizes)
    starts = np.flatnonzero(np.append(True, words[1:] != words[:-1])) if len(words) else np.empty(0, np.int64)
    held = np.diff(np.append(starts, len(words)))
    often = np.argsort(-held, kind="stable")[:MOST_FREQUENT]
    often = often[held[often] * FREQUENT >= n]
    features = np.zeros((len(often), n), np.float32)
    for row, (lo, hi) in enumerate(zip(starts[often].tolist(), (starts + held)[often].tolist())):
        features[row, owner[lo:hi]] = np.sqrt(np.log((n + 1) / (hi - lo)) * times[lo:hi] / (times[lo:hi] + 1.0))
    features /= np.maximum(np.linalg.norm(features, axis=0), np.float32(1e-6))
    centres = features[:, np.arange(KINDS) * n // KINDS]
    for _ in range(ROUNDS):
        kind = np.argmax(centres.T @ features, axis=0) if len(often) else np.zeros(n, np.int64)
        member = np.zeros((n, KINDS), np.float32)
        member[np.arange(n), kind] = 1
        centres = features @ member
        centres /= np.maximum(np.linalg.norm(centres, axis=0), np.float32(1e-6))
    order = np.lexsort((sizes, kind))
    ends, begin = [], 0
    for many in np.bincount(kind).tolist():
        parts = -(-many // PART)
        ends += [begin + many * (i + 1) // parts for i in range(parts)]
        begin += many
    return order, np.array(ends)


class Shard:
    """What the asked words add to a shard's documents: postings of rare words, a matrix of those that many queries and documents share, what bounds scores."""

    def __init__(self, sizes: list[int], terms: pa.Buffer, starts: pa.Buffer, places: pa.Buffer, times: pa.Buffer, ends: pa.Buffer, mean_size: float,
                 asked: np.ndarray, weights: np.ndarray, share: np.ndarray):
        """``asked`` ascends; ``weights`` are those of its words, ``share`` of the queries ask for each."""
        self.n = n = len(sizes)
        terms, starts, ends = np.frombuffer(terms, np.uint64), np.frombuffer(starts, "<i8"), np.frombuffer(ends, "<i8")
        at = np.minimum(np.searchsorted(asked, terms), max(0, len(asked) - 1))
        hit = np.flatnonzero(asked[at] == terms) if len(asked) else np.empty(0, np.int64)
        # One more word than the shard has: those that it does not have.
        self.number = np.full(len(asked), len(hit), np.int32)
        self.number[at[hit]] = np.arange(len(hit))
        held = np.diff(starts)
        chosen = np.zeros(len(terms), bool)
        chosen[hit] = True
        kept = np.flatnonzero(np.repeat(chosen, held))
        place = np.frombuffer(places, "<u2")[kept]
        # Impacts, step by step in one array; shards are large.
        worth = np.frombuffer(times, f"<u{len(times) // starts[-1]}" if starts[-1] else "<u1")[kept].astype(np.float64)
        del kept, chosen
        most = (K1 * (1 - B + B * np.array(sizes, np.float64) / mean_size))[place]
        most += worth
        worth *= K1 + 1
        worth /= most
        del most
        held, weights, share = held[hit], weights[at[hit]], share[at[hit]]
        word = np.repeat(np.arange(len(hit), dtype=np.int32), held)
        worth *= weights[word]
        stops = np.cumsum(held)
        begins = stops - held
        # Words that many queries and documents share are read as rows of a matrix.
        gain = held * share
        often = np.argsort(-gain, kind="stable")[:MOST_FREQUENT]
        often = often[gain[often] * DENSE >= n]
        # By level, each of which bounds scores by itself.
        often = often[np.argsort(weights[often], kind="stable")]
        self.row = np.full(len(hit) + 1, -1, np.int32)
        self.row[often] = np.arange(len(often))
        matrix = np.zeros((len(often), n), np.float32)
        for row, (lo, hi) in enumerate(zip(begins[often].tolist(), stops[often].tolist())):
            matrix[row, place[lo:hi]] = worth[lo:hi]
        self.rare, self.begins = np.append(held, 0).astype(np.int32), begins
        self.rare[often] = 0
        # Parts, and blocks in them: where they begin.
        parts = np.append(0, ends[:-1])
        self.blocks = np.concatenate([np.arange(lo, hi, BLOCK) for lo, hi in zip(parts.tolist(), ends.tolist())])
        first = np.append(np.searchsorted(self.blocks, parts), len(self.blocks))
        # A block's largest impacts, and the largest sum of those of a document, by level.
        ups = np.searchsorted(weights[often], LEVELS).tolist()
        self.levels = [(lo, hi) for lo, hi in itertools.pairwise([0, *ups, len(often)]) if lo < hi]
        self.most = np.maximum.reduceat(matrix, self.blocks, axis=1)
        self.sums = [np.maximum.reduceat(matrix[lo:hi].sum(axis=0), self.blocks) for lo, hi in self.levels]
        self.parts = []
        for lo, hi, x, y in zip(parts.tolist(), ends.tolist(), first[:-1].tolist(), first[1:].tolist()):
            rows = np.flatnonzero(self.most[:, x:y].any(axis=1))
            self.parts.append((lo, hi, x, y, rows, matrix[rows, lo:hi]))
        # Long documents have the highest scores; with these known, fewer of the others are looked at.
        mean = np.add.reduceat(np.array(sizes), parts) / (ends - parts)
        self.parts = [self.parts[i] for i in np.argsort(-mean, kind="stable")]
        del matrix
        # The same postings by document, words ascending.
        order = np.argsort(place, kind="stable")
        self.word, self.own_worth = word[order], worth[order]
        del order, word
        self.own = [0, *np.cumsum(np.bincount(place, minlength=n)).tolist()]
        self.marked = np.zeros(len(hit) + 1, bool)
        # A posting in 64 bits, read at once: its worth, with the place where its last 16 bits were.
        self.postings = worth.view(np.uint64)
        self.postings &= np.uint64(0xFFFFFFFFFFFF0000)
        self.postings |= place

    def better(self, asked: Asked, best: Best, least: np.ndarray) -> None:
        """Puts this shard's documents that may be among the best into ``best``. Scores below a query's ``least`` are not among the best of the table."""
        for lo in range(0, len(asked.sizes), AT_ONCE):
            hi = min(lo + AT_ONCE, len(asked.sizes))
            words = self.number[asked.words[asked.begins[lo]:asked.begins[hi]]]
            begins = asked.begins[lo:hi + 1] - asked.begins[lo]
            query = np.repeat(np.arange(hi - lo), np.diff(begins))
            row = self.row[words]
            hit = np.flatnonzero(row >= 0)
            often = np.zeros((hi - lo, len(self.most)), np.float32)
            often[query[hit], row[hit]] = 1
            score = self.scores(words, query, hi - lo)
            bound = np.maximum.reduceat(score, self.blocks, axis=1)
            for (x, y), most in zip(self.levels, self.sums):
                bound += np.minimum(often[:, x:y] @ self.most[x:y], most) * np.float32(1 + SLACK)
            floor = np.maximum(least[lo:hi], best.top[lo:hi, 0])
            which, document, about = self._found(often, score, bound, np.maximum(floor * (1 - SLACK), np.finfo(np.float32).tiny), best.k)
            stops = np.searchsorted(which, np.arange(hi - lo + 1)).tolist()
            for i, (x, y) in enumerate(itertools.pairwise(stops)):
                if x < y:
                    best.add(lo + i, self.exact(words[begins[i]:begins[i + 1]], document[x:y].tolist()), document[x:y], floor[i])

    def scores(self, words: np.ndarray, query: np.ndarray, queries: int) -> np.ndarray:
        """About what rare ``words``, each of a ``query``, give to each document: queries x documents."""
        found = np.empty((queries, self.n), np.float32)
        sizes = self.rare[words]
        hit = np.flatnonzero(sizes)
        sizes, query, begins = sizes[hit], query[hit], self.begins[words[hit]]
        stops = np.cumsum(sizes, dtype=np.int64)
        begins -= stops - sizes
        # Some queries at a time, so that what is read of them stays near.
        end = np.searchsorted(query, np.arange(queries + 1))
        read = np.append(0, stops)[end]
        first = 0
        while first < queries:
            last = int(np.searchsorted(read, read[first] + POSTINGS_AT_ONCE, side="right")) - 1
            last = min(max(first + 1, last), queries, first + max(1, POSTINGS_AT_ONCE // self.n))
            some = slice(end[first], end[last])
            at = np.repeat(begins[some], sizes[some])
            at += np.arange(read[first], read[last])
            worth = self.postings.take(at, mode="clip")
            np.bitwise_and(worth, np.uint64(0xFFFF), out=at.view(np.uint64))
            if last - first > 1:
                at += np.repeat((query[some] - first) * self.n, sizes[some])
            found[first:last] = np.bincount(at, weights=worth.view(np.float64), minlength=(last - first) * self.n).reshape(last - first, self.n)
            first = last
        return found

    def _found(self, often: np.ndarray, score: np.ndarray, bound: np.ndarray, cut: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Queries, ascending, their documents with scores of ``cut`` or more that may be among the k best of the shard, and about their scores.

        ``score`` is what rare words give, ``bound`` is what the scores in a block are below.
        """
        which, document, about = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32)
        for lo, hi, x, y, rows, matrix in self.parts:
            alive = bound[:, x:y] >= cut[:, None]
            some = np.flatnonzero(alive.any(axis=1))
            if not len(some):
                continue
            # Blocks before the first that counts are left out; queries that begin at about the same go together.
            first = np.argmax(alive[some], axis=1)
            order = np.argsort(first, kind="stable")
            half = np.searchsorted(first[order], (y - x + 1) // 2)
            for own in (order[:half], order[half:]):
                if not len(own):
                    continue
                own, begin = some[own], int(self.blocks[x + first[own[0]]])
                found = often[own].take(rows, axis=1) @ matrix[:, begin - lo:]
                found += score[own, begin:hi]
                least = cut[own]
                hit = found >= least[:, None]
                full = np.flatnonzero(hit.sum(axis=1) > k)
                if len(full):
                    hit[full] &= found[full] >= np.partition(found[full], -k, axis=1)[:, -k, None] * (1 - 2 * SLACK)
                q, d = np.nonzero(hit)
                if len(q):
                    which, document, about = np.append(which, own[q]), np.append(document, d + begin), np.append(about, found[q, d])
                    order = np.lexsort((-about, which))
                    which, document, about = which[order], document[order], about[order]
                    start = np.searchsorted(which, np.arange(len(cut)))
                    has = np.flatnonzero(np.searchsorted(which, np.arange(len(cut)), side="right") - start >= k)
                    cut[has] = np.maximum(cut[has], about[start[has] + k - 1] * (1 - 2 * SLACK))
                    good = about >= cut[which]
                    which, document, about = which[good], document[good], about[good]
        return which, document, about

    def exact(self, words: np.ndarray, documents: list[int]) -> np.ndarray:
        """Scores of ``documents``. Words are added in ascending order, so that equal texts have equal scores in all shards."""
        self.marked[words] = True
        scores = np.zeros(len(documents))
        for i, d in enumerate(documents):
            own = slice(self.own[d], self.own[d + 1])
            worth = self.own_worth[own][self.marked.take(self.word[own])]
            if len(worth):
                scores[i] = np.add.accumulate(worth)[-1]
        self.marked[words] = False
        return scores


class Asked:
    """Queries as numbers of asked words: how many each has, all ``words``, where each query begins, and the share of the queries that ask for a word."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray, weights: np.ndarray):
        self.sizes, self.words = sizes, words
        self.begins = np.append(0, np.cumsum(sizes))
        self.share = np.bincount(words, minlength=len(weights)) / max(1, len(sizes))


class Best:
    """The k best documents of each query so far, and all that are as good as the last of them until they are put in order."""

    def __init__(self, queries: int, k: int):
        self.k, self.top, self.names = k, np.zeros((queries, k)), []
        self.query, self.score, self.document = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        self.new: list[tuple] = []

    def add(self, query: int, scores: np.ndarray, documents: np.ndarray, least: float) -> None:
        """``documents`` of a shard with their ``scores``; those below ``least`` are left out."""
        good = (scores >= least) & (scores > 0)
        scores, documents = scores[good], documents[good]
        self.new.append((query, scores, documents))
        top = np.concatenate([self.top[query], scores])
        top.sort()
        self.top[query] = top[-self.k:]

    def settle(self, names: list) -> None:
        """Documents added since the last time are those of ``names``: the best are kept, equal ones by name, null first, and place."""
        if self.new:
            query, score, document = zip(*self.new)
            self.query = np.concatenate([self.query, np.repeat(query, [len(s) for s in score])])
            self.score = np.concatenate([self.score, *score])
            self.document = np.concatenate([self.document, np.concatenate(document) + len(self.names)])
            self.new = []
        self.names += names
        held, at = np.unique(self.document, return_inverse=True)
        rank = np.empty(len(held), np.int64)
        rank[sorted(range(len(held)), key=lambda i: ((name := self.names[held[i]]) is not None, name))] = np.arange(len(held))
        order = np.lexsort((rank[at], -self.score, self.query))
        query = self.query[order]
        begin = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else np.empty(0, np.int64)
        order = order[np.arange(len(query)) - np.repeat(begin, np.diff(np.append(begin, len(query)))) < self.k]
        self.query, self.score, self.document = self.query[order], self.score[order], self.document[order]


@contextmanager
def _short_batches(spark: SparkSession) -> Iterator[None]:
    """Texts go to Python some hundred at a time; shards are put together there, and batches of all their texts would need several times their memory."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(min(int(before), TEXTS_AT_ONCE) if int(before) > 0 else TEXTS_AT_ONCE))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def search(queries: DataFrame, docs: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` documents of ``docs`` (doc_id, text) for each row of ``queries`` (query_id, text): query_id, rank, doc_id, score.

    A query is the set of its text's words. Documents without any of them are not found; a null or empty text
    finds nothing and is not found. Ties go by doc_id, null first. Each row is a document or a query of its own.
    """
    with _short_batches(docs.sparkSession):
        index = durable(build_index(docs), "index")
    kind, query_kind = (t.simpleString() for t in (docs.schema["doc_id"].dataType, queries.schema["query_id"].dataType))

    def count(frames: Iterator) -> Iterator:
        for batch in frames:
            for shard in range(batch.num_rows):
                terms, starts = (np.frombuffer(batch.column(c)[shard].as_py(), t) for c, t in (("terms", np.int64), ("starts", "<i8")))
                yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(np.diff(starts))], ["term", "n"])

    frequency = durable(index.select("terms", "starts").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")), "frequency")
    documents, words = index.agg(F.coalesce(F.sum(F.size("sizes")), F.lit(0)),
                                 F.coalesce(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0))).first()
    mean_size = max(1.0, words / max(1, documents))

    def listed(frames: Iterator) -> Iterator:
        for batch in frames:
            found = [np.unique(w).view(np.int64).tolist() for w in word_hashes(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), pa.array(found, pa.list_(pa.int64()))], ["query_id", "terms"])

    with _short_batches(docs.sparkSession):
        asked = durable(queries.select("query_id", "text").mapInArrow(listed, f"query_id {query_kind}, terms array<long>").select(
            F.monotonically_increasing_id().alias("query"), "query_id", "terms", F.xxhash64("terms").alias("a"), F.xxhash64(F.lit(1), "terms").alias("b")), "queries")
    # Queries with the same words have the same result and are asked once.
    once = durable(asked.groupBy("a", "b").agg(F.min("query").alias("query")), "once")
    known = asked.select("query", "terms").join(once.select("query"), "query").select("query", F.explode("terms").alias("term")).join(frequency, "term")
    inverse = F.log(F.lit(1.0) + (F.lit(documents) - F.col("n") + 0.5) / (F.col("n") + 0.5))
    weighted = durable(known.groupBy("query").agg(F.sort_array(F.collect_list(F.struct(inverse.alias("weight"), "term"))).alias("t"))
                       .select("query", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights")), "weighted")
    blocks = max(1, -(-weighted.count() // QUERIES_AT_ONCE))
    found = []
    for first in range(0, blocks, BLOCKS_AT_ONCE):
        sent = [docs.sparkSession.sparkContext.broadcast(_flat(weighted.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).toArrow()))
                for block in range(first, min(first + BLOCKS_AT_ONCE, blocks))]

        def best_of(shards: DataFrame, least: list) -> DataFrame:
            return reduce(DataFrame.unionByName, [shards.mapInArrow(_best(x, y, mean_size, top), f"query long, doc_id {kind}, place long, score double")
                                                  for x, y in zip(sent, least)])

        # The k-th best score of a few shards bounds that of more of them, and theirs that of all.
        turn = F.pmod(F.xxhash64(F.size("names"), F.element_at("names", 1)), F.lit(SHARDS_PER_FIRST))
        turns = [0, *(x for x in TURNS if x < SHARDS_PER_FIRST), SHARDS_PER_FIRST]
        ended: list[DataFrame] = []
        for begin, end in itertools.pairwise(turns):
            least = None
            if ended:
                known = reduce(DataFrame.unionByName, ended).groupBy("query").agg(F.sort_array(F.collect_list("score"), False).alias("s")).where(
                    F.size("s") >= top).select("query", F.col("s")[top - 1].alias("least")).toArrow().to_pandas().sort_values("query")
                least = docs.sparkSession.sparkContext.broadcast((known["query"].to_numpy(), known["least"].to_numpy()))
            ended.append(durable(best_of(index.where((turn >= begin) & (turn < end)), [least] * len(sent)), "found"))
            if least is not None:
                least.unpersist()
        found += ended
        for x in sent:
            x.unpersist()
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"), "place")
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    asking = asked.select("query_id", "a", "b").join(once, ["a", "b"]).select("query", "query_id")
    return ranked.join(asking, "query").select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", "score")


def _flat(rows: pa.Table) -> tuple:
    """Queries, how many words each has, these as numbers, by weight, and of each number the word, ascending, and its weight."""
    terms, weights = (rows.column(c).combine_chunks() for c in ("terms", "weights"))
    flat = terms.flatten().to_numpy().view(np.uint64)
    asked, first, which = np.unique(flat, return_index=True, return_inverse=True)
    return rows.column("query").to_numpy(), np.diff(terms.offsets.to_numpy()), which.astype(np.int32), asked, weights.flatten().to_numpy()[first]


def _best(sent, floors, mean_size: float, top: int):
    def find(frames: Iterator) -> Iterator:
        names, sizes, which, terms, weights = sent.value
        asked, best = Asked(sizes, which, weights), Best(len(names), top)
        least = np.zeros(len(names))
        if floors is not None and len(floors.value[0]):
            known, low = floors.value
            at = np.minimum(np.searchsorted(known, names), len(known) - 1)
            least = np.where(known[at] == names, low[at], 0.0)
        kind = None
        for batch in frames:
            kind = batch.schema.field("names").type.value_type
            for i in range(batch.num_rows):
                cells = [batch.column("sizes")[i].as_py()] + [batch.column(c)[i].as_buffer() for c in ("terms", "starts", "places", "times", "ends")]
                Shard(*cells, mean_size, terms, weights, asked.share).better(asked, best, least)
                best.settle(batch.column("names")[i].as_py())
        if len(best.query):
            yield pa.RecordBatch.from_arrays([pa.array(names[best.query], pa.int64()), pa.array([best.names[d] for d in best.document.tolist()], kind),
                                              pa.array(best.document, pa.int64()), pa.array(best.score, pa.float64())], ["query", "doc_id", "place", "score"])

    return find


def op5_topk_search(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return search(docs.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "text"), docs)
