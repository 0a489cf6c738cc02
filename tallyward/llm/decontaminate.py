"""Benchmark passages in documents, also reworded ones, by latent semantic retrieval.

Passages of all documents are TF-IDF vectors over hashed words. One pass multiplies the matrix of all
passages with a sparse random sign matrix; the singular vectors of this small product are the leading
directions, in which passages and benchmark items are compared by cosine. The cosine with any item is at most
the share of a passage's norm that lies on words of the benchmark, so passages with a small share are not
looked at further. Besides, every place with as many words in a row of an item as a copy must have is a candidate, whatever
its cosine. A candidate is then read word by word: the longest common subsequence with the item
decides, and for a reworded item also its answer, the last sentence, has to be there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import mixed, spare_name, table, word_hashes
from tallyward.plans.durable import durable

# Hashed words, rows of the random product, singular directions, words of half a passage.
BUCKETS = 1 << 12
SKETCH_ROWS = 128
RANK = 96
HALF = 16
COSINE = 0.42
# Least share of a passage's squared norm on words of the benchmark: with less its cosine with every item is below the floor.
COVERED = COSINE ** 2
# A word with this share of all words has half the weight of a rare one.
COMMON = 1e-3
# Share of an item's words, in order, that makes a copy; less, but with the answer, makes a reworded one.
COPY = 0.8
REWORDED = 0.6
# Items that are searched for at once; they and their vectors are sent to every task.
ITEMS_AT_ONCE = 20_000
_SHIFT = np.uint32(32 - BUCKETS.bit_length() + 1)
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def _bucket(ids: np.ndarray) -> np.ndarray:
    return (ids >> _SHIFT).astype(np.int64)


def _read(batch, column: str = "ids") -> list[np.ndarray]:
    return [np.frombuffer(b, "<u4") for b in batch.column(column).to_pylist()]


def word_ids(docs: DataFrame) -> DataFrame:
    """doc_id, loc (hash of doc_id and text) and the words as 32-bit hashes; rows without words are left out."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def hashed(frames: Iterator) -> Iterator:
        for batch in frames:
            ids = [(h >> np.uint64(32)).astype("<u4").tobytes() for h in word_hashes(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("loc"), pa.array(ids, pa.binary())], ["doc_id", "loc", "ids"])

    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("loc")).mapInArrow(
        hashed, f"doc_id {kind}, loc long, ids binary").where(F.length("ids") > 0)


def inverse_frequencies(ids: DataFrame) -> np.ndarray:
    """Smooth inverse frequency of each bucket, COMMON / (COMMON + share), from the words of all documents."""

    def count(frames: Iterator) -> Iterator:
        total = np.zeros(BUCKETS, np.int64)
        for batch in frames:
            for words in _read(batch):
                total += np.bincount(_bucket(words), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    # One row per bucket.
    counted = ids.select("ids").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    total = np.zeros(BUCKETS)
    total[counted.bucket.to_numpy()] = counted.n.to_numpy()
    return COMMON / (COMMON + total / max(1.0, total.sum()))


def _chunks(documents: list[np.ndarray], words: int = 50_000) -> Iterator[list[np.ndarray]]:
    held, n = [], 0
    for d in documents:
        held.append(d)
        n += len(d)
        if n >= words:
            yield held
            held, n = [], 0
    if held:
        yield held


def _halves(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of all documents, where their half passages begin, and each half's document. Passages never
    reach over the end of a document: its last half may be short."""
    sizes = np.array([len(d) for d in documents])
    parts = -(-sizes // HALF)
    owner = np.repeat(np.arange(len(sizes)), parts)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    return np.concatenate(documents), np.repeat(np.cumsum(sizes) - sizes, parts) + nth * HALF, owner


def latent_space(ids: DataFrame, idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Directions (bucket by rank): leading right singular vectors of the matrix of all passages, each divided
    by its singular value. Every passage is added, with a random sign, to a random row of the product."""

    def sketch(frames: Iterator) -> Iterator:
        total = np.zeros(SKETCH_ROWS * BUCKETS)
        for batch in frames:
            locs = batch.column("loc").to_numpy().view(np.uint64)
            for at, documents in enumerate(_read(batch)):
                words, begins, _ = _halves([documents])
                bucket = _bucket(words)
                weight = idf[bucket]
                norm = np.sqrt(np.add.reduceat(weight * weight, begins))
                draw = mixed(locs[at] + np.arange(1, len(begins) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                signed = np.where(draw >> np.uint64(63), 1.0, -1.0) / norm
                sizes = np.diff(np.append(begins, len(words)))
                row = np.repeat((draw % np.uint64(SKETCH_ROWS)).astype(np.int64) * BUCKETS, sizes)
                np.add.at(total, row + bucket, weight * np.repeat(signed, sizes))
        total = total.reshape(SKETCH_ROWS, BUCKETS)
        used = np.flatnonzero(np.abs(total).sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(r[used].astype(np.float32)) for r in total)], ["bucket", *columns])

    columns = [f"r{j}" for j in range(SKETCH_ROWS)]
    parts = ids.select("loc", "ids").mapInArrow(sketch, "bucket long, " + ", ".join(f"{c} float" for c in columns))
    # One row per bucket.
    added = parts.groupBy("bucket").agg(*(F.sum(F.col(c).cast("double")).alias(c) for c in columns)).toArrow().to_pandas()
    product = np.zeros((SKETCH_ROWS, BUCKETS))
    product[:, added.bucket.to_numpy()] = added[columns].to_numpy().T
    _, singular, directions = np.linalg.svd(product, full_matrices=False)
    least = max(singular[0] * 1e-6, 1e-12)
    return directions[:rank].T * np.where(singular[:rank] > least, 1 / np.maximum(singular[:rank], least), 0.0)


class _Item:
    """A benchmark item whose longest common subsequence with other words is counted bit by bit."""

    def __init__(self, name, words: np.ndarray, answer: np.ndarray):
        self.name, self.words, self.answer = name, words, answer
        self.masks = [self._mask(words), self._mask(answer)]
        self.least = REWORDED * len(words) - (len(words) - len(self.masks[0]))

    @staticmethod
    def _mask(words: np.ndarray) -> dict[int, int]:
        masks: dict[int, int] = {}
        for i, w in enumerate(words.tolist()):
            masks[w] = masks.get(w, 0) | 1 << i
        return masks

    def in_reach(self, other: list[int]) -> bool:
        """Whether enough words occur at all for the least common subsequence that counts."""
        return len(self.masks[0].keys() & set(other)) >= self.least

    def share(self, other: list[int], of_answer: bool = False) -> float:
        masks = self.masks[of_answer]
        length = len(self.answer if of_answer else self.words)
        full = (1 << length) - 1
        row = full
        for w in other:
            mask = masks.get(w)
            if mask is not None:
                hit = row & mask
                row = ((row + hit) | (row - hit)) & full
        return (length - row.bit_count()) / length


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of so many words."""
    last = len(words) - size + 1
    return sum(words[k:last + k].astype(np.uint64) * _FACTORS[k] for k in range(size)) if last > 0 else np.empty(0, np.uint64)


_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def copy_gram(n: int) -> int:
    """So many words in a row, three at most, are left in each copy of an item of ``n`` words of which words were dropped or replaced."""
    gone = int((1 - COPY) * n + 1e-9)
    return min(3, -(-(n - gone) // (gone + 1)))


def reworded_grams(n: int) -> tuple[int, int]:
    """Size and number of runs of words that are left in each rewording of an item of ``n`` words of which words were dropped or
    replaced: each word that goes takes two pairs with it."""
    gone = int((1 - REWORDED) * n + 1e-9)
    return (2, n - 1 - 2 * gone) if n - 1 - 2 * gone > 0 else (1, n - gone)


class _Runs:
    """Runs of words of one size of items, and how many of them a place needs to be looked at."""

    def __init__(self, size: int, needs: dict[int, int], items: list[_Item]):
        self.size = size
        own = [_grams(items[k].words, size) for k in needs]
        kinds, often = np.unique(np.concatenate(own), return_counts=True)
        kept, left = [], []
        for grams, need in zip(own, needs.values()):
            # Of those that must be there, half may be the ones that most items have: the others are looked for.
            rare = np.argsort(-often[np.searchsorted(kinds, grams)], kind="stable")[need // 2:]
            kept.append(np.unique(grams[rare]))
            left.append(need - need // 2)
        grams, of_item = np.concatenate(kept), np.repeat(list(needs), [len(k) for k in kept])
        order = np.argsort(grams, kind="stable")
        self.grams, self.of_item = grams[order], of_item[order]
        self.need = np.ones(len(items), np.int64)
        self.need[list(needs)] = left
        self.reach = np.array([2 * len(i.words) for i in items])
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[self.grams >> np.uint64(42)] = True

    def places(self, words: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places, with their items, at which enough runs begin to stand close together; ``document`` has that of each word."""
        grams = _grams(words, self.size)
        at = np.flatnonzero(self.maybe[grams >> np.uint64(42)])
        at = at[document[at] == document[at + self.size - 1]]
        low, high = (np.searchsorted(self.grams, grams[at], side=side) for side in ("left", "right"))
        n = high - low
        place = np.repeat(at, n)
        item = self.of_item[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        order = np.lexsort((place, item))
        place, item = place[order], item[order]
        other = np.arange(len(place)) + self.need[item] - 1
        fits = other < len(place)
        other = np.where(fits, other, 0)
        enough = fits & (item[other] == item) & (document[place[other]] == document[place]) & (place[other] - place <= self.reach[item])
        return place[enough], item[enough]


def _runs(items: list[_Item]) -> list[_Runs]:
    needs: dict[tuple[int, bool], dict[int, int]] = {}
    for k, item in enumerate(items):
        needs.setdefault((copy_gram(len(item.words)), True), {})[k] = 1
        size, need = reworded_grams(len(item.words))
        needs.setdefault((size, False), {})[k] = need
    return [_Runs(size, some, items) for (size, _), some in needs.items()]


def _item_words(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Words of an item and of its last sentence."""
    whole, last = word_hashes([text, _SENTENCE.split((text or "").strip())[-1]])
    return tuple((h >> np.uint64(32)).astype(np.uint32) for h in (whole, last))


def leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds: doc_id, loc, item_id, cosine, lcs (share of
    the item's words found in order), answer (share of its last sentence's words), copy (else reworded).

    Items and documents without a word are in no pair. Equal items, and rows that repeat a document, give
    a pair each. Without items or documents the result is empty.
    """
    ids = durable(word_ids(docs), "words")
    idf = inverse_frequencies(ids)
    space = latent_space(ids, idf)
    weights = (idf[:, None] * space).astype(np.float32)
    spark = docs.sparkSession
    weights_sent = spark.sparkContext.broadcast((idf ** 2, weights))  # BUCKETS by RANK numbers
    kind, item_kind = (f.dataType.simpleString() for f in (docs.schema["doc_id"], benchmark.schema["item_id"]))
    schema = f"doc_id {kind}, loc long, item_id {item_kind}, cosine double, lcs double, answer double, copy boolean"
    benchmark = benchmark.select("item_id", "text")
    blocks = max(1, -(-benchmark.count() // ITEMS_AT_ONCE))
    found = spark.createDataFrame([], schema)
    for block in range(blocks):
        some = benchmark.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == block).collect()
        items = [(r["item_id"], *_item_words(r["text"])) for r in some]
        items = [i for i in items if len(i[1])]
        if items:
            found = found.unionByName(ids.mapInArrow(_search(spark.sparkContext.broadcast(items), weights_sent, cosine, kind, item_kind), schema))
    return found


def _search(items_sent, weights_sent, cosine: float, kind: str, item_kind: str):
    def search(frames: Iterator) -> Iterator:
        squares, weights = weights_sent.value
        items = [_Item(*i) for i in items_sent.value]
        # An item is searched for by its own passages: all of it if it is short.
        targets, of_item = [], []
        for k, item in enumerate(items):
            step = HALF if len(item.words) > 3 * HALF else len(item.words)
            for begin in range(0, max(1, len(item.words) - HALF), step):
                targets.append(weights[_bucket(item.words[begin:begin + max(step, 2 * HALF)])].sum(axis=0))
                of_item.append(k)
        targets = np.array(targets)
        targets /= np.maximum(np.linalg.norm(targets, axis=1), 1e-9)[:, None]
        of_item = np.array(of_item)
        runs = _runs(items)
        ours = np.zeros(1 << 20, bool)
        ours[np.concatenate([i.words for i in items]) >> np.uint32(12)] = True
        for batch in frames:
            names, locs = batch.column("doc_id").to_pylist(), batch.column("loc").to_pylist()
            rows, base = [], 0
            for documents in _chunks(_read(batch)):
                words, begins, owner = _halves(documents)
                bucket = _bucket(words)
                square = squares[bucket]
                norm = np.add.reduceat(square, begins)
                held = np.add.reduceat(np.where(ours[words >> np.uint32(12)], square, 0.0), begins)
                # A passage is two halves that follow one another, or the only one.
                joined = np.append(owner[1:] == owner[:-1], False)
                follow = np.append(np.arange(1, len(begins)), 0)
                alive = held + joined * held[follow] >= COVERED * (norm + joined * norm[follow])
                wanted = alive.copy()
                wanted[1:] |= (alive & joined)[:-1]
                sizes = np.diff(np.append(begins, len(words)))
                vectors = np.zeros((len(begins), weights.shape[1]), np.float32)
                vectors[wanted] = np.add.reduceat(weights[bucket[np.repeat(wanted, sizes)]],
                                                  np.cumsum(sizes[wanted]) - sizes[wanted], axis=0)
                places = np.flatnonzero(alive)
                passages = vectors[places] + joined[places, None] * vectors[follow[places]]
                passages /= np.maximum(np.linalg.norm(passages, axis=1), 1e-9)[:, None]
                best: dict[tuple[int, int], tuple] = {}
                starts = np.cumsum([0] + [len(d) for d in documents])

                def read(d: int, k: int, first: int, near: float | None) -> None:
                    item, margin = items[k], len(items[k].words)
                    segment = documents[d][max(0, first - margin):first + 2 * HALF + margin].tolist()
                    if not item.in_reach(segment):
                        return
                    share = item.share(segment)
                    if share >= REWORDED:
                        answer = item.share(segment, of_answer=True)
                        if share >= COPY or answer >= REWORDED:
                            if near is None:
                                passage = weights[_bucket(documents[d][first:first + 2 * HALF])].sum(axis=0)
                                near = float((targets[of_item == k] @ passage).max() / max(np.linalg.norm(passage), 1e-9))
                            best[d, k] = max(best.get((d, k), ()), (share, answer, near))

                for lo in range(0, len(passages), 4096):
                    near = passages[lo:lo + 4096] @ targets.T
                    for p, t in zip(*np.nonzero(near >= cosine)):
                        d = int(owner[places[lo + p]])
                        read(d, int(of_item[t]), int(begins[places[lo + p]] - starts[d]), float(near[p, t]))
                document = np.repeat(np.arange(len(documents)), np.diff(starts))
                for some in runs:
                    last = (-1, -1, 0)
                    for place, k in zip(*(v.tolist() for v in some.places(words, document))):
                        d = int(document[place])
                        # Places that follow one another are read together.
                        if last[:2] != (d, k) or place - last[2] > HALF:
                            last = d, k, place
                            if best.get((d, k), (0,))[0] < COPY:
                                read(d, k, place - int(starts[d]), None)
                rows += [(names[base + d], locs[base + d], items[k].name, c, share, answer, share >= COPY)
                         for (d, k), (share, answer, c) in sorted(best.items())]
                base += len(documents)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                    [batch.schema.field("doc_id").type, pa.int64(), _ARROW.get(item_kind, pa.string()), pa.float64(), pa.float64(), pa.float64(), pa.bool_()])],
                ["doc_id", "loc", "item_id", "cosine", "lcs", "answer", "copy"])

    return search


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def decontaminate(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``docs`` (doc_id, text, any other columns) without the documents that hold a benchmark item."""
    found = durable(leaks(docs, benchmark, cosine).select("loc").distinct(), "leaks")
    loc = spare_name("_loc", docs.columns)
    return docs.withColumn(loc, F.xxhash64("doc_id", "text")).join(
        found.toDF(loc).hint("shuffle_hash"), loc, "left_anti").select(*docs.columns)


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("loc")
