"""Log-probability of texts under a small causal self-attention model of subword ids, and a word unigram base.

The model is factored: a subword id belongs to a class, attention over the classes before it gives the class,
and the id follows from its share within the class after the id before it. All of it is learned from the whole texts of all
training documents: classes from the neighbours that ids have, shares from a table of all pairs of neighbours, and the
attention weights in rounds, in which every task takes steps of its own on its windows and the weights are then averaged.
A text is read in windows that overlap: every id is scored once, in the first window that has it, with at least ``OVERLAP`` ids before it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import id_bucket, read_whole, row_key, table, tokenizer_path, word_hashes, WordIds
from tallyward.plans.durable import durable

CLASSES = 64
# The most frequent ids are read as themselves, others as their class.
OWN = 448
WIDTH = 16
WINDOW = 32
OVERLAP = 8
# Windows of a step. Training goes over all windows, and over few windows more than once: so often that these are read in all.
BATCH = 128
LEAST_WINDOWS = 115_200
# Training rows are dealt into this many parts; the rounds take these shares of all that is to be read, at these rates.
PARTS = 64
ROUNDS = [(1 / 32, 0.02), (1 / 32, 0.02), (1 / 16, 0.02), (1 / 8, 0.02), (1 / 4, 0.015), (1 / 4, 0.008), (1 / 4, 0.003)]
# Windows that are held and shuffled at once.
HELD = 8192
# Ids in whose neighbourhood others are counted for their classes.
COMMON = 192
VOCABULARY = 49_408
END = VOCABULARY - 1
# Words with at least this share of all training words are looked up in every task; there are at most 1 / share.
FREQUENT = 1e-6
# Pairs of ids with at least this share of all training ids, likewise.
FREQUENT_PAIR = 5e-7
_KEY = ["row_a", "row_b"]
# Windows that are scored at once; their arrays stay in a core's cache.
SCORED = 64
_PAST = np.tri(WINDOW, dtype=np.float32)


def held_out() -> Column:
    return id_bucket("doc_id", 7) == 2


@dataclass
class Attention:
    """One causal self-attention layer: from symbols, frequent ids or classes of others, to the class that follows."""

    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, symbols: int, classes: int = CLASSES, width: int = WIDTH, window: int = WINDOW) -> Attention:
        draw = np.random.default_rng(11)

        def some(*shape: int) -> np.ndarray:
            return (draw.standard_normal(shape) * 0.1).astype(np.float32)

        return cls({"query": some(symbols, width), "key": some(symbols, width), "value": some(symbols, width),
                    "at_query": some(window, width), "at_key": some(window, width), "own": some(symbols, width),
                    "out": some(width, classes), "next": np.zeros((symbols, classes), np.float32)})

    def forward(self, x: np.ndarray) -> tuple:
        w, size = self.weights, x.shape[1]
        q, k, v = w["query"][x] + w["at_query"][:size], w["key"][x] + w["at_key"][:size], w["value"][x]
        a = np.matmul(q, k.transpose(0, 2, 1))
        a *= np.float32(1 / math.sqrt(q.shape[2]))
        # What comes later has no weight; scores are small, so no maximum need be taken off.
        np.clip(a, -30, 30, out=a)
        np.exp(a, out=a)
        a *= _PAST[:size, :size]
        a /= a.sum(axis=2, keepdims=True)
        g = np.tanh(np.matmul(a, v) + w["own"][x])
        logits = g @ w["out"]
        logits += w["next"][x]
        return q, k, v, a, g, logits

    def log_share(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Natural log-probability of class ``y`` after each place of ``x``."""
        logits = self.forward(x)[-1]
        own = np.take_along_axis(logits, y[..., None], axis=2)[..., 0]
        np.exp(logits, out=logits)
        return own - np.log(logits.sum(axis=2))

    def gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        w, (q, k, v, a, g, logits) = self.weights, self.forward(x)
        # Step by step in the array of logits: what is allocated anew for each step costs as much as the arithmetic.
        logits -= logits.max(axis=2, keepdims=True)
        own = np.take_along_axis(logits, y[..., None], axis=2)
        d = np.exp(logits, out=logits)
        total = d.sum(axis=2, keepdims=True)
        loss = float((np.log(total) - own).mean())
        total *= y.size
        d /= total
        d.reshape(-1)[np.arange(y.size) * d.shape[2] + y.reshape(-1)] -= np.float32(1 / y.size)
        dh = d @ w["out"].T
        dh *= 1 - g * g
        da = np.matmul(dh, v.transpose(0, 2, 1))
        da -= np.einsum("bij,bij->bi", da, a)[..., None]
        da *= a
        da *= np.float32(1 / math.sqrt(q.shape[2]))
        ds = da
        dq, dk = np.matmul(ds, k), np.matmul(ds.transpose(0, 2, 1), q)
        rows = np.concatenate([r.reshape(x.size, -1) for r in (dq, dk, np.matmul(a.transpose(0, 2, 1), dh), dh, d)], axis=1)
        flat = x.reshape(-1)
        order = np.argsort(flat.astype(np.uint16), kind="stable")
        ordered, rows = flat[order], rows[order]
        begins = np.flatnonzero(np.diff(ordered, prepend=-1))
        table = np.zeros((len(w["next"]), rows.shape[1]), np.float32)
        for symbol, lo, hi in zip(ordered[begins].tolist(), begins.tolist(), [*begins[1:].tolist(), x.size]):
            rows[lo:hi].sum(axis=0, out=table[symbol])
        found = dict(zip(_TABLES, np.split(table, np.cumsum([w[n].shape[1] for n in _TABLES])[:-1], axis=1)))
        for name, each in (("at_query", dq), ("at_key", dk)):
            found[name] = np.zeros_like(w[name])
            found[name][:x.shape[1]] = each.sum(axis=0)
        return loss, found | {"out": np.tensordot(g, d, axes=([0, 1], [0, 1]))}

    def rows(self) -> np.ndarray:
        """All weights as one matrix: a row of each symbol, then those of the places, then those of the output."""
        w = self.weights
        tables = np.concatenate([w[n] for n in _TABLES], axis=1)
        found = np.zeros((len(tables) + len(w["at_query"]) + len(w["out"]), tables.shape[1]))
        found[:len(tables)] = tables
        places = np.concatenate([w["at_query"], w["at_key"]], axis=1)
        found[len(tables):-len(w["out"]), :places.shape[1]] = places
        found[-len(w["out"]):, :w["out"].shape[1]] = w["out"]
        return found

    def like(self, rows: np.ndarray) -> Attention:
        """A model of this one's shape with the weights that ``rows`` gave."""
        w, size = self.weights, len(self.weights["next"])
        tables = np.split(rows[:size], np.cumsum([w[n].shape[1] for n in _TABLES])[:-1], axis=1)
        found = dict(zip(_TABLES, tables))
        found["at_query"], found["at_key"] = rows[size:-len(w["out"]), :WIDTH], rows[size:-len(w["out"]), WIDTH:2 * WIDTH]
        found["out"] = rows[-len(w["out"]):, :w["out"].shape[1]]
        return Attention({n: np.ascontiguousarray(found[n], np.float32) for n in w})


# Weights with a row for each symbol, in the order of the columns of rows().
_TABLES = ["query", "key", "value", "own", "next"]


class Learner:
    """Adam on windows, from given weights and second moments on; what it gives back can be averaged."""

    def __init__(self, model: Attention, spread: Attention, rate: float):
        self.model, self.rate, self.draw = model, rate, np.random.default_rng(5)
        self.first = {n: np.zeros_like(v) for n, v in model.weights.items()}
        self.second = {n: v * v for n, v in spread.weights.items()}
        self.seen = np.zeros(len(model.weights["next"]), np.int64)
        self.fresh = not any(v.any() for v in spread.weights.values())
        self.steps = self.ids = 0
        self.lines: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def read(self, x: np.ndarray, y: np.ndarray) -> None:
        """Symbols, and the classes that follow them; what is left over waits for more."""
        self.lines.append((x, y))
        self.held += len(x)
        if self.held >= HELD * WINDOW:
            self._learn(HELD)

    def finish(self) -> None:
        if self.lines:
            self._learn(HELD)
            (x, y), = self.lines
            if len(x):
                self._step(x[None], y[None])

    def _learn(self, held: int) -> None:
        """All whole windows, about ``held`` of them shuffled at a time."""
        all_x, all_y = (np.concatenate([pair[side] for pair in self.lines]) for side in (0, 1))
        whole = len(all_x) // WINDOW
        for begin in range(0, whole, held):
            x, y = (v[begin * WINDOW:min(begin + held, whole) * WINDOW].reshape(-1, WINDOW) for v in (all_x, all_y))
            order = self.draw.permutation(len(x))
            for lo in range(0, len(x), BATCH):
                self._step(x[order[lo:lo + BATCH]], y[order[lo:lo + BATCH]])
        self.lines = [(all_x[whole * WINDOW:], all_y[whole * WINDOW:])]
        self.held = len(self.lines[0][0])

    def _step(self, x: np.ndarray, y: np.ndarray) -> None:
        self.steps += 1
        self.ids += x.size
        self.seen += np.bincount(x.reshape(-1), minlength=len(self.seen))
        _, gradient = self.model.gradient(x, y)
        for n, g in gradient.items():
            first, second = self.first[n], self.second[n]
            first += np.float32(0.1) * (g - first)
            second += np.float32(0.01) * (g * g - second)
            # Moments of earlier rounds are known; first ones begin at nought, as second ones of the first round do.
            known = np.float32(1 - 0.99 ** self.steps) if self.fresh else np.float32(1)
            self.model.weights[n] -= np.float32(self.rate) * first / (np.sqrt(second / known) + np.float32(1e-7))

    def counts(self) -> np.ndarray:
        """How much each row of weights has learned from: symbols by their occurrences, the rest by ids."""
        return np.concatenate([self.seen, np.full(len(self.model.weights["at_query"]) + len(self.model.weights["out"]), self.ids)])


# Weights are added up as integers, so that the sum does not depend on the order of the tasks.
_UNIT = float(1 << 22)


def _part() -> Column:
    return F.pmod(F.xxhash64("row_a", "row_b"), F.lit(PARTS))


def readings(part: int, begin: int, end: int) -> int:
    """How often a part's rows are read in a round from ``begin`` to ``end`` of all that is read, part after part, round and round."""
    return (end - 1 - part) // PARTS - (begin - 1 - part) // PARTS


def fit(training: DataFrame, rank: np.ndarray, classes: np.ndarray, n_ids: int) -> Attention:
    """The attention weights, learned from all windows of ``training``, as many steps as there are batches of them."""
    spark = training.sparkSession
    model = Attention.fresh(OWN + CLASSES + 1)
    spread = model.like(np.zeros_like(model.rows()))
    if not n_ids:
        return model
    total = PARTS * max(1, math.ceil(LEAST_WINDOWS * WINDOW / n_ids))
    known = spark.sparkContext.broadcast((rank, classes))
    done = 0.0
    for share, rate in ROUNDS:
        begin, end = round(done * total), round((done + share) * total)
        done += share
        times = {p: n for p in range(PARTS) if (n := readings(p, begin, end))}
        # Arrays only: what is broadcast does not carry the classes of this package with it.
        sent = spark.sparkContext.broadcast((model.weights, spread.weights))
        some = training.select("ids", _part().alias("part")).where(F.col("part").isin(list(times)))
        parts = some.mapInArrow(_learn_part(known, sent, times, rate), "row long, n long, rows binary")
        # As many rows as the model has of each task; each row's are added up in one place.
        added = parts.repartition("row").mapInArrow(_add_up, "row long, n long, rows binary").toArrow()
        rows, spreads = model.rows(), spread.rows()
        for row, n, data in zip(*(added.column(c).to_pylist() for c in ("row", "n", "rows"))):
            rows[row], spreads[row] = np.split(np.frombuffer(data, np.int64) / (n * _UNIT), 2)
        model, spread = model.like(rows), spread.like(spreads)
    return model


def _learn_part(known, sent, times: dict[int, int], rate: float):
    def learn(frames: Iterator) -> Iterator:
        rank, classes = known.value
        model, spread = map(Attention, sent.value)
        # The broadcast stays as it is: other tasks of this process begin with it.
        learner = Learner(model.like(model.rows()), spread, rate)
        begin = len(model.weights["next"]) - 1
        for batch in frames:
            for ids, part in zip(_ids(batch), batch.column("part").to_pylist()):
                line = np.append(begin, symbols_of(ids[:-1], rank, classes)), classes[ids]
                for _ in range(times[part]):
                    learner.read(*line)
        learner.finish()
        n = learner.counts()
        at = np.flatnonzero(n)
        both = np.rint(np.concatenate([learner.model.rows(), Attention({k: np.sqrt(v) for k, v in learner.second.items()}).rows()], axis=1) * _UNIT).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at]), pa.array([(both[i] * n[i]).tobytes() for i in at], pa.binary())], ["row", "n", "rows"])

    return learn


def _add_up(frames: Iterator) -> Iterator:
    total: dict[int, list] = {}
    for batch in frames:
        for row, n, data in zip(*(batch.column(c).to_pylist() for c in ("row", "n", "rows"))):
            held = total.setdefault(row, [0, 0])
            held[0] += n
            held[1] = held[1] + np.frombuffer(data, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([t[0] for t in total.values()], pa.int64()),
                                      pa.array([t[1].tobytes() for t in total.values()], pa.binary())], ["row", "n", "rows"])


def neighbour_counts(ids: DataFrame, common: np.ndarray) -> np.ndarray:
    """How often each id stands one or two places before, and one place after, each of ``common`` ids, in all rows: an
    id's row has the counts of the former and then of the latter."""
    wide = 2 * len(common)
    column = np.full(VOCABULARY, -1)
    column[common] = np.arange(len(common))

    def count(frames: Iterator) -> Iterator:
        for batch in frames:
            for text in _joined(_ids(batch)):
                cells = []
                for shift, side in ((1, 0), (2, 0), (-1, 1)):
                    a, b = (text[:-shift], text[shift:]) if shift > 0 else (text[1:], text[:-1])
                    ok = column[b] >= 0
                    cells.append(a[ok] * wide + column[b[ok]] + side * len(common))
                at, n = np.unique(np.concatenate(cells), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n.astype(np.int64))], ["cell", "n"])

    # One row per cell that occurs, vocabulary times COMMON twice at most.
    counted = ids.select("ids").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").cast("float").alias("n")).toArrow()
    near = np.zeros(VOCABULARY * wide, np.float32)
    for some in counted.to_batches():
        near[some.column("cell").to_numpy()] = some.column("n").to_numpy()
    return near.reshape(VOCABULARY, wide)


def _joined(texts: list[np.ndarray], size: int = 1_000_000) -> Iterator[np.ndarray]:
    """Texts, which end in an end id, one after another, about ``size`` ids at a time."""
    held, n = [], 0
    for text in texts:
        held.append(text)
        n += len(text)
        if n >= size:
            yield np.concatenate(held)
            held, n = [], 0
    if held:
        yield np.concatenate(held)


def learn_classes(near: np.ndarray, counts: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """Class of each id: ids with like neighbours go together; ids that no training row has share the last class."""
    seen = np.flatnonzero(counts)
    found = np.full(VOCABULARY, classes - 1, np.int64)
    if len(seen) <= classes:
        found[seen] = np.arange(len(seen)) % classes
        return found
    near, mass = near[seen], counts[seen].astype(float)
    usual = 0.5 * near.mean(axis=0)
    near = np.sqrt((near + usual) / (near.sum(axis=1, keepdims=True) + usual.sum() + np.float32(1e-9)))
    near -= near.mean(axis=0)
    weighted = near * np.sqrt(mass / mass.sum()).astype(np.float32)[:, None]
    _, directions = np.linalg.eigh((weighted.T @ weighted).astype(float))
    spots = near @ directions[:, ::-1][:, :16]
    # Weighted k-means from the ids with the largest counts.
    centres = spots[np.argsort(-mass, kind="stable")[:classes - 1]]
    for _ in range(12):
        far = (spots ** 2).sum(axis=1)[:, None] - 2 * spots @ centres.T + (centres ** 2).sum(axis=1)
        own = far.argmin(axis=1)
        total = np.bincount(own, weights=mass, minlength=len(centres))
        for j in range(spots.shape[1]):
            sums = np.bincount(own, weights=mass * spots[:, j], minlength=len(centres))
            centres[:, j] = np.where(total > 0, sums / np.maximum(total, 1e-9), centres[:, j])
    found[seen] = own
    return found


def subword_ids(docs: DataFrame, tokenizer: str) -> DataFrame:
    """row, held_out and the ids of each text as unsigned 16-bit integers, with an end id; null counts as empty."""
    spec = docs.sparkSession.sparkContext.broadcast(read_whole(tokenizer))  # a vocabulary file, a few MB

    def encode(frames: Iterator) -> Iterator:
        ids_of = WordIds(spec.value)
        for batch in frames:
            ids = [np.append(i, END).astype("<u2").tobytes() for i in ids_of.encode(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("row_a"), batch.column("row_b"), batch.column("held_out"), pa.array(ids, pa.binary())],
                                             [*_KEY, "held_out", "ids"])

    return docs.select(*row_key(), held_out().alias("held_out"), "text").mapInArrow(encode, "row_a long, row_b long, held_out boolean, ids binary")


def _ids(batch) -> list[np.ndarray]:
    return [np.frombuffer(b, "<u2").astype(np.int64) for b in batch.column("ids").to_pylist()]


def id_counts(ids: DataFrame) -> np.ndarray:
    """How often each id occurs in all rows."""

    def count(frames: Iterator) -> Iterator:
        total = np.zeros(VOCABULARY, np.int64)
        for batch in frames:
            for some in _ids(batch):
                total += np.bincount(some, minlength=VOCABULARY) if len(some) > VOCABULARY else 0
                if len(some) <= VOCABULARY:
                    np.add.at(total, some, 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])

    # One row per id of the vocabulary.
    counted = ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    total = np.zeros(VOCABULARY, np.int64)
    total[counted.id.to_numpy()] = counted.n.to_numpy()
    return total


def pair_counts(ids: DataFrame) -> DataFrame:
    """(pair, n): how often each id follows each other one, in all rows; a pair is the id before times 65,536 and the id."""

    def count(frames: Iterator) -> Iterator:
        for batch in frames:
            for line in _joined(_ids(batch)):
                # A row's first id follows nothing.
                ok = line[:-1] != END
                at, n = np.unique(line[:-1][ok] << 16 | line[1:][ok], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n.astype(np.int64))], ["pair", "n"])

    return ids.select("ids").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


@dataclass
class Shares:
    """Log-share of an id within its class, after the id before it. Pairs that were seen add what ``gains`` says."""

    alone: np.ndarray  # log-share of each id in its class, whatever stands before it
    left: np.ndarray  # by id before, VOCABULARY for none, and class: log-share of what its pairs leave to the rest
    kinds: np.ndarray  # by the same: kinds of ids that follow, 1 at least

    @classmethod
    def of(cls, counts: np.ndarray, pairs: DataFrame, classes: np.ndarray) -> Shares:
        inside = np.bincount(classes, weights=counts + 1.0, minlength=CLASSES)
        sent = pairs.sparkSession.sparkContext.broadcast(classes)

        def classed(frames: Iterator) -> Iterator:
            own = sent.value
            for batch in frames:
                pair = batch.column("pair").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(((pair >> 16) * CLASSES + own[pair & 0xFFFF]).astype(np.int32)), batch.column("n")], ["cell", "n"])

        # One row per id and class that follows it.
        found = pairs.mapInArrow(classed, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"), F.count(F.lit(1)).cast("int").alias("kinds")).toArrow()
        total, kinds = np.zeros((VOCABULARY + 1) * CLASSES, np.float32), np.ones((VOCABULARY + 1) * CLASSES, np.float32)
        for some in found.to_batches():
            cell = some.column("cell").to_numpy()
            total[cell], kinds[cell] = some.column("n").to_numpy(), some.column("kinds").to_numpy()
        # As many kinds as follow an id within a class, so much weight has the share whatever stands before.
        return cls(np.log((counts + 1.0) / inside[classes]), np.log(kinds / (total + kinds)).reshape(-1, CLASSES), kinds.reshape(-1, CLASSES))

    def gains(self, pairs: DataFrame, classes: np.ndarray) -> DataFrame:
        """(pair, n, gain): what is to be added for a pair that was seen."""
        sent = pairs.sparkSession.sparkContext.broadcast((self.alone, self.kinds, classes))

        def gain(frames: Iterator) -> Iterator:
            alone, kinds, own = sent.value
            for batch in frames:
                pair, n = batch.column("pair").to_numpy(), batch.column("n").to_numpy()
                before, after = pair >> 16, pair & 0xFFFF
                found = np.log1p(n / (kinds[before, own[after]] * np.exp(alone[after])))
                yield pa.RecordBatch.from_arrays([batch.column("pair"), batch.column("n"), pa.array(found.astype(np.float64))], ["pair", "n", "gain"])

        return pairs.mapInArrow(gain, "pair long, n long, gain double")

    def __call__(self, ids: np.ndarray, before: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Of ids and the ids before them, but for the gains."""
        return self.alone[ids] + self.left[before, classes[ids]]


def windows(sizes: np.ndarray, window: int = WINDOW, overlap: int = OVERLAP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts with so many ids: each window's text, its first place, and how many of its places were scored before."""
    step = window - overlap
    parts = 1 + -(-np.maximum(0, sizes - window) // step)
    owner = np.repeat(np.arange(len(sizes)), parts)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    return owner, nth * step, np.where(nth > 0, overlap, 0)


def symbols_of(ids: np.ndarray, rank: np.ndarray, classes: np.ndarray) -> np.ndarray:
    return np.where(rank[ids] < OWN, rank[ids], OWN + classes[ids])


def text_scores(documents: list[np.ndarray], model: Attention, rank: np.ndarray, classes: np.ndarray, shares: Shares,
                known: np.ndarray, gain: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Natural log-probability of each document's ids without the gains of pairs that are not ``known``; these pairs, and how often each is there."""
    begin = len(model.weights["next"]) - 1
    sizes = np.array([len(d) for d in documents])
    flat = np.concatenate(documents)
    firsts = np.cumsum(sizes) - sizes
    before = np.concatenate([[VOCABULARY], flat[:-1]])
    before[firsts] = VOCABULARY
    each = shares(flat, before, classes)
    pairs, which = np.unique(before << 16 | flat, return_inverse=True)
    at = np.minimum(np.searchsorted(known, pairs), max(0, len(known) - 1))
    hit = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
    each += np.where(hit, gain[at], 0.0)[which] if len(known) else 0.0
    score = np.add.reduceat(each, firsts)
    other = np.flatnonzero(~hit[which] & (before != VOCABULARY))
    owned, times = np.unique(np.repeat(np.arange(len(sizes)), sizes)[other] << 32 | pairs[which[other]], return_counts=True)
    stops = np.searchsorted(owned, np.arange(1, len(sizes)) << 32)
    rest, times = np.split(owned & 0xFFFFFFFF, stops), np.split(times.astype(np.int64), stops)
    after = classes[flat]
    # What stands before each id; the beginning before a document's first.
    line = np.concatenate([[begin], symbols_of(flat[:-1], rank, classes)])
    line[firsts] = begin
    owner, first, done = windows(sizes)
    for lo in range(0, len(owner), SCORED):
        o, f = owner[lo:lo + SCORED], first[lo:lo + SCORED]
        offset = np.arange(WINDOW)
        valid = f[:, None] + offset < sizes[o][:, None]
        at = np.where(valid, firsts[o][:, None] + f[:, None] + offset, 0)
        found = model.log_share(line[at], after[at])
        found[~valid | (offset < done[lo:lo + SCORED, None])] = 0
        np.add.at(score, o, found.sum(axis=1, dtype=np.float64))
    return score, rest, times


def model_scores(ids: DataFrame) -> DataFrame:
    """(row, score): log10 probability of each distinct row of ``ids`` under a model of those not held out."""
    spark = ids.sparkSession
    training = ids.where("NOT held_out")
    counts = id_counts(training)
    n_ids = int(counts.sum())
    order = np.argsort(-counts, kind="stable")
    classes = learn_classes(neighbour_counts(training, order[:COMMON]), counts)
    rank = np.full(VOCABULARY, OWN)
    rank[order[:OWN]] = np.arange(OWN)
    pairs = durable(pair_counts(training), "pairs")
    shares = Shares.of(counts, pairs, classes)
    gains = durable(shares.gains(pairs, classes), "gains")
    # At most 1 / FREQUENT_PAIR pairs.
    frequent = gains.where(F.col("n") >= max(1.0, FREQUENT_PAIR * n_ids)).select("pair", "gain").toArrow()
    known, gain = (frequent.column(c).to_numpy() for c in ("pair", "gain"))
    by_pair = np.argsort(known)
    model = fit(training, rank, classes, n_ids)
    sent = spark.sparkContext.broadcast((model.weights, rank, classes, (shares.alone, shares.left, shares.kinds), known[by_pair], gain[by_pair].astype(np.float32)))

    def score(frames: Iterator) -> Iterator:
        weights, rank, classes, table, known, gain = sent.value
        learned = Attention(weights), rank, classes, Shares(*table), known, gain
        for batch in frames:
            documents, found, rest, times = _ids(batch), [], [], []
            begin = 0
            while begin < len(documents):
                end, held_ids = begin, 0
                while end < len(documents) and (end == begin or held_ids < 50_000):
                    held_ids += len(documents[end])
                    end += 1
                some = text_scores(documents[begin:end], *learned)
                found.append(some[0])
                rest += some[1]
                times += some[2]
                begin = end
            ends = np.cumsum([0, *map(len, rest)]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(x) if x else np.empty(0, np.int64))) for x in (rest, times)]
            scores = np.concatenate(found) if found else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column("row_a"), batch.column("row_b"), pa.array(scores), *lists], [*_KEY, "part", "rest", "times"])

    parts = durable(ids.select(*_KEY, "ids").mapInArrow(
        score, "row_a long, row_b long, part double, rest array<long>, times array<long>"), "parts").dropDuplicates(_KEY)
    rare = parts.select(*_KEY, F.explode(F.arrays_zip("rest", "times")).alias("r")).select(*_KEY, F.col("r.rest").alias("pair"), F.col("r.times").alias("times"))
    added = rare.join(gains.select("pair", "gain"), "pair").groupBy(*_KEY).agg(F.sum(F.col("times") * F.col("gain")).alias("more"))
    return parts.select(*_KEY, "part").join(added, _KEY, "left").select(
        *_KEY, ((F.col("part") + F.coalesce("more", F.lit(0.0))) / math.log(10)).alias("score"))


def base_scores(docs: DataFrame) -> DataFrame:
    """(row, n_tokens, n_known, train_tokens, base_score): the word unigram base, counted on rows that are not held out."""

    def count(frames: Iterator) -> Iterator:
        for batch in frames:
            found = list(word_hashes(batch.column("text").to_pylist()))
            words, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.uint64), np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])

    training = docs.where(~held_out())
    counts = durable(training.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "counts")
    texts = training.count()
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, kinds = total[0] + texts, total[1] + (texts > 0)
    scale = float(tokens + kinds + 1)
    frequent = counts.where(F.col("n") >= max(1.0, FREQUENT * tokens)).toArrow().to_pandas().sort_values("word")
    known_words = docs.sparkSession.sparkContext.broadcast((frequent.word.to_numpy(), frequent.n.to_numpy()))  # at most 1 / FREQUENT words
    end = math.log10((texts + 1) / scale)

    def add_up(frames: Iterator) -> Iterator:
        known, n = known_words.value
        value = np.log10((n + 1) / scale)
        for batch in frames:
            size, sure, score, rest, times = [], [], [], [], []
            for words in word_hashes(batch.column("text").to_pylist()):
                words = words.view(np.int64)
                at = np.minimum(np.searchsorted(known, words), max(0, len(known) - 1))
                hit = known[at] == words if len(known) else np.zeros(len(words), bool)
                other, often = np.unique(words[~hit], return_counts=True)
                size.append(len(words) + 1)
                sure.append(int(hit.sum()) + (texts > 0))
                score.append(float(value[at[hit]].sum()) + end)
                rest.append(other)
                times.append(often)
            ends = np.cumsum([0, *map(len, rest)]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64))) for x in (rest, times)]
            yield pa.RecordBatch.from_arrays([batch.column("row_a"), batch.column("row_b"), pa.array(size, pa.int64()), pa.array(sure, pa.int64()),
                                              pa.array(score, pa.float64()), *lists], [*_KEY, "n_tokens", "sure", "part", "rest", "times"])

    parts = durable(docs.select(*row_key(), "text").mapInArrow(
        add_up, "row_a long, row_b long, n_tokens long, sure long, part double, rest array<long>, times array<long>"), "parts").dropDuplicates(_KEY)
    rare = parts.select(*_KEY, F.explode(F.arrays_zip("rest", "times")).alias("r")).select(*_KEY, F.col("r.rest").alias("word"), F.col("r.times").alias("times"))
    n = F.coalesce(F.col("n"), F.lit(0))
    added = rare.join(counts, "word", "left").groupBy(*_KEY).agg(
        F.sum(F.col("times") * F.log10((n + 1) / F.lit(scale))).alias("more"), F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("also"))
    return parts.drop("rest", "times").join(added, _KEY, "left").select(
        *_KEY, "n_tokens", (F.col("sure") + F.coalesce("also", F.lit(0))).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("part") + F.coalesce("more", F.lit(0.0))).alias("base_score"))


def score_texts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs`` (doc_id, text).

    A null text counts as empty and has its end alone. Rows with equal doc_id and text are trained on as often as they
    occur and get equal scores. Without training rows all words are unknown. An empty table gives an empty result.
    """
    docs = docs.select("doc_id", "text")
    scores = durable(model_scores(durable(subword_ids(docs, tokenizer), "ids")), "scores")
    base = base_scores(docs)
    # Neither side holds texts.
    return docs.select("doc_id", held_out().alias("held_out"), *row_key()).join(base, _KEY).join(scores, _KEY).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), tokenizer_path())
