"""Best-fit decreasing packing of tokenized documents into fixed windows.

A document is cut into full windows; what remains of it, shorter than a window, goes into the
open window that it fills best. A segment tree over remaining capacities finds that window in
log(window) steps. The remainders are dealt evenly to groups of bounded size, and each group is
packed by itself, so a group costs at most one partly filled window or so and no task sees more
than a group.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import WordIds, batches, read_whole, tokenizer_path
from tallyward.plans.durable import durable

WINDOW = 4096
END_ID = 2
# Remainders that are packed together. Padding falls as this grows, memory rises.
GROUP_ROWS = 50_000
_GROUP_BITS = 32


class OpenWindows:
    """Open windows by remaining capacity. A node of the tree counts the windows below it."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, capacity: int, change: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += change
            node >>= 1

    def put(self, capacity: int, name: int) -> None:
        self.at[capacity].append(name)
        self._add(capacity, 1)

    def take_tightest(self, need: int) -> tuple[int, int] | None:
        """Capacity and name of the window with the least room that is at least ``need``."""
        node = need + self.leaves
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._add(capacity, -1)
        return capacity, self.at[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each length; windows are numbered as they are opened."""
    sequence = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    open_windows = OpenWindows(window)
    opened = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = open_windows.take_tightest(need)
        if found is None:
            found = window, opened
            opened += 1
        room, name = found
        sequence[i], offset[i] = name, window - room
        if room > need:
            open_windows.put(room - need, name)
    return sequence, offset


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID,
           with_ids: bool = True) -> DataFrame:
    """Cut ``docs`` (doc_id, text) into pieces of at most ``window`` ids.

    Columns: doc_id, start, length, ids_crc32, doc_tokens and, on request, ids. A null text counts
    as empty and gives the end id alone; a null or repeated doc_id is kept as it is, each row a
    document of its own. Other columns are left out.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_whole(tokenizer))  # a vocabulary file, a few MB
    types = [("doc_id", docs.schema["doc_id"].dataType.simpleString()), ("start", "long"), ("length", "long"),
             ("ids_crc32", "long"), ("doc_tokens", "long")] + [("ids", "array<int>")] * with_ids

    def cut(frames: Iterator) -> Iterator:
        ids_of = WordIds(spec.value)
        for names, texts in batches(frames, ["doc_id", "text"]):
            out: list[list] = [[] for _ in types]
            for name, ids in zip(names, ids_of.encode(texts)):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start:start + window]
                    row = (name, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), piece.tolist() if with_ids else None)
                    for values, value in zip(out, row):
                        values.append(value)
            yield pa.RecordBatch.from_pydict({n: pa.array(v, type=_ARROW.get(t)) for (n, t), v in zip(types, out)})

    return docs.select("doc_id", "text").mapInArrow(cut, ", ".join(f"{n} {t}" for n, t in types))


_ARROW = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}


def place(cut: DataFrame, window: int = WINDOW, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Add sequence_id and offset to rows with a ``length`` of 1 to ``window``; other columns stay.

    ``cut`` should be a written table: it is read twice, once to count it.
    """
    if group_rows < 1:
        raise ValueError("group_rows must be >= 1")
    cut = cut.drop("sequence_id", "offset")
    parts = cut.where(F.col("length") < window)
    groups = max(1, -(-parts.count() // group_rows))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"

    def pack(frames: Iterator) -> Iterator:
        from pyspark import TaskContext

        held = [b for b in frames if b.num_rows]
        if not held:
            return
        # One group: at most about group_rows rows.
        rows = pa.Table.from_batches(held).combine_chunks()
        sequence, offset = best_fit_decreasing(rows.column("length").to_numpy(), window)
        first = (TaskContext.get().partitionId() * 2) << _GROUP_BITS
        rows = rows.append_column("sequence_id", pa.array(sequence + first)).append_column("offset", pa.array(offset))
        yield from rows.to_batches()

    # Without a key rows are dealt out evenly, whatever they hold, and in the same way by a repeated task.
    packed = parts.repartition(groups).mapInArrow(pack, schema)
    # Full windows stand alone: even group numbers belong to packed windows, odd ones to these.
    task = F.shiftright(F.monotonically_increasing_id(), 33)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    alone = cut.where(F.col("length") == window).select(
        "*", (F.shiftleft(task * 2 + 1, _GROUP_BITS) + within).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone)


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents with their places. An empty table gives an empty result."""
    return place(durable(pieces(docs, tokenizer, window, with_ids=with_ids), "pieces"), window)


def op2_packing(spark, sf_dir: str) -> DataFrame:
    from tallyward.llm.common import table

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)
