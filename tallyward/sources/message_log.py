"""A folder of message segments as a bounded, restartable stream.

Segments are Parquet files below numbered folders and are read in that order. An offset names a segment and how many
of its rows are read, so a micro-batch takes ``messagesPerTrigger`` messages at most, wherever segments end. Spark asks for the
next offset without saying where it is, so the reader keeps the last offset that was planned under ``progress``; what was
read is in the stream's checkpoint alone. Paths are opened by Arrow, which knows local and mounted folders and the common
object stores.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

MESSAGES = "value string, topic string, partition string, offset string, timestamp string"
# Rows that one task reads of a segment.
SLICE_ROWS = 100_000

# Readers run in processes of their own, which need no copy of this package.
register_pickle_by_value(sys.modules[__name__])


@dataclass
class Slice(InputPartition):
    path: str
    begin: int
    end: int


class MessageLogReader(DataSourceStreamReader):
    def __init__(self, path: str, limit: int, progress: str):
        if limit < 1:
            raise ValueError("messagesPerTrigger must be >= 1")
        self.path, self.limit, self.progress = path, limit, progress
        self.rows: dict[str, int] = {}
        self.planned: dict[str, Any] | None = None

    def _open(self, path: str):
        from pyarrow import fs

        return fs.FileSystem.from_uri(path)

    def _segments(self, since: str) -> list[tuple[str, int]]:
        """Names and rows of the segments from ``since`` on. A folder counts once its writer has finished."""
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, root = self._open(self.path)
        found = [f.path for f in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)) if f.is_file]
        done = {p.rsplit("/", 1)[0] for p in found if p.endswith("/_SUCCESS")}
        names = sorted(p[len(root):].lstrip("/") for p in found if p.endswith(".parquet") and p.rsplit("/", 1)[0] in done)
        for name in names:
            if name >= since and name not in self.rows:
                with store.open_input_file(f"{root}/{name}") as file:
                    self.rows[name] = pq.ParquetFile(file).metadata.num_rows
        return [(n, self.rows[n]) for n in names if n >= since]

    def initialOffset(self) -> dict:
        return {"segment": "", "row": 0}

    def _last_planned(self) -> dict:
        if self.planned is None:
            store, path = self._open(self.progress)
            try:
                with store.open_input_file(path) as file:
                    self.planned = json.loads(file.read())
            except FileNotFoundError:
                self.planned = self.initialOffset()
        return self.planned

    def latestOffset(self) -> dict:
        at, left = self._last_planned(), self.limit
        for name, rows in self._segments(at["segment"]):
            begin = at["row"] if name == at["segment"] else 0
            take = min(rows - begin, left)
            if take > 0:
                at, left = {"segment": name, "row": begin + take}, left - take
            if not left:
                break
        return at

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        # From here on this micro-batch is in the checkpoint, and will be read up to ``end`` even after a restart.
        store, path = self._open(self.progress)
        with store.open_output_stream(path + ".new") as file:
            file.write(json.dumps(end).encode())
        store.move(path + ".new", path)
        self.planned = end
        slices: list[InputPartition] = []
        for name, rows in self._segments(start["segment"]):
            if name > end["segment"]:
                break
            begin = start["row"] if name == start["segment"] else 0
            last = end["row"] if name == end["segment"] else rows
            slices += [Slice(name, b, min(b + SLICE_ROWS, last)) for b in range(begin, last, SLICE_ROWS)]
        return slices

    def read(self, partition: Slice) -> Iterator:
        import pyarrow.parquet as pq

        names = [field.split()[0] for field in MESSAGES.split(", ")]
        store, root = self._open(self.path)
        with store.open_input_file(f"{root}/{partition.path}") as file:
            segment, first = pq.ParquetFile(file), 0
            for group in range(segment.num_row_groups):
                rows = segment.metadata.row_group(group).num_rows
                if first < partition.end and first + rows > partition.begin:
                    at = first
                    for batch in segment.iter_batches(10_000, row_groups=[group], columns=names):
                        begin, end = max(partition.begin - at, 0), min(partition.end - at, batch.num_rows)
                        if begin < end:
                            yield batch.select(names).slice(begin, end - begin)
                        at += batch.num_rows
                first += rows

    def commit(self, end: dict) -> None:
        """Segments stay; whoever owns the folder removes those that all readers have passed."""


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self) -> str:
        return MESSAGES

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return MessageLogReader(self.options["path"], int(self.options.get("messagesPerTrigger", 1_000)), self.options["progress"])


def append_segment(messages: DataFrame, path: str, number: int) -> None:
    """Write ``messages`` (value, topic, partition, offset, timestamp) as segment ``number``; numbers ascend."""
    columns = [F.col(field.split()[0]).cast("string") for field in MESSAGES.split(", ")]
    messages.select(*columns).write.parquet(f"{path}/{number:012d}")


def read_message_log(spark: SparkSession, path: str, progress: str, per_trigger: int = 1_000) -> DataFrame:
    """The folder as a stream. Each query needs a ``progress`` file of its own, kept as long as its checkpoint. Run it with a
    processing-time trigger: under ``availableNow`` Spark asks once and would stop after one micro-batch."""
    spark.dataSource.register(MessageLog)
    return (spark.readStream.format("message_log").option("path", path).option("progress", progress)
            .option("messagesPerTrigger", str(per_trigger)).load())
