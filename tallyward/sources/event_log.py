"""Published events as a log that shows a batch of them at once or not at all.

Tasks write their events into files of their own. The driver then writes one manifest that names the files: only then
do readers see them. A batch that fails leaves no manifest and its files are removed; a batch that comes again, as after a
restart, finds its manifest and adds nothing. So every event is there once, whatever is repeated.
"""

from __future__ import annotations

import hashlib
import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.cloudpickle import register_pickle_by_value
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

register_pickle_by_value(sys.modules[__name__])


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    events: int


class _Log:
    """What batch and stream writers share."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def _store(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path)

    def write(self, iterator: Iterator) -> Written:
        """Runs in a task: the rows' ``value`` as lines of a new file, which no one sees yet."""
        store, root = self._store()
        store.create_dir(f"{root}/data", recursive=True)
        name, events = f"data/{uuid.uuid4().hex}.jsonl", 0
        try:
            with store.open_output_stream(f"{root}/{name}") as file:
                for row in iterator:
                    file.write(row["value"].encode() + b"\n")
                    events += 1
        except BaseException:
            self.discard([Written(name, events)])
            raise
        return Written(name, events)

    def publish(self, messages: list[Written | None], batch: str) -> None:
        """Runs on the driver once all tasks are done."""
        from pyarrow import fs

        store, root = self._store()
        store.create_dir(f"{root}/manifests", recursive=True)
        manifest = f"{root}/manifests/{hashlib.sha256(batch.encode()).hexdigest()[:32]}.json"
        if store.get_file_info(manifest).type != fs.FileType.NotFound:
            self.discard(messages)
            return
        lines = [json.dumps({"batch": batch, "file": m.file, "events": m.events}) for m in messages if m and m.events]
        with store.open_output_stream(manifest + ".new") as file:
            file.write("\n".join(lines).encode())
        store.move(manifest + ".new", manifest)

    def discard(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        store, root = self._store()
        for m in messages:
            if m and m.file and store.get_file_info(f"{root}/{m.file}").type != fs.FileType.NotFound:
                store.delete_file(f"{root}/{m.file}")


class EventWriter(_Log, DataSourceWriter):
    def __init__(self, path: str, batch: str):
        super().__init__(path)
        self.batch = batch

    def commit(self, messages: list) -> None:
        self.publish(messages, self.batch)

    def abort(self, messages: list) -> None:
        self.discard(messages)


class EventStreamWriter(_Log, DataSourceStreamWriter):
    def __init__(self, path: str, query: str):
        super().__init__(path)
        self.query = query

    def commit(self, messages: list, batchId: int) -> None:
        self.publish(messages, f"{self.query}/{batchId}")

    def abort(self, messages: list, batchId: int) -> None:
        self.discard(messages)


class EventLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "event_log"

    def schema(self) -> str:
        return "key string, value string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("An event log is only added to.")
        return EventWriter(self.options["path"], self.options["batch"])

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        return EventStreamWriter(self.options["path"], self.options["query"])


def publish(events: DataFrame, path: str, batch: str) -> None:
    """Add ``events`` (key, value) as ``batch``; a batch that is there already stays as it is."""
    events.sparkSession.dataSource.register(EventLog)
    events.select("key", "value").write.format("event_log").mode("append").option("path", path).option("batch", batch).save()


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """``value`` of all committed events. Names of files come to the driver, as with any table."""
    try:
        manifests = spark.read.schema("batch string, file string, events long").json(f"{path}/manifests")
        files = [f"{path}/{r['file']}" for r in manifests.where(F.col("file").isNotNull()).select("file").collect()]
    except AnalysisException:
        files = []
    return spark.read.text(files) if files else spark.createDataFrame([], "value string")
