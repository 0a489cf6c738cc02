"""Versions of a model and which of them serves.

A version is written once and never changed. The pointer is a folder of empty files named ``number=version``; the highest number
serves. Adding such a file is one step of the file system, so a reader sees the old version or the new one, a run that
fails before leaves the old one, and of two runs that read the same pointer only one can move it.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession


class Moved(RuntimeError):
    """Somebody else has moved the pointer."""


def _names(spark: SparkSession, path: str) -> list[str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in store.listStatus(folder)) if store.exists(folder) else []


def versions(spark: SparkSession, root: str) -> list[str]:
    return _names(spark, f"{root}/versions")


def history(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(number, version) of all that has served, the present one last."""
    found = [name.partition("=") for name in _names(spark, f"{root}/serving") if "=" in name]
    return sorted((int(number), version) for number, _, version in found)


def serving_version(spark: SparkSession, root: str) -> str | None:
    served = history(spark, root)
    return served[-1][1] if served else None


def add_version(spark: SparkSession, root: str, model: PipelineModel) -> str:
    """Store ``model``; it does not serve yet."""
    version = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    model.write().save(f"{root}/versions/{version}")
    return version


def serve(spark: SparkSession, root: str, version: str, after: int | None = None) -> None:
    """Let ``version`` serve, also an earlier one again. ``after`` is the number of the pointer that the decision was based on."""
    if version not in versions(spark, root):
        raise ValueError(f"There is no version {version!r} under {root}")
    served = history(spark, root)
    last = served[-1][0] if served else 0
    if after is not None and after != last:
        raise Moved(f"The serving model of {root} has changed")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/serving/{last + 1:012d}={version}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).createNewFile(path):
        raise Moved(f"The serving model of {root} has changed")


def load_serving(spark: SparkSession, root: str) -> PipelineModel:
    """The serving version; a folder without versions is a model itself."""
    version = serving_version(spark, root)
    return PipelineModel.load(f"{root}/versions/{version}" if version else root)
