"""Intermediate results that outlive the executors that computed them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_root: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names. Only a session
    without that setting on a local master, as in tests, gets a local folder: elsewhere each
    machine would write to its own disk."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.conf.get("spark.app.id", "local")
    if not root:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
        root = _own_root.setdefault(app, "") or tempfile.mkdtemp(prefix="tallyward-")
        _own_root[app] = root
    return f"{root.rstrip('/')}/tallyward/{app}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` once and go on from the written table: a lost executor then costs a
    re-read and not a recomputation."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
