"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_own_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir.  Where that is unset, a local session gets a folder of its own; on a cluster the setting is required,
    because a folder of one machine would be invisible to the others."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own_roots:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _own_roots[app] = f"file://{tempfile.mkdtemp(prefix='cardloom-')}"
    return _own_roots[app]


def new_folder(spark: SparkSession, tag: str) -> str:
    """A folder of its own for what a job writes between its steps."""
    return f"{shared_root(spark)}/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"
