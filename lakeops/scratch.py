"""Where intermediate tables and checkpoints go.

The shared folder is the one the cluster names in ``spark.checkpoint.dir``. A
machine-local folder is used only by a local session that names none.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_root: dict[str, str] = {}


def root(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder every executor can reach"
            )
        app = context.applicationId
        if app not in _local_root:
            _local_root[app] = tempfile.mkdtemp(prefix="lakeops-")
        named = _local_root[app]
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


def fresh(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{root(spark)}/{label}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a path through the file system it lives on."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(jpath) and fs.delete(jpath, True)
