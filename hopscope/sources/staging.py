"""Intermediate tables that two later steps read.

A staged table is written once, packed with zstd, to the shared folder named by
``spark.checkpoint.dir``. That cuts the lineage (a lost executor re-reads the
table instead of repeating the scan behind it), lets each reader prune columns
and gives the planner real sizes to decide on broadcasts.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_scratch: tempfile.TemporaryDirectory | None = None
# Paths staged inside the open ``staging`` blocks, innermost last.
_open_blocks: list[list[str]] = []


def staging_root(spark: SparkSession) -> str:
    """Shared folder from the session; a scratch folder only in local mode.

    On a cluster without one it raises: executors don't see each other's
    folders, and steps that go over a table again and again would repeat all
    the work before them.
    """
    global _local_scratch
    conf = spark.sparkContext.getConf()
    root = conf.get(_CHECKPOINT_DIR) or spark.conf.get(_CHECKPOINT_DIR, None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.TemporaryDirectory(prefix="hopscope-")
    return _local_scratch.name


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a reader of it."""
    spark = df.sparkSession
    path = f"{staging_root(spark).rstrip('/')}/hopscope-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if _open_blocks:
        _open_blocks[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end of the block, the tables that were staged in it.

    Frames built in the block can't be read any more after it.
    """
    _open_blocks.append([])
    try:
        yield
    finally:
        for path in _open_blocks.pop():
            hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
