"""Shared scratch storage used to cut lineage and to exchange tables between stages."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=None)
def _local_root(application_id: str) -> str:
    root = tempfile.mkdtemp(prefix="keepwell-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder, which goes when the process
    ends; a cluster session must name a folder that all executors can reach.
    """
    return shared_path(spark, f"{label}-{uuid.uuid4().hex}")


def shared_path(spark: SparkSession, name: str) -> str:
    """The path of that name below the shared folder, the same in every call."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _local_root(context.applicationId)
    return f"{root.rstrip('/')}/{name}"


def materialise(df: DataFrame, label: str = "stage", folders: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and return it as a fresh scan.

    Used where a table feeds several actions: it is computed once, later reads prune columns, and a
    lost executor costs a re-read instead of a recomputation. Each value of the columns in ``folders`` gets a
    folder of its own, so that a read of some values leaves the other files alone; these columns come last.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*folders).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove materialised tables that nothing reads any more; results read later must not rest on them."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
