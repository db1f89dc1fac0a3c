"""What the library needs to know about the Spark session it runs in."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_handed_out: list[str] = []


@functools.lru_cache(maxsize=None)
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="tierloom-")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for tables that cut lineage.

    The cluster names it in ``spark.checkpoint.dir``. Only a session in local mode, as in tests, may
    leave it unset and gets a folder on its own machine.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return _local_folder(spark.conf.get("spark.app.id", ""))
    raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")


def new_table_path(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that nothing has been written to yet; see :func:`drop_stored`."""
    path = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


def drop_stored(spark: SparkSession) -> int:
    """Delete what has been stored under new paths by this driver so far; the number of paths.

    For when the results that read them have been written or collected: DataFrames over them cannot run again.
    """
    done = 0
    while _handed_out:
        path = spark._jvm.org.apache.hadoop.fs.Path(_handed_out.pop())
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
        done += 1
    return done
