"""Steps that are kept where every executor can read them."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession


def shipped(spark: SparkSession, value: object) -> Broadcast[bytes]:
    """A broadcast of a value of this package's classes. It holds the classes with the value, so
    workers that lack the package can unpack it with ``arrived``."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def arrived(shared: Broadcast[bytes]) -> object:
    return cloudpickle.loads(shared.value)


def _base(spark: SparkSession) -> str:
    """The folder that the cluster shares; a temporary one where a single machine does all."""
    context = spark.sparkContext
    named = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="shared-")


def saved(df: DataFrame) -> DataFrame:
    """The frame computed now and kept as a reliable checkpoint.

    Its files go to the folder in ``spark.checkpoint.dir``; only where that is unset, as in
    tests on one machine, a temporary folder is taken.
    """
    spark = SparkSession.getActiveSession() or df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_base(spark))
    kept = df.checkpoint()
    release(spark)
    return kept


def release(spark: SparkSession) -> None:
    """Shuffle files and older checkpoints that nothing needs any more go when the driver collects
    its garbage, which by itself may be long after many steps."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shared_folder(spark: SparkSession) -> str:
    """A new path, not yet existing, below the shared folder."""
    return f"{_base(spark)}/{uuid.uuid4()}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that an operator wrote, on whatever file system it is."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
