"""What several operators need: the shared folder, reading tables, and files by URI."""

from __future__ import annotations

import ctypes
import posixpath
import re
import tempfile
import uuid

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it; set here only where it is unset and all run on one machine."""
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jvm_dir.isDefined():
            return posixpath.dirname(jvm_dir.get())
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError(f"{CHECKPOINT_CONF} names no folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="threshmill-")
        spark.conf.set(CHECKPOINT_CONF, root)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run's tables under the shared folder."""
    return f"{shared_root(spark)}/threshmill/{name}-{uuid.uuid4().hex[:12]}"


def staged(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later jobs start from it, whichever executors are lost."""
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI and the path in it; a plain path is a local one."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def remove(spark: SparkSession, uri: str) -> None:
    """Delete a folder of the run that nothing reads any more, if it is there, in whatever store Spark has it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: Bytes of an Arrow batch.
BATCH_BYTES = 2 << 20


def frugal(run):
    """A task's generator that gives what it has freed back to the system, so that Python workers, which Spark keeps, stay small."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return wrapped


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, so that long texts do not pile up in one. All operators set the same bound."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
