"""Tables between the stages of a job, in the folder that driver and executors share."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_folder: ContextVar[str | None] = ContextVar("_folder", default=None)


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where it is unset, a folder of this machine in local mode, and an error on a cluster."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = f"file:///tmp/checkpoints/{uuid.uuid4().hex}"
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{_folder.get() or shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def run(spark: SparkSession, tag: str = "run") -> Iterator[str]:
    """Everything that is saved within goes below one folder, which is deleted at the end, whether the job fails or not. Write results elsewhere before it ends: tables made within can't be read after it."""
    at = new_path(spark, tag)
    token = _folder.set(at)
    try:
        yield at
    finally:
        _folder.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def save(df: DataFrame, tag: str, by: str | None = None) -> DataFrame:
    """df as a table in the shared folder, read back: lineage ends there and survives lost executors. by: a column with a folder for each value (few), so that reading some values opens only their files."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    if by is None:
        df.write.parquet(path)
    else:
        df.repartition(by).write.partitionBy(by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete saved tables that nothing will read again."""
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
