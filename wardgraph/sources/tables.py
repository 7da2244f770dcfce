"""Tables in the folder that the driver and all executors see."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or in local mode, as in tests, a new folder of our own if it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="wardgraph-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


#: Paths written inside each scratch() that is open.
_OPEN: list[list[str]] = []


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet; it goes when the session ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    at, fs = _at(spark, path)
    fs.deleteOnExit(at)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are written inside go at its end, but those that are to be kept."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            at, fs = _at(spark, path)
            fs.delete(at, True)


def written(df: DataFrame, name: str, keep: bool = False, compression: str | None = None) -> DataFrame:
    """df as a table in the shared folder: its lineage is cut, and a lost executor costs nothing. keep: beyond the scratch()
    it is written in. compression: another than the session's."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    inside = _OPEN[:-1] if keep else _OPEN
    if inside:
        inside[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a partition, about, where their number is told by that of the rows.
PART_ROWS = 1_000_000


def partitions(spark: SparkSession, rows: int) -> int:
    """Partitions for so many rows, not fewer than Spark's own number: what a task holds does not grow with the input."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // PART_ROWS))
