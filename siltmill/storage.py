"""Tables written in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir. Where it is unset, a folder of this process, but only for a session whose
    tasks run in this very process: executors elsewhere would not find what others wrote there."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="siltmill-")
    return _own[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that goes when the driver's Python ends, or with the scratch() around it."""
    path = f"{shared_dir(spark)}/siltmill/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def written(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends here and a lost executor costs no recomputation.

    narrow: rows of a few dozen bytes, which go to an eighth of the usual number of files.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    out = df.coalesce(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)) if narrow else df
    out.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that name, on any store that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The store and the folder in it that a path or URL names, for tasks that open single files by key."""
    if path.startswith("file:/") and not path.startswith("file://"):  # as Spark names local files, with signs that a URL would escape
        return fs.LocalFileSystem(), path.removeprefix("file:")
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")


@contextmanager
def scratch() -> Iterator[None]:
    """Removes on leaving what is written inside. Results that read such tables must be saved or collected by then; a
    session that runs many jobs so keeps its folder small."""
    first = len(_written)
    try:
        yield
    finally:
        _clear(first)


def _clear(first: int = 0) -> None:
    while len(_written) > first:
        _remove(*_written.pop())


def _remove(spark: SparkSession, path: str) -> None:
    try:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the JVM may be gone by now
        return


atexit.register(_clear)
