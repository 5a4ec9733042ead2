"""Shared scratch space for results that must be fixed before they are used twice."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, types as T

PACKED = "zstd"  # codec of whole tables on disk
SPLIT_BYTES = 8 << 20  # of a packed table in one reading task; its rows, once per copy, are many times that in memory

_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own; on a cluster every
    executor has to see the same place, so there the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="nestloom-")
    return _LOCAL_FOLDERS[app]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/nestloom/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` once and continue from the written table.

    Cuts the lineage: later uses read the same rows even if executors are lost in between, and read
    only the columns they need.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    names = {k: k.replace("__", ".") for k in values}
    before = {n: spark.conf.get(n, None) for n in names.values()}
    try:
        for k, n in names.items():
            spark.conf.set(n, values[k])
        yield
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


@contextlib.contextmanager
def written(df: DataFrame, label: str = "cut") -> Iterator[DataFrame]:
    """Like ``materialize`` for the length of a block; the files go when it ends. Packed tightly, as whole tables pass here.

    However few or large the files are, a task of the block reads ``SPLIT_BYTES``: a shuffle to more partitions than
    ``spark.shuffle.sort.bypassMergeThreshold`` holds all rows of its task, or spills them.
    """
    path = new_path(df.sparkSession, label)
    try:
        df.write.option("compression", PACKED).option("parquet.block.size", SPLIT_BYTES // 2).parquet(path)
        with settings(df.sparkSession, spark__sql__files__maxPartitionBytes=str(SPLIT_BYTES)):
            yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove_folder(df.sparkSession, path)


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def path_exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Parquet under ``path``, or no rows if nothing was written there yet."""
    files, folder = _folder(spark, path)
    if files.exists(folder):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def subfolders(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column, from the folder names ``column=value`` under ``path``."""
    files, folder = _folder(spark, path)
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def fingerprint(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of all files under a folder: what a result derived from them depends on."""
    files, folder = _folder(spark, path)
    found, listed = [], files.listFiles(folder, True)
    while listed.hasNext():
        f = listed.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def remove_folder(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)
