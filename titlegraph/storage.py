"""Tables written on the way, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where that is unset, a folder of our own, if all runs on one machine; else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _OWN:
        _OWN.append("file://" + tempfile.mkdtemp(prefix="titlegraph-"))
    return _OWN[0]


def arrow_file(path: str):
    """pyarrow's file system of a path or URI, such as file:/a, and the place in it; for use in tasks."""
    from pyarrow import fs

    if "://" not in path:
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/titlegraph/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str, reader: SparkSession | None = None) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends there, and a lost executor loses nothing."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return (reader or df.sparkSession).read.schema(df.schema).parquet(path)


def _file(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    store, at = _file(spark, path)
    return store.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder or file, if there is one."""
    store, at = _file(spark, path)
    store.delete(at, True)


def drop(spark: SparkSession, df: DataFrame) -> None:
    """Deletes the files behind a cut() that nothing reads any more."""
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        delete(spark, f)
