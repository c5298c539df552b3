"""Operator 12: exact copies, by stateful streaming deduplication. Built-in functions only.

1. A stream reads the files of a folder, each once, whenever it runs (available-now trigger, files a batch bounded). Its
   state, on disk (RocksDB, with its changes in the shared folder) and without expiry, holds for each digest of a
   normalised text how many rows have it and the row that stays: its doc_id and its content's locator, file and row.
   Copies are counted on the map side, so a text that a third of the rows share reaches its state as a row a task.
2. The state is read back as a table of groups. Rows whose digest others share are hits: each is compared, byte by byte,
   with the text at its group's locator. Large groups are spread over tasks by salts.
3. A digest under which different texts stand (with SHA-256 none is expected) is grouped by the texts themselves.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..storage import delete, exists
from .common import Tables, cut, scratch
from .contents import replicated, salted, salts, sha256, small

#: Files that a batch of the stream reads at most.
FILES = 10_000
#: The state store of the stream: on disk, its memory bounded for all partitions of an executor together.
STATE = {
    "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "rocksdb.changelogCheckpointing.enabled": "true",
    "rocksdb.boundedMemoryUsage": "true",
    "rocksdb.maxMemoryUsageMB": "128",
    # without it each partition holds a manifest of 4 MB on disk, mostly empty
    "rocksdb.allowFAllocate": "false",
}


def normal(text: Column) -> Column:
    """A-Z lower-cased, nothing else; null is empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def _pattern(path: str) -> str:
    """A glob that matches only this path; the stream's source takes a single file only as one."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def _rows(source: DataFrame, digest: Callable[[Column], Column], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, digest, at): the normalised text, its digest, and the row's id with its place."""
    at = F.struct(F.col(id_col).alias("doc_id"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("row"))
    return source.select(F.col(id_col).alias("doc_id"), normal(F.col(text_col)).alias("text"), at.alias("at")).withColumn("digest", digest(F.col("text")))


def ingest(spark: SparkSession, path: str, state: str, schema: StructType, digest: Callable[[Column], Column] = sha256, id_col: str = "doc_id", text_col: str = "text", files: int = FILES) -> StreamingQuery:
    """Takes the Parquet files at path that the state has not seen into it. A run that fails goes on where it stopped."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if k.startswith("spark.sql.") and own.conf.isModifiable(k):
            own.conf.set(k, v)
    for k, v in STATE.items():
        own.conf.set(f"spark.sql.streaming.stateStore.{k}", v)
    source = own.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(_pattern(path))
    groups = _rows(source, digest, id_col, text_col).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("at").alias("keep"))
    return groups.writeStream.outputMode("update").format("noop").option("checkpointLocation", state).trigger(availableNow=True).start()


def groups(spark: SparkSession, state: str, id_type: str = "long") -> DataFrame:
    """(digest, n, keep (doc_id, path, row)) of all that was taken into the state so far."""
    if not exists(spark, f"{state}/commits/0"):
        return spark.createDataFrame([], f"digest binary, n long, keep struct<doc_id:{id_type},path:string,row:long>")
    return spark.read.format("statestore").load(state).select("key.digest", F.col("value.count").alias("n"), F.col("value.max").alias("keep"))


def decide(spark: SparkSession, path: str, known: DataFrame, schema: StructType, tables: Tables, digest: Callable[[Column], Column] = sha256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row at path; known is groups(), written."""
    docs = _rows(spark.read.schema(schema).parquet(path), digest, id_col, text_col)
    total = known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    large = salts(known, total)
    rows = docs.select("doc_id", "digest", "at", F.sha2("text", 256).alias("text_sha256"))
    found = salted(rows, large, F.col("at")).join(replicated(known, large), ["digest", "salt"])
    # hits: rows whose digest others share, against the text at the locator of the one that stays
    repeated = tables.cut(known.where("n > 1"), "repeated-digests")
    hits = tables.cut(docs.join(small(repeated), "digest"), "hits")
    kept = hits.where(F.col("at") == F.col("keep")).select("digest", F.col("text").alias("kept_text"))
    mine = salted(hits.select("digest", "text", "at"), large, F.col("at"))
    compared = mine.join(replicated(kept, large), ["digest", "salt"], "left")
    odd = tables.cut(compared.where(F.col("kept_text").isNull() | (F.col("kept_text") != F.col("text"))).select("digest").distinct(), "several-texts")
    result = lambda df: df.select("doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("at") == F.col("keep")).alias("kept"), "text_sha256")
    if odd.isEmpty():
        return result(found)
    several = hits.drop("keep", "n").join(small(odd), "digest", "left_semi")
    exact = several.groupBy("text").agg(F.count(F.lit(1)).alias("n"), F.max("at").alias("keep"))
    return result(found.join(small(odd), "digest", "left_anti")).unionByName(result(several.withColumn("text_sha256", F.sha2("text", 256)).join(exact, "text")))


def exact_duplicates(spark: SparkSession, path: str, digest: Callable[[Column], Column] = sha256, id_col: str = "doc_id", text_col: str = "text", state: str | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): a row for each row of the Parquet files at path.

    Texts are equal if they are after lower-casing A-Z; a null text counts as empty. Of equal ones the row with the largest
    doc_id stays, a null doc_id counting as less than any; of rows that repeat that doc_id too, one stays (the last by file
    and place in it), so each group has exactly one row with kept. Other columns are not looked at, whatever their names.
    Texts of any length are compared whole. An empty table gives no rows.

    state: a folder whose state is kept, for corpora that grow: files seen earlier are not read into it again.
    """
    schema = spark.read.parquet(path).select(id_col, text_col).schema
    own = state or scratch(spark, "exact-dedup-state")
    ingest(spark, path, own, schema, digest, id_col, text_col).awaitTermination()
    tables = Tables(spark)
    known = tables.cut(groups(spark, own, schema[id_col].dataType.simpleString()), "groups")
    out = cut(decide(spark, path, known, schema, tables, digest, id_col, text_col), "exact-dedup")
    tables.drop()
    if state is None:
        delete(spark, own)
    return out
