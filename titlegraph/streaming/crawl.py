"""Incremental ingest: pages that arrive in a folder, each parsed once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.names import pending
from ..operators.wikitext import ingest
from ..sources import wiki_api

#: The state store of streams: on disk, its memory bounded, and without manifests of 4 MB for each partition.
STATE = {"providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "rocksdb.changelogCheckpointing.enabled": "true", "rocksdb.boundedMemoryUsage": "true", "rocksdb.allowFAllocate": "false"}
PAGES = "title string, wikitext string, pageId long, url string, wikidataId string"


def ingest_stream(spark: SparkSession, source: str, target: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Parses all NDJSON pages that have arrived since the last call and appends their holder rows to a Parquet table.

    The checkpoint remembers what was read. A batch that is run again after a failure overwrites its own folder, so no row
    is written twice. Lines that are no JSON, pages without a title and files that cannot be read give nothing.

    once: a title that comes again, in whatever file and run, is not parsed again. The titles that were seen are the
    stream's state, on disk and without expiry; of pages of one title that arrive in one batch any one counts.
    """
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if k.startswith("spark.sql.") and own.conf.isModifiable(k):
            own.conf.set(k, v)
    for k, v in STATE.items():
        own.conf.set(f"spark.sql.streaming.stateStore.{k}", v)
    pages = own.readStream.schema(PAGES).option("ignoreCorruptFiles", True).json(source).where("title is not null")
    if once:
        pages = pages.dropDuplicates(["title"])

    def write(batch: DataFrame, number: int) -> None:
        ingest(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def resume(titles: DataFrame, processed: DataFrame | None) -> DataFrame:
    """Titles still to be fetched; all of them without a table of processed ones."""
    return titles if processed is None else pending(titles, processed)


def crawl_category(spark: SparkSession, options: dict, target: str, checkpoint: str, batch: int = 50) -> StreamingQuery:
    """Crawls a category: titles as a stream, their pages fetched, answers about them appended to a Parquet table.

    options are those of the source wikicategory. The checkpoint holds the API's continuation token, so a crawl that was
    stopped goes on in the middle of the category. A batch that is run again overwrites its own folder.
    """
    wiki_api.register(spark)
    reader = spark.readStream.format("wikicategory")
    for k, v in options.items():
        reader = reader.option(k, v)

    def write(titles: DataFrame, number: int) -> None:
        wiki_api.fetch_pages(titles, options, batch=batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return reader.load().writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()
