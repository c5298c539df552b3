"""Operator 1: contiguous shards of near-equal bytes, cut from global prefix sums.

Rows are ordered by (text hash, doc_id), so equal texts are neighbours. The order is cut into cells by the hash's top
bits; a cell that weighs more than its share (a hot text) is split by a hash of doc_id. Cell totals are at most
``buckets + 2 * pieces`` rows whatever the input is; their prefix sums are the cells' offsets, and a window inside each
cell gives each row its global byte offset and position. A row goes to shard floor(offset * shards / total); in an
unsplit cell the offset of the row's group of equal texts counts, so small groups stay whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut


def shard_by_bytes(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", buckets: int = 1024, pieces: int = 512) -> DataFrame:
    """One row (doc_id, size, text_crc32, shard, slot) for each row of docs; other columns are ignored.

    A null text counts as no bytes (size 1, crc32 0); an empty table gives no rows; repeated rows each get a slot of
    their own; a null doc_id sorts first. Whatever the order of the input, equal inputs give equal shards.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    row = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
    ).withColumn("b", F.shiftrightunsigned("h", 64 - (buckets.bit_length() - 1)).cast("int"))
    row = cut(row, "shard-rows")
    by_bucket = row.groupBy("b").agg(F.sum("size").alias("bucket_bytes"))
    whole = Window.partitionBy()
    by_bucket = by_bucket.withColumn("split", F.greatest(F.lit(1), F.ceil(F.col("bucket_bytes") * pieces / F.sum("bucket_bytes").over(whole))).cast("int")).select("b", F.when(F.col("split") > 2, F.col("split")).otherwise(1).alias("split"))
    row = row.join(F.broadcast(by_bucket), "b").withColumn("s", F.pmod(F.xxhash64("doc_id"), F.col("split")).cast("int"))
    # at most buckets + 2 * pieces cells
    cell_order = Window.orderBy("b", "s").rowsBetween(Window.unboundedPreceding, -1)
    cells = row.groupBy("b", "s").agg(F.sum("size").alias("cell_bytes"), F.count(F.lit(1)).alias("cell_rows"))
    cells = cells.select("b", "s", F.coalesce(F.sum("cell_bytes").over(cell_order), F.lit(0)).alias("before_bytes"), F.coalesce(F.sum("cell_rows").over(cell_order), F.lit(0)).alias("before_rows"), F.sum("cell_bytes").over(whole).alias("total"))
    inside = Window.partitionBy("b", "s").orderBy("h", "doc_id", "size", "text_crc32")
    row = row.join(F.broadcast(cells), ["b", "s"])
    row = row.withColumn("start", F.col("before_bytes") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).withColumn("at", F.col("before_rows") + F.row_number().over(inside) - 1)
    row = row.withColumn("offset", F.when(F.col("split") == 1, F.min("start").over(Window.partitionBy("b", "s", "h"))).otherwise(F.col("start")))
    row = row.withColumn("shard", F.least(F.lit(shards - 1), F.floor(F.col("offset") * shards / F.col("total"))).cast("int"))
    row = cut(row.select("doc_id", "size", "text_crc32", "shard", "at"), "shard-placed")
    first = row.groupBy("shard").agg(F.min("at").alias("first"))  # a row for each shard
    return row.join(F.broadcast(first), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("at") - F.col("first")).alias("slot"))
