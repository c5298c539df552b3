"""Files of the pipeline: NDJSON, CSV, packs, and what is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HOLDER = "source string, sourcePage string, dynastySection string, rawLine string, fief string, pn string, nt string, person string, wikiPersonTitle string, startYear int, endYear int, confidence string, needsReview boolean, sourcePageId long, sourcePageUrl string, sourceWikidataId string, wikiPersonPageId long, wikiPersonUrl string, wikidataId string"
CRAWL_COLUMNS = ["sourcePage", "sourcePageId", "sourcePageUrl", "sourceWikidataId", "dynastySection", "fief", "pn", "nt", "person", "wikiPersonTitle", "wikiPersonPageId", "wikiPersonUrl", "wikidataId", "startYear", "endYear", "confidence", "needsReview", "rawLine", "source"]
PACK = "authorityId string, displayName string, primaryName string, names array<struct<type:string,text:string>>"


def read_ndjson(spark: SparkSession, path: str, schema: str = HOLDER) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_ndjson_numbered(spark: SparkSession, path: str, schema: str = HOLDER) -> DataFrame:
    """With row_pos, the line's place, and review_id: the row's own, else row_pos + 1. Lines keep their order by file
    name, file block and place in it; numbers come from the counts of the partitions before."""
    lines = spark.read.text(path).where(F.trim("value") != "").withColumn("f", F.col("_metadata.file_path")).withColumn("b", F.col("_metadata.file_block_start")).withColumn("i", F.monotonically_increasing_id())
    sizes = lines.groupBy("f", "b").agg(F.count(F.lit(1)).alias("size"), F.min("i").alias("low"))  # a row for each block
    order = Window.orderBy("f", "b").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("f", "b", F.coalesce(F.sum("size").over(order), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("f", "b").orderBy("i")) - 1
    # both are dealt by block already
    rows = lines.withColumn("n", inside).join(before, ["f", "b"]).withColumn("row_pos", F.col("before") + F.col("n"))
    parsed = rows.select("row_pos", F.from_json("value", f"{schema}, review_id long").alias("r")).select("row_pos", "r.*")
    return parsed.withColumn("review_id", F.coalesce("review_id", F.col("row_pos") + 1))


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A sheet with quoted cells, records over several lines, and missing cells as empty."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path).na.fill("")


def read_pack(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PACK).json(path)


def read_list(spark: SparkSession, path: str, field: str, element: str = "string") -> DataFrame:
    """(pos, value) of the array in one field of a JSON file."""
    return spark.read.schema(f"`{field}` array<{element}>").option("multiLine", True).json(path).select(F.posexplode(field).alias("pos", "value"))


def read_wikitext(spark: SparkSession, path: str, title: str) -> DataFrame:
    """A local page as (title, wikitext)."""
    return spark.read.text(path, wholetext=True).select(F.lit(title).alias("title"), F.col("value").alias("wikitext"))


def write_ndjson(rows: DataFrame, path: str, source: str | None = None) -> None:
    """One object a line, nulls kept; source fills that column where it is null."""
    if source is not None:
        own = F.col("source") if "source" in rows.columns else F.lit(None).cast("string")
        rows = rows.withColumn("source", F.coalesce(own, F.lit(source)))
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_csv(rows: DataFrame, path: str, columns: list[str] | None = None) -> None:
    rows.select(*(columns or rows.columns)).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def inventory(spark: SparkSession, pattern: str) -> DataFrame:
    """(fileName, bytes, sha256) of files."""
    files = spark.read.format("binaryFile").load(pattern)
    return files.select(F.regexp_extract("path", r"[^/]+\z", 0).alias("fileName"), F.length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"))
