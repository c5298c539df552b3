"""Names, patterns, relations, facts: what annotators call at run time."""

from __future__ import annotations

import re
import unicodedata
import xml.etree.ElementTree as ET

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..functions.constants import PATTERN_RANKS
from ..functions.text import nfc, trim


def segment(name: Column, surnames: list[str]) -> Column:
    """struct(family, given) by the first surname, in list order, that is a proper prefix; null for names of one
    character or of other than CJK ideographs. surnames: longest first."""
    own = trim(nfc(name))
    pattern = "^(" + "|".join(r"\Q" + s.replace(r"\E", "") + r"\E" for s in surnames) + r")(.+)\z"
    fits = own.rlike(r"^[\x{4E00}-\x{9FFF}]{2,}\z") & own.rlike(pattern)
    return F.when(fits, F.struct(F.regexp_extract(own, pattern, 1).alias("family"), F.regexp_extract(own, pattern, 2).alias("given")))


def segment_by_join(names: DataFrame, surnames: DataFrame, name: str = "name") -> DataFrame:
    """names with family and given, for surname tables (pos, surname) too large for a pattern: prefixes, then an equi-join."""
    own = names.withColumn("__own", trim(nfc(F.col(name))))
    fits = F.col("__own").rlike(r"^[\x{4E00}-\x{9FFF}]{2,}\z")
    prefixes = own.where(fits).select("__own").distinct().select("__own", F.explode(F.transform(F.sequence(F.lit(1), F.length("__own") - 1), lambda n: F.substring(F.col("__own"), F.lit(1), n))).alias("surname"))
    best = prefixes.join(surnames, "surname").groupBy("__own").agg(F.min_by("surname", "pos").alias("family"))
    return own.join(best, "__own", "left").withColumn("given", F.substring("__own", F.length("family") + 1, F.length("__own"))).drop("__own")


def romanized(split: Column, family: Column, given: Column, whole: Column) -> Column:
    """'Family Given' from the romanised parts; the one there is; else the whole name's."""
    joined = F.concat_ws(" ", F.nullif(family, F.lit("")), F.nullif(given, F.lit("")))
    return F.when(split.isNull(), whole).otherwise(F.coalesce(F.nullif(joined, F.lit("")), whole))


def patterns(suffixes: DataFrame, surnames: DataFrame, source: str = "pattern") -> DataFrame:
    """Candidates for every princely rank among suffixes (pos, string) with every surname (pos, surname)."""
    ranks = suffixes.where(F.col("string").isin(PATTERN_RANKS)).select(F.col("pos").alias("rank_pos"), F.col("string").alias("rank"))
    # the ranks, at most six, are an array on each surname's row
    held = ranks.groupBy().agg(F.array_sort(F.collect_list(F.struct("rank_pos", "rank"))).alias("r")).first()
    rows = surnames.select(F.col("pos").alias("surname_pos"), "surname", F.explode(F.array(*[F.struct(F.lit(x.rank_pos).alias("rank_pos"), F.lit(x.rank).alias("rank")) for x in held.r]) if held.r else F.array().cast("array<struct<rank_pos:int,rank:string>>")).alias("x"))
    own = F.concat_ws(":", F.lit("pattern"), F.col("x.rank"), F.col("surname"))
    return rows.select("x.rank_pos", "surname_pos", F.lit(source).alias("source"), own.alias("authorityId"), F.lit("person").alias("kind"), F.col("surname").alias("primaryName"), F.array(F.concat("x.rank", "surname")).alias("searchStrings"), F.struct(own.alias("personId"), own.alias("titleRowId"), F.struct(F.col("x.rank").alias("roleName"), F.col("surname").alias("persName")).alias("components")).alias("wrapper"))


def office_relations(annotations: DataFrame, source: str, max_gap: int = 0) -> DataFrame:
    """Parent and child of adjacent offices (doc_id, start, end, source, authorityId, kind, followsOffice) where the second,
    of the given source, follows an office."""
    later = F.lead(F.struct("start", "source", "authorityId", "kind", "followsOffice")).over(Window.partitionBy("doc_id").orderBy("start", "end", "authorityId"))
    pairs = annotations.withColumn("next", later).where((F.col("kind") == "office") & (F.col("next.kind") == "office") & (F.lower("next.source") == source.lower()) & F.col("next.followsOffice") & (F.col("next.start") - F.col("end") <= max_gap) & (F.col("next.start") >= F.col("end")))
    return pairs.select("doc_id", F.lit(source).alias("source"), F.lit("office-concatenation").alias("rule"), F.array(F.col("authorityId").cast("string"), F.col("next.authorityId").cast("string")).alias("sourceIds"), F.lit("inferred").alias("confidence"))


FACTS = "pos int, element string, value string, ref string, children array<struct<element:string,value:string,ref:string>>"


def facts_of(xml: str | None) -> list[tuple]:
    """The facts of a person wrapper, by kind, then in document order; blank ones and broken XML give none."""
    try:
        root = ET.fromstring(xml or "")
    except ET.ParseError:
        return []
    local = lambda e: e.tag.rsplit("}", 1)[-1]
    text = lambda e: "".join(e.itertext()).strip()
    out: list[tuple] = []
    for tag, element in (("nationality", "nationality"), ("placeOfOrigin", "placeName"), ("officeName", "state"), ("nobleTitle", "nobleTitle")):
        for e in root.iter():
            if local(e) != tag or e is root or not text(e):
                continue
            children = []
            if tag == "nobleTitle":
                for kind, wanted in (("placeName", None), ("roleName", None), ("persName", "posthumous")):
                    hit = next((c for c in e.iter() if c is not e and local(c) == kind and (wanted is None or c.get("type") == wanted)), None)
                    if hit is not None:
                        children.append((kind, text(hit), hit.get("ref")))
            out.append((len(out), element, text(e), e.get("ref"), children))
    return out


class Facts:
    """Table function: facts(xml)."""

    def eval(self, xml: str):
        yield from facts_of(xml)


RELATION = "doc_id string, source string, rule string, sourceIds array<string>, confidence string"


class OfficeRelations:
    """Table function: office_relations(TABLE(t) PARTITION BY doc_id ORDER BY (start, end), source, max_gap)."""

    def __init__(self):
        self.last = None

    def eval(self, row: Row, source: str, max_gap: int):
        last, self.last = self.last, row
        if last is None or last["kind"] != "office" or row["kind"] != "office" or (row["source"] or "").lower() != source.lower() or not row["followsOffice"]:
            return
        if last["end"] is not None and row["start"] is not None and 0 <= row["start"] - last["end"] <= max_gap:
            yield str(row["doc_id"]), source, "office-concatenation", [None if x is None else str(x) for x in (last["authorityId"], row["authorityId"])], "inferred"


class NamePatterns:
    """Table function: name_patterns(TABLE(t), array of ranks): every princely rank of the array with every surname of t."""

    @staticmethod
    def analyze(row: AnalyzeArgument, ranks: AnalyzeArgument) -> AnalyzeResult:
        if not row.isTable or not isinstance(row.dataType, StructType) or "surname" not in row.dataType.names:
            raise ValueError("the first argument must be a table with a column surname")
        if not isinstance(ranks.dataType, ArrayType):
            raise ValueError("the second argument must be an array of ranks")
        return AnalyzeResult(StructType().add("rank", "string").add("surname", row.dataType["surname"].dataType).add("authorityId", "string").add("searchString", "string"))

    def eval(self, row: Row, ranks: list[str]):
        for rank in ranks:
            if rank in PATTERN_RANKS and row["surname"] is not None:
                yield rank, row["surname"], f"pattern:{rank}:{row['surname']}", f"{rank}{row['surname']}"


def segmenter(surnames: list[str]):
    """A scalar function for SQL: struct(family, given) as of segment(), null where there is no split."""
    pattern = re.compile("(" + "|".join(map(re.escape, surnames)) + ")(.+)", re.S)

    @F.arrow_udf(StructType().add("family", "string").add("given", "string"))
    def segment_name(name: pa.Array) -> pa.Array:
        out = []
        for x in name.to_pylist():
            own = None if x is None else re.sub(r"^[\s\ufeff]+|[\s\ufeff]+\Z", "", unicodedata.normalize("NFC", x))
            m = pattern.fullmatch(own) if own and len(own) > 1 and all("\u4e00" <= c <= "\u9fff" for c in own) else None
            out.append(m and {"family": m.group(1), "given": m.group(2)})
        return pa.array(out, pa.struct([("family", pa.string()), ("given", pa.string())]))

    return segment_name


def register(spark: SparkSession, surnames: list[str] | None = None) -> None:
    """Registers what annotators call from SQL: the table functions facts(xml), office_relations(table, source, max_gap) and
    name_patterns(table, ranks), and with surnames, longest first, the function segment_name(name)."""
    spark.udtf.register("facts", F.udtf(Facts, returnType=FACTS))
    spark.udtf.register("office_relations", F.udtf(OfficeRelations, returnType=RELATION))
    spark.udtf.register("name_patterns", F.udtf(NamePatterns))
    if surnames:
        spark.udf.register("segment_name", segmenter(surnames))


def occurrences(entries: DataFrame, doc: str, entry: str, position: str) -> DataFrame:
    """entries with occurrence_index in their document, and form: full at first, short after."""
    n = F.row_number().over(Window.partitionBy(doc, entry).orderBy(position))
    return entries.withColumn("occurrence_index", n).withColumn("form", F.when(n == 1, "full").otherwise("short"))


def renumber(numbered: DataFrame, deleted: DataFrame, doc: str, entry: str, position: str) -> DataFrame:
    """occurrences() after rows are deleted: numbered without those in deleted (doc, entry, position).

    Only groups that lose a row are numbered again; all others pass as they are, without a shuffle where the table of groups
    that lose one is small enough to be broadcast.
    """
    touched = deleted.select(F.col(doc).alias("__doc"), F.col(entry).alias("__entry")).distinct()
    same = F.col(doc).eqNullSafe(F.col("__doc")) & F.col(entry).eqNullSafe(F.col("__entry"))
    gone = deleted.select(F.col(doc).alias("__doc"), F.col(entry).alias("__entry"), F.col(position).alias("__at"))
    left = numbered.join(touched, same, "left_semi").join(gone, same & F.col(position).eqNullSafe(F.col("__at")), "left_anti")
    again = occurrences(left.drop("occurrence_index", "form"), doc, entry, position)
    return numbered.join(touched, same, "left_anti").unionByName(again.select(*numbered.columns))


def search(table: DataFrame, columns: list[str], text: str, limit: int = 20, offset: int = 0, order: str | None = None) -> DataFrame:
    """Rows of which any column contains the text, whatever its accents, case and spaces: a page of the result."""
    plain = lambda c: F.replace(F.lower(c), F.lit(" "), F.lit(""))
    wanted = re.sub(" ", "", text).lower()
    hit = None
    for c in columns:
        one = F.contains(F.collate(plain(F.col(c).cast("string")), "UNICODE_CI_AI"), F.collate(F.lit(wanted), "UNICODE_CI_AI"))
        hit = one if hit is None else hit | one
    return table.where(hit).orderBy(order or columns[0]).offset(offset).limit(limit)


def missing_ids(entries: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """entries with `missing`: whether the table lacks their id."""
    known = table.select(F.col(key).alias("__k")).distinct()
    return entries.join(known, entries[key] == F.col("__k"), "left").withColumn("missing", F.col("__k").isNull()).drop("__k")


def pending(titles: DataFrame, done: DataFrame, key: str = "title") -> DataFrame:
    """Titles that are not done."""
    return titles.join(done.select(key).distinct(), key, "left_anti")
