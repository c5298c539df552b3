"""Authority records: search strings, wiki records, canonical records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, first_of
from .review import number

#: The forms of a title, in order: fief F, posthumous name P, its short form A, rank N, person H, dynasty D. A leading '-'
#: wants the fief empty, a leading '!' a dynasty other than the fief.
FORMS = ["FPN", "FN", "FPNH", "FNH", "-PN", "-PNH", "FAN", "FANH", "-AN", "-ANH", "!DFPN", "!DFPNH", "-DPN", "-DPNH", "!DFAN", "!DFANH", "-DAN", "-DANH"]


def search_strings(fief: Column, pn: Column, short_pn: Column, nt: Column, person: Column, dyn: Column) -> Column:
    """The distinct forms of a title whose parts are all present; the first of equal ones counts."""
    part = dict(zip("FPANHD", map(blank_to_null, (fief, pn, short_pn, nt, person, dyn)), strict=True))
    out = []
    for form in FORMS:
        value = F.concat(*[part[c] for c in form if c in part])  # null if any is
        if form[0] == "-":
            value = F.when(part["F"].isNull(), value)
        elif form[0] == "!":
            value = F.when(part["D"] != part["F"], value)
        out.append(value)
    return F.array_distinct(F.array_compact(F.array(*out)))


def match_key(*parts: Column) -> Column:
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def _record(df: DataFrame, source: str, prefix: str, person_ref: Column) -> DataFrame:
    """The columns that wiki and canonical records share; df has n, strings and the title's parts."""
    row = F.concat(F.lit("wnt-"), F.format_string("%04d", F.col("n")))
    person = blank_to_null(F.col("person"))
    wrapper = F.when(person_ref.isNotNull() & person.isNotNull(), F.struct(person_ref.alias("personId"), row.alias("titleRowId"), F.struct(F.col("fief"), F.col("nt").alias("roleName"), F.col("pn").alias("posthumousName"), person.alias("persName")).alias("components")))
    ends = lambda s: F.endswith(s, person)
    empty = F.array().cast("array<string>")
    meta = F.struct(
        F.lit(True).alias("isNobleTitle"), F.when(wrapper.isNull(), "nobleTitle").alias("teiTag"), first_of(F.col("sourcePageUrl"), F.col("sourcePage")).alias("sourceRef"), F.col("dyn").alias("dynasty"),
        F.col("metaStart").alias("startYear"), F.col("metaEnd").alias("endYear"), F.struct(F.when(F.col("wikidataId") != "", F.array("wikidataId")).alias("wikidata"), F.col("dbPerson").alias("db")).alias("crosswalk"),
        wrapper.alias("wrapper"), F.when(person.isNotNull(), F.filter("strings", ends)).otherwise(empty).alias("wrapperSearchStrings"),
        F.when(person.isNotNull(), F.filter("strings", lambda s: ~ends(s))).otherwise(F.col("strings")).alias("titleSearchStrings"),
        F.struct("fief", F.col("nt").alias("roleName"), F.col("pn").alias("posthumousName")).alias("nobleTitle"),
    )
    title = F.concat_ws("", "fief", "pn", "nt")
    return df.select(
        row.alias("id"), F.lit(source).alias("source"), F.concat(F.lit(prefix), F.format_string("%04d", F.col("n"))).alias("authorityId"), F.lit("person").alias("kind"), first_of(person, title, F.col("sourcePage")).alias("primaryName"),
        "action", match_key(F.col("dyn"), F.col("fief"), F.col("pn"), F.col("nt"), person).alias("matchKey"), F.col("strings").alias("searchStrings"),
        F.when(person.isNotNull(), F.array(F.struct(person.alias("text"), F.lit("wrapper-person").alias("type")))).otherwise(F.array().cast("array<struct<text:string,type:string>>")).alias("names"),
        "wiki", "db", "proposedNt", F.col("reviewer_notes").alias("reviewerNotes"), meta.alias("metadata"),
    )


def wiki_records(plans: DataFrame, order: list[str], source: str = "wiki", prefix: str = "wiki-nt:") -> DataFrame:
    """Asset records of plans (see review.plan), numbered over those that are emitted: not skipped, with any string."""
    df = plans.where("action <> 'skip'").withColumn("action", F.when(F.col("action") == "link_title", "title_only").otherwise(F.col("action")))
    df = df.withColumn("person", F.col("personBare")).withColumn("strings", search_strings(F.col("fief"), F.col("pn"), F.lit(None).cast("string"), F.col("nt"), F.col("person"), F.col("dyn")))
    df = number(df.where(F.size("strings") > 0), order, "n")
    nonzero = lambda c: F.when(F.coalesce(F.col(c), F.lit(0)) != 0, F.col(c).cast("string"))
    df = df.withColumn("dbPerson", nonzero("personId")).withColumn("dbTitle", nonzero("ntInd"))
    linked = F.col("dbPerson").isNotNull() | F.col("dbTitle").isNotNull()
    wiki = F.struct("sourcePage", "sourcePageId", "sourcePageUrl", "sourceWikidataId", "dynastySection", "dyn", "fief", "pn", "nt", "person", "startYear", "endYear", "wikidataId", "wikiPersonUrl")
    db = F.struct(F.col("dbPerson").alias("personId"), F.col("dbTitle").alias("ntInd"), F.coalesce("db.can_name", "person").alias("canName"), F.coalesce("db.dyn", "dyn").alias("dyn"), F.col("db.fief").alias("fief"), F.col("db.pn").alias("pn"), F.col("db.nt").alias("nt"), F.coalesce("db.dyn_id", "dynId").alias("dynId"), F.col("db.start_year").alias("startYear"), F.col("db.end_year").alias("endYear"))
    df = df.withColumn("wiki", wiki).withColumn("db", F.when(linked, db)).withColumn("proposedNt", F.when(F.col("action").isin("insert_nt", "update_nt"), F.struct("dyn", "fief", "pn", "nt", "dynId", "startYear", "endYear")))
    df = df.withColumn("metaStart", F.col("startYear")).withColumn("metaEnd", F.col("endYear"))
    return _record(df, source, prefix, F.coalesce("dbPerson", F.when(F.col("wikidataId") != "", F.concat(F.lit("wikidata:"), F.col("wikidataId")))))


def pack_names(pack: DataFrame) -> DataFrame:
    """(person_id, primary, display) from a persons pack; the last of an id counts."""
    order = "row_pos" if "row_pos" in pack.columns else "authorityId"
    primary = F.coalesce(F.get(F.filter("names", lambda x: x["type"] == "primary"), F.lit(0))["text"], F.col("primaryName"))
    return pack.groupBy(F.col("authorityId").cast("string").alias("pid")).agg(F.max_by(primary, F.col(order)).alias("primary"), F.max_by(F.coalesce("displayName", primary), F.col(order)).alias("display"))


def canonical_records(titles: DataFrame, names: DataFrame, covered: DataFrame, start: int = 0, source: str = "direct", prefix: str = "direct-nt:", note: str = "from the title table") -> DataFrame:
    """Records of titles whose (person_id, ind) no record covers, numbered after `start`, in table order.

    An empress title 后 without fief and posthumous name takes both from a display name that ends in 皇后. Titles without
    a rank, or without any search string, give none.
    """
    key = [F.col("person_id").cast("string").alias("personId"), F.col("ind").cast("string").alias("ntInd")]
    df = titles.withColumns({"personId": key[0], "ntInd": key[1]}).join(covered.select("personId", "ntInd").distinct(), ["personId", "ntInd"], "left_anti").where(F.col("nt") != "")
    df = df.join(names, F.col("personId") == F.col("pid"), "left")
    empress = (F.col("nt") == "后") & (F.coalesce("fief", F.lit("")) == "") & (F.coalesce("pn", F.lit("")) == "") & F.endswith("display", F.lit("皇后"))
    df = df.withColumn("empress", F.coalesce(empress, F.lit(False)))
    df = df.withColumn("pn", F.when(F.col("empress"), F.substring("display", F.lit(1), F.length("display") - 2)).otherwise(F.col("pn"))).withColumn("nt", F.when(F.col("empress"), "皇后").otherwise(F.col("nt")))
    df = df.withColumn("person", F.when(~F.col("empress"), F.col("primary")))
    df = df.withColumn("strings", search_strings(F.col("fief"), F.col("pn"), F.col("pn_abr"), F.col("nt"), F.col("person"), F.col("dyn")))
    df = number(df.where(F.size("strings") > 0), ["row_pos"], "n", start + 1)
    none = F.lit(None)
    df = df.withColumns({
        "action": F.lit("canonical"), "dbPerson": F.col("personId"), "wiki": none.cast("string"), "proposedNt": none.cast("string"), "reviewer_notes": F.lit(note), "sourcePage": none.cast("string"), "sourcePageUrl": none.cast("string"), "wikidataId": none.cast("string"), "metaStart": none.cast("int"), "metaEnd": none.cast("int"),
        "db": F.struct("personId", "ntInd", F.coalesce("primary", "display").alias("canName"), "dyn", "fief", "pn", "pn_abr", "nt", F.col("dyn_id").alias("dynId"), F.col("start_year").alias("startYear"), F.col("end_year").alias("endYear")),
    })
    return _record(df, source, prefix, F.col("personId"))


def covered_keys(records: DataFrame) -> DataFrame:
    """(personId, ntInd) that records link."""
    return records.select("db.personId", "db.ntInd").where("personId is not null and ntInd is not null").distinct()


def without_source(records: DataFrame, source: str) -> DataFrame:
    """Drops the records of an earlier canonical run."""
    return records.where(~F.coalesce(F.col("source") == source, F.lit(False)))


def envelope(records: DataFrame, asset_id: str, version: str, compiled_at: str, license: str, attribution: str) -> DataFrame:
    """One row about the records: their number, and their number by action. The records stay a table beside it."""
    counts = records.groupBy("action").agg(F.count(F.lit(1)).alias("n"))  # a row for each action
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("recordCount"), F.map_from_entries(F.collect_list(F.struct("action", "n"))).alias("actionCounts")).select(F.lit(asset_id).alias("id"), F.lit(version).alias("assetVersion"), F.lit(compiled_at).alias("compiledAt"), F.lit(license).alias("license"), F.lit(attribution).alias("attribution"), "recordCount", "actionCounts")


def append_records(base: DataFrame, more: DataFrame) -> DataFrame:
    """Records of an asset with those of a later run behind them; columns that one of them lacks are null."""
    return base.unionByName(more, allowMissingColumns=True)


def bundled_paths(own: Column, packs: Column) -> Column:
    """The paths that a release bundles: its own and its packs', each once, in the order in which they are first told."""
    empty = F.array().cast("array<string>")
    return F.array_compact(F.array_distinct(F.concat(F.coalesce(own, empty), F.coalesce(packs, empty))))
