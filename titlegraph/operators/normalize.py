"""Normalising and de-duplicating holder rows; enriching them from page lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import DYNASTIES, MARK_SKIP
from ..functions.text import page_url, translate, without_note
from ..storage import cut
from .wikitext import split_title


def dynasties(section: Column, table: dict[str, list[str]] = DYNASTIES, skip: list[str] = MARK_SKIP) -> Column:
    """Candidate dynasties of a section, in order; an unlisted section is its own; null or a skipped one has none."""
    known = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return F.when(section.isNull() | section.isin(skip), F.array().cast("array<string>")).otherwise(F.coalesce(F.try_element_at(known, section), F.array(section)))


def normalize(rows: DataFrame, characters: dict[str, str] | None = None, order: list[str] | None = None) -> DataFrame:
    """Holder rows with dynCandidates, personBare, fillNotes, skipReason, cleanKey and reviewStatus.

    Names are converted by `characters`; a null fief or rank comes from the page's title. The first row of a cleanKey, by
    `order`, is ready, later ones are duplicates; rows of skipped sections are marked and are nobody's first.
    """
    order = order or ["sourcePage", "line_no"]
    for c in ("sourcePage", "dynastySection", "fief", "pn", "nt", "person"):
        rows = rows.withColumn(c, translate(F.col(c), characters))
    page = split_title(F.col("sourcePage"))
    empty = lambda c: F.coalesce(c, F.lit("")) == ""
    notes = F.array_compact(F.array(F.when(empty(F.col("fief")) & page["fief"].isNotNull(), F.lit("fief←sourcePage")), F.when(empty(F.col("nt")) & page["nt"].isNotNull(), F.lit("nt←sourcePage"))))
    rows = rows.withColumn("fillNotes", F.array_join(notes, "; ")).withColumn("fief", F.coalesce("fief", page["fief"])).withColumn("nt", F.coalesce("nt", page["nt"]))
    rows = rows.withColumn("dynCandidates", dynasties(F.col("dynastySection"))).withColumn("personBare", without_note(F.col("person")))
    rows = rows.withColumn("skipReason", F.when(F.col("dynastySection").isin(MARK_SKIP), F.concat(F.lit("section:"), F.col("dynastySection"))))
    parts = [F.col("sourcePage"), F.get("dynCandidates", F.lit(0)), F.col("fief"), F.col("pn"), F.col("nt"), F.col("personBare"), F.col("startYear").cast("string")]
    rows = rows.withColumn("cleanKey", F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]))
    return mark_duplicates(rows, F.col("cleanKey"), F.col("skipReason").isNotNull(), order)


def mark_duplicates(rows: DataFrame, key: Column, skipped: Column, order: list[str], status: str = "reviewStatus") -> DataFrame:
    """First wins: status ready, duplicate or skip_section; no row goes.

    The first row of a key is found by a minimum, summed on the map side, so that a key with very many rows is no task's
    alone. Rows that are equal in `order` too are told apart by where they were read.
    """
    rows = cut(rows.withColumns({"__key": F.sha2(key, 256), "__skip": skipped, "__m": F.monotonically_increasing_id()}), "marked")
    first = cut(rows.where("not __skip").groupBy("__key").agg(F.min(F.struct(*order, "__m"))["__m"].alias("__first")), "first-of-key")
    out = rows.join(first, "__key", "left")
    return out.withColumn(status, F.when(F.col("__skip"), "skip_section").when(F.col("__m") != F.col("__first"), "duplicate").otherwise("ready")).drop("__key", "__skip", "__m", "__first")


def resolve_redirects(titles: DataFrame, info: DataFrame, redirects: DataFrame) -> DataFrame:
    """info (title, pageId, url, wikidataId) of each distinct title, direct or over one redirect (source, target).

    Of several redirects of a source the last counts, by row_pos where redirects have it.
    """
    titles = titles.distinct()
    hop = redirects.groupBy(F.col("source").alias("title")).agg(F.max_by("target", "row_pos" if "row_pos" in redirects.columns else "target").alias("target"))
    direct = titles.join(info, "title", "left").join(hop, "title", "left")
    over = info.select(F.col("title").alias("target"), *[F.col(c).alias(f"r_{c}") for c in ("pageId", "url", "wikidataId")])
    return direct.join(over, "target", "left").select("title", *[F.coalesce(c, f"r_{c}").alias(c) for c in ("pageId", "url", "wikidataId")])


def enrich(rows: DataFrame, info: DataFrame, redirects: DataFrame) -> DataFrame:
    """Fills page ids, addresses and item ids of source pages and persons: looked up, else as they were, else derived."""
    wanted = rows.select(F.col("sourcePage").alias("title")).union(rows.select("wikiPersonTitle")).where("title is not null")
    found = resolve_redirects(wanted, info, redirects)
    for c, kind in (("sourcePageId", "long"), ("sourcePageUrl", "string"), ("sourceWikidataId", "string"), ("wikiPersonPageId", "long"), ("wikiPersonUrl", "string"), ("wikidataId", "string")):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast(kind))
    page = found.select(F.col("title").alias("sourcePage"), F.col("pageId").alias("p_id"), F.col("url").alias("p_url"), F.col("wikidataId").alias("p_item"))
    person = found.select(F.col("title").alias("wikiPersonTitle"), F.col("pageId").alias("h_id"), F.col("url").alias("h_url"), F.col("wikidataId").alias("h_item"))
    rows = rows.join(page, "sourcePage", "left").join(person, "wikiPersonTitle", "left")
    return rows.withColumns({
        "sourcePageId": F.coalesce("p_id", "sourcePageId"), "sourcePageUrl": F.coalesce("p_url", "sourcePageUrl", page_url(F.col("sourcePage"))), "sourceWikidataId": F.coalesce("p_item", "sourceWikidataId"),
        "wikiPersonPageId": F.coalesce("h_id", "wikiPersonPageId"), "wikiPersonUrl": F.coalesce("h_url", "wikiPersonUrl", page_url(F.col("wikiPersonTitle"))), "wikidataId": F.coalesce("h_item", "wikidataId"),
    }).drop("p_id", "p_url", "p_item", "h_id", "h_url", "h_item")
