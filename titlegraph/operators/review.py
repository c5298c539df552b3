"""The review sheet, corrections, apply plans and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, csv_cell, first_of, key, sql_int, sql_string, trim
from ..storage import cut

#: Columns of the review sheet; those of the matched title get the given prefix.
WIKI_COLUMNS = ["sourcePage", "dynastySection", "dyn_candidates", "fief", "pn", "nt", "person", "personBare", "startYear", "endYear"]
DB_COLUMNS = {"person_id": "person_id", "nt_ind": "ind", "can_name": "can_name", "dyn": "dyn", "fief": "fief", "pn": "pn", "nt": "nt", "start_year": "start_year", "end_year": "end_year", "dyn_id": "dyn_id"}
CORRECTED = ["fief_corrected", "pn_corrected", "reviewer_notes"]


def number(rows: DataFrame, order: list[str], name: str = "review_id", start: int = 1) -> DataFrame:
    """Gapless numbers in the given order, without moving all rows to one task.

    Range partitions are sorted and written once, each row with its place in its partition, so that the sizes that are
    summed are those of the partitions that are numbered. Rows that are equal in `order` are told apart by where they were
    read, so that many of them do not meet in one task.
    """
    spark = rows.sparkSession
    n, key = int(spark.conf.get("spark.sql.shuffle.partitions")), [*order, "__m"]
    flat = rows.withColumn("__m", F.monotonically_increasing_id()).repartitionByRange(n, *key).sortWithinPartitions(*key).drop("__m")
    flat = cut(flat.select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__n")), "numbered")
    sizes = flat.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))  # a row for each partition
    before = sizes.select("__part", (F.coalesce(F.sum("__size").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + start).alias("__before"))
    return flat.join(F.broadcast(before), "__part").withColumn(name, F.col("__n") + F.col("__before")).drop("__part", "__n", "__before")


def review_sheet(rows: DataFrame, order: list[str], prefix: str = "db") -> DataFrame:
    """Matched rows as the sheet that reviewers edit: all strings, numbered from 1, action left blank."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    wiki = [text(F.array_join("dynCandidates", "|") if c == "dyn_candidates" else F.col(c)).alias(f"wiki_{c}") for c in WIKI_COLUMNS]
    wiki.insert(4, F.lit("").alias("fief_corrected"))
    wiki.insert(6, F.lit("").alias("pn_corrected"))
    return number(rows, order).select(
        F.col("review_id").cast("string").alias("review_id"), text(F.col("suggestedAction")).alias("suggested_action"), F.lit("").alias("action"), text(F.col("matchStatus")).alias("match_status"),
        text(F.col("matchTier")).alias("match_tier"), text(F.col("matchNote")).alias("match_note"), *wiki, text(F.col("wikidataId")).alias("wikidataId"), text(F.col("wikiPersonUrl")).alias("wikiPersonUrl"),
        *[text(F.col(f"db.{c}")).alias(f"{prefix}_{k}") for k, c in DB_COLUMNS.items()], text(F.col("fillNotes")).alias("fill_notes"), F.lit("").alias("reviewer_notes"),
    )


def csv_lines(df: DataFrame) -> DataFrame:
    """Each row as one quoted CSV record."""
    return df.select(F.concat_ws(",", *[csv_cell(F.col(c)) for c in df.columns]).alias("value"))


def correct(rows: DataFrame, corrections: DataFrame, use_action: bool = True) -> DataFrame:
    """rows (review_id) with fief_corrected, pn_corrected, reviewer_notes and action of the last correction of their id.

    use_action False leaves the reviewer's action out, as older sheets did.
    """
    names = [*CORRECTED, "action"]
    order = "row_pos" if "row_pos" in corrections.columns else "review_id"
    last = corrections.groupBy(F.col("review_id").cast("long").alias("__id")).agg(*[F.max_by(F.col(c), F.col(order)).alias(f"__{c}") for c in names])
    out = rows.join(last, F.col("review_id").cast("long") == F.col("__id"), "left")
    for c in names:
        new = blank_to_null(F.col(f"__{c}")) if c != "action" or use_action else F.lit(None).cast("string")
        out = out.withColumn(c, F.coalesce(new, F.col(c)) if c in rows.columns else new)
    return out.drop("__id", *[f"__{c}" for c in names])


def effective(column: str, fallback: Column | None = None) -> Column:
    """A corrected value, else the parsed one, else the sheet's."""
    found = [F.col(f"{column}_corrected"), F.col(column)]
    return first_of(*found, *([] if fallback is None else [fallback]))


def decide(manual: Column, suggested: Column, status: Column, corrected: Column, honour_skip: bool = True) -> Column:
    """The action: the reviewer's, else the suggested one if it applies by itself, else a title link for rows without a
    unique match or with corrections, else skip. honour_skip False lets a manual skip fall through."""
    manual, suggested = blank_to_null(trim(manual)), trim(suggested)
    if not honour_skip:
        manual = F.when(manual != "skip", manual)
    return F.coalesce(manual, F.when(suggested.isin("link", "insert_nt", "update_nt"), suggested), F.when(status.isin("wiki_only", "ambiguous") | corrected, F.lit("link_title")), F.lit("skip"))


def dynasty(rows: DataFrame, ids: DataFrame, row_id: str) -> DataFrame:
    """rows with dyn and dynId: the matched title's, else of the first candidate that has an id, else the first candidate.

    ids: (row_pos, id, name), the last of a name (as a join key) counts. Candidates are trimmed, blank ones left out.
    """
    rows = rows.withColumn("dynCandidates", F.filter(F.transform("dynCandidates", trim), lambda x: x != ""))
    table = ids.where(F.col("name") != "").groupBy(key(F.col("name")).alias("name")).agg(F.max_by("id", "row_pos").alias("own")).where("own <> 0")
    found = rows.select(row_id, F.posexplode("dynCandidates").alias("pos", "name")).join(table, "name").groupBy(row_id).agg(F.min(F.struct("pos", "name", "own")).alias("hit"))
    out = rows.join(found, row_id, "left")
    matched = F.coalesce(F.col("db.dyn_id"), F.lit(0)) != 0
    return out.withColumn("dyn", F.when(matched, F.col("db.dyn")).otherwise(F.coalesce("hit.name", F.get("dynCandidates", F.lit(0))))).withColumn("dynId", F.when(matched, F.col("db.dyn_id")).otherwise(F.col("hit.own"))).drop("hit")


def plan(rows: DataFrame, ids: DataFrame, row_id: str = "review_id", honour_skip: bool = True) -> DataFrame:
    """Corrected rows with the apply plan's columns: action, fief, pn, nt, dyn, dynId, personId, ntInd.

    Columns of the sheet (wiki_fief and so on), where rows have them, serve where a value is missing.
    """
    for c in ("fief", "pn", "nt", "startYear", "endYear", "sourcePage", "personBare"):
        if f"wiki_{c}" in rows.columns and c not in ("fief", "pn"):
            own = F.col(c) if c in rows.columns else F.lit(None)
            rows = rows.withColumn(c, F.coalesce(own, F.col(f"wiki_{c}").cast(rows.schema[c].dataType if c in rows.columns else "string")))
    sheet = {c: F.col(f"wiki_{c}") if f"wiki_{c}" in rows.columns else None for c in ("fief", "pn")}
    rows = dynasty(rows, ids, row_id)
    corrected = (F.coalesce("fief_corrected", F.lit("")) != "") | (F.coalesce("pn_corrected", F.lit("")) != "")
    return rows.withColumns({"action": decide(F.col("action"), F.col("suggestedAction"), F.col("matchStatus"), corrected, honour_skip), "fief": effective("fief", sheet["fief"]), "pn": effective("pn", sheet["pn"]), "personId": F.col("db.person_id"), "ntInd": F.col("db.ind")})


def statements(plans: DataFrame, created_by: str = "wiki-import") -> DataFrame:
    """plans with `sql`, a row for each statement (none for skipped plans), and `n`, its place in the plan."""
    s, i, by = lambda c: sql_string(F.col(c)), lambda c: sql_int(F.col(c)), sql_string(F.lit(created_by))

    def insert(table: str, values: dict[str, Column]) -> Column:
        parts = [F.lit(f"INSERT INTO {table} ({', '.join(values)}) VALUES (")]
        for k, v in enumerate(values.values()):
            parts += [F.lit(", ")] * (k > 0) + [v]
        return F.concat(*parts, F.lit(");"))

    def wiki(ind: Column) -> Column:
        return insert("person_wiki", {"person_id": i("personId"), "person_nt_ind": ind, "wikidata_id": s("wikidataId"), "wiki_url": s("wikiPersonUrl"), "wiki_source_page": s("sourcePage"), "created_by": by})

    person, title = F.coalesce("personId", F.lit(0)) != 0, F.coalesce("ntInd", F.lit(0)) != 0
    new = insert("person_nt", {"person_id": i("personId"), "dyn": s("dyn"), "fief": s("fief"), "pn": s("pn"), "nt": s("nt"), "start_year": i("startYear"), "end_year": i("endYear"), "dyn_id": i("dynId"), "created_by": by})
    sets = F.array_compact(F.array(
        F.concat(F.lit("modified_by = "), by), F.lit("mod_date = NOW()"),
        F.when(F.col("pn") != "", F.concat(F.lit("pn = COALESCE(NULLIF(pn, ''), "), s("pn"), F.lit(")"))),
        F.when(F.col("startYear").isNotNull(), F.concat(F.lit("start_year = COALESCE(start_year, "), i("startYear"), F.lit(")"))),
        F.when(F.col("endYear").isNotNull(), F.concat(F.lit("end_year = COALESCE(end_year, "), i("endYear"), F.lit(")"))),
    ))
    update = F.concat(F.lit("UPDATE person_nt SET "), F.array_join(sets, ", "), F.lit(" WHERE ind = "), i("ntInd"), F.lit(";"))
    only = insert("nt_wiki", {
        "dyn": s("dyn"), "fief": s("fief"), "pn": s("pn"), "nt": s("nt"), "start_year": i("startYear"), "end_year": i("endYear"), "wiki_source_page": s("sourcePage"), "wiki_source_page_id": i("sourcePageId"),
        "wiki_source_wikidata": s("sourceWikidataId"), "wiki_person_wikidata": s("wikidataId"), "wiki_person_url": s("wikiPersonUrl"), "wiki_person_name": s("personBare"), "link_status": F.lit("'title_only'"), "created_by": by,
    })
    a = F.col("action")
    all_of = (
        F.when((a == "insert_nt") & person, F.array(new, wiki(F.lit("LAST_INSERT_ID()"))))
        .when((a == "update_nt") & title, F.array_compact(F.array(update, F.when(person, wiki(i("ntInd"))))))
        .when((a == "link") & person, F.array(wiki(i("ntInd"))))
        .when(a == "link_title", F.array(only))
    )
    return plans.select("*", F.posexplode(all_of).alias("n", "sql"))


def action_counts(rows: DataFrame, column: str = "action") -> DataFrame:
    """(action, n), most frequent first; null counts as none."""
    return rows.groupBy(F.coalesce(F.col(column), F.lit("none")).alias("action")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "action")


def conditional_counts(rows: DataFrame, **conditions: Column) -> DataFrame:
    """One row: n, and for each condition the number of rows for which it holds, in one pass."""
    return rows.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(name) for name, c in conditions.items()])


def crawl_counts(rows: DataFrame) -> DataFrame:
    """What a crawl reports of its rows: how many need a review, and how many have a person's page and an item."""
    there = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).isin("", "0") == F.lit(False)
    return conditional_counts(rows, needs_review=F.col("needsReview"), with_person_page=there("wikiPersonPageId"), with_item=there("wikidataId"))


def sample(rows: DataFrame, order: list[str], n: int = 3) -> DataFrame:
    """The first rows, to print."""
    return rows.orderBy(*order).limit(n)
