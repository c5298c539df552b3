"""Tiered matching of normalised rows against a title table and a person table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import key
from ..storage import cut


def last_by(df: DataFrame, by: str, value: str, order: str = "row_pos") -> DataFrame:
    """The last value of each key."""
    return df.groupBy(by).agg(F.max_by(value, order).alias(value))


def with_names(titles: DataFrame, persons: DataFrame) -> DataFrame:
    """titles (person_id, ...) with can_name from persons (row_pos, id, name)."""
    return titles.join(last_by(persons, "id", "name").select(F.col("id").alias("person_id"), F.col("name").alias("can_name")).hint("merge"), "person_id", "left")


def match(rows: DataFrame, titles: DataFrame, persons: DataFrame, row_id: str = "row_id") -> DataFrame:
    """rows with matchStatus, matchTier, suggestedAction, matchNote, matchCount and db (the matched title's columns).

    rows: row_id, dynCandidates, fief, pn, nt, personBare, startYear, endYear, skipReason, reviewStatus. Tier B compares
    dynasty (any candidate), fief, pn, rank and person; C leaves out pn; D compares the person alone; E finds a person
    without a title. The best tier that has hits counts; of its hits the first by candidate, then by row_pos. All tiers
    are equi-joins with titles counted by key, ranked in one pass. Rows without candidates are tried with an empty
    dynasty once. All joins go by shuffle (merge), since files that compress well look small enough to be broadcast.
    """
    db = with_names(titles, persons)
    parts = ["dyn", "fief", "pn", "nt"]
    skip = F.col("skipReason").isNotNull() & (F.col("skipReason") != "") | F.coalesce(F.col("reviewStatus") == "duplicate", F.lit(False))
    own = cut(rows.where(~skip).select(F.col(row_id).alias("rid"), F.coalesce("dynCandidates", F.array(F.lit(""))).alias("dynCandidates"), *[key(F.col(c)).alias(f"k_{c}") for c in parts[1:]], key(F.col("personBare")).alias("k_name")), "match-rows")
    many = own.select("*", F.posexplode("dynCandidates").alias("pos", "dyn")).withColumn("k_dyn", key(F.col("dyn")))
    narrow = cut(db.select("row_pos", *[key(F.col(c)).alias(f"k_{c}") for c in parts], key(F.col("can_name")).alias("k_name")), "match-titles")

    def hits(tier: str, mine: DataFrame, by: list[str]) -> DataFrame:
        """Titles are counted for each key first, so a common key costs a row and not all pairs."""
        table = narrow.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("row_pos").alias("row_pos"))
        return mine.join(table.hint("merge"), by).select("rid", F.lit(tier).alias("tier"), "n", "pos", "row_pos")

    found = hits("B", many, [f"k_{c}" for c in parts] + ["k_name"]).union(hits("C", many, ["k_dyn", "k_fief", "k_nt", "k_name"])).union(hits("D", own.where("k_name <> ''").withColumn("pos", F.lit(0)), ["k_name"]))
    best = found.groupBy("rid", "tier").agg(F.sum("n").alias("n"), F.min(F.struct("pos", "row_pos")).alias("f")).groupBy("rid").agg(F.min(F.struct("tier", "n", "f.row_pos")).alias("m")).select("rid", "m.*")
    record = db.select(F.col("row_pos"), F.struct("ind", "person_id", "can_name", "dyn", "fief", "pn", "nt", "start_year", "end_year", "dyn_id").alias("db"))
    best = best.join(record.hint("merge"), "row_pos").drop("row_pos")
    # an id has its last name, and the place of its first row
    people = persons.groupBy("id").agg(F.max_by("name", "row_pos").alias("name"), F.min("row_pos").alias("place"))
    known = people.groupBy(key(F.col("name")).alias("k_name")).agg(F.min_by(F.struct("id", "name"), "place").alias("only")).where("only.id <> 0")
    known = own.join(known.hint("merge"), "k_name").select("rid", F.col("only.id").alias("only_id"), F.col("only.name").alias("only_name"))
    out = rows.join(best.hint("merge"), F.col(row_id) == F.col("rid"), "left").drop("rid").join(known.hint("merge"), F.col(row_id) == F.col("rid"), "left").drop("rid")
    missing = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).isin("", "0")
    lacks = lambda mine, theirs: ~missing(mine) & missing(theirs)
    incomplete = lacks("pn", "db.pn") | lacks("startYear", "db.start_year") | lacks("endYear", "db.end_year")
    one, several, person = F.col("n") == 1, F.col("n") > 1, F.col("only_id").isNotNull()

    def choose(skipped, ambiguous, full, partial, alone, none):
        return F.when(skip, skipped).when(several, ambiguous).when(one & ~incomplete, full).when(one, partial).when(person, alone).otherwise(none)

    nothing = F.lit(None).cast("string")
    only = F.struct(*[(F.col("only_id") if f.name == "person_id" else F.col("only_name") if f.name == "can_name" else F.lit(None)).cast(f.dataType).alias(f.name) for f in record.schema["db"].dataType])
    return out.withColumns({
        "matchStatus": choose(F.coalesce("reviewStatus", F.lit("skip")), F.lit("ambiguous"), F.lit("matched"), F.lit("matched"), F.lit("person_only"), F.lit("wiki_only")),
        "matchTier": choose(nothing, F.col("tier"), F.col("tier"), F.col("tier"), F.lit("E"), nothing),
        "suggestedAction": choose(F.lit("skip"), F.lit("review"), F.lit("link"), F.lit("update_nt"), F.lit("insert_nt"), F.lit("review")),
        "matchNote": choose(F.coalesce("skipReason", F.lit("duplicate")), F.concat(F.col("n").cast("string"), F.lit(" candidates")), F.lit("full match"), F.lit("row incomplete"), F.lit("person known, no matching title"), F.lit("no match")),
        "matchCount": F.when(several & ~skip, F.col("n")),
        "db": F.when(~skip & F.col("db").isNotNull(), F.col("db")).when(~skip & person, only),
    }).drop("tier", "n", "only_id", "only_name")


def only_matched(rows: DataFrame) -> DataFrame:
    """Rows for which any tier found something."""
    return rows.where(F.col("matchStatus").isin("matched", "person_only", "ambiguous"))
