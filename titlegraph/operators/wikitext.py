"""Wiki pages to title-holder rows, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import PARSE_SKIP, RANKS
from ..functions.text import blank_to_null, trim

#: Patterns of links, years of office and level-two headers.
LINK = r"\[\[([^|\]#]+)(?:#[^\]|]+)?(?:\|([^\]]+))?\]\]"
YEARS = r"(\d+|\?)年\s*-\s*(\d+|\?)年"
HEADER = r"^==\s*([^=\n]+?)\s*==\s*\z"


def _rank(text: Column, ranks: list[str], more: int = 0) -> Column:
    """The first rank, in list order, that ends a text; `more` characters at least stand before it. Null if there is none."""
    return F.coalesce(*[F.when(F.endswith(text, F.lit(r)) & (F.length(text) >= len(r) + more), F.lit(r)) for r in ranks])


def _before(text: Column, rank: Column) -> Column:
    return F.substring(text, F.lit(1), F.length(text) - F.length(rank))


def split_title(title: Column, ranks: list[str] = RANKS) -> Column:
    """struct(fief, nt): by the first rank, in list order, that ends the trimmed title and leaves something before it."""
    title = trim(title)
    rank = _rank(title, ranks, 1)
    return F.struct(_before(title, rank).alias("fief"), rank.alias("nt"))


def clean_label(label: Column) -> Column:
    """Without links and what follows a comma, trimmed."""
    return trim(F.regexp_replace(F.regexp_replace(F.coalesce(label, F.lit("")), r"\[\[[^\]]+\]\]", ""), r"[，,].*\z", ""))


def _label_parts(clean: Column, rank: Column, fief: Column, nt: Column) -> Column:
    body = _before(clean, rank)
    longer = rank.isNotNull() & (F.coalesce(fief, F.lit("")) != "") & F.startswith(body, fief) & (F.length(body) > F.length(fief))
    own = F.when(rank.isNull() | longer, fief).otherwise(F.coalesce(blank_to_null(body), fief))
    return F.struct(own.alias("fief"), F.when(longer, F.substring(body, F.length(fief) + 1, F.length(body))).alias("pn"), F.coalesce(rank, nt).alias("nt"))


def split_label(label: Column, fief: Column, nt: Column, ranks: list[str] = RANKS) -> Column:
    """struct(fief, pn, nt) of a holder's label; fief and nt are the page's."""
    clean = clean_label(label)
    return _label_parts(clean, _rank(clean, ranks), fief, nt)


def links(text: Column) -> Column:
    """array(struct(target, display)) of all wiki links."""
    both = F.arrays_zip(F.regexp_extract_all(text, F.lit(LINK), 1).alias("t"), F.regexp_extract_all(text, F.lit(LINK), 2).alias("d"))
    return F.transform(both, lambda x: F.struct(trim(x["t"]).alias("target"), F.coalesce(blank_to_null(trim(x["d"])), trim(x["t"])).alias("display")))


def choose_link(found: Column) -> Column:
    """The first link that is no list page, else the first."""
    return F.coalesce(F.get(F.filter(found, lambda x: ~F.endswith(x["target"], F.lit("列表"))), F.lit(0)), F.get(found, F.lit(0)))


def years(text: Column) -> Column:
    """struct(start, end) of the first range; a question mark is null."""
    return F.struct(*[F.regexp_extract(text, YEARS, i).try_cast("int").alias(n) for i, n in ((1, "start"), (2, "end"))])


def is_disambiguation(text: Column) -> Column:
    return F.coalesce(text.rlike(r"(?i)\{\{(disambig|otheruses)"), F.lit(False))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column that is computed once a row: a generator ends what may be merged into the expressions above it."""
    return df.withColumn(name, F.explode(F.array(value)))


def sectioned_lines(pages: DataFrame, keys: list[str], text_col: str = "wikitext") -> DataFrame:
    """Every line with its number and the level-two header above it; lines above a page's first header go, if it has one.

    All inside a page's row, in time that grows with its length: its lines are cut at the headers into sections, sections
    and then their lines become rows. Nothing is shuffled, and pages of one key stay apart.
    """
    name = lambda x: F.when(F.startswith(x, F.lit("==")), blank_to_null(F.regexp_extract(x, HEADER, 1)))
    headers = F.filter(F.transform(F.col("p.lines"), lambda x, i: F.struct(i.alias("at"), name(x).alias("name"))), lambda h: h["name"].isNotNull())
    rows = _once(pages.select(*keys, F.col(text_col).alias("__text")).where("__text is not null"), "p", F.struct(F.split("__text", "\n").alias("lines"))).drop("__text")
    rows = _once(rows, "h", F.struct(headers.alias("headers")))
    end = lambda i: F.coalesce(F.get(F.col("h.headers"), i + 1)["at"], F.size("p.lines"))
    section = lambda h, i: F.struct(h["name"].alias("section"), (h["at"] + 1).alias("first"), F.slice(F.col("p.lines"), h["at"] + 2, end(i) - h["at"] - 1).alias("lines"))
    whole = F.array(F.struct(F.lit(None).cast("string").alias("section"), F.lit(0).alias("first"), F.col("p.lines").alias("lines")))
    cut = rows.select(*keys, F.explode(F.when(F.size("h.headers") == 0, whole).otherwise(F.transform("h.headers", section))).alias("s"))
    lines = cut.select(*keys, "s.section", "s.first", F.posexplode("s.lines").alias("__i", "line"))
    return lines.select(*keys, (F.col("first") + F.col("__i")).alias("line_no"), "line", "section")


def holders(pages: DataFrame, text_col: str = "wikitext", title_col: str = "title", keep: tuple[str, ...] = ()) -> DataFrame:
    """Title-holder rows of pages, in page order by (sourcePage, line_no); columns in keep come along.

    The list lines of each section, but for reference sections and headings of grants. Confidence falls to medium without
    a link or where the line's fief or rank differs from the page's, and to low with neither link nor label.
    """
    rows = sectioned_lines(pages.select(F.col(title_col).alias("sourcePage"), F.col(text_col).alias("wikitext"), *keep), ["sourcePage", *keep])
    rows = rows.where(F.col("line").rlike(r"^\*+") & (F.col("section").isNull() | ~F.col("section").isin(PARSE_SKIP)))
    rows = _once(rows, "rawLine", trim(F.regexp_replace("line", r"^\*+\s*", ""))).where(F.col("rawLine") != "")
    rows = rows.where(~((F.startswith("rawLine", F.lit("第")) & F.contains("rawLine", F.lit("册封"))) | F.col("rawLine").rlike(r"^第[一二三四五六七八九十\d]+次")))
    rows = _once(_once(rows, "__title", trim(F.col("sourcePage"))), "__rank", _rank(F.col("__title"), RANKS, 1))
    rows = _once(rows, "page", F.struct(_before(F.col("__title"), F.col("__rank")).alias("fief"), F.col("__rank").alias("nt")))
    rows = _once(_once(rows, "__links", links(F.col("rawLine"))), "link", choose_link(F.col("__links")))
    at = F.instr("rawLine", F.concat(F.lit("[["), F.col("link.target")))
    rows = rows.withColumn("label", F.when(F.col("link").isNull(), F.col("rawLine")).when(at > 0, F.substring("rawLine", F.lit(1), at - 1)).otherwise(""))
    # as split_label(), with what it uses again computed once
    rows = _once(rows, "clean", clean_label(F.col("label")))
    rows = _once(_once(rows, "rank", _rank(F.col("clean"), RANKS)), "t", _label_parts(F.col("clean"), F.col("rank"), F.col("page.fief"), F.col("page.nt")))
    rows = rows.withColumn("y", years(F.col("rawLine")))
    rows = rows.where(F.col("link").isNotNull() | F.col("t.fief").isNotNull() | F.col("t.nt").isNotNull())
    changed = F.coalesce(F.col("page.nt") != F.col("t.nt"), F.lit(False)) | F.coalesce(F.col("page.fief") != F.col("t.fief"), F.lit(False))
    rows = rows.withColumn("confidence", F.when(F.col("link").isNull() & (trim(F.col("label")) == ""), "low").when(F.col("link").isNull() | changed, "medium").otherwise("high"))
    return rows.select(
        "sourcePage", "line_no", F.col("section").alias("dynastySection"), "rawLine", "t.fief", "t.pn", "t.nt", F.col("link.display").alias("person"), F.col("link.target").alias("wikiPersonTitle"),
        F.col("y.start").alias("startYear"), F.col("y.end").alias("endYear"), "confidence", ((F.col("confidence") != "high") | (F.col("y.start").isNull() & F.col("y.end").isNull())).alias("needsReview"), *keep,
    )


def ingest(pages: DataFrame) -> DataFrame:
    """Holder rows, with page metadata, of the disambiguation pages among pages (title, wikitext, pageId, url, wikidataId)."""
    text = F.col("wikitext")
    fit = pages.where(text.isNotNull() & ~text.rlike(r"(?i)^\s*#REDIRECT|^\s*#重定向") & is_disambiguation(text))
    meta = {"sourcePageId": F.col("pageId"), "sourcePageUrl": F.col("url"), "sourceWikidataId": F.col("wikidataId")}
    return holders(fit.withColumns(meta), keep=tuple(meta))
