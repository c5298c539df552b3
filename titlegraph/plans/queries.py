"""Registered queries of the engine on the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import csv_cell, page_url, sql_int, sql_string, without_note
from ..operators import asset, match, names, normalize, review, wikitext

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_RANKS = ["small", "large", "red", "blue"]
@query("""
    select p_partkey, case when ends_with(p_name, 'small') then p_name[:-6] when ends_with(p_name, 'large') then p_name[:-6] when ends_with(p_name, 'red') then p_name[:-4] when ends_with(p_name, 'blue') then p_name[:-5] end as fief,
           case when ends_with(p_name, 'small') then 'small' when ends_with(p_name, 'large') then 'large' when ends_with(p_name, 'red') then 'red' when ends_with(p_name, 'blue') then 'blue' end as nt
    from (select p_partkey, p_name || case p_partkey % 5 when 0 then 'small' when 1 then 'large' when 2 then 'red' when 3 then 'blue' else '' end as p_name from part)
""")
def suffix_split(spark, sf_dir):
    ends = F.element_at(F.array(*map(F.lit, [*_RANKS, ""])), (F.col("p_partkey") % 5 + 1).cast("int"))
    t = wikitext.split_title(F.concat("p_name", ends), _RANKS)
    return table(spark, sf_dir, "part").select("p_partkey", t["fief"].alias("fief"), t["nt"].alias("nt"))


@query("""
    select page_id, cast(count(*) as bigint) as links, min(target) as first_target from (
        select page_id, unnest(regexp_extract_all(html, '<a href="/([^"]*)">([^<]*)</a>', 1)) as target from pages
    ) group by page_id
""")
def link_extract(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    text = F.regexp_replace("html", r'<a href="/([^"|#\]]*)">([^<\]]*)</a>', "[[$1|$2]]")
    found = pages.select("page_id", F.explode(wikitext.links(F.concat_ws("", F.regexp_extract_all(text, F.lit(r"\[\[[^\]]*\]\]"), 0)))).alias("l"))
    return found.groupBy("page_id").agg(F.count(F.lit(1)).alias("links"), F.min("l.target").alias("first_target"))


@query("""
    select o_orderkey, case when o_orderkey % 3 = 0 then null else cast(o_orderkey % 700 as int) end as start_year, cast(o_custkey % 900 as int) as end_year from orders
""")
def year_range_parse(spark, sf_dir):
    first = F.when(F.col("o_orderkey") % 3 == 0, F.lit("?")).otherwise((F.col("o_orderkey") % 700).cast("string"))
    y = wikitext.years(F.concat(F.lit("x，"), first, F.lit("年 - "), (F.col("o_custkey") % 900).cast("string"), F.lit("年在位")))
    return table(spark, sf_dir, "orders").select("o_orderkey", y["start"].alias("start_year"), y["end"].alias("end_year"))


@query("""
    with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line_no from documents)
    select doc_id, cast(line_no as int) as line_no, length(line) as chars from l
""")
def line_explode(spark, sf_dir):
    lines = wikitext.sectioned_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"], "text")
    return lines.select("doc_id", "line_no", F.length("line").cast("long").alias("chars"))


@query("select doc_id, case when row_number() over (partition by text order by doc_id) > 1 then 'duplicate' else 'ready' end as status from documents")
def dedupe_first_wins(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.xxhash64("text").alias("h"), F.sha2("text", 256).alias("k"))
    return normalize.mark_duplicates(docs, F.col("k"), F.lit(False), ["doc_id"], "status").select("doc_id", "status")


@query("""
    with r as (select r_name, r_regionkey from region)
    select n_nationkey, case when n_regionkey = 0 then 'A' when n_regionkey = 1 then 'B' else r_name end as dyn, cast(case when n_regionkey < 2 then 2 else 1 end as int) as candidates
    from nation join r on n_regionkey = r_regionkey
""")
def candidate_lookup(spark, sf_dir):
    regions = table(spark, sf_dir, "region")
    first = {r.r_regionkey: r.r_name for r in regions.where("r_regionkey < 2").collect()}
    known = {first[0]: ["A", "AA"], first[1]: ["B", "BB"]}
    rows = table(spark, sf_dir, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    d = normalize.dynasties(F.col("r_name"), known, ["none"])
    return rows.select("n_nationkey", F.get(d, F.lit(0)).alias("dyn"), F.size(d).alias("candidates"))


def _parts(spark, sf_dir):
    """Rows to match, and a title table, both from parts."""
    part = table(spark, sf_dir, "part")
    rows = part.select(
        F.col("p_partkey").alias("row_id"), F.array("p_brand", F.lit("other")).alias("dynCandidates"), F.col("p_type").alias("fief"), F.when(F.col("p_partkey") % 4 != 0, F.col("p_size").cast("string")).alias("pn"),
        F.lit("x").alias("nt"), F.col("p_name").alias("personBare"), F.lit(None).cast("int").alias("startYear"), F.lit(None).cast("int").alias("endYear"), F.lit(None).cast("string").alias("skipReason"), F.when(F.col("p_partkey") % 50 == 0, "duplicate").otherwise("ready").alias("reviewStatus"),
    )
    titles = part.select(
        F.col("p_partkey").alias("row_pos"), F.col("p_partkey").alias("ind"), F.col("p_partkey").alias("person_id"), F.col("p_brand").alias("dyn"), F.when(F.col("p_partkey") % 6 != 0, F.col("p_type")).otherwise("?").alias("fief"),
        F.when(F.col("p_partkey") % 10 != 0, F.col("p_size").cast("string")).alias("pn"), F.lit("x").alias("nt"), F.lit(1).alias("start_year"), F.lit(2).alias("end_year"), F.lit(7).cast("long").alias("dyn_id"),
    )
    # rows miss where sizes and prices change a value
    titles = titles.join(part.select(F.col("p_partkey").alias("ind"), (F.col("p_size") > 25).alias("other")).hint("merge"), "ind").withColumn("dyn", F.when(F.col("other"), F.lit("none")).otherwise(F.col("dyn"))).drop("other")
    persons = part.select(F.col("p_partkey").alias("row_pos"), F.col("p_partkey").alias("id"), F.when(F.col("p_retailprice") % 100 < 30, F.concat(F.lit("no "), F.col("p_name"))).otherwise(F.col("p_name")).alias("name"))
    return rows, titles, persons


_MATCH = """
    with r as (select p_partkey as row_id, p_brand as dyn, p_type as fief, case when p_partkey % 4 <> 0 then cast(p_size as varchar) end as pn, p_name as person, p_partkey % 50 = 0 as dup from part),
    p as (select p_partkey as id, case when p_retailprice % 100 < 30 then 'no ' || p_name else p_name end as name from part),
    t as (select p_partkey as row_pos, case when p_size > 25 then 'none' else p_brand end as dyn, case when p_partkey % 6 <> 0 then p_type else '?' end as fief, case when p_partkey % 10 <> 0 then cast(p_size as varchar) end as pn, coalesce(name, '') as name
          from part left join p on p_partkey = id),
    h as (
        select row_id, 'B' as tier, row_pos from r join t on r.dyn = t.dyn and r.fief = t.fief and coalesce(r.pn, '') = coalesce(t.pn, '') and r.person = t.name where not dup
        union all select row_id, 'C', row_pos from r join t on r.dyn = t.dyn and r.fief = t.fief and r.person = t.name where not dup
        union all select row_id, 'D', row_pos from r join t on r.person = t.name where not dup
    ), g as (select row_id, tier, count(*) as n, min(row_pos) as row_pos, row_number() over (partition by row_id order by tier) as o from h group by row_id, tier),
    b as (select g.row_id, tier, n, g.row_pos, t.pn as tpn from g join t on g.row_pos = t.row_pos where o = 1),
    e as (select name, arg_min(id, id) as only_id from p where id <> 0 group by name),
    m as (
        select r.row_id, r.dup, r.pn, b.*exclude(row_id), e.only_id, coalesce(r.pn, '') not in ('', '0') and coalesce(tpn, '') in ('', '0') as lacks
        from r left join b on r.row_id = b.row_id left join e on r.person = e.name
    )
"""


@query(
    _MATCH
    + """
    select row_id, case when dup then 'duplicate' when n > 1 then 'ambiguous' when n = 1 then 'matched' when only_id is not null then 'person_only' else 'wiki_only' end as status,
           case when dup then null when n >= 1 then tier when only_id is not null then 'E' end as tier,
           case when dup then 'skip' when n > 1 then 'review' when n = 1 and lacks then 'update_nt' when n = 1 then 'link' when only_id is not null then 'insert_nt' else 'review' end as action,
           case when dup then null when n >= 1 then row_pos end as ind, case when not dup and n > 1 then n end as candidates
    from m
"""
)
def tiered_match(spark, sf_dir):
    out = match.match(*_parts(spark, sf_dir))
    return out.select("row_id", F.col("matchStatus").alias("status"), F.col("matchTier").alias("tier"), F.col("suggestedAction").alias("action"), F.col("db.ind").alias("ind"), F.col("matchCount").alias("candidates"))


_SHEET = ", ".join(f"coalesce(cast({v} as varchar), '') as {c}" for c, v in {
    "review_id": "row_number() over (order by row_id)", "suggested_action": "case when dup then 'skip' when n > 1 then 'review' when n = 1 and lacks then 'update_nt' when n = 1 then 'link' when only_id is not null then 'insert_nt' else 'review' end", "action": "''",
    "match_status": "case when dup then 'duplicate' when n > 1 then 'ambiguous' when n = 1 then 'matched' when only_id is not null then 'person_only' else 'wiki_only' end", "match_tier": "case when dup then null when n >= 1 then tier when only_id is not null then 'E' end",
    "match_note": "case when dup then 'duplicate' when n > 1 then n || ' candidates' when n = 1 and lacks then 'row incomplete' when n = 1 then 'full match' when only_id is not null then 'person known, no matching title' else 'no match' end",
    "wiki_sourcePage": "p_type || '王'", "wiki_dynastySection": "p_brand", "wiki_dyn_candidates": "p_brand || '|other'", "wiki_fief": "p_type", "fief_corrected": "''", "wiki_pn": "case when p_partkey % 4 <> 0 then p_size end", "pn_corrected": "''", "wiki_nt": "'x'", "wiki_person": "p_name || ' (x)'", "wiki_personBare": "p_name",
    "wiki_startYear": "null", "wiki_endYear": "null", "wikidataId": "'Q' || row_id", "wikiPersonUrl": "null", "db_person_id": "case when not dup and n >= 1 then row_pos when not dup then only_id end", "db_nt_ind": "case when not dup and n >= 1 then row_pos end", "db_can_name": "case when not dup and (n >= 1 or only_id is not null) then tname end",
    "db_dyn": "case when not dup and n >= 1 then tdyn end", "db_fief": "case when not dup and n >= 1 then tfief end", "db_pn": "case when not dup and n >= 1 then tpn end", "db_nt": "case when not dup and n >= 1 then 'x' end", "db_start_year": "case when not dup and n >= 1 then 1 end", "db_end_year": "case when not dup and n >= 1 then 2 end",
    "db_dyn_id": "case when not dup and n >= 1 then 7 end", "fill_notes": "'fief←sourcePage'", "reviewer_notes": "''",
}.items())


@query(_MATCH + f"""
    select {_SHEET} from (
        select m.*, p_type, p_brand, p_size, p_partkey, p_name, coalesce(nullif(t.name, ''), case when n is null then p.name end) as tname, t.dyn as tdyn, t.fief as tfief
        from m join part on row_id = p_partkey left join t on t.row_pos = m.row_pos left join p on p.id = m.only_id
    )
""")
def review_sheet(spark, sf_dir):
    """The sheet that reviewers edit, all its 32 columns."""
    rows, titles, persons = _parts(spark, sf_dir)
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), F.concat("p_type", F.lit("王")).alias("sourcePage"), F.col("p_brand").alias("dynastySection"), F.concat("p_name", F.lit(" (x)")).alias("person"), F.concat(F.lit("Q"), F.col("p_partkey").cast("string")).alias("wikidataId"), F.lit(None).cast("string").alias("wikiPersonUrl"), F.lit("fief←sourcePage").alias("fillNotes"))
    return review.review_sheet(match.match(rows.join(part.hint("merge"), "row_id"), titles, persons), ["row_id"])


@query(_MATCH + "select case when dup then 'skip' when n > 1 then 'review' when n = 1 and lacks then 'update_nt' when n = 1 then 'link' when only_id is not null then 'insert_nt' else 'review' end as action, count(*) as n from m group by 1")
def match_action_counts(spark, sf_dir):
    return review.action_counts(match.match(*_parts(spark, sf_dir)), "suggestedAction")


@query("""
    with c as (select c_name, c_custkey, c_acctbal from customer where c_acctbal > 0)
    select o_orderkey, c.c_custkey + 5 as page_id, coalesce('u' || c.c_custkey, 'https://zh.wikipedia.org/wiki/' || replace(o.c_name, '#', '%23')) as url, h.c_custkey + 5 as person_page, coalesce('Q' || h.c_custkey, 'old') as item
    from (select o_orderkey, a.c_name, b.c_name as person from orders join customer a on o_custkey = a.c_custkey left join customer b on o_custkey + 1 = b.c_custkey) o
    left join c on c.c_name = o.c_name left join c h on h.c_name = o.person
""")
def enrich_left_coalesce(spark, sf_dir):
    rows, info = _enriched(spark, sf_dir)
    out = normalize.enrich(rows, info, spark.createDataFrame([], "source string, target string"))
    return out.select("o_orderkey", F.col("sourcePageId").alias("page_id"), F.col("sourcePageUrl").alias("url"), F.col("wikiPersonPageId").alias("person_page"), F.col("wikidataId").alias("item"))


def _enriched(spark, sf_dir):
    """Rows for enrich(), one for each order, and what is known of pages."""
    customer = table(spark, sf_dir, "customer")
    other = customer.select((F.col("c_custkey") - 1).alias("k"), F.col("c_name").alias("wikiPersonTitle"))
    rows = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).join(other, F.col("o_custkey") == F.col("k"), "left").select("o_orderkey", F.col("c_name").alias("sourcePage"), "wikiPersonTitle", F.lit("old").alias("wikidataId"))
    k = F.col("c_custkey").cast("string")
    info = customer.where("c_acctbal > 0").select(F.col("c_name").alias("title"), (F.col("c_custkey") + 5).alias("pageId"), F.concat(F.lit("u"), k).alias("url"), F.concat(F.lit("Q"), k).alias("wikidataId"))
    return rows, info


@query("""
    select a.n_name as title, coalesce(case when a.n_nationkey < 15 then a.n_nationkey end, case when b.n_nationkey < 15 then b.n_nationkey end) as pageId
    from nation a left join nation b on b.n_nationkey = a.n_nationkey - 10
""")
def redirect_one_hop(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    info = nation.where("n_nationkey < 15").select(F.col("n_name").alias("title"), F.col("n_nationkey").alias("pageId"), F.lit("u").alias("url"), F.lit("q").alias("wikidataId"))
    hops = nation.alias("a").join(nation.alias("b"), F.expr("b.n_nationkey = a.n_nationkey - 10")).select(F.col("a.n_name").alias("source"), F.col("b.n_name").alias("target"))
    return normalize.resolve_redirects(nation.select(F.col("n_name").alias("title")), info, hops).select("title", "pageId")


@query("""
    select p_partkey as review_id, case when p_partkey % 7 = 0 then 'fixed' else p_type end as fief, case when p_partkey % 21 = 0 then 'pn' else p_brand end as pn, case when p_partkey % 7 = 0 then 'note' end as reviewer_notes from part
""")
def corrections_overlay(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    rows = part.select(F.col("p_partkey").alias("review_id"), F.col("p_type").alias("fief"), F.col("p_brand").alias("pn"))
    sheet = part.where("p_partkey % 7 = 0").select(F.col("p_partkey").cast("string").alias("review_id"), F.explode(F.array(F.struct(F.lit(0).alias("row_pos"), F.lit("old").alias("f")), F.struct(F.lit(1).alias("row_pos"), F.lit("fixed").alias("f")))).alias("x"), F.when(F.col("p_partkey") % 21 == 0, "pn").otherwise("").alias("pn_corrected"))
    sheet = sheet.select("review_id", "x.row_pos", F.col("x.f").alias("fief_corrected"), "pn_corrected", F.lit("note").alias("reviewer_notes"), F.lit("").alias("action"))
    out = review.correct(rows, sheet)
    return out.select("review_id", review.effective("fief").alias("fief"), review.effective("pn").alias("pn"), "reviewer_notes")


@query("""
    select p_partkey, case when p_partkey % 11 = 0 then 'skip' when p_partkey % 5 = 0 then 'link' when p_partkey % 5 = 1 then 'insert_nt' when p_partkey % 3 = 0 or p_size > 40 then 'link_title' else 'skip' end as action from part
""")
def action_decision(spark, sf_dir):
    k = F.col("p_partkey")
    manual, suggested = F.when(k % 11 == 0, "skip").otherwise(""), F.when(k % 5 == 0, "link").when(k % 5 == 1, "insert_nt").otherwise("review")
    return table(spark, sf_dir, "part").select("p_partkey", review.decide(manual, suggested, F.when(k % 3 == 0, "wiki_only").otherwise("matched"), F.col("p_size") > 40).alias("action"))


@query("""
    select p_partkey, unnest(list_distinct(list_filter([f || p || n, f || n, f || p || n || h, f || n || h, d || f || p || n, d || f || p || n || h, case when f is null then p || n end, case when f is null then p || n || h end, case when f is null then d || p || n end, case when f is null then d || p || n || h end], lambda x: x is not null))) as s
    from (select p_partkey, case when p_partkey % 3 <> 0 then p_type end as f, case when p_partkey % 4 <> 0 then p_brand end as p, 'N' as n, case when p_partkey % 5 <> 0 then p_name end as h, 'D' as d from part)
""")
def search_strings(spark, sf_dir):
    k = F.col("p_partkey")
    s = asset.search_strings(F.when(k % 3 != 0, F.col("p_type")), F.when(k % 4 != 0, F.col("p_brand")), F.lit(None).cast("string"), F.lit("N"), F.when(k % 5 != 0, F.col("p_name")), F.lit("D"))
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(s).alias("s"))


@query("select s_suppkey, 'wnt-' || printf('%04d', row_number() over (order by s_suppkey)) as id from supplier where s_acctbal > 0")
def dense_record_ids(spark, sf_dir):
    rows = review.number(table(spark, sf_dir, "supplier").where("s_acctbal > 0"), ["s_suppkey"], "n")
    return rows.select("s_suppkey", F.concat(F.lit("wnt-"), F.format_string("%04d", F.col("n"))).alias("id"))


@query("select p_partkey, p_name from part where p_partkey not in (select l_partkey from lineitem where l_quantity > 45)")
def covered_anti_join(spark, sf_dir):
    covered = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return names.pending(table(spark, sf_dir, "part").select("p_partkey", "p_name"), covered, "p_partkey")


@query("""
    select p_partkey, row_number() over (order by p_partkey) + (select count(*) from supplier) as n from part where p_size < 10
    union all select s_suppkey, row_number() over (order by s_suppkey) from supplier
""")
def append_canonical(spark, sf_dir):
    base = review.number(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("p_partkey")), ["p_partkey"], "n")
    more = review.number(table(spark, sf_dir, "part").where("p_size < 10").select("p_partkey"), ["p_partkey"], "n", base.count() + 1)
    return base.unionByName(more).select("p_partkey", "n")


@query("select r || n_name as s, 'pattern:' || r || ':' || n_name as id from nation, (values ('王'), ('公')) t(r)")
def cross_pattern_candidates(spark, sf_dir):
    ranks = spark.createDataFrame([(0, "王"), (1, "公"), (2, "府")], "pos int, string string")
    surnames = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("pos"), F.col("n_name").alias("surname"))
    return names.patterns(ranks, surnames).select(F.get("searchStrings", F.lit(0)).alias("s"), F.col("authorityId").alias("id"))


@query("""
    select doc_id, source_id, next_id from (
        select conv_id as doc_id, role, turn, cast(turn as varchar) as source_id, lead(role) over w as next_role, cast(lead(turn) over w as varchar) as next_id, lead(turn) over w as next_turn from conversations window w as (partition by conv_id order by turn)
    ) where role in ('user', 'assistant') and next_role = 'assistant' and turn % 2 = 0 and next_turn = turn + 1
""")
def adjacent_relation(spark, sf_dir):
    """Turns as offices; every second one ends before the next begins, and relates to none."""
    out = names.office_relations(domain._turns(spark, sf_dir), "assistant")
    return out.select("doc_id", F.col("sourceIds")[0].alias("source_id"), F.col("sourceIds")[1].alias("next_id"))


@query("select event_type as action, count(*) as n from events group by 1")
def action_counts(spark, sf_dir):
    return review.action_counts(table(spark, sf_dir, "events"), "event_type")


@query("select doc_id from documents where doc_id not in (select doc_id from labels)")
def resume_pending(spark, sf_dir):
    return names.pending(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@query("""
    with c as (
        select c_custkey as k, c_nationkey as n, '''' || replace(c_name, '''', '''''') || '''' as page, case when c_custkey % 3 = 0 then 'NULL' else '''p''''n''' end as pn, case when c_custkey % 3 = 0 then '' else ', pn = COALESCE(NULLIF(pn, ''''), ''p''''n'')' end as set_pn,
               case when c_custkey % 5 = 0 then 'NULL' else cast(c_nationkey as varchar) end as y, case when c_custkey % 5 = 0 then '' else ', start_year = COALESCE(start_year, ' || c_nationkey || ')' end as set_y from customer
    )
    select k as c_custkey, 0 as n, 'INSERT INTO person_wiki (person_id, person_nt_ind, wikidata_id, wiki_url, wiki_source_page, created_by) VALUES (' || k || ', ' || n || ', ''Q' || k || ''', NULL, ' || page || ', ''wiki-import'');' as sql from c where k % 4 = 0 and k <> 0
    union all select k, 0, 'INSERT INTO person_nt (person_id, dyn, fief, pn, nt, start_year, end_year, dyn_id, created_by) VALUES (' || k || ', ''d'', NULL, ' || pn || ', ''王'', ' || y || ', NULL, NULL, ''wiki-import'');' from c where k % 4 = 1
    union all select k, 1, 'INSERT INTO person_wiki (person_id, person_nt_ind, wikidata_id, wiki_url, wiki_source_page, created_by) VALUES (' || k || ', LAST_INSERT_ID(), ''Q' || k || ''', NULL, ' || page || ', ''wiki-import'');' from c where k % 4 = 1
    union all select k, 0, 'UPDATE person_nt SET modified_by = ''wiki-import'', mod_date = NOW()' || set_pn || set_y || ' WHERE ind = ' || n || ';' from c where k % 4 = 2 and n <> 0
    union all select k, 1, 'INSERT INTO person_wiki (person_id, person_nt_ind, wikidata_id, wiki_url, wiki_source_page, created_by) VALUES (' || k || ', ' || n || ', ''Q' || k || ''', NULL, ' || page || ', ''wiki-import'');' from c where k % 4 = 2 and n <> 0
    union all select k, 0, 'INSERT INTO nt_wiki (dyn, fief, pn, nt, start_year, end_year, wiki_source_page, wiki_source_page_id, wiki_source_wikidata, wiki_person_wikidata, wiki_person_url, wiki_person_name, link_status, created_by) VALUES (''d'', NULL, ' || pn || ', ''王'', ' || y || ', NULL, ' || page || ', ' || k || ', NULL, ''Q' || k || ''', NULL, ''甲'', ''title_only'', ''wiki-import'');' from c where k % 4 = 3
""")
def sql_render(spark, sf_dir):
    """The statements of all actions."""
    k, null = F.col("c_custkey"), F.lit(None).cast("string")
    plans = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(k % 4 == 0, "link").when(k % 4 == 1, "insert_nt").when(k % 4 == 2, "update_nt").otherwise("link_title").alias("action"), k.alias("personId"), F.col("c_nationkey").alias("ntInd"), F.concat(F.lit("Q"), k.cast("string")).alias("wikidataId"), F.col("c_name").alias("sourcePage"),
        F.lit("d").alias("dyn"), F.when(k % 3 != 0, "p'n").alias("pn"), F.lit("王").alias("nt"), F.when(k % 5 != 0, F.col("c_nationkey")).alias("startYear"), k.alias("sourcePageId"), F.lit("甲").alias("personBare"), *[null.alias(c) for c in ("wikiPersonUrl", "fief", "dynId", "endYear", "sourceWikidataId")],
    )
    return review.statements(plans).select("c_custkey", "n", "sql")


@query("""
    with c as (select c_name, c_custkey from customer where c_acctbal > 0)
    select count(*) as n, count(*) filter (where o_orderkey % 3 = 0) as needs_review, count(h.c_custkey) as with_person_page, count(*) filter (where h.c_custkey is not null or o_orderkey % 2 = 0) as with_item
    from (select o_orderkey, b.c_name as person from orders join customer a on o_custkey = a.c_custkey left join customer b on o_custkey + 1 = b.c_custkey) o left join c h on h.c_name = o.person
""")
def conditional_counts(spark, sf_dir):
    """What a crawl reports of its rows, counted in one pass."""
    rows, info = _enriched(spark, sf_dir)
    out = normalize.enrich(rows.withColumn("wikidataId", F.when(F.col("o_orderkey") % 2 == 0, "old")), info, spark.createDataFrame([], "source string, target string"))
    return review.crawl_counts(out.withColumn("needsReview", F.col("o_orderkey") % 3 == 0))


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 3")
def print_sample(spark, sf_dir):
    """The first three rows, as a crawl prints them."""
    return review.sample(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"])


@query("""
    select doc_id, case when regexp_matches(t, '[",\n\r]') then '"' || replace(t, '"', '""') || '"' else t end as cell, case when t = '' then 'NULL' else '''' || replace(replace(t, '\\', '\\\\'), '''', '''''') || '''' end as literal
    from (select doc_id, text as t from documents)
""")
def cell_escape(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", csv_cell(F.col("text")).alias("cell"), sql_string(F.col("text")).alias("literal"))


@query("select o_orderkey, coalesce(cast(cast(trunc(o_totalprice) as bigint) as varchar), 'NULL') as literal from orders")
def int_literal(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", sql_int(F.col("o_totalprice")).alias("literal"))


@query("select doc_id, sha256(text) as sha256, strlen(text) as bytes from documents")
def content_sha256(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("bytes"))


@query("select event_id, row_number() over w as occurrence_index, case when row_number() over w = 1 then 'full' else 'short' end as form from events window w as (partition by user_id, event_type order by event_id)")
def occurrence_index(spark, sf_dir):
    return names.occurrences(table(spark, sf_dir, "events"), "user_id", "event_type", "event_id").select("event_id", F.col("occurrence_index").cast("long").alias("occurrence_index"), "form")


@query("select doc_id from documents where contains(replace(strip_accents(lower(text)), ' ', ''), 'reau') order by doc_id limit 20")
def accent_insensitive_search(spark, sf_dir):
    return names.search(table(spark, sf_dir, "documents").select("doc_id", "text"), ["text"], "Ré au", 20, 0, "doc_id").select("doc_id")


@query("select n_nationkey, 'https://zh.wikipedia.org/wiki/' || replace(n_name, ' ', '_') || '_(x)%26' as url, n_name as bare from nation")
def page_urls(spark, sf_dir):
    title = F.concat("n_name", F.lit(" (x)&"))
    return table(spark, sf_dir, "nation").select("n_nationkey", page_url(title).alias("url"), without_note(F.concat("n_name", F.lit(" (x)"))).alias("bare"))


@query("select c_custkey, c_nationkey not in (select c_nationkey from customer where c_acctbal > 9900) as missing from customer")
def sync_missing(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    known = customer.where("c_acctbal > 9900").select(F.col("c_nationkey").alias("nation"))
    return names.missing_ids(customer.select("c_custkey", F.col("c_nationkey").alias("entry")).withColumnRenamed("entry", "nation"), known, "nation").select("c_custkey", "missing")


@query("""
    with w as (select p_partkey, case p_partkey % 3 when 0 then '司' when 1 then '司马' else '司马相' end || case when p_partkey % 2 = 0 then '如' else '' end as w from part),
    f as (select *, case when starts_with(w, '司马') and length(w) > 2 then '司马' when length(w) > 1 then '司' end as family from w)
    select p_partkey, family, w[length(family) + 1 :] as given from f
""")
def longest_prefix_segment(spark, sf_dir):
    k = F.col("p_partkey")
    name = F.concat(F.when(k % 3 == 0, "司").when(k % 3 == 1, "司马").otherwise("司马相"), F.when(k % 2 == 0, "如").otherwise(""))
    split = names.segment(name, ["司马", "司"])
    return table(spark, sf_dir, "part").select("p_partkey", split["family"].alias("family"), split["given"].alias("given"))


@query("""
    with w as (select p_partkey, case p_partkey % 3 when 0 then '司' when 1 then '司马' else '司马相' end || case when p_partkey % 2 = 0 then '如' else '' end as w, case when p_size % 4 = 0 then '' else 'F' || p_size end as f, case when p_size % 5 = 0 then null else 'G' || p_size end as g from part)
    select p_partkey, case when length(w) < 2 then p_partkey || '!' when f = '' and g is null then p_partkey || '!' when f = '' then g when g is null then f else f || ' ' || g end as name from w
""")
def romanized_names(spark, sf_dir):
    """Family and given name in Latin letters; the whole name's where there is no split, or no part."""
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    name = F.concat(F.when(k % 3 == 0, "司").when(k % 3 == 1, "司马").otherwise("司马相"), F.when(k % 2 == 0, "如").otherwise(""))
    family, given = F.when(F.col("p_size") % 4 == 0, "").otherwise(F.concat(F.lit("F"), size)), F.when(F.col("p_size") % 5 != 0, F.concat(F.lit("G"), size))
    return table(spark, sf_dir, "part").select("p_partkey", names.romanized(names.segment(name, ["司马", "司"]), family, given, F.concat(k.cast("string"), F.lit("!"))).alias("name"))


from . import domain  # noqa: E402, F401  registers its queries too
