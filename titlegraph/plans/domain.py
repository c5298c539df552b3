"""Registered queries that run the engine's sources, records, rules and streams through files in the shared folder."""

from __future__ import annotations

import json
import urllib.parse

from pyspark.sql import functions as F

from ..functions.constants import WIKI_SOURCE
from ..functions.text import translate
from ..operators import asset, json_rules, manifest, match, names, normalize, review, wikitext
from ..sources import asset_sink, dump, files, wiki_api
from ..storage import cut, delete, scratch
from ..streaming import crawl
from .queries import _MATCH, _parts, query, table


def _pages(spark, sf_dir):
    """A page for each supplier; two share a title. Some are redirects, some no lists, some have no text."""
    k = F.col("s_suppkey")
    text = lambda c: c.cast("string")
    body = F.concat(F.lit("==汉朝==\n*第一次册封\n**[[人"), text(k), F.lit(" (某王)|人"), text(k), F.lit("]]，"), text(k + 40), F.lit("年-?年在位\n==参见==\n*[[某书]]\n"), F.when(k % 5 == 0, "").otherwise("{{disambig}}"))
    body = F.when(k % 11 != 0, F.concat(F.when(k % 7 == 0, "#REDIRECT [[某王]]\n").otherwise(""), body))
    return table(spark, sf_dir, "supplier").select(F.concat(F.lit(" 東"), text(F.floor(k / 2)), F.lit("王 ")).alias("title"), body.alias("wikitext"), k.alias("pageId"), F.concat(F.lit("u"), text(k)).alias("url"), F.concat(F.lit("Q"), text(k)).alias("wikidataId"))


@query("""
    select n_name || '王' as sourcePage, 2 as line_no, '汉朝' as dynastySection, n_name as fief, null as pn, '王' as nt, 'B' || n_nationkey as person, 'A' || n_nationkey as wikiPersonTitle, cast(40 + n_nationkey as int) as startYear, cast(50 + n_nationkey as int) as endYear, 'high' as confidence, false as needsReview from nation
    union all select n_name || '王', 3, '汉朝', n_name, '恭', '王', 'C', 'C', 43, null, 'high', false from nation
    union all select n_name || '王', 4, '汉朝', '崇德', null, '侯', 'D', 'D (x)', 200, 220, 'medium', true from nation
    union all select n_name || '王', 8, '西晋', n_name, '文献', '王', 'E', 'E', null, 311, 'high', false from nation
    union all select n_name || '王', 9, '西晋', '南康文宣', null, '公', null, null, null, null, 'medium', true from nation
""")
def parse_holders(spark, sf_dir):
    """Lines with and without links, titles, years; grants' headings and reference sections give nothing."""
    k, own = F.col("n_nationkey"), F.col("n_name")
    year = lambda n: (k + n).cast("string")
    text = F.concat(
        F.lit("==汉朝==\n*第一次册封\n**[[A"), k.cast("string"), F.lit("|B"), k.cast("string"), F.lit("]]，"), year(40), F.lit("年-"), year(50), F.lit("年在位\n**"), own, F.lit("恭王[[C]]，43年-?年在位\n**崇德侯[[D (x)|D]]，200年-220年\n"),
        F.lit("==参见==\n*[[no]]\n== 西晋 ==\n*"), own, F.lit("文献王[[E]]，?年-311年\n*南康文宣公\nno list"),
    )
    return wikitext.holders(table(spark, sf_dir, "nation").select(F.concat(own, F.lit("王")).alias("title"), text.alias("wikitext"))).drop("rawLine")


@query("select n_name || '王' as sourcePage, n_nationkey + 1 as sourcePageId, '汉朝' as dynastySection, n_name as fief, 'B' || n_nationkey as person, 'Q' || n_nationkey as wikidataId, 'zh.wikipedia' as source, 19 as columns, true as same from nation")
def crawl_export(spark, sf_dir):
    """A crawl's rows as NDJSON and as a sheet of its 19 columns; both are read back and compared."""
    k, own = F.col("n_nationkey"), F.col("n_name")
    page = F.concat(F.lit("==汉朝==\n*[[A"), k.cast("string"), F.lit("|B"), k.cast("string"), F.lit("]]，1年-2年\n{{disambig}}"))
    pages = table(spark, sf_dir, "nation").select(F.concat(own, F.lit("王")).alias("title"), page.alias("wikitext"), (k + 1).cast("long").alias("pageId"), F.lit("u").alias("url"), F.lit(None).cast("string").alias("wikidataId"))
    people = table(spark, sf_dir, "nation").select(F.concat(F.lit("A"), k.cast("string")).alias("title"), k.cast("long").alias("pageId"), F.lit("p").alias("url"), F.concat(F.lit("Q"), k.cast("string")).alias("wikidataId"))
    rows = normalize.enrich(wikitext.ingest(pages), people, spark.createDataFrame([], "source string, target string"))
    at = scratch(spark, "export")
    files.write_ndjson(rows.drop("line_no"), f"{at}/ndjson", WIKI_SOURCE)
    again = files.read_ndjson(spark, f"{at}/ndjson")
    files.write_csv(again, f"{at}/csv", files.CRAWL_COLUMNS)
    sheet = files.read_csv(spark, f"{at}/csv", files.CRAWL_COLUMNS)
    same = F.lit(True)
    for c in files.CRAWL_COLUMNS:
        same = same & (F.col(f"s.{c}") == F.coalesce(F.col(f"n.{c}").cast("string"), F.lit("")))
    both = again.alias("n").join(sheet.alias("s"), F.col("n.sourcePage") == F.col("s.sourcePage"))
    out = both.select("n.sourcePage", F.col("n.sourcePageId").cast("int").alias("sourcePageId"), "n.dynastySection", "n.fief", "n.person", "n.wikidataId", "n.source", F.lit(len(sheet.columns)).alias("columns"), same.alias("same"))
    out = cut(out, "exported")
    delete(spark, at)
    return out


@query("select '東海王' as sourcePage, '東海' as fief, '人' || n_nationkey as person from nation")
def local_pages(spark, sf_dir):
    """Pages from local files, under a title that is given."""
    at = scratch(spark, "pages")
    table(spark, sf_dir, "nation").select("n_name", F.concat(F.lit("==汉朝==\n*[[人"), F.col("n_nationkey").cast("string"), F.lit("]]")).alias("value")).write.partitionBy("n_name").text(at)
    out = cut(wikitext.holders(files.read_wikitext(spark, f"{at}/*/part-*", "東海王")).select("sourcePage", "fief", "person"), "local-pages")
    delete(spark, at)
    return out


_FIT = "from supplier where s_suppkey % 5 <> 0 and s_suppkey % 7 <> 0 and s_suppkey % 11 <> 0"


@query(f"""
    select '汉朝' as dynastySection, '東' || (s_suppkey // 2) as fief, null as pn, '王' as nt, '人' || s_suppkey as person, '人' || s_suppkey || ' (某王)' as wikiPersonTitle, cast(s_suppkey + 40 as int) as startYear, null as endYear, 'high' as confidence, false as needsReview,
           s_suppkey as sourcePageId, 'Q' || s_suppkey as sourceWikidataId {_FIT}
""")
def ingest_pages(spark, sf_dir):
    """Redirects, pages that are no lists and pages without text give nothing; each page's metadata comes along, also where
    pages share a title."""
    out = wikitext.ingest(_pages(spark, sf_dir))
    return out.select("dynastySection", "fief", "pn", "nt", "person", "wikiPersonTitle", "startYear", "endYear", "confidence", "needsReview", "sourcePageId", "sourceWikidataId")


@query(f"select '東' || (s_suppkey // 2) as fief, '人' || s_suppkey as person, s_suppkey as sourcePageId {_FIT} and (s_suppkey % 2 = 0 or (s_suppkey - 1) % 6 <> 0)")
def stream_ingest(spark, sf_dir):
    """Files that arrive are parsed once, whenever the stream runs again, and so are titles that come again in a later file
    and run; files and lines that cannot be read give nothing."""
    at, k = scratch(spark, "crawl"), F.col("pageId")
    pages = _pages(spark, sf_dir)
    run = lambda: crawl.ingest_stream(spark, f"{at}/in", f"{at}/out", f"{at}/checkpoint", once=True).awaitTermination()
    pages.where(k % 2 == 0).write.json(f"{at}/in")
    run()
    again = (k - 1) % 6 == 0
    pages.where((k % 2 == 1) & again).write.mode("append").json(f"{at}/in")
    table(spark, sf_dir, "region").select(F.concat(F.lit("{"), "r_name").alias("value")).write.mode("append").text(f"{at}/in")
    run()
    pages.where((k % 2 == 1) & ~again).withColumn("title", F.concat(F.lit(" "), "title")).write.mode("append").json(f"{at}/in")
    run()
    out = cut(spark.read.parquet(f"{at}/out").select("fief", "person", "sourcePageId"), "crawled")
    delete(spark, at)
    return out


def _dump_lines(rows, insert, body, order, per=20):
    """Lines of INSERTs of a few rows each, in order, in as many files as there are partitions."""
    groups = rows.groupBy(F.floor(F.col(order) / per).alias("g")).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), body.alias("t")))).alias("ts"))
    line = F.concat(F.lit(insert), F.array_join(F.transform("ts", lambda x: x["t"]), ","), F.lit(";"))
    return groups.select("g", line.alias("value")).repartitionByRange("g").sortWithinPartitions("g").select("value")


@query("""
    select row_number() over (order by pass, s_suppkey) as pos, s_suppkey as id, case when pass = 0 then replace(s_name, 'Supplier', 'it''s;(a\\b),') when s_acctbal > 0 then 'x' end as name
    from supplier, (values (0), (1)) t(pass)
""")
def dump_tables(spark, sf_dir):
    """Dumps of many INSERTs, with quotes, escapes, brackets, NULL and another table between, read in ranges of 1,000 bytes."""
    supplier, k = table(spark, sf_dir, "supplier"), F.col("s_suppkey").cast("string")
    quoted = F.replace(F.replace(F.replace("s_name", F.lit("Supplier"), F.lit("it's;(a\\b),")), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    first = F.concat(F.lit("("), k, F.lit(",'"), quoted, F.lit("')"))
    second = F.concat(F.lit("("), k, F.when(F.col("s_acctbal") > 0, ",_binary 'x')").otherwise(",NULL)"))
    at = scratch(spark, "dump")
    _dump_lines(supplier, "INSERT INTO `other` VALUES (1,'z;INSERT INTO `person` VALUES (0)');\nINSERT INTO `person` VALUES ", first, "s_suppkey").write.text(f"{at}/a")
    _dump_lines(supplier, "INSERT INTO `person` (`id`,`name`)\nVALUES ", second, "s_suppkey").write.text(f"{at}/b")
    rows = review.number(dump.load(spark, at, "person", size=1_000), ["row_pos"], "pos")
    out = cut(rows.select("pos", "id", "name"), "dumped")
    delete(spark, at)
    return out


@query("""
    select p_partkey as ind, p_brand as dyn, p_size as start_year, s_name as can_name, r_regionkey as dyn_id, r_name as dyn_name
    from part left join supplier on s_suppkey = p_partkey % 100 left join region on r_regionkey = p_size % 7
""")
def dump_match(spark, sf_dir):
    """The three tables of a dump that matching reads, in one folder of files; titles with their persons and dynasties."""
    q = lambda c: F.concat(F.lit("'"), c.cast("string"), F.lit("'"))
    n, comma = F.lit("NULL"), F.lit(",")
    part, supplier, region = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier"), table(spark, sf_dir, "region")
    title = [F.col("p_partkey").cast("string"), (F.col("p_partkey") % 100).cast("string"), q(F.col("p_brand")), q(F.col("p_type")), n, n, F.lit("'王'"), n, n, n, F.col("p_size").cast("string"), n, (F.col("p_size") % 7).cast("string")]
    at = scratch(spark, "dump")
    for name, rows, key, values in (("person_nt", part, "p_partkey", title), ("person", supplier, "s_suppkey", [F.col("s_suppkey").cast("string"), q(F.col("s_name"))]), ("date_dynasties", region, "r_regionkey", [F.col("r_regionkey").cast("string"), q(F.col("r_name"))])):
        body = F.concat(F.lit("("), *[x for i, v in enumerate(values) for x in ([comma] if i else []) + [v]], F.lit(")"))
        _dump_lines(rows, f"INSERT INTO `{name}` VALUES ", body, key).write.text(f"{at}/{name}")
    titles, persons, dynasties = dump.load_reference(spark, at, size=4_000)
    out = match.with_names(titles, persons).join(dynasties.select(F.col("id").alias("dyn_id"), F.col("name").alias("dyn_name")), "dyn_id", "left")
    out = cut(out.select("ind", "dyn", "start_year", "can_name", F.when(F.col("dyn_name").isNotNull(), F.col("dyn_id")).cast("int").alias("dyn_id"), "dyn_name"), "dumped")
    delete(spark, at)
    return out


@query("select row_number() over (order by c_custkey) - 1 as row_pos, case when c_custkey % 3 = 0 then c_custkey * 100 else row_number() over (order by c_custkey) end as review_id, c_name as person, 'zh.wikipedia' as source, c_nationkey as startYear from customer")
def ndjson_numbered(spark, sf_dir):
    """Rows written as NDJSON, in many files, and read with their places; a row's own review_id counts."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").repartitionByRange("c_custkey").sortWithinPartitions("c_custkey")
    rows = rows.select(F.lit(None).cast("string").alias("source"), F.col("c_name").alias("person"), F.col("c_nationkey").alias("startYear"), F.when(k % 3 == 0, k * 100).alias("review_id"))
    at = scratch(spark, "ndjson")
    files.write_ndjson(rows, at, WIKI_SOURCE)
    out = cut(files.read_ndjson_numbered(spark, at).select("row_pos", "review_id", "person", "source", "startYear"), "numbered-lines")
    delete(spark, at)
    return out


@query("select c_custkey as id, c_mktsegment || '\"a\nb,' as cell, '' as blank from customer")
def csv_sheet(spark, sf_dir):
    """Cells with quotes, commas and line breaks, and blank ones, through a sheet."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.concat("c_mktsegment", F.lit('"a\nb,')).alias("cell"), F.lit("").alias("blank"))
    at = scratch(spark, "sheet")
    files.write_csv(rows, at, ["id", "cell", "blank"])
    return files.read_csv(spark, at, ["id", "cell", "blank"]).select(F.col("id").cast("long").alias("id"), "cell", "blank")


@query("select 'part' as kind, sha256(n_name || chr(10)) as sha256, strlen(n_name) + 1 as bytes from nation")
def file_inventory(spark, sf_dir):
    at = scratch(spark, "inventory")
    table(spark, sf_dir, "nation").select("n_name").repartition("n_name").write.option("maxRecordsPerFile", 1).text(at)
    return files.inventory(spark, f"{at}/part-*").select(F.substring("fileName", 1, 4).alias("kind"), "sha256", "bytes")


@query("select n_nationkey - 0 as pos, n_name as value from nation")
def json_list(spark, sf_dir):
    """An array in a field of a JSON file, with the places of its items."""
    at = scratch(spark, "list")
    held = table(spark, sf_dir, "nation").agg(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x["n_name"]).alias("surnames"))
    held.coalesce(1).write.json(at)
    return files.read_list(spark, at, "surnames")


@query("select n_name as title, n_nationkey + 1 as pageId, 'https://x/' || n_nationkey as url, case when n_regionkey > 0 then 'Q' || n_nationkey end as wikidataId from nation where n_regionkey < 4 union all select n_name || ' (old)', case when n_regionkey < 4 then n_nationkey + 1 end, case when n_regionkey < 4 then 'https://x/' || n_nationkey end, case when n_regionkey between 1 and 3 then 'Q' || n_nationkey end from nation")
def wiki_api_pages(spark, sf_dir):
    """Captured answers: pages, missing ones and redirects; asked titles keep their own name."""
    nation, k = table(spark, sf_dir, "nation"), F.col("n_nationkey").cast("string")
    props = F.when(F.col("n_regionkey") > 0, F.struct(F.concat(F.lit("Q"), k).alias("wikibase_item")))
    page = F.struct(F.when(F.col("n_regionkey") < 4, F.col("n_nationkey") + 1).alias("pageid"), F.col("n_name").alias("title"), F.concat(F.lit("https://x/"), k).alias("fullurl"), F.when(F.col("n_regionkey") == 4, "").alias("missing"), props.alias("pageprops"))
    raw = nation.select(F.to_json(F.struct(F.struct(F.create_map(k, page).alias("pages"), F.array(F.struct(F.concat("n_name", F.lit(" (old)")).alias("from"), F.col("n_name").alias("to"))).alias("redirects")).alias("query"))).alias("value"))
    pages, hops = wiki_api.captured(raw)
    asked = nation.where("n_regionkey < 4").select(F.col("n_name").alias("title")).union(nation.select(F.concat("n_name", F.lit(" (old)"))))
    return wiki_api.with_members(asked, pages, hops).select("title", F.col("pageId").cast("int").alias("pageId"), "url", "wikidataId")


@query("select n_nationkey, element, value, ref from (select n_nationkey, 'nationality' as element, n_name as value, 'n' || n_nationkey as ref from nation union all select n_nationkey, 'state', 'a b', null from nation where n_regionkey = 1 union all select n_nationkey, 'nobleTitle', '東海王', null from nation)")
def xml_facts(spark, sf_dir):
    """The table function facts() over XML wrappers."""
    names.register(spark)
    k = F.col("n_nationkey").cast("string")
    xml = F.concat(F.lit("<w><nationality ref='n"), k, F.lit("'> "), F.col("n_name"), F.lit("</nationality>"), F.when(F.col("n_regionkey") == 1, "<officeName>a <b>b</b></officeName>").otherwise("<officeName> </officeName>"), F.lit("<nobleTitle><placeName>東海</placeName><roleName>王</roleName></nobleTitle></w>"))
    table(spark, sf_dir, "nation").select("n_nationkey", xml.alias("xml")).createOrReplaceTempView("wrappers")
    return spark.sql("select n_nationkey, f.element, f.value, f.ref from wrappers, lateral facts(xml) f")


_GOOD = {"manifestVersion": "1.0.0", "id": "x-y", "name": "n", "version": "1.0.0", "description": "d", "license": "MIT", "host": {"minVersion": "1"}, "entry": {"kind": "javascript", "module": "m"}}
_BAD = {
    1: {"manifestVersion": "9.0.0", "id": "@name", "name": " "},
    2: _GOOD | {"version": "1", "regions": ["china", "@type", 7], "entry": {"kind": "hybrid", "module": "m"}, "more": 1, "author": None},
    3: _GOOD | {"contributions": {"toolsMenu": [{"id": "@name", "label": "l"}, 7], "autoTagging": [{"id": "t", "label": "l", "kind": "none"}], "authorityPacks": [{"id": "p", "label": "l", "install": {"source": "url"}}, {"id": "p", "label": "l"}], "settingsSections": 1}, "dependencies": {"extensions": ["ok", "@brand"]}},
    4: ["@name"],
    6: _GOOD | {"host": {"minVersion": 1, "other": 2}, "languages": ["zh", ""], "languagePrompt": {"message": "m", "documentLanguages": "zh"}, "bundled": [None], "contributions": {"disambiguation": [{"id": "d", "label": "l", "entityKind": "person", "x": 1}]}},
    7: "@name",
    8: _GOOD | {"entry": {"kind": "python", "python": {"module": ""}}},
}


def _manifests(spark, sf_dir):
    """A manifest for each part, of one of ten kinds; some are no JSON."""
    kind, raw = F.col("p_size") % 10, F.lit(json.dumps(_GOOD))
    for n, held in _BAD.items():
        raw = F.when(kind == n, F.lit(json.dumps(held))).otherwise(raw)
    for mark, c in (("@name", "p_name"), ("@type", "p_type"), ("@brand", "p_brand")):
        raw = F.replace(raw, F.lit(mark), F.col(c))
    raw = F.when(kind == 5, F.concat(F.lit("{"), "p_name")).when(kind == 9, F.lit(None)).otherwise(raw)
    return table(spark, sf_dir, "part").select("p_partkey", "p_size", raw.alias("raw"))


_USUAL = ["manifestVersion must be 1.0.0", "id must be a non-empty string", "name must be a non-empty string", "version must be a non-empty string", "description must be a non-empty string", "license must be a non-empty string", "host must be an object", "entry must be an object"]
_ERRORS = {
    1: [_USUAL[0], "id must be kebab-case", *_USUAL[2:]],
    2: ["manifest.more is not allowed", "version must be semver", "regions contains invalid value: @type", "regions contains invalid value: 7", "entry.python is required for python/hybrid extensions"],
    3: ["contributions.toolsMenu[0].id must be kebab-case", "contributions.toolsMenu[1] must be an object", "contributions.autoTagging[0].kind is invalid", "contributions.authorityPacks[0].install.url is required when source=url", "contributions.authorityPacks[1].install is required", "contributions.settingsSections must be an array", "dependencies.extensions contains invalid id: @brand"],
    4: ["manifest.0 is not allowed", *_USUAL],
    5: ["manifest is not JSON"],
    6: ["host.other is not allowed", "host.minVersion must be a non-empty string", "languages[1] must be a non-empty string", "languagePrompt.documentLanguages must be an array", "contributions.disambiguation[0].x is not allowed", "bundled[0] must be a non-empty string"],
    7: ["manifest must be an object"],
    8: ["entry.python.module must be a non-empty string"],
    9: ["manifest must be an object"],
}
_ERROR_ROWS = ", ".join(f"({k}, {n}, '{e}')" for k, es in _ERRORS.items() for n, e in enumerate(es))


@query(f"select p_partkey, n, replace(replace(e, '@type', p_type), '@brand', p_brand) as error from part join (values {_ERROR_ROWS}) t(kind, n, e) on p_size % 10 = kind")
def manifest_errors(spark, sf_dir):
    """Manifests with their errors in order."""
    return manifest.validate(_manifests(spark, sf_dir)).select("p_partkey", F.posexplode("errors").alias("n", "error"))


_SCHEMA = {
    "type": "object", "required": ["k", "kind", "at"], "additionalProperties": False,
    "properties": {"k": {"$ref": "#/$defs/small"}, "kind": {"enum": ["click", "view", "error"]}, "tags": {"type": "array", "uniqueItems": True, "items": {"type": "string", "pattern": "^[a-z]+$"}}, "at": {"type": "number"}},
    "if": {"properties": {"kind": {"const": "error"}}, "required": ["kind"]}, "then": {"required": ["tags"]},
    "$defs": {"small": {"type": "integer", "minimum": 10, "maximum": 90}},
}


@query("""
    with e as (select event_id, cast(props::json ->> '$.k' as int) as k, event_type as kind, event_id % 4 as r, event_id % 9 as s from events),
    f as (
        select event_id, 1 as o, '$.more is not allowed' as error from e where s = 8
        union all select event_id, 2, '$.at is required' from e where r = 3
        union all select event_id, 3, '$.k must be at least 10' from e where k < 10
        union all select event_id, 4, '$.k must be at most 90' from e where k > 90
        union all select event_id, 5, '$.kind must be one of ["click", "view", "error"]' from e where kind not in ('click', 'view', 'error')
        union all select event_id, 6, '$.tags must have unique items' from e where r = 1
        union all select event_id, 7, '$.tags[0] must match ^[a-z]+$' from e where r = 1 and not regexp_matches(kind, '^[a-z]+$')
        union all select event_id, 8, '$.tags[1] must match ^[a-z]+$' from e where r = 1 and not regexp_matches(kind, '^[a-z]+$')
        union all select event_id, 9, '$.tags[0] must be of type string' from e where r = 2
        union all select event_id, 10, '$.tags is required' from e where r not in (1, 2) and kind = 'error'
    )
    select event_id, cast(row_number() over (partition by event_id order by o) - 1 as int) as n, error from f
""")
def json_rule_validation(spark, sf_dir):
    """JSON of events against a schema."""
    r, s = F.col("event_id") % 4, F.col("event_id") % 9
    tags = F.when(r == 1, F.concat(F.lit(', "tags": ["'), "event_type", F.lit('", "'), "event_type", F.lit('"]'))).when(r == 2, F.concat(F.lit(', "tags": ['), F.col("event_id").cast("string"), F.lit("]"))).otherwise("")
    more = F.concat(F.when(r != 3, ', "at": 1.5').otherwise(""), F.when(s == 8, ', "more": null').otherwise(""))
    raw = F.concat(F.expr("substring(props, 1, length(props) - 1)"), F.lit(', "kind": "'), "event_type", F.lit('"'), tags, more, F.lit("}"))
    rows = table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    return json_rules.with_errors(rows, "raw", _SCHEMA).select("event_id", F.posexplode("errors").alias("n", "error"))


@query("select 'nation-' || n_nationkey as id, case when n_regionkey = 0 then 1 else 0 end as errors from nation where n_regionkey <> 4")
def manifest_files(spark, sf_dir):
    """Manifests as files, found by a glob, but for those of a folder that is left out."""
    at, k = scratch(spark, "manifests"), F.col("n_nationkey").cast("string")
    raw = F.concat(F.lit('{"id": "nation-'), k, F.lit('", '), F.lit(json.dumps({c: v for c, v in _GOOD.items() if c != "id"})[1:-1]), F.when(F.col("n_regionkey") == 0, ', "more": 1').otherwise(""), F.lit("}"))
    rows = table(spark, sf_dir, "nation").select(raw.alias("value"), F.when(F.col("n_regionkey") == 4, "sdk").otherwise("x").alias("kind"), "n_nationkey")
    rows.repartition("n_nationkey").select("value", "kind").write.option("maxRecordsPerFile", 1).partitionBy("kind").text(at)
    found = manifest.validate(manifest.read_manifests(spark, f"{at}/*/part-*", skip="kind=sdk"))
    out = cut(found.select(F.get_json_object("raw", "$.id").alias("id"), F.size("errors").alias("errors")), "manifests")
    delete(spark, at)
    return out


def _wide(rows, **kinds):
    for c, k in kinds.items():
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast(k))
    return rows


@query("""
    with p as (
        select p_partkey, p_type, p_brand, p_size, case when p_size % 3 = 0 then ' link ' when p_size % 3 = 1 then 'skip' else '' end as manual, p_size % 4 as s, p_size > 40 as fix, p_size % 5 = 0 as hasdb from part
    )
    select p_partkey as review_id, case when trim(manual) <> '' then trim(manual) when s = 0 then 'link' when s = 1 then 'link_title' when fix then 'link_title' else 'skip' end as action,
           case when fix then 'fixed' when p_size % 7 = 0 then 'sheet' else p_type end as fief, case when hasdb then 'db' when p_size % 6 = 0 then '東漢' else '無' end as dyn, case when hasdb then 77 when p_size % 6 = 0 then 9 end as dyn_id, case when hasdb then 5 end as person_id
    from p
""")
def review_plan(spark, sf_dir):
    """Corrections, decisions, dynasty ids and the sheet's own columns."""
    size = F.col("p_size")
    db = F.when(size % 5 == 0, F.struct(F.lit(5).cast("long").alias("person_id"), F.lit(6).cast("long").alias("ind"), F.lit("db").alias("dyn"), F.lit(77).cast("long").alias("dyn_id")))
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("review_id"), F.when(size % 7 != 0, F.col("p_type")).alias("fief"), F.lit("sheet").alias("wiki_fief"), F.col("p_brand").alias("pn"), F.lit("王").alias("nt"), F.when(size % 4 == 0, "link").otherwise("review").alias("suggestedAction"), F.when(size % 4 == 1, "wiki_only").otherwise("matched").alias("matchStatus"), F.when(size % 6 == 0, F.array(F.lit(" "), F.lit("東漢 "), F.lit("漢"))).otherwise(F.array(F.lit("無"))).alias("dynCandidates"), db.alias("db"), "p_size")
    sheet = rows.select(F.col("review_id").cast("string").alias("review_id"), F.when(size > 40, "fixed").otherwise("").alias("fief_corrected"), F.lit("").alias("pn_corrected"), F.lit("").alias("reviewer_notes"), F.when(size % 3 == 0, " link ").when(size % 3 == 1, "skip").otherwise("").alias("action"))
    ids = spark.createDataFrame([(0, 8, "東漢"), (1, 9, "東漢"), (2, 10, "漢")], "row_pos long, id long, name string")
    plans = review.plan(review.correct(rows, sheet), ids)
    return plans.select("review_id", "action", "fief", "dyn", F.col("dynId").alias("dyn_id"), F.col("personId").alias("person_id"))


_CANON = """
    with p as (  -- the pack: names of persons, some without a primary one
        select s_suppkey as pid, case when s_suppkey % 4 = 1 then s_name end as primary_name, case when s_suppkey % 4 = 2 then s_name || '皇后' when s_suppkey % 4 = 1 then s_name end as display from supplier
    ), t as (
        select p_partkey, p_brand as d, case when p_size % 4 = 0 then null else p_type end as f, case when p_size % 4 in (0, 1) then null else p_name end as n, case p_size % 4 when 0 then '后' when 3 then null else '王' end as r, primary_name, display
        from part left join p on pid = p_partkey % 100 where p_size % 5 <> 0
    ), e as (
        select p_partkey, d, f, coalesce(r = '后' and display like '%皇后', false) as empress, n, r, primary_name, display from t where r is not null
    ), x as (
        select p_partkey, d, f, case when empress then display[:-3] else n end as n, case when empress then '皇后' else r end as r, case when not empress then primary_name end as h from e
    ), s as (
        select *, list_distinct(list_filter([f || n || r, f || r, f || n || r || h, f || r || h, case when f is null then n || r end, case when f is null then n || r || h end, case when d <> f then d || f || n || r end, case when d <> f then d || f || n || r || h end,
                                             case when f is null then d || n || r end, case when f is null then d || n || r || h end], lambda v: v is not null)) as strings from x
    )
"""


@query(
    _CANON
    + """
    select 'wnt-' || printf('%04d', 682 + row_number() over (order by p_partkey)) as id, 'direct-nt:' || printf('%04d', 682 + row_number() over (order by p_partkey)) as authority, coalesce(h, nullif(concat_ws('', f, n, r), '')) as primary_name,
           array_to_string(list_sort(strings), '|') as strings, concat_ws('|', d, coalesce(f, ''), coalesce(n, ''), r, coalesce(h, '')) as match_key, case when h is not null then cast(p_partkey % 100 as varchar) end as wrapper, case when h is null then 'nobleTitle' end as tag
    from s where len(strings) > 0
"""
)
def canonical_export(spark, sf_dir):
    """Titles that no record covers; an empress takes her name from its display form; an earlier run's records go first."""
    size, none = F.col("p_size"), F.lit(None)
    parts = table(spark, sf_dir, "part")
    titles = parts.select(
        F.col("p_partkey").alias("row_pos"), F.col("p_partkey").alias("ind"), (F.col("p_partkey") % 100).alias("person_id"), F.col("p_brand").alias("dyn"), F.when(size % 4 != 0, F.col("p_type")).alias("fief"), F.when(size % 4 > 1, F.col("p_name")).alias("pn"),
        none.cast("string").alias("pn_abr"), F.when(size % 4 == 0, "后").when(size % 4 != 3, "王").alias("nt"), none.cast("int").alias("start_year"), none.cast("int").alias("end_year"), none.cast("long").alias("dyn_id"),
    )
    k, name = F.col("s_suppkey") % 4, F.col("s_name")
    names = F.when(k == 1, F.array(F.struct(F.lit("primary").alias("type"), name.alias("text")))).otherwise(F.array().cast("array<struct<type:string,text:string>>"))
    at = scratch(spark, "pack")
    table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("authorityId"), F.when(k == 2, F.concat(name, F.lit("皇后"))).alias("displayName"), names.alias("names")).write.json(at)
    key = F.struct((F.col("p_partkey") % 100).cast("string").alias("personId"), F.col("p_partkey").cast("string").alias("ntInd"))
    records = parts.where(size % 5 == 0).select(key.alias("db"), F.lit("wiki").alias("source")).union(parts.where(size % 5 == 1).select(key.alias("db"), F.lit("direct").alias("source")))
    out = asset.canonical_records(titles, asset.pack_names(files.read_pack(spark, at)), asset.covered_keys(asset.without_source(records, "direct")), start=682)
    out = out.select("id", F.col("authorityId").alias("authority"), F.col("primaryName").alias("primary_name"), F.array_join(F.array_sort("searchStrings"), "|").alias("strings"), F.col("matchKey").alias("match_key"), F.col("metadata.wrapper.personId").alias("wrapper"), F.col("metadata.teiTag").alias("tag"))
    out = cut(out, "canonical")
    delete(spark, at)
    return out


_PLANS = """
    with t as (
        select p_partkey, case p_size % 4 when 0 then 'update_nt' when 1 then 'title_only' when 2 then 'link' end as action, p_brand as d, case when p_size % 6 > 0 then p_type end as f, case when p_size % 3 = 0 then p_name end as n, case when p_size % 6 > 0 or p_size % 4 = 1 then '王' end as r,
               case when p_size % 5 > 0 then '甲' || p_partkey end as h, case when p_size % 4 = 0 then p_partkey + 5 end as pid, p_size as y
        from part where p_size % 4 <> 3
    ), s as (
        select *, list_filter([f || n || r, f || r, f || n || r || h, f || r || h, case when f is null then n || r end, case when f is null then n || r || h end, case when d <> f then d || f || n || r end, case when d <> f then d || f || n || r || h end,
                               case when f is null then d || n || r end, case when f is null then d || n || r || h end], lambda v: v is not null) as strings from t
    ), r as (
        select 'wnt-' || printf('%04d', row_number() over (order by p_partkey)) as id, action, array_to_string(strings, '|') as strings, cast(pid as varchar) as person, case when action = 'update_nt' then y end as start_year,
               case when h is not null then coalesce(cast(pid as varchar), 'wikidata:Q' || p_partkey) end as wrapper, concat_ws('|', d, coalesce(f, ''), coalesce(n, ''), r, coalesce(h, '')) as match_key,
               array_to_string(list_filter(strings, lambda v: h is not null and ends_with(v, h)), '|') as wrapper_strings, array_to_string(list_filter(strings, lambda v: h is null or not ends_with(v, h)), '|') as title_strings
        from s where len(strings) > 0
    )
"""


def _records(spark, sf_dir):
    size, key, none = F.col("p_size"), F.col("p_partkey"), F.lit(None)
    plans = table(spark, sf_dir, "part").select(
        key.alias("review_id"), F.when(size % 4 == 0, "update_nt").when(size % 4 == 1, "link_title").when(size % 4 == 2, "link").otherwise("skip").alias("action"), F.lit("page").alias("sourcePage"), F.when(size % 5 > 0, F.concat(F.lit("甲"), key.cast("string"))).alias("personBare"),
        F.col("p_brand").alias("dyn"), F.when(size % 6 > 0, F.col("p_type")).alias("fief"), F.when(size % 3 == 0, F.col("p_name")).alias("pn"), F.when((size % 6 > 0) | (size % 4 == 1), "王").alias("nt"), size.alias("startYear"), none.cast("int").alias("endYear"),
        F.when(size % 4 == 0, key + 5).alias("personId"), none.cast("long").alias("ntInd"), F.concat(F.lit("Q"), key.cast("string")).alias("wikidataId"),
    )
    plans = _wide(plans, sourcePageId="long", sourcePageUrl="string", sourceWikidataId="string", dynastySection="string", wikiPersonUrl="string", reviewer_notes="string", dynId="long", db="struct<can_name:string,dyn:string,fief:string,pn:string,nt:string,dyn_id:long,start_year:int,end_year:int>")
    return asset.wiki_records(plans, ["review_id"])


@query(_PLANS + "select * from r")
def asset_records(spark, sf_dir):
    """Records of plans. Skipped plans and those without any string give none."""
    meta = F.col("metadata")
    return _records(spark, sf_dir).select(
        "id", "action", F.array_join("searchStrings", "|").alias("strings"), F.col("db.personId").alias("person"), F.col("proposedNt.startYear").alias("start_year"), meta["wrapper"]["personId"].alias("wrapper"), F.col("matchKey").alias("match_key"),
        F.array_join(meta["wrapperSearchStrings"], "|").alias("wrapper_strings"), F.array_join(meta["titleSearchStrings"], "|").alias("title_strings"),
    )


@query(_PLANS + "select 'x' as id, 'MIT' as license, action, count(*) as n, (select count(*) from r) as records, count(distinct id) as written from r group by action")
def asset_files(spark, sf_dir):
    """The records and their envelope through the sink, and back."""
    asset_sink.register(spark)
    at = scratch(spark, "asset")
    _records(spark, sf_dir).write.format("asset").option("id", "x").option("license", "MIT").mode("overwrite").save(at)
    own = spark.read.option("multiLine", True).schema("id string, license string, recordCount long, actionCounts map<string,long>").json(f"{at}/{asset_sink.ENVELOPE}")
    written = spark.read.schema("id string, action string").json(f"{at}/part-*").groupBy("action").agg(F.countDistinct("id").alias("written"))
    out = own.select("id", "license", F.col("recordCount").alias("records"), F.explode("actionCounts").alias("action", "n")).join(written, "action")
    out = cut(out.select("id", "license", "action", "n", "records", "written"), "asset-read")
    delete(spark, at)
    return out


@query(_PLANS + "select id, action, cast(null as varchar) as tag from r union all select 'wnt-' || printf('%04d', 1000000 + row_number() over (order by s_suppkey)), 'canonical', 'n' from supplier")
def append_assets(spark, sf_dir):
    """Records with those of another run behind them."""
    more = review.number(table(spark, sf_dir, "supplier"), ["s_suppkey"], "n", 1_000_001).select(F.format_string("wnt-%04d", "n").alias("id"), F.lit("canonical").alias("action"), F.lit("n").alias("tag"))
    return asset.append_records(_records(spark, sf_dir).select("id", "action"), more).select("id", "action", "tag")


@query("select p_partkey, array_to_string(list_sort(list_distinct([p_name, p_type, p_brand] || case when p_size % 2 = 0 then [p_type, 'x', p_name] else [] end)), '|') as paths from part")
def bundled_paths(spark, sf_dir):
    """The set union of the paths that a release bundles."""
    packs = F.when(F.col("p_size") % 2 == 0, F.array("p_type", F.lit("x"), "p_name"))
    out = table(spark, sf_dir, "part").select("p_partkey", asset.bundled_paths(F.array("p_name", "p_type", "p_brand"), packs).alias("paths"))
    return out.select("p_partkey", F.array_join(F.array_sort("paths"), "|").alias("paths"))


_PAIRS = {"red widget": "<1>", "red": "<2>", "widget": "<3>", "cold": "<4>", "old": "<5>", "small ring": "<6>", "ring": "<7>", "l r": "<8>", "g": "G"}


@query("select p_partkey, replace(replace(replace(replace(replace(replace(replace(replace(replace(p_name, 'red widget', '<1>'), 'red', '<2>'), 'cold', '<4>'), 'old', '<5>'), 'small ring', '<6>'), 'l r', '<8>'), 'ring', '<7>'), 'widget', '<3>'), 'g', 'G') as converted from part")
def phrase_convert(spark, sf_dir):
    """Phrases beat their parts, and characters."""
    return table(spark, sf_dir, "part").select("p_partkey", translate(F.col("p_name"), _PAIRS).alias("converted"))


def _turns(spark, sf_dir):
    """Turns as annotations that end where the next begins, but for every second one, which ends earlier."""
    turn, role = F.col("turn"), F.col("role")
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), (turn * 10).alias("start"), (turn * 10 + 10 - turn % 2).alias("end"), role.alias("source"), turn.cast("string").alias("authorityId"), F.when(role.isin("user", "assistant"), "office").otherwise("other").alias("kind"), (role == "assistant").alias("followsOffice"))


@query("""
    with c as (select conv_id as doc_id, role, turn, lead(role) over w as next_role, lead(turn) over w as next_turn from conversations window w as (partition by conv_id order by turn))
    select cast(doc_id as varchar) as who, cast(turn as varchar) as what, cast(next_turn as varchar) as that from c where role in ('user', 'assistant') and next_role = 'assistant' and turn % 2 = 0 and next_turn = turn + 1
    union all select '王' || n_name, 'pattern:王:' || n_name, n_name from nation
    union all select '張' || n_nationkey, null, null from nation where n_regionkey < 2
    union all select case n_regionkey when 2 then '歐陽修' when 3 then '張' else '張良' end, case n_regionkey when 2 then '歐陽' when 4 then '張' end, case n_regionkey when 2 then '修' when 4 then '良' end from nation where n_regionkey >= 2
    union all select n_name, 'nationality', 'n' from nation
""")
def sql_hooks(spark, sf_dir):
    """What annotators call, from SQL: relations and patterns of tables, names, facts."""
    names.register(spark, ["歐陽", "張", "歐"])
    _turns(spark, sf_dir).createOrReplaceTempView("hook_turns")
    key = F.col("n_regionkey")
    name = F.when(key < 2, F.concat(F.lit("張"), F.col("n_nationkey").cast("string"))).when(key == 2, "歐陽修").when(key == 3, "張").otherwise("張良")
    table(spark, sf_dir, "nation").select("n_name", F.col("n_name").alias("surname"), name.alias("name")).createOrReplaceTempView("hook_names")
    return spark.sql("""
        select doc_id as who, sourceIds[0] as what, sourceIds[1] as that from office_relations(table(hook_turns) partition by doc_id order by (start, end), 'assistant', 0)
        union all select searchString, authorityId, surname from name_patterns(table(select surname from hook_names), array('王', '皇'))
        union all select name, s.family, s.given from (select name, segment_name(name) as s from hook_names)
        union all select n_name, f.element, f.ref from hook_names, lateral facts('<w><nationality ref="n">' || n_name || '</nationality></w>') f
    """)


@query("select n_nationkey as pageId, n_name || '王' as title, '人' || n_nationkey as person from nation")
def wiki_crawl(spark, sf_dir):
    """A category as a stream of captured answers, a nation a title, 10 titles an answer; its pages are fetched, and parsed."""
    rows = table(spark, sf_dir, "nation").orderBy("n_nationkey").select("n_nationkey", "n_name").collect()  # what a server would hold
    answers, pages = {}, [(r.n_nationkey, f"{r.n_name}王") for r in rows]
    for i in range(0, len(pages), 10):
        own, more = pages[i : i + 10], i + 10 < len(pages)
        asked = {"action": "query", "list": "categorymembers", "cmtitle": "c", "cmlimit": 500} | ({"cmcontinue": f"t{i}"} if i else {})
        answers[urllib.parse.urlencode(sorted(asked.items()))] = {"query": {"categorymembers": [{"pageid": k, "title": t} for k, t in own]}} | ({"continue": {"cmcontinue": f"t{i + 10}"}} if more else {})
        for k, t in own:
            asked = {"action": "query", "redirects": 1, "prop": "info|pageprops|revisions", "inprop": "url", "titles": t, "rvprop": "content", "rvslots": "main"}
            answers[urllib.parse.urlencode(sorted(asked.items()))] = {"query": {"pages": {str(k): {"pageid": k, "title": t, "fullurl": "u", "revisions": [{"slots": {"main": {"content": f"*[[人{k}]]\n{{{{disambig}}}}"}}}]}}}}
    at = scratch(spark, "wiki")
    spark.createDataFrame([(json.dumps(answers),)], "value string").coalesce(1).write.text(f"{at}/answers")
    (held,) = [r.f for r in spark.read.text(f"{at}/answers").select(F.col("_metadata.file_path").alias("f")).collect()]
    options = {"api": "http://wiki.invalid/api", "category": "c", "delay_ms": "0", "answers": held}
    run = crawl.crawl_category(spark, options, f"{at}/out", f"{at}/checkpoint", batch=1)
    run.processAllAvailable()
    run.stop()
    found, _ = wiki_api.captured(spark.read.schema("value string").parquet(f"{at}/out"))
    out = cut(wikitext.ingest(found).select(F.col("sourcePageId").alias("pageId"), F.col("sourcePage").alias("title"), "person"), "crawled")
    delete(spark, at)
    return out


@query("""
    with e as (select event_id, user_id, event_type from events where value >= 5)
    select event_id, row_number() over w as occurrence_index, case when row_number() over w = 1 then 'full' else 'short' end as form from e window w as (partition by user_id, event_type order by event_id)
""")
def occurrence_recompute(spark, sf_dir):
    """Numbers after rows are deleted: only the groups that lose one are counted again."""
    numbered = names.occurrences(table(spark, sf_dir, "events"), "user_id", "event_type", "event_id")
    out = names.renumber(numbered, table(spark, sf_dir, "events").where("value < 5"), "user_id", "event_type", "event_id")
    return out.select("event_id", F.col("occurrence_index").cast("long").alias("occurrence_index"), "form")


@query(_MATCH + "select row_id from m where not dup and (n >= 1 or only_id is not null)")
def only_matched(spark, sf_dir):
    return match.only_matched(match.match(*_parts(spark, sf_dir))).select("row_id")


@query("""
    with r as (select n_nationkey, n_regionkey, n_name from nation)
    select n_nationkey, case n_regionkey when 0 then '東漢' when 1 then '無名' end as dyn, case when n_regionkey = 2 then 'section:諡號' end as skip,
           case when n_regionkey = 2 then 'skip_section' when row_number() over (partition by n_regionkey order by n_nationkey) > 1 then 'duplicate' else 'ready' end as status, '東海' as fief, '王' as nt, 'fief←sourcePage; nt←sourcePage' as notes
    from r
""")
def normalize_rows(spark, sf_dir):
    """Names converted by a table, blanks filled from the page's title, sections looked up, first of equal rows wins."""
    k = F.col("n_regionkey")
    rows = table(spark, sf_dir, "nation").select("n_nationkey", F.lit("东海王").alias("sourcePage"), F.col("n_nationkey").alias("line_no"), F.when(k == 0, "汉朝").when(k == 1, "无名").when(k == 2, "諡號").alias("dynastySection"), *[F.lit(None).cast("string").alias(c) for c in ("fief", "pn", "nt")], F.concat(F.lit("刘彊"), k.cast("string"), F.lit(" (x)")).alias("person"), F.lit(None).cast("int").alias("startYear"))
    out = normalize.normalize(rows, {"东": "東", "汉": "漢", "无": "無", "刘": "劉"})
    return out.select("n_nationkey", F.get("dynCandidates", F.lit(0)).alias("dyn"), F.col("skipReason").alias("skip"), F.col("reviewStatus").alias("status"), "fief", "nt", F.col("fillNotes").alias("notes"))
