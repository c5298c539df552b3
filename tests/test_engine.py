import glob
import json
import os
import random
import re
import socket
import tempfile
import threading
import time
import urllib.parse
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from titlegraph.functions import phrases, text
from titlegraph.operators import asset, json_rules, manifest, match, names, normalize, review, wikitext
from titlegraph.plans import queries
from titlegraph.sources import asset_sink, dump, files, wiki_api
from titlegraph.streaming import crawl

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    df = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(df.columns)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    assert Counter(map(str, got)) == Counter(map(str, want.fetchall()))


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_labels_and_links(spark):
    lab = lambda s: wikitext.split_label(F.lit(s), F.lit("东海"), F.lit("王"))
    r = one(spark, a=lab("东海恭王"), b=lab("崇德侯"), c=lab("东海文献王"), d=lab("东海王，注"), e=lab(""), f=wikitext.links(F.lit("[[刘政 (东海王)|刘政]]x[[A#b]]")), g=wikitext.years(F.lit("250年-?年在位")), h=wikitext.split_title(F.lit("王")))
    assert tuple(r.a) == ("东海", "恭", "王") and tuple(r.b) == ("崇德", None, "侯") and tuple(r.c) == ("东海", "文献", "王")
    assert tuple(r.d) == ("东海", None, "王") and tuple(r.e) == ("东海", None, "王") and tuple(r.h) == (None, None)
    assert [tuple(x) for x in r.f] == [("刘政 (东海王)", "刘政"), ("A", "A")] and tuple(r.g) == (250, None)


def test_text_functions(spark):
    r = one(spark, a=text.trim(F.lit("\u3000 x\u00a0\n")), b=text.key(F.lit(" e\u0301 ")), c=text.key(F.lit(None).cast("string")), d=text.sql_string(F.lit("a'\\")), e=text.sql_int(F.lit("3.9")), f=text.sql_int(F.lit("x")), g=text.csv_cell(F.lit('a"b')), h=text.page_url(F.lit("A (b)!~*'")), i=text.without_note(F.lit("刘政（东海王）")))
    assert (r.a, r.b, r.c, r.d, r.e, r.f, r.g, r.i) == ("x", "\u00e9", "", "'a''\\\\'", "3", "NULL", '"a""b"', "刘政")
    assert r.h == "https://zh.wikipedia.org/wiki/A_(b)!~*'"


def test_normalize_marks_duplicates_and_skips(spark):
    pages = spark.createDataFrame([("东海王", "==汉朝==\n*[[刘彊]]，43年-58年\n*[[刘彊]]，43年-58年\n==爵位==\n*[[甲]]")], "title string, wikitext string")
    rows = normalize.normalize(wikitext.holders(pages)).orderBy("line_no").collect()
    assert [r.reviewStatus for r in rows] == ["ready", "duplicate", "skip_section"]
    assert rows[0].dynCandidates == ["東漢", "西漢", "漢"] and rows[0].cleanKey == "东海王|東漢|东海||王|刘彊|43" and rows[2].skipReason == "section:爵位"


def test_review_round_trip(spark):
    rows = spark.createDataFrame([(1, ["漢", "東漢"], "南康文宣", None, "公", "王曇", 1, None, None, "ready", "南康公", "Q1")], "row_id long, dynCandidates array<string>, fief string, pn string, nt string, personBare string, startYear int, endYear int, skipReason string, reviewStatus string, sourcePage string, wikidataId string")
    for c, k in (("dynastySection", "string"), ("person", "string"), ("wikiPersonUrl", "string"), ("fillNotes", "string"), ("sourcePageId", "long"), ("sourcePageUrl", "string"), ("sourceWikidataId", "string")):
        rows = rows.withColumn(c, F.lit(None).cast(k))
    titles = spark.createDataFrame([], "row_pos long, ind long, person_id long, dyn string, fief string, pn string, pn_abr string, nt string, start_year int, end_year int, dyn_id long")
    persons = spark.createDataFrame([], "row_pos long, id long, name string")
    matched = match.match(rows, titles, persons)
    assert matched.first().matchStatus == "wiki_only"
    sheet = review.review_sheet(matched, ["row_id"])
    assert len(sheet.columns) == 32 and sheet.first().wiki_dyn_candidates == "漢|東漢"
    fixed = spark.createDataFrame([("1", "南康", "文宣", "", "")], "review_id string, fief_corrected string, pn_corrected string, reviewer_notes string, action string")
    plans = review.plan(review.correct(review.number(matched, ["row_id"]), fixed), spark.createDataFrame([(0, 9, "東漢")], "row_pos long, id long, name string"))
    p = plans.first()
    assert (p.action, p.fief, p.pn, p.dyn, p.dynId) == ("link_title", "南康", "文宣", "東漢", 9)
    assert review.statements(plans).first().sql.startswith("INSERT INTO nt_wiki (dyn, fief")
    record = asset.wiki_records(plans, ["review_id"]).first()
    assert record.action == "title_only" and record.id == "wnt-0001" and record.db is None and "南康文宣公" in record.searchStrings and record.metadata.wrapper.personId == "wikidata:Q1"


def test_canonical_records(spark):
    schema = "row_pos long, ind long, person_id long, dyn string, fief string, pn string, pn_abr string, nt string, start_year int, end_year int, dyn_id long"
    titles = spark.createDataFrame([(0, 1112, 3710, "漢", "漢", "昭烈", None, "帝", 1, 2, 3), (1, 1182, 7582, "漢", "東海", "恭", None, "王", 1, 2, 3), (2, 5, 6, None, None, None, None, "后", None, None, None), (3, 7, 8, None, "x", None, None, None, None, None, None), (4, 9, 10, "漢", "中山", "靖", None, "王", None, None, None)], schema)
    pack = spark.createDataFrame([("3710", "劉備", None, [("primary", "劉備")]), ("6", "孝元皇后", None, [])], files.PACK)
    covered = spark.createDataFrame([("7582", "1182")], "personId string, ntInd string")
    out = asset.canonical_records(titles, asset.pack_names(pack), covered, start=682).orderBy("id").collect()
    assert [r.id for r in out] == ["wnt-0683", "wnt-0684", "wnt-0685"]
    assert set(out[0].searchStrings) == {"漢昭烈帝", "漢帝", "漢昭烈帝劉備", "漢帝劉備"}
    assert out[1].searchStrings == ["孝元皇后"] and out[1].metadata.wrapper is None and out[1].metadata.nobleTitle.roleName == "皇后"
    assert out[2].metadata.teiTag == "nobleTitle" and out[2].names == []


def test_names_and_facts(spark):
    s = lambda n: names.segment(F.lit(n), ["欧阳", "司马", "欧", "王"])
    r = one(spark, a=s("欧阳修"), b=s("欧阳"), c=s("A"), d=s("王安石"))
    assert tuple(r.a) == ("欧阳", "修") and tuple(r.b) == ("欧", "阳") and r.c is None and tuple(r.d) == ("王", "安石")
    table = spark.createDataFrame([(0, "欧阳"), (1, "欧")], "pos int, surname string")
    assert names.segment_by_join(spark.createDataFrame([("欧阳修",)], "name string"), table).first().given == "修"
    found = names.facts_of("<w><nationality ref='n'>漢</nationality><nobleTitle>x<placeName>東海</placeName><persName type='posthumous'>恭</persName></nobleTitle><officeName> </officeName></w>")
    assert [(f[1], f[2], f[3]) for f in found] == [("nationality", "漢", "n"), ("nobleTitle", "x東海恭", None)] and [c[0] for c in found[1][4]] == ["placeName", "persName"]
    names.register(spark)
    assert spark.sql("select element from facts('<w><placeOfOrigin>a</placeOfOrigin></w>')").first().element == "placeName"


GOOD = {"manifestVersion": "1.0.0", "id": "x-y", "name": "n", "version": "1.0.0", "description": "d", "license": "MIT", "host": {"minVersion": "1"}, "entry": {"kind": "javascript", "module": "m"}}


def errors_of(spark, *raws, **options):
    df = spark.createDataFrame(list(enumerate(raws)), "i int, raw string")
    return [r.errors for r in manifest.validate(df, **options).orderBy("i").collect()]


def test_manifests(spark):
    good, bad, array, number, text, broken, null, twice = errors_of(spark, json.dumps(GOOD), json.dumps({"manifestVersion": "9.0.0", "id": "x"}), "[1]", "1", '"x"', "{", None, '{"id": "a", "id": "b"}')
    assert good == [] and number == text == null == ["manifest must be an object"] and broken == twice == ["manifest is not JSON"]
    assert bad == ["manifestVersion must be 1.0.0", "name must be a non-empty string", "version must be a non-empty string", "description must be a non-empty string", "license must be a non-empty string", "host must be an object", "entry must be an object"]
    assert array[:2] == ["manifest.0 is not allowed", "manifestVersion must be 1.0.0"]
    other = {k: v for k, v in GOOD.items() if k != "host"} | {"shell": {"minVersion": "1"}, "dependencies": {"modules": ["Bad", None]}, "entry": {"kind": "python"}}
    assert errors_of(spark, json.dumps(other), host="shell", group="modules") == [["entry.python is required for python/hybrid modules", "dependencies.modules[1] must be a non-empty string", "dependencies.modules contains invalid id: Bad", "dependencies.modules contains invalid id: null"]]
    rows = manifest.validate(spark.createDataFrame([(json.dumps(GOOD),), ("{}",)], "raw string")).collect()
    assert sorted(r.ok for r in rows) == [False, True]


def test_manifests_by_schema(spark):
    schema = {"type": "object", "properties": {"languages": {"type": "array", "items": {"type": "string", "minLength": 2}, "uniqueItems": True}, "homepage": {"type": "string", "format": "uri"}}}
    (found,) = errors_of(spark, json.dumps(GOOD | {"languages": ["zh", "zh", "z"], "homepage": "x"}), schema=schema)
    assert found == ["manifest.languages must have unique items", "manifest.languages[2] must have at least 2 characters"]


def test_schema_rules(spark):
    schema = {
        "type": "object", "required": ["a"], "additionalProperties": False, "allOf": [{"if": {"properties": {"b": {"const": "x"}}, "required": ["b"]}, "then": {"required": ["c"]}}],
        "properties": {"a": {"$ref": "#/$defs/n"}, "b": {"type": ["string", "null"], "maxLength": 3}, "c": {"const": [1, {"k": None}]}, "d.e": {"type": "boolean"}, "f": {"type": "array", "minItems": 1, "maxItems": 2, "items": {"type": "object", "required": ["g"]}}},
        "$defs": {"n": {"type": "integer", "maximum": 5}},
    }
    cases = {
        '{"a": 5.0, "b": null, "d.e": true}': [], '{"a": 1, "c": [1, {"k": null}], "b": "x", "f": [{"g": null}]}': [], '{"a": 1.5}': ["$.a must be of type integer"], '{"a": "1"}': ["$.a must be of type integer"], '{"a": 6}': ["$.a must be at most 5"],
        '{}': ["$.a is required"], '{"a": 1, "z": 0}': ["$.z is not allowed"], '{"a": 1, "b": "x"}': ["$.c is required"], '{"a": 1, "b": "long"}': ["$.b must have at most 3 characters"], '{"a": 1, "c": [2]}': ['$.c must be [1, {"k": null}]'],
        '{"a": 1, "d.e": 1}': ["$.d.e must be of type boolean"], '{"a": 1, "f": []}': ["$.f must have at least 1 items"], '{"a": 1, "f": [1, {}, {"g": 1}]}': ["$.f must have at most 2 items", "$.f[0] must be of type object", "$.f[1].g is required"],
        "[]": ["$ must be of type object"], "{": ["$ is not JSON"],
    }
    df = spark.createDataFrame([(c,) for c in [*cases, None]], "raw string").select("raw", json_rules.schema_errors(F.col("raw"), schema).alias("e"))
    assert {r.raw: r.e for r in df.collect()} == cases | {None: ["$ is not JSON"]}
    with pytest.raises(ValueError):
        json_rules.schema_errors(F.col("raw"), {"not": {}})


def test_dump(spark, tmp_path):
    sql = "INSERT INTO `person` VALUES (1,'a\\'b;(x),'),(2,NULL);\nINSERT INTO `other` VALUES (3,'z');\nINSERT INTO `person` (`id`,`name`) VALUES (4,_binary 'it''s');"
    (tmp_path / "d.sql").write_text(sql)
    got = dump.load(spark, str(tmp_path / "d.sql"), "person").orderBy("row_pos").collect()
    assert [(r.id, r.name) for r in got] == [(1, "a'b;(x),"), (2, None), (4, "it's")]
    assert dump.load(spark, str(tmp_path / "d.sql"), "date_dynasties").count() == 0
    assert [r.id for r in dump.load(spark, str(tmp_path), "person", first_only=True).orderBy("row_pos").collect()] == [1, 2]


CELLS = st.one_of(st.none(), st.sampled_from(["INSERT INTO `t` VALUES (1)", "--", ";"]), st.text(alphabet="a'\\\n(),;\u6f22", max_size=6))
INSERTS = st.lists(st.tuples(st.sampled_from(["t", "u"]), st.booleans(), st.lists(st.lists(CELLS, min_size=1, max_size=4), max_size=4)), max_size=4)


def as_dump(inserts):
    quote = lambda v: "NULL" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"
    return "".join(f"DROP TABLE x;\nINSERT INTO `{t}` {'(`a`, `b`)' if named else ''}\nVALUES " + ",".join("(" + ",".join(map(quote, r)) + ")" for r in rows) + ";\n" for t, named, rows in inserts)


@settings(max_examples=100, deadline=None)
@given(INSERTS, st.integers(1, 60))
def test_dump_in_ranges_equals_the_whole(inserts, size):
    """A file cut anywhere, into ranges of any size, each scanned without what stands before it."""
    sql, want = as_dump(inserts), [r for t, _, rows in inserts if t == "t" for r in rows]
    assert list(dump.rows(sql, "t")) == want
    with tempfile.NamedTemporaryFile() as f:
        f.write(sql.encode())
        f.flush()
        start, n = dump._start("t"), len(sql.encode())
        ranges = [dump.Range(f.name, a, min(a + size, n)) for a in range(0, n, size)]
        begun = dump.beginnings([[dump.outcome(r, start, s) for s in (dump.OUT, dump.IN, dump.ESCAPED)] for r in ranges])
        assert [t for r, b in zip(ranges, begun, strict=True) for t in dump.tuples(r, start, *b, False)] == want
        first = next((rows for t, _, rows in inserts if t == "t"), [])
        assert [t for r, b in zip(ranges, begun, strict=True) for t in dump.tuples(r, start, *b, True)] == first


def test_large_dump_in_many_tasks(spark, tmp_path):
    """One file of one statement, read by many tasks."""
    path = tmp_path / "d.sql"
    path.write_text("INSERT INTO `t` VALUES " + ",".join(f"({i},'it\\'s; ({i}),漢')" for i in range(20_000)) + ";")
    found = dump.read_dump(spark, str(path), "t", size=10_000)
    assert found.select(F.spark_partition_id().alias("p")).distinct().count() > 3
    rows = found.orderBy("row_pos").collect()
    assert [r.fields for r in rows] == [[str(i), f"it's; ({i}),漢"] for i in range(20_000)]
    assert len({r.row_pos for r in rows}) == len(rows)


def test_client_waits_and_pages():
    answers = [(429, {"Retry-After": "3"}, ""), (200, {}, json.dumps({"query": {"categorymembers": [{"title": "a"}]}, "continue": {"cmcontinue": "x"}})), (200, {}, json.dumps({"query": {"categorymembers": [{"title": "b"}]}}))]
    slept = []
    client = wiki_api.Client("u", delay_ms=0, fetch=lambda url: answers.pop(0), sleep=slept.append)
    assert list(client.members("c")) == ["a", "b"] and slept == [3.0]
    assert wiki_api.wait_ms(None, 3, 1000) == 8000 and wiki_api.wait_ms("999", 0, 1) == 60_000 and wiki_api.setting(None, "NO_SUCH", "d") == "d"


def test_captured_pages(spark):
    raw = json.dumps({"query": {"pages": {"1": {"pageid": 1, "title": "T", "fullurl": "u", "pageprops": {"wikibase_item": "Q1"}}, "-1": {"title": "M", "missing": ""}}, "redirects": [{"from": "S", "to": "T"}]}})
    pages, hops = wiki_api.captured(spark.createDataFrame([(raw,)], "value string"))
    asked = wiki_api.with_members(spark.createDataFrame([("S",), ("M",)], "title string"), pages, hops)
    assert {r.title: r.pageId for r in asked.collect()} == {"S": 1, "M": None}


def test_files_and_stream(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    page = {"title": "东海王", "wikitext": "*[[刘彊]]，43年-58年\n{{disambig}}", "pageId": 1, "url": "u", "wikidataId": "Q"}
    (src / "a.json").write_text(json.dumps(page) + "\n")
    for _ in range(2):
        crawl.ingest_stream(spark, str(src), str(out), str(tmp_path / "cp")).awaitTermination()
    rows = spark.read.parquet(str(out))
    assert rows.count() == 1
    files.write_ndjson(rows.drop("batch"), str(tmp_path / "nd"), "zh")
    again = files.read_ndjson_numbered(spark, str(tmp_path / "nd"))
    assert [(r.row_pos, r.review_id, r.person, r.source) for r in again.collect()] == [(0, 1, "刘彊", "zh")]
    sheet = spark.createDataFrame([('a"b\nc', "")], "x string, y string")
    files.write_csv(sheet, str(tmp_path / "csv"))
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "csv"), ["x", "y"]).collect()] == [('a"b\nc', "")]
    assert files.inventory(spark, str(src / "a.json")).first().bytes == (src / "a.json").stat().st_size


def test_numbers_are_gapless_at_size(spark, tmp_path):
    """More rows than the range sample holds, with a payload that counting does not read."""
    path = str(tmp_path / "rows")
    spark.range(3_000_000).select((F.col("id") * 7_919 % 3_000_000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("payload")).write.parquet(path)
    out = review.number(spark.read.parquet(path), ["k"], "n")
    assert out.count() == 3_000_000 and out.where("n <> k + 1").isEmpty()


def test_numbers_of_equal_rows(spark):
    out = review.number(spark.range(5000).select(F.lit(1).alias("k")), ["k"], "n", start=10)
    assert sorted(r.n for r in out.collect()) == list(range(10, 5010))


def test_match_of_rows_without_candidates_or_status(spark):
    schema = "row_id long, dynCandidates array<string>, fief string, pn string, nt string, personBare string, startYear int, endYear int, skipReason string, reviewStatus string"
    rows = spark.createDataFrame([(1, None, "f", None, "王", "甲", None, None, None, "ready"), (2, ["漢"], "f", None, "王", "乙", None, None, "section:x", None), (3, [], "f", None, "王", "丙", None, None, None, "ready"), (4, ["漢"], "f", None, "王", "戊", None, None, None, "ready")], schema)
    titles = spark.createDataFrame([(0, 1, 1, None, "f", None, None, "王", 1, 2, 3)], "row_pos long, ind long, person_id long, dyn string, fief string, pn string, pn_abr string, nt string, start_year int, end_year int, dyn_id long")
    persons = spark.createDataFrame([(0, 1, "甲"), (1, 5, "丙"), (2, 5, "丁"), (3, 6, "戊"), (4, 6, "戊")], "row_pos long, id long, name string")
    out = {r.row_id: r for r in match.match(rows, titles, persons).collect()}
    assert (out[1].matchTier, out[1].suggestedAction) == ("B", "link")
    assert (out[2].matchStatus, out[2].suggestedAction) == ("skip", "skip")
    assert out[3].matchStatus == "wiki_only"  # 丙 was renamed
    assert (out[4].matchStatus, out[4].db.person_id, out[4].db.can_name) == ("person_only", 6, "戊")
    assert sorted(r.row_id for r in match.only_matched(match.match(rows, titles, persons)).collect()) == [1, 4]


def test_sections_equal_a_walk_and_take_linear_time(spark):
    rng = random.Random(6)
    bits = ["==A==", "== B c ==\r", "===no===", "x", "", "*[[y]]", "==", "==D=="]
    pages = [(i, "\n".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))) for i in range(200)] + [(900, None)]

    def walk(text):
        lines, section, any_header, out = text.split("\n"), None, False, []
        names_of = [m.group(1) if (m := re.fullmatch(r"==\s*([^=\n]+?)\s*==\s*", x)) else None for x in lines]
        any_header = any(names_of)
        for n, (x, name) in enumerate(zip(lines, names_of, strict=True)):
            section = name or section
            if not name and (section or not any_header):
                out.append((n, x, section))
        return out

    got = wikitext.sectioned_lines(spark.createDataFrame(pages, "k int, wikitext string"), ["k"]).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((k, *x) for k, t in pages if t is not None for x in walk(t)), key=str)
    long = "\n".join(f"==h{i}==\nline {i}\nmore" for i in range(10_000))
    began = time.time()
    assert wikitext.sectioned_lines(spark.createDataFrame([(1, long)], "k int, wikitext string"), ["k"]).count() == 20_000
    assert time.time() - began < 10


def test_pages_of_one_title_keep_their_own_rows(spark):
    pages = spark.createDataFrame([("东海王", "*[[甲]]\n{{disambig}}", 1, "u1", "Q1"), ("东海王", "*[[乙]]\n{{disambig}}", 2, "u2", "Q2")], crawl.PAGES)
    assert sorted((r.person, r.sourcePageId) for r in wikitext.ingest(pages).collect()) == [("乙", 2), ("甲", 1)]


PAIRS = st.dictionaries(st.text(alphabet="abc中", min_size=1, max_size=4), st.sampled_from(["X", "YY", ""]), max_size=6)


@settings(max_examples=300, deadline=None)
@given(PAIRS, st.lists(st.one_of(st.none(), st.text(alphabet="abcd中\U0001f600", max_size=12)), max_size=4))
def test_phrases_equal_the_longest_match(pairs, texts):
    def plain(t):
        out, i = [], 0
        while i < len(t):
            best = max((p for p in pairs if t.startswith(p, i)), key=len, default=None)
            out.append(t[i] if best is None else pairs[best])
            i += 1 if best is None else len(best)
        return "".join(out)

    assert phrases.Phrases(pairs).convert(texts) == [None if t is None else plain(t) for t in texts]


def test_phrase_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("皇后\t皇后\n后\t後 后\n只\t隻\nno tab\n")
    pairs = phrases.read_phrases(spark, str(tmp_path))
    assert pairs == {"皇后": "皇后", "后": "後", "只": "隻"}
    rows = spark.createDataFrame([("皇后之后",), (None,), ("",)], "t string").select(text.translate(F.col("t"), pairs).alias("t")).collect()
    assert [r.t for r in rows] == ["皇后之後", None, ""]


def test_asset_sink(spark, tmp_path):
    asset_sink.register(spark)
    at = str(tmp_path / "asset")
    rows = spark.createDataFrame([(1, "link", ["a"]), (2, "skip", []), (3, "link", None)], "id int, action string, s array<string>").repartition(3)
    rows.write.format("asset").option("id", "x").mode("overwrite").save(at)
    envelope = json.load(open(f"{at}/asset.json"))
    assert (envelope["recordCount"], envelope["actionCounts"]) == (3, {"link": 2, "skip": 1}) and envelope["compiledAt"].endswith("Z")
    assert sorted((r.id, r.s) for r in spark.read.json(f"{at}/part-*").collect()) == [(1, ["a"]), (2, []), (3, None)]
    failing = rows.select("id", F.when(F.col("id") == 3, F.raise_error(F.lit("no"))).otherwise(F.col("action")).alias("action"))
    with pytest.raises(Exception, match="no"):
        failing.write.format("asset").mode("overwrite").save(at)
    assert os.listdir(tmp_path) == ["asset"] and json.load(open(f"{at}/asset.json")) == envelope  # nothing of it is left
    with pytest.raises(Exception, match="no"):
        failing.write.format("asset").mode("overwrite").save(str(tmp_path / "other"))
    assert os.listdir(tmp_path) == ["asset"]


def test_crawl_goes_on_in_the_middle(spark, tmp_path):
    """Stopped after each answer and started again: no title is lost or asked for twice. A busy answer is asked for again."""
    key = lambda **p: urllib.parse.urlencode(sorted({k: str(v) for k, v in p.items()}.items()))
    answers = {}
    for i in range(3):
        more = {"cmcontinue": f"t{i}"} if i else {}
        body = {"query": {"categorymembers": [{"pageid": 10 * i + j, "title": f"T{i}{j}"} for j in range(2)]}} | ({"continue": {"cmcontinue": f"t{i + 1}"}} if i < 2 else {})
        answers[key(action="query", list="categorymembers", cmtitle="c", cmlimit=500, **more)] = [[429, {"Retry-After": "0"}, ""], [200, {}, body]] if i == 1 else body
        titles = f"T{i}0|T{i}1"
        answers[key(action="query", redirects=1, prop="info|pageprops|revisions", inprop="url", titles=titles, rvprop="content", rvslots="main")] = {"query": {"pages": {str(10 * i + j): {"pageid": 10 * i + j, "title": f"T{i}{j}"} for j in range(2)}}}
    (tmp_path / "answers").write_text(json.dumps(answers))
    options = {"api": "http://x.invalid/api", "category": "c", "delay_ms": "0", "answers": str(tmp_path / "answers")}
    runs = 0
    while True:
        query = crawl.crawl_category(spark, options, str(tmp_path / "out"), str(tmp_path / "cp"))
        until = time.time() + 60
        while not [p for p in query.recentProgress if p["numInputRows"]] and time.time() < until and query.isActive:
            time.sleep(0.05)
        query.stop()
        runs += 1
        found = sorted(r.title for r in wiki_api.captured(spark.read.schema("value string").parquet(str(tmp_path / "out")))[0].collect())
        assert len(found) == len(set(found))
        if len(found) == 6:
            break
        assert runs < 6
    assert found == [f"T{i}{j}" for i in range(3) for j in range(2)]


def test_client_settings(monkeypatch):
    monkeypatch.setenv("WIKI_DELAY_MS", "5")
    monkeypatch.setenv("ALL_PROXY", "http://p:1")
    client = wiki_api.Client.configured({"api": "u"})
    assert client.delay_ms == 5 and client.retries == 6 and wiki_api.proxy_setting() == "http://p:1"
    assert wiki_api.delay_setting("x") == 2000 and wiki_api.delay_setting("-1") == 2000 and wiki_api.delay_setting("7") == 7
    monkeypatch.setenv("WIKI_PROXY", "socks5://p:2")
    assert wiki_api.proxy_setting() == "socks5://p:2" and wiki_api.proxy_setting("socks5://q:3") == "socks5://q:3"


def test_client_through_socks():
    """A request through a small SOCKS5 server that answers for the wiki itself."""
    server, seen = socket.create_server(("127.0.0.1", 0)), []

    def serve():
        c, _ = server.accept()
        assert c.recv(3) == b"\x05\x01\x00"
        c.sendall(b"\x05\x00")
        head = c.recv(5)
        seen.append(c.recv(head[4] + 2)[:-2].decode())
        c.sendall(b"\x05\x00\x00\x01\x00\x00\x00\x00\x00\x00")
        seen.append(c.recv(4096).decode().split("\r\n")[0])
        body = b'{"query": {"categorymembers": [{"title": "a"}]}}'
        c.sendall(b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\nConnection: close\r\n\r\n" % len(body) + body)
        c.close()

    threading.Thread(target=serve, daemon=True).start()
    client = wiki_api.Client("http://wiki.invalid/api", delay_ms=0, proxy=f"socks5://127.0.0.1:{server.getsockname()[1]}")
    assert list(client.members("c")) == ["a"] and seen[0] == "wiki.invalid" and seen[1].startswith("GET /api?format=json&action=query")
    with pytest.raises(OSError, match="could not connect to the SOCKS proxy"):
        server.close()
        wiki_api.Client("http://wiki.invalid/api", delay_ms=0, retries=0, proxy="socks5://127.0.0.1:1").get({})


def test_redirects_agree(spark):
    """The last of several redirects of a title counts, in both operators."""
    hops = spark.createDataFrame([("a", "z", 0), ("a", "b", 1)], "source string, target string, row_pos long")
    pages = spark.createDataFrame([("b", None, 2, "ub", "Q2"), ("z", None, 9, "uz", "Q9")], crawl.PAGES)
    titles = spark.createDataFrame([("a",)], "title string")
    assert wiki_api.with_members(titles, pages, hops).first().pageId == normalize.resolve_redirects(titles, pages.drop("wikitext"), hops).first().pageId == 2


def test_titles_that_come_again(spark, tmp_path):
    """A title is parsed once, over restarts; broken lines and files give nothing."""
    page = lambda t, p: json.dumps({"title": t, "wikitext": f"*[[{p}]]\n{{{{disambig}}}}", "pageId": 1})
    src = tmp_path / "in"
    src.mkdir()
    for n, lines in enumerate([[page("东海王", "甲"), "{broken"], [page("东海王", "乙"), page("南康公", "丙")], [page(None, "丁")]]):
        (src / f"{n}.json").write_text("\n".join(lines))
        crawl.ingest_stream(spark, str(src), str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()
    assert sorted(r.person for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["丙", "甲"]


def test_hooks_refuse_wrong_arguments(spark):
    names.register(spark, ["張"])
    with pytest.raises(Exception, match="surname"):
        spark.sql("select * from name_patterns(table(select 1 as x), array('王'))").collect()
    assert spark.sql("select segment_name(null) as s, segment_name('張 ') as t").first().asDict() == {"s": None, "t": None}


def test_renumber_equals_counting_again(spark):
    rng = random.Random(9)
    rows = spark.createDataFrame([(rng.choice([None, 1, 2]), rng.choice("ab"), i) for i in range(300)], "d int, e string, p int")
    gone = rows.where("p % 7 = 0 and (d = 1 or d is null)")
    numbered = names.occurrences(rows, "d", "e", "p")
    want = names.occurrences(rows.where("not (p % 7 = 0 and (d = 1 or d is null))"), "d", "e", "p")
    assert sorted(map(str, names.renumber(numbered, gone, "d", "e", "p").collect())) == sorted(map(str, want.collect()))


def test_small_operators(spark):
    r = one(spark, a=asset.bundled_paths(F.array(F.lit("b"), F.lit("a")), F.array(F.lit("a"), F.lit(None), F.lit("c"))), b=asset.bundled_paths(F.lit(None).cast("array<string>"), F.lit(None).cast("array<string>")))
    assert r.a == ["b", "a", "c"] and r.b == []
    rows = spark.createDataFrame([(True, 1, ""), (None, 0, "Q"), (False, None, None)], "needsReview boolean, wikiPersonPageId long, wikidataId string")
    assert tuple(review.crawl_counts(rows).first()) == (3, 1, 1, 1) and review.sample(rows, ["wikidataId"], 2).count() == 2
    assert asset.append_records(spark.range(1).select("id"), spark.createDataFrame([(5, "x")], "id long, s string")).count() == 2


@pytest.mark.parametrize("name", ["tiered_match", "only_matched", "match_action_counts"])
def test_matching_broadcasts_no_table(spark, name, capsys):
    """Whole tables of rows, titles and persons meet by shuffle, however small their files look."""
    queries.QUERIES[name](spark, SF).explain()
    said = capsys.readouterr().out
    assert "SortMergeJoin" in said and "Broadcast" not in said


def test_dump_in_small_ranges_takes_few_tasks(spark, tmp_path):
    """Ranges that are small cost no task each; row_pos tells the range and the tuple as before."""
    (tmp_path / "d.sql").write_text("INSERT INTO `t` VALUES " + ",".join(f"({i},'x')" for i in range(30_000)) + ";")
    found = dump.read_dump(spark, str(tmp_path), "t", size=500)
    assert found.rdd.getNumPartitions() <= 4
    rows = found.orderBy("row_pos").collect()
    assert [r.fields for r in rows] == [[str(i), "x"] for i in range(30_000)] and len({r.row_pos // 500 for r in rows}) > 600


@settings(max_examples=30, deadline=None)
@given(INSERTS, st.integers(1, 60), st.integers(1, 9))
def test_dump_in_blocks_of_ranges_equals_the_whole(inserts, size, per):
    """Ranges of a block take their bytes from it."""
    sql = as_dump(inserts)
    with tempfile.NamedTemporaryFile() as f:
        f.write(sql.encode())
        f.flush()
        start, n = dump._start("t"), len(sql.encode())
        ranges = [dump.Range(dump.Block(f.name, b, min(b + size * per, n)), a, min(a + size, n)) for b in range(0, n, size * per) for a in range(b, min(b + size * per, n), size)]
        begun = dump.beginnings([[dump.outcome(r, start, s) for s in (dump.OUT, dump.IN, dump.ESCAPED)] for r in ranges])
        assert [t for r, b in zip(ranges, begun, strict=True) for t in dump.tuples(r, start, *b, False)] == [r for t, _, rows in inserts if t == "t" for r in rows]


def test_manifests_of_one_partition_are_checked_by_many_tasks(spark):
    rows = spark.createDataFrame([(i, json.dumps(GOOD)) for i in range(40)], "i int, raw string").coalesce(1)
    out = manifest.validate(rows).select("i", "ok", F.spark_partition_id().alias("p")).collect()
    assert sorted(r.i for r in out) == list(range(40)) and all(r.ok for r in out) and len({r.p for r in out}) == 4


def test_review_sheet_broadcasts_no_table(spark, monkeypatch, capsys):
    """Rows and the other columns of the sheet meet by shuffle too, before they are numbered."""
    number = review.number
    monkeypatch.setattr(review, "number", lambda rows, *order: (rows.explain(), number(rows, *order))[1])
    queries.QUERIES["review_sheet"](spark, SF)
    said = capsys.readouterr().out
    assert "SortMergeJoin" in said and "Broadcast" not in said
