"""The contract queries of the training-data operators: thin calls that derive digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, decontaminate, exact_dedup, fim, html_extract, language_id, lexical, line_dedup, ngram_join, sharding, token_files, url_filter
from .common import drop

#: The rules of the url query.
URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def tokenizer_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), token_files.token_folder(spark), tokenizer_path())
    return token_files.digest_token_files(manifest)


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    rules = spark.sql(f"select * from values {values} as t(host, path, verdict)")
    return url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.mark(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return marked.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), decontaminate.items_digest(F.col("items")).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = ann.usable(table(spark, sf_dir, "embeddings"))
    quantizer = ann.learn_quantizer(vectors)
    if quantizer is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = ann.build_index(vectors, quantizer)
    return ann.search(index, index.where("vec_id % 20 = 0"), quantizer, k=20)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    filters = language_id.learn(docs.where(~language_id.held_out("doc_id")).select("text", "lang"))
    return language_id.identify(docs.select("doc_id", "text"), filters).select("doc_id", language_id.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), passage=line_dedup.PASSAGE, report=True).select("doc_id", "n_removed", "text")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.bpe_encode(docs, tokenizer_path(), bpe.build_lexicon(docs, tokenizer_path()), digests=True)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), digests=True)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(spark, f"{sf_dir}/documents.parquet").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = lexical.build_postings(table(spark, sf_dir, "documents"))
    out = lexical.search(postings, table(spark, sf_dir, "benchmark"), k=50)
    drop(spark, postings)
    return out


def line_dedup_sql(passages: bool = False) -> str:
    """SQL of line_dedup.dedup_lines(report=True); with passages, of its word windows beside its windows of lines."""
    words = """, a as (
        select doc_id, list(word order by pos) as ws from w group by doc_id
    ), passages as (
        select doc_id, low, md5(array_to_string(ws[low + 1 : low + 51], ' ')) as key from (select doc_id, ws, unnest(range(greatest(len(ws) - 50, 0))) as low from a)
    )"""
    more = """union all
        select doc_id, case when f.doc_id = p.doc_id then greatest(low, f.low + 51) else low end, low + 51
        from (select *, first_value(struct_pack(doc_id, low)) over (partition by key order by doc_id, low) as f, row_number() over (partition by key order by doc_id, low) as o from passages) p where o > 1"""
    return r"""
    with l as (
        select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as ln from documents where text is not null
    ), t as (  -- words, each with the white space after it
        select doc_id, ln, unnest(regexp_extract_all(line, '[^ \t\r\f\x0b]+[ \t\r\f\x0b]*')) as token, generate_subscripts(regexp_extract_all(line, '[^ \t\r\f\x0b]+[ \t\r\f\x0b]*'), 1) as i from l
    ), w as (
        select doc_id, ln, i, token, regexp_extract(token, '^[^ \t\r\f\x0b]+') as word, row_number() over (partition by doc_id order by ln, i) - 1 as pos from t
    ), u as (  -- lines that are not blank
        select *, row_number() over (partition by doc_id order by ln) - 1 as k, count(*) over (partition by doc_id) as n
        from (select doc_id, ln, min(pos) as low, max(pos) + 1 as high, string_agg(word, ' ' order by pos) as unit from w group by doc_id, ln)
    ), lines as (
        select doc_id, low, least(n, 3) as size, case least(n, 3) when 1 then high when 2 then lead(high) over d else lead(high, 2) over d end as high,
               md5(unit || coalesce(chr(10) || lead(unit, 1) over d, '') || coalesce(chr(10) || lead(unit, 2) over d, '')) as key
        from u window d as (partition by doc_id order by k) qualify k <= greatest(n - 3, 0)
    )__WORDS__, ranges as (
        select doc_id, low, high from (select *, row_number() over (partition by key, size order by doc_id, low) as o from lines) where o > 1
        __MORE__
    ), gone as (
        select distinct doc_id, unnest(range(low, high)) as pos from ranges
    ), kept as (
        select w.doc_id, w.ln, string_agg(token, '' order by i) filter (where g.pos is null) as line, count(g.pos) as removed, bool_or(g.pos is null and i = 1) as head,
               arg_max(g.pos is not null, i) as tail_gone
        from w left join gone g on w.doc_id = g.doc_id and w.pos = g.pos group by w.doc_id, w.ln
    ), b as (  -- the words before each blank line
        select l.doc_id, l.ln, count(w.pos) as at from l left join w on l.doc_id = w.doc_id and w.ln < l.ln where l.line not similar to '.*[^ \t\r\f\x0b].*' group by l.doc_id, l.ln
    ), inside as (
        select b.doc_id, b.ln from b join gone x on b.doc_id = x.doc_id and x.pos = b.at - 1 join gone y on b.doc_id = y.doc_id and y.pos = b.at
    ), whole as (
        select l.doc_id, cast(coalesce(sum(removed), 0) as bigint) as n_removed,
               coalesce(string_agg(case when k.removed is null or removed = 0 then l.line
                                        else case when head then regexp_extract(l.line, '^[ \t\r\f\x0b]*') else '' end || case when tail_gone then regexp_replace(k.line, '[ \t\r\f\x0b]+$', '') else k.line end end, chr(10) order by l.ln)
                        filter (where (k.removed is null and i.ln is null) or removed = 0 or k.line is not null), '') as text
        from l left join kept k on l.doc_id = k.doc_id and l.ln = k.ln left join inside i on l.doc_id = i.doc_id and l.ln = i.ln group by l.doc_id
    )
    select d.doc_id, coalesce(n_removed, 0) as n_removed, whole.text from documents d left join whole on d.doc_id = whole.doc_id
    """.replace("__WORDS__", words if passages else "").replace("__MORE__", more if passages else "")


QUERIES = {f.__name__: f for f in (op1_sharding, op2_token_files, op3_html_extract, op4_url_filter, op5_decontaminate, op6_ann, op7_language_id, op8_line_dedup, op9_ngram_join, op10_bpe, op11_fill_in_middle, op12_exact_dedup, op13_lexical_search)}

ORACLE_SQL = {
    "op4_url_filter": """
        with p as (
            select page_id,
                   case when url like '%://%' then substr(url, strpos(url, '://') + 3) else '' end as rest
            from pages
        ), h as (
            select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                   regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path
            from p
        ), r(rule_host, rule_path, v) as (
            values ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')
        ), f as (
            select page_id, max(struct_pack(n := length(rule_host || rule_path), rule := rule_host || rule_path, v := v)) as best
            from h join r on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
            group by page_id
        )
        select h.page_id, host, path, best.rule as rule, coalesce(best.v, 'allow') as verdict from h left join f on h.page_id = f.page_id
    """,
    "op8_line_dedup": line_dedup_sql(passages=True),
    "op11_fill_in_middle": r"""
        with t as (
            select doc_id, coalesce(text, '') as text, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as seed from documents
        ), u as (
            select doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as tokens,
                   cast('0x' || seed[1:8] as bigint) as h1, cast('0x' || seed[9:16] as bigint) as h2, cast('0x' || seed[17:24] as bigint) as h3, cast('0x' || seed[25:32] as bigint) as h4 from t
        ), c as (
            select doc_id, text, tokens, len(tokens) as n, least(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) as a, greatest(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) as b,
                   case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form from u
        ), p as (
            select doc_id, text, n, form, array_to_string(tokens[1:a], '') as prefix, array_to_string(tokens[a + 1:b], '') as middle, array_to_string(tokens[b + 1:], '') as suffix from c
        )
        select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars,
               sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
               sha256(text) as restored_sha256
        from p
    """,
    "op12_exact_dedup": """
        with t as (
            select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents
        ), g as (
            select text, max(doc_id) as keep_id, count(*) as group_size from t group by text
        )
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(g.text) as text_sha256 from t join g on t.text = g.text
    """,
    "op13_lexical_search": r"""
        with d as (
            select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents
        ), q as (
            select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark
        ), s as (
            select count(*) as docs, sum(len(terms)) as words from d where len(terms) > 0
        ), p as (
            select doc_id, n, term, count(*) as tf from (select doc_id, len(terms) as n, unnest(terms) as term from d) group by doc_id, n, term
        ), w as (
            select term, cast(floor(1000 * ln((2.0::double * max(docs) + 2) / (2 * count(*) + 1))) as bigint) as w from p, s where term in (select term from q) group by term
        ), r as (
            select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // words))))) as bigint) as score
            from q join w on q.term = w.term join p on p.term = q.term, s group by item_id, doc_id
        )
        select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank, doc_id, score from r where score > 0
        qualify row_number() over (partition by item_id order by score desc, doc_id) <= 50
    """,
}
