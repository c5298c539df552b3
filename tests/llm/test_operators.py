import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from titlegraph.llm import ann, bpe, decontaminate, html_extract, language_id, line_dedup, ngram_join, pretokens, queries, sharding, token_files, url_filter

SF = "/root/testdata/sf0.001"
PATH = queries.tokenizer_path()
ODD = "doc_id long, text string, shard int, host string, n_words int, score double, `c0` string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, blanks, ties, repeated rows, a very long text, clashing names."""
    long = " ".join(f"w{i}" for i in range(20_000))
    texts = [(1, "the cat sat on the mat today"), (2, "The cat sat on the mat today"), (3, None), (4, ""), (5, " \n\t "), (6, "a b"), (7, "a b"), (7, "a b"), (8, long), (9, long + " x"), (10, "x" * 5000), (11, "naïve <|endoftext|> 中文\x1c  \U0001f600"), (12, "1 2 3")]
    return spark.createDataFrame([(i, t, 0, "h", 1, 0.5, "c") for i, t in texts], ODD).repartition(3).cache()


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    got = sorted((tuple(r[c] for c in columns) for r in queries.QUERIES[name](spark, SF).collect()), key=str)
    assert got == sorted(want.fetchall(), key=str)


def test_shards_are_even_and_gapless(docs):
    out = sharding.shard_by_bytes(docs, shards=3).collect()
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in out) == sorted((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows_of(docs))
    for s in {r.shard for r in out}:
        own = sorted(r.slot for r in out if r.shard == s)
        assert own == list(range(len(own)))
    assert sharding.shard_by_bytes(docs.limit(0)).count() == 0


def test_shards_equal_brute_force(spark):
    """Even, contiguous, equal texts together; null doc_ids and a text that half of the rows share."""
    rng = random.Random(2)
    rows = [(i, "x" * rng.randint(0, 40) + str(i % 90)) for i in range(900)] + [(None, None), (None, "n")] + [(2000 + i, "hot text") for i in range(900)]
    out = sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), shards=8).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t in rows)
    total, order = sum(size(t) for _, t in rows), sorted(out, key=lambda r: (r.shard, r.slot))
    weigh = Counter()
    for r in out:
        weigh[r.shard] += r["size"]
    assert sorted(weigh) == list(range(8)) and all(abs(w - total / 8) <= 41 * 20 for w in weigh.values())
    before = 0
    for r in order:  # a shard begins where the bytes before it are its share, but for a group of equal texts
        assert abs(min(7, before * 8 // total) - r.shard) <= 1
        before += r["size"]
    where = {}
    for r in out:
        where.setdefault(r.text_crc32, set()).add(r.shard)
    assert sum(len(s) > 1 for s in where.values()) <= 7  # at most one group of equal texts at each cut
    assert [[r.slot for r in order if r.shard == s] for s in range(8)] == [list(range(n)) for n in (sum(r.shard == s for r in out) for s in range(8))]


def test_token_files_round_trip(spark, docs, library):
    docs = docs.unionByName(spark.createDataFrame([(None, "no id", 0, "h", 1, 0.5, "c"), (None, None, 0, "h", 1, 0.5, "c")], ODD))
    manifest = token_files.write_token_files(docs, token_files.token_folder(spark), PATH, tasks=3, file_ids=1000)
    assert manifest.count() > 3 and manifest.agg(F.max("documents")).first()[0] > 1
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32, tuple(r.ids)) for r in token_files.read_token_files(manifest).collect())
    start, want = 0, []
    nulls = [r.n_tokens > 1 for r in token_files.read_token_files(manifest).where("doc_id is null").orderBy("start").collect()]
    for i, t in sorted(rows_of(docs), key=lambda x: (x[0] or 0, (x[1] is not None) != nulls[0] if x[0] is None else x[1] or "")):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((start, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), tuple(ids)))
        start += len(ids)
    assert got == want
    assert token_files.digest_token_files(token_files.write_token_files(docs.limit(0), token_files.token_folder(spark), PATH)).count() == 0


def test_encoder_equals_the_library(library):
    rng = random.Random(3)
    bits = ["a", "Bc", "é", " ", " ", "\n", "\n", "\t", ".", ",", "'s", "7", "中", "<|endoftext|>", "the", "\xa0", "\r", "x" * 60]
    own = token_files.Encoder(PATH)
    for size in (1, 7, 2000):
        texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(size)]
        ids, ends = own(pa.array(texts))
        assert [ids[a:z].tolist() for a, z in zip(ends, ends[1:])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_file_format_of_wide_ids():
    ids = [[1, 70_000, 5, 1 << 30], [], list(range(66_000))]
    d, n, flat = token_files.unpack(token_files.pack(pa.array([3, None, 9]), np.array(list(map(len, ids))), np.array(sum(ids, []), "<u4")))
    assert d.tolist() == [3, None, 9] and n.tolist() == [4, 0, 66_000] and flat.tolist() == [x for y in ids for x in y]


def test_bpe_equals_the_library(spark, docs, library):
    lexicon = bpe.build_lexicon(docs, PATH, entries=50)
    got = sorted((r.doc_id, r.n_tokens, tuple(r.ids), r.decoded) for r in bpe.bpe_encode(docs, PATH, lexicon).collect())
    want = []
    for i, t in rows_of(docs):
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), tuple(ids), library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)
    digest = bpe.bpe_encode(docs, PATH, lexicon, digests=True).where("doc_id = 1").first()
    assert digest.ids_sha256 == hashlib.sha256(",".join(map(str, next(w[2] for w in want if w[0] == 1))).encode()).hexdigest()


def test_bpe_of_unusual_texts_and_splits(library):
    rng = random.Random(5)
    bits = ["a", "B", "é", " ", "  ", "\n", "\t", ".", ",", "'s", "don't", "7", "½", "中文", "<|endoftext|>", "the", "\xa0", "€", "\u2028", "🙂", "º", "×", "x" * 300]
    texts = ["", " ", "\n", *["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(3000)]]
    coder = bpe.Coder(PATH, bpe.Lexicon(bpe.compile_lexicon({p: bpe.Merges(PATH).merge(p) for p in (b"the", b" the", " é".encode())})))
    ids, ends = coder.encode(texts)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids[a:z].tolist() for a, z in zip(ends, ends[1:])] == want
    assert coder.decode(ids, ends).to_pylist() == [library.decode(w, skip_special_tokens=False) for w in want]
    half = np.array(library.encode("🙂", add_special_tokens=False).ids[:1], "<u2")
    assert coder.decode(half, np.array([0, 1])).to_pylist() == [library.decode(half.tolist(), skip_special_tokens=False)]
    assert coder.encode([])[0].tolist() == []
    plain = [t for t in texts if pretokens.chunkable(t)]
    split = pretokens.split_usual(pa.array(plain))
    found = dict(zip(split.pieces.to_pylist(), split.counts().tolist()))
    assert {p: n for p, n in found.items() if n} == Counter(p for t in plain for p in pretokens.FAST.findall(t))


def test_lexicon_is_minimal_and_exact():
    words = {w.encode(): [i, 7] for i, w in enumerate(["tap", "taps", "top", "tops", "é"])}
    lexicon = bpe.Lexicon(bpe.compile_lexicon(words))
    found = lexicon.look_up(pa.array(["-", *[w.decode() for w in words], "to", "tapsx", ""])[1:])
    ids, sizes = lexicon.ids(found[:5], "<u2")
    assert ids.tolist() == [x for w in words.values() for x in w] and sizes.tolist() == [2] * 5 and found[5:].tolist() == [-1] * 3
    assert len(lexicon.arrays[3]) == 6  # the root, t, ta = to, tap = top, taps = tops = é, the first byte of é
    rng = random.Random(1)
    merges = bpe.Merges(PATH)
    pieces = ["".join(rng.choice("abeist é") for _ in range(rng.randint(0, 30))).encode() for _ in range(300)] + [b"ab" * 400]
    assert [np.frombuffer(x, "<u2").tolist() for x in merges.merge_many(pieces, "<u2")] == [merges.merge(p) for p in pieces]


def test_extract_drops_what_is_not_the_article(spark):
    page = "<html><head><title>t</title><style>a{}</style></head><body><nav><ul><li>menu</ul></nav><header>h</header><div class='cookie-notice'>c</div><article><h1>A &amp; B</h1><p>one\n two<p>thr<b>ee</b><script>var x='</p>'</script><form>f</form><div class=comments>no</div></article><aside>s</aside><footer>f</footer>"
    df = spark.createDataFrame([(1, "http://a.b/", page, "x"), (2, None, None, "x"), (3, "http://a.b/2", "plain <br> text", "x")], "page_id long, url string, html string, text string")
    out = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract(df).collect()}
    assert out == {1: ("A & B\none two\nthree", 19), 2: ("", 0), 3: ("plain text", 10)}
    same = [(i, f"http://s.t/{i}", f"<body><div class=a>buy now</div><div class=b>news {i} here</div>", "") for i in range(9)]
    out = html_extract.extract(spark.createDataFrame(same, "page_id long, url string, html string, text string"))
    assert {r.text for r in out.collect()} == {f"news {i} here" for i in range(9)}
    assert html_extract.extract(df.limit(0)).count() == 0


def test_extract_keeps_sections_whose_ids_are_words_of_marks(spark):
    inner = "<h2 id='side-effects'>one</h2><section id='modal-logic'>two</section><section class='related-work'>three</section><div id='search-engine'>four</div><h3 class='header' id='search'>five</h3><section id='advertising'>six</section><div class='promontory'>seven</div>"
    pages = [(1, "http://a.b/", f"<body><article>{inner}<div class='x ads'>no</div><div id='comments'>no</div></article>"), (2, "http://a.b/", f"<body>{inner}<div class='site-footer'>no</div><div class='search'>no</div><div class='comment-list'>no</div></body>")]
    pages += [(10 + i, f"http://s.t/{i}", f"<article><p>text {i}</p><section id='side-effects'>{'same' if i % 3 else 'other'}</section><section id='modal-logic'>own {i}</section></article>") for i in range(20)]
    out = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert out[1] == out[2] == "one\ntwo\nthree\nfour\nfive\nsix\nseven"
    assert all(out[10 + i] == f"text {i}\nown {i}" for i in range(20))  # a possible mark that the style tree confirms


def test_extract_keeps_what_repeats_in_articles(spark):
    """Pages put together from known blocks: the article's own, many of them the same on every page, and what surrounds it."""
    rng = random.Random(3)
    names = ["Ada", "Ben"]
    pages, want = [], {}
    for i in range(60):
        host = ["a.b", "c.d", "few.pages"][0 if i < 30 else 1 if i < 57 else 2]
        own = [("h1", f"Title {i} &amp; more", f"Title {i} & more"), ("div class='byline'", f"By {names[0 if host == 'a.b' else i % 2]}", None), ("h2", "Ingredients", None)]
        own += [("p", f"part {rng.random()} of\n {i}", None) for _ in range(rng.randint(1, 4))]
        own += [("h2", "Method", None), ("p", "Heat the oven first.", None), ("p", f"then wait {rng.random()}", None), ("p class='sign-off'", "Enjoy your meal!", None)]
        inner = "".join(f"<{tag}>{html}</{tag.split()[0]}>" for tag, html, _ in own)
        pages.append((i, f"http://{host}/{i}", f"<body><nav><a href='/'>home</a></nav><div class='x1'>Only today: {i % 3}</div><article>{inner}<div class='ads'>buy {i}</div></article><div class='x2'>All rights kept</div><footer>f</footer></body>"))
        want[i] = "\n".join(" ".join((text or html).split()) for _, html, text in own)
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == want
    # the tree decides outside of articles, without any mark
    bare = [(i, u, h.replace("<nav>", "<div class='x0'>").replace("</nav>", "</div>").replace("<footer>f</footer>", "").replace(f"<div class='ads'>buy {i}</div>", "")) for i, u, h in pages[:57]]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(bare, "page_id long, url string, html string"), marks=False).collect()}
    assert got == {i: want[i] for i in range(57)}


def test_importance_equals_brute_force(spark):
    from math import log

    pages = [("h", f"<body><ul>{'<li>m' * (1 + i % 2)}</ul><div class=c><p>text {i}{'<p>more' * (i % 3)}</div><footer>f {i % 2}</footer></body>") for i in range(7)]
    got = {r.place & (1 << 64) - 1: r for r in html_extract.style_tree(spark.createDataFrame([*pages, pages[0]], "host string, html string")).collect()}
    seen = {}
    for host, html in pages:
        root = html_extract.parse(html, host)
        todo = [root]
        sums = {}
        while todo:
            n = todo.pop()
            kids = [c for c in n.children if isinstance(c, html_extract.Node)]
            todo += kids
            inner = lambda n: [inner(c) if isinstance(c, html_extract.Node) else (c or "").strip() for c in n.children]
            size = lambda n: sum(size(c) if isinstance(c, html_extract.Node) else len((c or "").strip()) for c in n.children)
            if size(n):
                own = sums.setdefault(n.place, [[], [], 0])
                own[0].insert(0, str(inner(n)))
                own[1].insert(0, str([c.place for c in kids]))
                own[2] += size(n)
        for p, (c, f, z) in sums.items():
            seen.setdefault(p, []).append((str(c), str(f), z, size(root)))
    entropy = lambda xs: 1.0 if len(xs) < 2 else -sum(n / len(xs) * log(n / len(xs)) for n in Counter(xs).values()) / log(len(xs))
    assert set(got) == set(seen)
    for p, rows in seen.items():
        c, f, share = entropy([r[0] for r in rows]), entropy([r[1] for r in rows]), sum(r[2] for r in rows) / sum(r[3] for r in rows)
        assert (got[p].pages, round(got[p].content, 9), round(got[p].presentation, 9), round(got[p].share, 9), round(got[p].importance, 9)) == (len(rows), round(c, 9), round(f, 9), round(share, 9), round(f + (1 - f) * c * share, 9))


def test_the_style_tree_alone_finds_the_articles(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").withColumn("url", F.regexp_replace("url", "://[^/]*", "://one.host"))
    texts = lambda **kw: {r.page_id: r.text for r in html_extract.extract(pages, **kw).collect()}
    whole = texts()
    assert texts(marks=False) == whole == texts(tree=False)
    assert not any(t == whole[i] for i, t in texts(marks=False, tree=False).items())
    monkeypatch.setattr(html_extract, "BROADCAST_PLACES", 0)
    assert texts(marks=False) == whole


def test_broken_pages_take_linear_time(spark):
    import time

    began = time.time()
    for page in ("<a " * 300_000, '<a "' * 200_000 + ">", "<div>" * 50_000 + "x", "<div>" * 20_000 + "</section>" * 50_000, "<ul>" + "<div>" * 20_000 + "<li>a" * 20_000, "<button>" * 100_000):
        root = html_extract.parse(page)
        html_extract.blocks(root), html_extract.places(root)
    assert time.time() - began < 20
    hidden = "<article>a <span hidden>no <b>no</b></span><i class=ad>no</i>b<p>c <em aria-hidden=true>no</em>d</article>"
    assert html_extract.blocks(html_extract.parse(hidden)) == ["a b", "c d"]


def test_url_rules(spark):
    rules = spark.createDataFrame([("com", "/en/", "block"), ("example.com", "/en/7", "allow")], "host string, path string, verdict string")
    urls = ["http://WWW.Example.COM/en/71?x", "https://b.com/en/1", "http://acom/en/1", "no url", None, "http://com/en/#f", "http://example.com/EN/7", ""]
    got = [(r.url, r.host, r.rule, r.verdict) for r in url_filter.judge_urls(spark.createDataFrame([(u, "old") for u in urls], "url string, rule string"), rules).collect()]
    assert dict((g[0], g[2:]) for g in got) == {urls[0]: ("example.com/en/7", "allow"), urls[1]: ("com/en/", "block"), urls[2]: (None, "allow"), urls[3]: (None, "allow"), None: (None, "allow"), urls[5]: ("com/en/", "block"), urls[6]: (None, "allow"), "": (None, "allow")}
    assert next(g[1] for g in got if g[0] == urls[0]) == "www.example.com"
    assert {r.verdict for r in url_filter.judge_urls(spark.createDataFrame([("http://a/",)], "url string"), rules.limit(0)).collect()} == {"allow"}


def test_fm_index_equals_a_scan():
    rng = np.random.default_rng(3)
    seq = rng.integers(0, 4, 500)
    index = decontaminate.FMIndex(seq)
    for n in (1, 2, 5):
        patterns = rng.integers(0, 5, (40, n))
        low, high = index.search(patterns)
        for p, a, z in zip(patterns, low, high, strict=True):
            want = [i for i in range(501 - n) if (seq[i : i + n] == p).all()]
            assert sorted(index.locate(np.arange(a, z)).tolist()) == want


@pytest.mark.parametrize("block", [16 << 20, 30])
def test_decontaminate_equals_brute_force(spark, docs, block):
    items = [(1, "cat sat on the mat today"), (2, None), (3, ""), (4, " ".join(f"w{i}" for i in range(50, 75))), (5, "cat sat on the mat TODAY"), (6, "absent words"), (7, "B")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.mark(docs, bench, block_bytes=block).select("doc_id", "n_words", "spans", "items", decontaminate.items_digest(F.col("items")).alias("d")).collect()
    want = sorted((i, *decontaminate.brute_force(t, items)) for i, t in rows_of(docs))
    assert sorted((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), r["items"], r.d) for r in out) == want
    cleaned = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, bench, block_bytes=block).collect()}
    assert cleaned[1] == "the" and cleaned[12] == "1 2 3" and cleaned[3] is None and " w49 w75 " in cleaned[8]


def test_nearest_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 16)).astype(np.float32)
    x[7] = x[8]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None, *[1.0] * 15])]
    df = ann.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert df.count() == 400
    q = ann.learn_quantizer(df, books=8, words=32)
    index = ann.build_index(df, q)
    for metric in ("ip", "l2"):
        got = {}
        for r in ann.search(index, index.where("vec_id % 50 = 0"), q, k=10, rerank=60, metric=metric, block=4).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.vec_id)
        hits = 0
        for i in range(0, 400, 50):
            s = x.astype(float) @ x[i] if metric == "ip" else -((x.astype(float) - x[i]) ** 2).sum(1)
            s[i] = -np.inf
            hits += len(set(np.argsort(-s)[:10]) & set(got[i]))
        assert hits >= 0.9 * 80
    # with every candidate reranked the result is exact, whatever the blocks of queries and groups of vectors
    want = {(i, j) for i in range(0, 400, 3) for j in [j for j in sorted(range(400), key=lambda j: (-float(x[i].astype(float) @ x[j].astype(float)), j)) if j != i][:5]}
    for block, group in ((7, 50), (400, 400), (1, 400)):
        got = ann.search(index, index.where("vec_id % 3 = 0"), q, k=5, rerank=400, block=block, group=group).collect()
        assert {(r.query_id, r.vec_id) for r in got} == want and len(got) == len(want)
    assert ann.learn_quantizer(df.limit(0)) is None
    # repeated rows, two vectors of one id, another length; and results do not depend on batches
    odd = spark.createDataFrame([*[(i, v.tolist()) for i, v in enumerate(x)], *[(8, x[8].tolist())] * 30, (9, (x[9] * 2).tolist()), (950, [1.0])], "vec_id long, embedding array<float>")
    odd = ann.usable(odd).coalesce(1)
    index = ann.build_index(odd, q)
    find = lambda: [tuple(r) for r in ann.search(index, index.where("vec_id = 20"), q, k=399, rerank=500).orderBy("rank").collect()]
    found = find()
    scores = sorted(((max(float(x[i].astype(float) @ x[20]), 2 * float(x[i].astype(float) @ x[20])) if i == 9 else float(x[i].astype(float) @ x[20])), -i) for i in range(400) if i != 20)[::-1]
    assert [r[2] for r in found] == [-i for _, i in scores]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        narrow = [r[2] for r in ann.search(index, index.where("vec_id = 20"), q, k=10, rerank=30).orderBy("rank").collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert narrow == [r[2] for r in ann.search(index, index.where("vec_id = 20"), q, k=10, rerank=30).orderBy("rank").collect()]
    index = ann.build_index(df, q)
    few = index.where("vec_id < 3")
    assert ann.search(few, few, q, k=20).count() == 6


def test_language_id(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the house and the garden of the king", "en"), ("das haus und der garten des königs", "de")] * 20)] + [(90, None, "en"), (91, "12 !", "en"), (92, "der garten", None), (93, "", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(df, language_id.learn(df)).collect()}
    assert all(out[i][0] == rows[i][2] for i in range(40)) and out[92][0] == "de"
    assert out[90] == out[91] == out[93] == ("und", 0.0) and all(0 <= s <= 1 for _, s in out.values())
    assert {r.lang_pred for r in language_id.identify(df, language_id.learn(df.limit(0))).collect()} == {"und"}
    texts = ["Hello, world 12 foo!", "", "a", "Ünï çode\0x", "  abc  "]
    assert language_id.ngrams(texts)[1].tolist() == [sum(language_id.tally([t]).values()) for t in texts]


def test_many_languages_and_filters_equal_sets():
    rng = np.random.default_rng(1)
    grams = {f"l{i:03}": rng.integers(0, 1 << 63, 200, dtype=np.uint64) for i in range(130)}
    filters = language_id.Filters(grams)
    for i, lang in enumerate(filters.languages):
        assert filters.bit(filters.masks(grams[lang]), i).all()  # no false negative
    other = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    rates = np.array([filters.bit(filters.masks(other), i).mean() for i in range(130)])
    assert np.abs(rates - filters.false).max() < 0.02
    words = {f"l{i:03}": "".join(chr(97 + i // 26 + 3 * j) + chr(97 + i % 26) for j in range(4)) for i in range(130)}
    filters = language_id.Filters({k: np.unique(language_id.ngrams([w])[0]) for k, w in words.items()})
    assert filters.predict(list(words.values()))[0] == list(words)


def test_rare_languages_are_learned(spark):
    rows = [("the common text", "en")] * 3000 + [(f"english words number {i} and others", "en") for i in range(300)] + [("ein seltener deutscher satz", "de")]
    filters = language_id.learn(spark.createDataFrame(rows, "text string, lang string"), bound=20)
    assert filters.languages == ["de", "en"] and filters.predict(["seltener satz", "english words"])[0] == ["de", "en"]


def test_texts_of_no_learned_language_fit_none(spark):
    """Clean documents all fit, learned from or not; unlearned languages and letters at random do not, unless they are short."""
    labelled = spark.read.parquet(f"{SF}/documents.parquet").where(~language_id.held_out("doc_id"))
    filters = language_id.learn(labelled)
    out = language_id.identify(spark.read.parquet(f"{SF}/documents.parquet"), filters)
    assert out.where(~F.col("fits") & (F.col("lang_pred") != "und")).count() == 0
    rng = random.Random(3)
    noise = " ".join("".join(rng.choice("bcdfgjkqvwxyz") for _ in range(7)) for _ in range(40))
    texts = [noise, "это предложение написано на русском языке " * 4, "qvx", "", None, "12 !"]
    assert filters.predict(texts)[2].tolist() == [False, False, True, False, False, False]
    # n-grams that one text alone has say nothing about other texts: a language of one text rejects none
    one = language_id.learn(spark.createDataFrame([("a single english sentence", "en")], "text string, lang string"))
    assert one.known.tolist() == [0.0] and one.predict([noise])[2].tolist() == [True]
    assert language_id.learn(labelled.limit(0)).predict(["some words"])[2].tolist() == [False]


def test_known_share_equals_brute_force(spark):
    texts = ["the house and the garden", "the garden of the king", "a king", "zebra zebra"]
    filters = language_id.learn(spark.createDataFrame([(t, "en") for t in texts + texts[:1]], "text string, lang string"))
    tallies = [language_id.tally([t]) for t in texts]
    shared = sum(n for t in tallies for g, n in t.items() if sum(g in u for u in tallies) > 1)
    assert abs(filters.known[0] - shared / sum(sum(t.values()) for t in tallies)) < 1e-12


def test_held_out_accuracy(spark):
    out = queries.op7_language_id(spark, SF).where("held_out").join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    r = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert r[0] >= 0.95


def test_line_dedup(spark, docs):
    p = "one line here\nsecond line here\nthird line here"
    para = " ".join(f"p{i}" for i in range(55))
    rows = [(1, f"a\n{p}\nb"), (2, f"x\ny\n{p}"), (3, f"{p}\n{p}"), (4, f"intro\n{para}\nend"), (5, f"other\n{para}\nlast"), (6, None), (7, "  \n \n"), (8, "  \n \n"), (None, p), (9, "one line here\nsecond line here"), (10, f"\tc  d\t{para}  e \t f \nlast"), (11, f"  {para}\t g  h")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lines = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_lines(df, report=True).collect()}
    assert lines == {i: (t, 0) for i, t in rows} | {2: ("x\ny", 9), 3: ("", 18)}  # words that repeat are left alone
    out = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_lines(df, passage=line_dedup.PASSAGE, report=True).collect()}
    assert out == {1: (f"a\n{p}\nb", 0), 2: ("x\ny", 9), 3: ("", 18), 4: (f"intro\n{para}\nend", 0), 5: ("other\nlast", 55), 6: (None, 0), 7: ("  \n \n", 0), 8: ("  \n \n", 0), None: (p, 0), 9: (rows[9][1], 0), 10: ("\tc  d\te \t f \nlast", 55), 11: ("g  h", 55)}
    assert line_dedup.dedup_lines(docs).columns == docs.columns and line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_line_dedup_looks_past_blank_lines(spark):
    passage = "first line here\n\nsecond line here\n\n\nthird line here"
    rows = [(1, f"one text\n\nReferences\n\n{passage}\n\nend"), (2, "other text\n\nReferences\n\nmore of it\n\nlast"), (3, f"new\n\n{passage.replace(chr(10) * 3, chr(10))}\n\nown"), (4, "\nReferences\n"), (5, "\n\n"), (6, "References\n")]
    out = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), report=True).collect()}
    assert out == {1: (rows[0][1], 0), 2: (rows[1][1], 0), 3: ("new\n\n\nown", 9), 4: (rows[3][1], 0), 5: (rows[4][1], 0), 6: ("", 1)}


@pytest.mark.parametrize("passages", [False, True])
def test_line_dedup_equals_its_sql_on_odd_texts(spark, passages):
    rng = random.Random(11)
    bits = ["a", "b", "c d", "", " ", "x\t y", "long " + " ".join(map(str, range(53))), "e f g"]
    rows = [(i, "\n".join(rng.choice(bits) for _ in range(rng.randint(0, 9)))) for i in range(300)] + [(300, None)]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    want = con.execute(queries.line_dedup_sql(passages)).fetchall()
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), passage=line_dedup.PASSAGE if passages else None, report=True).select("doc_id", "n_removed", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def brute_passages(rows):
    """The texts' words without those that later occurrences of a passage cover, and without layout."""
    seen, out = {}, []
    for d, t in sorted(rows):
        words, gone = t.split(), set()
        for i in range(len(words) - 50):
            first = seen.setdefault(tuple(words[i : i + 51]), (d, i))
            if first != (d, i):
                gone |= set(range(max(i, first[1] + 51) if first[0] == d else i, i + 51))
        out.append((d, [w for i, w in enumerate(words) if i not in gone]))
    return dict(out)


def test_passages_at_any_place_equal_brute_force(spark, docs):
    rng = random.Random(8)
    new = lambda n: [f"{rng.randrange(10**6)}é" for _ in range(n)]
    para, loop = new(51), new(3)
    texts = [" ".join([*new(3), *para, *new(9)]), " ".join(new(20) + para), " ".join(new(2)) + "\n" + " ".join(para[:26]) + "\n" + " ".join(para[26:]) + "\nlast", " ".join(new(2) + para[1:] + new(70)), " ".join(loop * 60), "", " \n ", " ".join(para[5:] + para + new(1)), " ".join(new(50)), "\n".join(new(60))]
    texts += [" ".join(sum((rng.choice([para[: rng.randint(30, 51)], new(rng.randint(1, 40)), new(5) + para]) for _ in range(4)), [])) for _ in range(30)]
    texts += [texts[9], " ".join(texts[9].split()[4:58])]
    df = spark.createDataFrame([*enumerate(texts), (0, texts[0]), (None, texts[0]), (500, None)], "doc_id long, text string").repartition(4)
    out = [(r.doc_id, r.text) for r in line_dedup.dedup_passages(df).collect()]
    want = brute_passages(list(enumerate(texts)))
    assert {i: t.split() for i, t in out if i is not None and t is not None} == want and len(out) == len(texts) + 3
    assert out.count((0, texts[0])) == 2 and (None, texts[0]) in out and (500, None) in out
    assert dict(out)[1] == " ".join(texts[1].split()[:20]) and dict(out)[2] == texts[2].split("\n")[0] + "\nlast" and dict(out)[3] == texts[3]
    assert line_dedup.dedup_passages(docs).columns == docs.columns and line_dedup.dedup_passages(docs.limit(0)).count() == 0


def test_pipeline_removes_passages_within_lines(spark):
    para = " ".join(f"p{i}" for i in range(55))
    df = spark.createDataFrame([(1, f"x {para} end"), (2, f"some other words {para}")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in dict(corpus_pipeline.STAGES)["line_dedup"](spark, df, SF).collect()} == {1: f"x {para} end", 2: "some other words"}


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(300)]
    base = [[rng.choice(vocab) for _ in range(rng.randint(3, 60))] for _ in range(20)]
    texts = {1000: None, 1001: "", 1002: "one two", 1003: "ONE two", 1004: " \t "}
    shared = " ".join(vocab[:12])
    for i in range(260):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        texts[i] = " ".join(w) + (f" {shared}" if i % 3 == 0 else "")
    df = spark.createDataFrame([(i, t, 1) for i, t in texts.items()] + [(None, "one two", 2)], "doc_id long, text string, n int")
    out = ngram_join.near_duplicates(df).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out if r.doc_id is not None} == ngram_join.brute_force(texts)
    assert [(r.n_shingles, r.component_id) for r in out if r.doc_id is None] == [(1, None)]
    assert ngram_join.near_duplicates(df.limit(0)).count() == 0


def test_near_misses_of_a_template_do_not_meet(spark):
    """Documents that share four fifths of their text are no near duplicates, and never become pairs; true copies among them link."""
    rng = random.Random(6)
    template = " ".join(f"t{i}" for i in range(84))
    texts = {i: f"{template} " + " ".join(f"u{rng.randrange(10**9)}" for _ in range(20 + i % 3)) for i in range(1500)}
    texts |= {2000 + i: texts[i] + " x" for i in range(0, 1500, 100)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    seen = []
    posted = ngram_join.Join.posted
    ngram_join.Join.posted = lambda self, rows: (lambda out: seen.append(out.count()) or out)(posted(self, rows))
    try:
        out = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(df).collect()}
    finally:
        ngram_join.Join.posted = posted
    assert out == {i: i - 2000 if i >= 2000 else i for i in texts}
    assert sum(seen) <= 3 * len(texts)


def test_rows_of_one_id_are_one_document(spark):
    a, b = "a b c d e f g h i j", "k l m n o p q r s t"
    rows = [(5, a), (7, a), (7, b), (9, b), (11, "other words that are alone here")]
    out = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert out == [(5, 6, 5), (7, 6, 5), (7, 6, 5), (9, 6, 5), (11, 2, 11)]


def test_pipeline_keeps_null_ids_and_one_row_of_repeats(spark):
    t, u = "a b c d e f g", "some other text of its own"
    rows = [(1, t), (1, t), (2, t), (3, u), (3, u), (4, "only one here to keep"), (None, t), (None, t), (None, "lone")]
    out = dict(corpus_pipeline.STAGES)["ngram_join"](spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, t), (3, u), rows[5], *rows[6:]], key=str)
    assert out.columns == ["doc_id", "text"]


def test_pipeline_equals_brute_force(spark, library, tmp_path):
    """All stages over a fixture with nulls, noise, copies, repeated passages and benchmark passages, stage by stage."""
    rng = random.Random(12)
    vocab = "the house garden of king water and stone river under old new tree light over hill day night road small bread winter summer green field child mother father story long short open close write read north south east west morning evening river bank market town village ship sea island wind rain snow fire".split()
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    item, lines, para = say(14), "\n".join(say(6) for _ in range(3)), say(55)
    base = [say(60) for _ in range(12)]
    texts = [say(rng.randint(5, 90)) for _ in range(25)] + base
    texts += [b + " " + say(2) for b in base] + base[:3]
    texts += [f"{say(15)} {item} {say(15)}" for _ in range(4)] + [f"{say(9)}\n{lines}\n{say(9)}" for _ in range(4)] + [f"{say(7)} {para} {say(7)}" for _ in range(4)]
    texts += [None, "", " \n ", "12 3 !", "zqxv kkjw wqqz vvxq jjkz " * 12, item, "a b"]
    rng.shuffle(texts)
    rows = [(i, t, "en" if i % 3 and t and "zqxv" not in t else None, len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: (r.n_tokens, r.ids, r.decoded) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    # with so many labelled texts only letters at random fit no language
    kept = [(i, t) for i, t, _, _ in rows if t and any(c.isalpha() for c in t) and "zqxv" not in t]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", kept)
    found = con.execute(queries.line_dedup_sql(passages=True))
    at = [c[0] for c in found.description]
    kept = {r[at.index("doc_id")]: r[at.index("text")] for r in found.fetchall() if r[at.index("text")].strip()}
    kept = {i: kept[i] for i, (_, group) in ngram_join.brute_force(kept).items() if i == group}
    want = {}
    for i, t in kept.items():
        own, gone, w = decontaminate.words(t), set(), item.lower().encode().split()
        for a in range(len(own) - 9):
            if any(own[a : a + 10] == w[b : b + 10] for b in range(len(w) - 9)):
                gone |= set(range(a, a + 10))
        if gone:
            t = " ".join(x for n, x in enumerate(t.split()) if n not in gone)
        if t.strip():
            ids = library.encode(t, add_special_tokens=False).ids
            want[i] = (len(ids), ids, library.decode(ids, skip_special_tokens=False))
    assert got == want and len(rows) > len(want) > 30


def test_pipeline(spark, library):
    out = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert 0 < out.count() <= docs.count() and out.select("doc_id").distinct().count() == out.count()
    for r in out.limit(5).collect():
        assert r.ids == library.encode(r.decoded, add_special_tokens=False).ids
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = decontaminate.mark(out.select("doc_id", F.col("decoded").alias("text")), spark.createDataFrame(items, "item_id long, text string"))
    assert hit.where(F.size("spans") > 0).count() == 0


def test_line_dedup_query_removes_passages_too(spark, tmp_path):
    """What repeats within lines goes as well as repeated lines, in the query and in its SQL."""
    para = " ".join(f"p{i}" for i in range(55))
    rows = [(1, f"x {para} end"), (2, f"some other words {para}"), (3, "a\nb\nc\nd"), (4, "new\na\nb\nc")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.op8_line_dedup(spark, str(tmp_path)).collect()))
    assert got == [(1, 0, rows[0][1]), (2, 55, "some other words"), (3, 0, rows[2][1]), (4, 3, "new")]
    con = duckdb.connect()
    con.execute(f"create view documents as from '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(con.execute(queries.ORACLE_SQL["op8_line_dedup"]).fetchall()) == got
