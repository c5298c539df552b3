"""Fill-in-middle, exact dedup and ranked search against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from titlegraph.llm import contents, exact_dedup, fim, lexical
from titlegraph.llm.common import Tables

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = "doc_id long, text string, digest int, n int, slice string, term string, keep int, __x int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, blanks, ties, repeated rows, a very long text, a text of half the rows, clashing names."""
    rng = random.Random(5)
    texts = [(1, "The cat sat on the mat today"), (2, "the CAT sat on the mat today"), (3, None), (4, ""), (5, " \n\t "), (6, "a b"), (7, "a b"), (7, "a b"), (7, "A b"), (None, "a b"), (None, None), (8, " ".join(f"w{i % 999}" for i in range(30_000))), (9, "x" * 5000), (10, "naïve É <M> 中文\x1c  \U0001f600 "), (11, "tail  \n"), (12, "1 2 3 2"), (13, "İ i̇")]
    texts += [(20 + i, "one text that very many rows share") for i in range(400)] + [(500 + i, " ".join(rng.choices("the cat sat ON a mat".split(), k=rng.randint(1, 9))) + rng.choice(["", " ", "\n"])) for i in range(300)]
    return spark.createDataFrame([(i, t, 1, 2, "s", None, 3, 4) for i, t in texts], ODD).repartition(5)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=80).map(sorted))
def test_elias_fano_selects(values):
    held = fim.EliasFano.from_bytes(fim.EliasFano.of(np.array(values, np.int64)).to_bytes())
    assert [held.select(i) for i in range(held.size)] == values


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \t\n\x1c 中\U0001f600", max_size=30))
def test_token_ends_equal_the_pattern(text):
    assert fim.token_ends(text).tolist() == [m.end() for m in TOKEN.finditer(text)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>PSM a\n", max_size=40), st.lists(st.integers(0, 2**32 - 1), min_size=4, max_size=4))
def test_cut_texts_are_restored(text, h):
    form, output, a, m = fim.cut_text(text, fim.EliasFano.of(fim.token_ends(text)), h)
    assert fim.restore(output, form) == text and (form == "plain") == (a is None)


def plain_cut(doc_id, text):
    text = text or ""
    tokens, h = TOKEN.findall(text), [int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(tokens)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", text, None, None
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    return (n, "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)) if h[3] % 100 < 80 else (n, "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m))


@pytest.mark.parametrize("group,broadcast", [(1000, 100_000), (7, 0)])
def test_fill_in_middle_equals_brute_force(odd, monkeypatch, group, broadcast):
    monkeypatch.setattr(contents, "GROUP_ROWS", group)
    monkeypatch.setattr(contents, "BROADCAST_ROWS", broadcast or 3)
    want = Counter((r.doc_id, *plain_cut(r.doc_id, r.text)) for r in odd.collect())
    assert Counter((r.doc_id, r.n, r.form, r.output, r.prefix_chars, r.middle_chars) for r in fim.fill_in_middle(odd).collect()) == want
    assert {w[2] for w in want} == {"plain", "spm", "psm"}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert Counter((r.doc_id, r.output_sha256) for r in fim.fill_in_middle(odd, digests=True).collect()) == Counter((w[0], sha(w[3])) for w in want.elements())
    assert fim.fill_in_middle(odd.limit(0)).count() == 0


def test_texts_of_one_digest_are_told_apart(odd, monkeypatch):
    """Under a digest of 20 values most hold several texts; the texts themselves are grouped and joined."""
    monkeypatch.setattr(fim, "sha256", lambda t: F.pmod(F.crc32(t.cast("binary")), F.lit(20)).cast("string").cast("binary"))
    want = Counter((r.doc_id, *plain_cut(r.doc_id, r.text)) for r in odd.collect())
    assert Counter((r.doc_id, r.n, r.form, r.output, r.prefix_chars, r.middle_chars) for r in fim.fill_in_middle(odd).collect()) == want


def test_index_holds_each_text_once(odd, monkeypatch):
    """An entry for each distinct text; more only where very many documents share it. Texts are shuffled once."""
    monkeypatch.setattr(contents, "GROUP_ROWS", 100)
    index = fim.build_index(odd, Tables(odd.sparkSession))
    rows = index.collect()
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert plan[: plan.find("Initial Plan")].count("Exchange hashpartitioning") == 1
    want = Counter(r.text or "" for r in odd.collect())
    assert Counter({t: sum(len(r.documents) for r in rows if r.text == t) for t in want}) == want
    assert all(len([r for r in rows if r.text == t]) == 1 for t, n in want.items() if n <= 100)
    assert all(len(r.documents) < 200 for r in rows) and [fim.EliasFano.from_bytes(r.ends).size for r in rows] == [len(TOKEN.findall(r.text)) for r in rows]


def check_copies(got, source):
    groups = defaultdict(list)
    for i, t in source:
        groups[(t or "").translate(LOWER)].append(i)
    most = {t: max(ids, key=lambda i: -1 if i is None else i) for t, ids in groups.items()}
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert Counter((r.doc_id, sha[r.text_sha256]) for r in got) == Counter((i, t) for t, ids in groups.items() for i in ids)
    for t, ids in groups.items():
        own = [r for r in got if sha[r.text_sha256] == t]
        assert all((r.keep_id, r.group_size) == (most[t], len(ids)) for r in own)
        assert [r.doc_id for r in own if r.kept] == [most[t]]


@pytest.mark.parametrize("group,broadcast,digest", [(1000, 100_000, None), (7, 0, None), (50, 5, 20)])
def test_exact_dedup_equals_brute_force(spark, odd, tmp_path, monkeypatch, group, broadcast, digest):
    """Also with large groups spread, without broadcasts, and under a digest that many texts share."""
    monkeypatch.setattr(contents, "GROUP_ROWS", group)
    monkeypatch.setattr(contents, "BROADCAST_ROWS", broadcast or 3)
    path = str(tmp_path / "documents.parquet")
    odd.write.parquet(path)
    by = {} if digest is None else {"digest": lambda t: F.pmod(F.crc32(t.cast("binary")), F.lit(digest)).cast("string").cast("binary")}
    check_copies(exact_dedup.exact_duplicates(spark, path, **by).collect(), [(r.doc_id, r.text) for r in odd.collect()])


def test_exact_dedup_of_one_file_and_of_none(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "A"), (3, None)], "doc_id long, text string")
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    (file,) = (tmp_path / "one").glob("*.parquet")
    check_copies(exact_dedup.exact_duplicates(spark, str(file)).collect(), [(1, "a"), (2, "A"), (3, None)])
    rows.limit(0).write.parquet(str(tmp_path / "empty"))
    assert exact_dedup.exact_duplicates(spark, str(tmp_path / "empty")).count() == 0


def test_exact_dedup_state_grows_with_the_corpus(spark, tmp_path):
    """A second run reads only the files that are new; groups of both runs are one."""
    path, state = str(tmp_path / "documents"), str(tmp_path / "state")
    first, second = [(1, "a"), (2, "A"), (3, "b")], [(4, "a"), (5, "c"), (0, "b")]
    spark.createDataFrame(first, "doc_id long, text string").write.parquet(path)
    check_copies(exact_dedup.exact_duplicates(spark, path, state=state).collect(), first)
    spark.createDataFrame(second, "doc_id long, text string").write.mode("append").parquet(path)
    query = exact_dedup.ingest(spark, path, state, spark.read.parquet(path).schema)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 3
    check_copies(exact_dedup.exact_duplicates(spark, path, state=state).collect(), first + second)
    known = {bytes(r.digest).hex(): r.n for r in exact_dedup.groups(spark, state).collect()}
    assert known == {hashlib.sha256(t.encode()).hexdigest(): n for t, n in (("a", 3), ("b", 2), ("c", 1))}


def plain_search(docs, items, k):
    docs = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    docs = [(i, Counter(t), len(t)) for i, t in docs if t]
    total, df = sum(n for _, _, n in docs), Counter(w for _, c, _ in docs for w in c)
    weight = {w: math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * d + 1))) for w, d in df.items()}
    out = []
    for item, text in items:
        own = set(TERM.findall((text or "").translate(LOWER))) & set(df)
        scores = []
        for i, c, n in docs:
            m = 100 - 50 + ((50 * n * len(docs)) // total)
            score = sum(weight[w] * ((10**9 * c[w]) // (1000 * c[w] + 20 * m)) for w in own if w in c)
            if score > 0:
                scores.append((-score, math.inf if i is None else i))
        out += [(item, r, None if i == math.inf else i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return out


@pytest.mark.parametrize("broadcast,size,slices", [(500_000, 2 << 20, 1_024), (0, 300, 7)])
def test_search_equals_brute_force(spark, odd, monkeypatch, broadcast, size, slices):
    """Also with many small slices, of which several share a number, and terms joined by shuffle."""
    monkeypatch.setattr(lexical, "BROADCAST_TERMS", broadcast)
    monkeypatch.setattr(lexical, "SLAB", size)
    monkeypatch.setattr(lexical, "SLICES", slices)
    items = [(1, "CAT mat the the"), (2, None), (3, ""), (4, "no such terms"), (5, "one text w5 É naïve 2"), (6, "cat"), (7, "中文 x")]
    table = spark.createDataFrame([(i, t, 0, "c") for i, t in items], "item_id long, text string, score int, term string")
    postings = lexical.build_postings(odd)
    for k in (3, 50, 2000):
        got = [(r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.search(postings, table, k).collect()]
        assert sorted(got, key=str) == sorted(plain_search([(r.doc_id, r.text) for r in odd.collect()], items, k), key=str)
    assert lexical.search(postings, table.limit(0)).count() == 0 and lexical.search(lexical.build_postings(odd.limit(0)), table).count() == 0
    twice = lexical.search(postings, table.where("item_id = 6").union(table.where("item_id = 6")), 5).collect()
    assert len(twice) == 10 and len({(r["rank"], r.doc_id) for r in twice}) == 5


def test_search_sums_within_a_slice(spark, odd, monkeypatch):
    """No shuffle between the join and the sums: both are dealt by slice. Tasks pass on their best rows only."""
    plans, kept = [], lexical.cut
    postings = lexical.build_postings(odd)
    monkeypatch.setattr(lexical, "cut", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or kept(df, name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        lexical.search(postings, spark.createDataFrame([(1, "cat")], "item_id long, text string"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = plans[-1]
    sums = plan.index("HashAggregate")
    between = plan[sums : plan.index("SortMergeJoin", sums)]
    assert "Exchange" not in between and "Generate explode" in between and plan.count("WindowGroupLimit") == 2
