"""Operator 13: ranked lexical search over a table of postings.

1. Documents are tokenised where they are read, some megabytes of text a slice. A slice's postings are written as lists,
   a row for each term, in order of buckets of terms, without a shuffle; a term that most documents hold is spread over
   all slices.
2. The terms of the items are looked up: their document frequencies are counted on the map side and give their weights.
3. Lists of these terms and the items' weighted terms, repeated for each slice, meet by (slice, term), both dealt by
   slice. All terms of a document are then in one task, which sums the scores by item and document, again without a
   shuffle, and passes on no more than the best k of each item.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Tables, cut, parts, slabs, tidy, with_settings, words

#: Buckets of terms in a slice.
BUCKETS = 64
#: Slices of a task that reads documents at most; later ones share the numbers of the first.
SLICES = 1_024
#: Distinct terms of items up to which they are broadcast; more are joined by shuffle.
BROADCAST_TERMS = 500_000
#: Bytes of text in a slice.
SLAB = 2 << 20


def build_postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, slice, bucket, term, postings array of (row, doc_id, tf, n)), written.

    A row is a document of its part, and n all its terms. Rows with a null term hold a slice's totals instead: one posting
    with the documents that have any term as tf, and all terms of these as n.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, number = TaskContext.get().partitionId(), 0, 0
        for b in slabs(batches, 1, SLAB):
            texts = b.column(1).to_pylist()
            own = [Counter(words(t)) for t in texts]
            terms = sorted({w for c in own for w in c}, key=lambda w: (xxhash.xxh64_intdigest(w) % BUCKETS, w))
            place = {w: i for i, w in enumerate(terms)}
            held = np.array([len(c) for c in own], np.int64)
            at = np.repeat(np.arange(len(own)), held)
            term = np.array([place[w] for c in own for w in c], np.int64)
            tf = np.array([n for c in own for n in c.values()], np.int64)
            n = np.array([sum(c.values()) for c in own], np.int64)
            order = np.argsort(term, kind="stable")
            at, tf = at[order], tf[order]
            ends = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=len(terms))), [len(term) + 1])).astype(np.int32)
            ids = pa.concat_arrays([b.column(0).take(pa.array(at)), pa.nulls(1, b.column(0).type)])
            lists = pa.StructArray.from_arrays([pa.array(np.append(at + row, 0), pa.int64()), ids, pa.array(np.append(tf, (held > 0).sum()), pa.int64()), pa.array(np.append(n[at], n.sum()), pa.int64())], ["row", "doc_id", "tf", "n"])
            size = len(terms) + 1
            buckets = [xxhash.xxh64_intdigest(w) % BUCKETS for w in terms]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(size, part), pa.int32()), pa.array(np.full(size, number % SLICES), pa.int32()), pa.array([*buckets, None], pa.int32()), pa.array([*terms, None], pa.binary()).cast(pa.string()), pa.ListArray.from_arrays(pa.array(ends), lists)], names=["part", "slice", "bucket", "term", "postings"])
            row, number = row + b.num_rows, number + 1

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return cut(rows.mapInArrow(tidy(run), f"part int, slice int, bucket int, term string, postings array<struct<row:long,doc_id:{kind},tf:long,n:long>>"), "postings")


def search(postings: DataFrame, items: DataFrame, k: int = 50, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents with the highest score above 0 of each item.

    A term's weight is floor(1000 ln((2N + 2) / (2df + 1))) of N documents with any term, of which df hold it. A document's
    score sums weight * (10^9 tf div (1000 tf + 20 m)) over the item's distinct terms, where m is 50 + (50 n N div L) with
    n its own terms and L all terms; div rounds down. Equal scores go by ascending doc_id, a null one last. Rows of the
    documents that repeat a doc_id are documents of their own, and so are rows of items. Null and empty texts have no terms.
    """
    postings = with_settings(postings, spark__sql__requireAllClusterKeysForCoPartition="false")
    tables, total = Tables(postings.sparkSession), F.col("postings")[0]
    totals = postings.where("term is null").select(F.coalesce(F.sum(total["tf"]), F.lit(0)), F.coalesce(F.sum(total["n"]), F.lit(0)), F.coalesce(F.max("part"), F.lit(0)), F.coalesce(F.max("slice"), F.lit(0)))
    documents, terms, last_part, last_slice = totals.first()
    asked = build_postings(with_settings(items), id_col, text_col)
    tables.held.append(asked)
    asked = asked.where("term is not null")
    mine = asked.select("part", "bucket", "term", F.explode("postings").alias("p")).select((F.shiftleft(F.col("part").cast("long"), 40) + F.col("p.row")).alias("item"), F.col("p.doc_id").alias("item_id"), "bucket", "term")
    names = tables.cut(mine.select("item", "item_id").distinct(), "items")
    wanted = tables.cut(asked.select("term").distinct(), "wanted-terms")
    if wanted.count() <= BROADCAST_TERMS:
        wanted = F.broadcast(wanted)
    hits = postings.join(wanted, "term", "left_semi")
    df = hits.groupBy("term").agg(F.sum(F.size("postings")).alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1))).cast("long")
    weighted = tables.cut(mine.join(df, "term").select("item", "term", weight.alias("w")).where("w <> 0"), "weighted-terms")
    every = lambda name, last: F.explode(F.sequence(F.lit(0), F.lit(last))).alias(name)
    weighted = weighted.select("*", every("part", last_part)).select("*", every("slice", last_slice))
    impact = F.transform("postings", lambda p: F.struct(p["row"].alias("row"), p["doc_id"].alias("doc_id"), _impact(p["tf"], 50 + _div(50 * p["n"] * documents, F.lit(max(terms, 1)))).alias("impact")))
    # dealt by slice, which both sides of the join and the sums can use
    n, by = min((last_part + 1) * (last_slice + 1), 16 * parts(postings.sparkSession)), ["part", "slice"]
    lists = hits.select(*by, "term", impact.alias("impacts")).repartition(n, *by)
    met = lists.join(weighted.repartition(n, *by), [*by, "term"]).select(*by, "item", "w", F.explode("impacts").alias("x"))
    scores = met.groupBy(*by, "item", F.col("x.row").alias("row"), F.col("x.doc_id").alias("doc_id")).agg(F.sum(F.col("w") * F.col("x.impact")).alias("score")).where("score > 0")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), *by, "row")
    ranked = scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    out = cut(ranked.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "ranked")
    tables.drop()
    return out


def _div(a: Column, b: Column) -> Column:
    """Integer division of numbers that are not negative."""
    return F.call_function("div", a, b)


def _impact(tf: Column, m: Column) -> Column:
    return _div(1_000_000_000 * tf, 1000 * tf + 20 * m)
