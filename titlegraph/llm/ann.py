"""Operator 6: approximate nearest neighbours by additive quantisation.

Every vector is approximated by a sum of full-dimensional codewords, one from each codebook. Codebooks are learned on a
bounded sample by residual k-means. Every vector is encoded (beam search over the partial sums) and its codes are stored with the squared norm of the
approximation. A query scores all vectors by its lookup tables; of each group of vectors the best ones are reranked by
exact inner product, and the best of all groups are merged by exact score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, parts, tidy

BOOKS, WORDS, BEAM = 24, 256, 4
#: Bound of the sample that codebooks are learned on, chosen by a hash of vec_id.
SAMPLE = 8_192
#: Vectors of a group, about, and those of each that are reranked exactly for a query.
GROUP, RERANK = 8_192, 300
#: Vectors that a task scores at a time.
ROWS = 4_096
#: Queries of a block, about, which a task holds at a time.
BLOCK = 3_072


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    words = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        near = (x @ words.T * 2 - (words**2).sum(1)).argmax(1)
        sums, counts = np.zeros_like(words), np.bincount(near, minlength=k)
        np.add.at(sums, near, x)
        full = counts > 0
        words[full] = sums[full] / counts[full, None]
    return words


class Quantizer:
    """Codebooks (books, words, dims)."""

    def __init__(self, books: np.ndarray, beam: int = BEAM):
        self.books, self.beam = books.astype(np.float32), beam
        self.norms = (self.books**2).sum(2)

    @classmethod
    def learn(cls, x: np.ndarray, books: int = BOOKS, words: int = WORDS, beam: int = BEAM, seed: int = 7) -> Quantizer:
        rng, x = np.random.default_rng(seed), x.astype(np.float32)
        words = max(1, min(words, len(x)))
        rest, found = x.copy(), []
        for _ in range(books):
            found.append(_kmeans(rest, words, rng))
            near = (rest @ found[-1].T * 2 - (found[-1] ** 2).sum(1)).argmax(1)
            rest -= found[-1][near]
        return cls(np.stack(found), beam)

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Codes (rows, books): of each book the codeword, by beam search over partial sums."""
        out = np.zeros((len(x), len(self.books)), np.uint8 if self.books.shape[1] <= 256 else np.uint16)
        for a in range(0, len(x), 1024):
            out[a : a + 1024] = self._encode(x[a : a + 1024].astype(np.float32))
        return out

    def _encode(self, x: np.ndarray) -> np.ndarray:
        n, (_, k, _) = len(x), self.books.shape
        rows = np.arange(n)[:, None]
        # of each partial sum s in the beam: its codes, the rest x - s, and |x - s|2 but for |x|2
        codes, rest, cost = np.zeros((n, 1, 0), np.int64), x[:, None, :], np.zeros((n, 1), np.float32)
        for words, norms in zip(self.books, self.norms, strict=True):
            total = (cost[:, :, None] + norms - 2 * (rest @ words.T)).reshape(n, -1)
            width = min(self.beam, total.shape[1])
            best = np.argpartition(total, width - 1, axis=1)[:, :width] if width < total.shape[1] else np.tile(np.arange(width), (n, 1))
            cost, word = total[rows, best], best % k
            codes = np.concatenate([codes[rows, best // k], word[:, :, None]], axis=2)
            rest = rest[rows, best // k] - words[word]
        return codes[np.arange(n), cost.argmin(1)]

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return sum(book[codes[:, i]] for i, book in enumerate(self.books))

    def scores(self, tables: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """tables: (queries, books, words), each query's inner products with all codewords. (queries, rows)."""
        out = np.zeros((len(tables), len(codes)), np.float32)
        for i in range(codes.shape[1]):
            out += np.take(tables[:, i], codes[:, i], axis=1)
        return out


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v array<float>) without vectors that are null, empty or zero or hold null or non-finite components.

    Vectors of another length than most have take no part either. Rows that repeat a vec_id and its vector count once;
    different vectors of one vec_id are each searched, and the vec_id is found by its best.
    """
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v")).where(F.col("vec_id").isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").take(2)  # a row for each length
    if len(sizes) > 1:
        rows = rows.where(F.size("v") == sizes[0].n)
    several = cut(rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("vec_id"), "ann-repeated")
    if not several.isEmpty():
        again = rows.join(several, "vec_id", "left_semi")
        rows = rows.join(several, "vec_id", "left_anti").unionByName(again.groupBy("vec_id", F.xxhash64("v").alias("h")).agg(F.min("v").alias("v")).drop("h"))
    return rows


def _matrix(column: pa.ListArray) -> np.ndarray:
    """The lists of a column, all of one length."""
    return np.asarray(column.flatten()).reshape(len(column), -1)


def learn_quantizer(vectors: DataFrame, sample: int = SAMPLE, **options) -> Quantizer | None:
    """From at most `sample` vectors of usable(); None if there are none."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").toArrow().column(0).combine_chunks()
    return Quantizer.learn(_matrix(rows), **options) if len(rows) else None


def build_index(vectors: DataFrame, quantizer: Quantizer) -> DataFrame:
    """(vec_id, v, codes, norm) of every vector, written to the shared folder."""
    q = vectors.sparkSession.sparkContext.broadcast(quantizer)  # BOOKS * WORDS codewords at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = q.value.encode(_matrix(b.column(1)))
            norm = (q.value.decode(codes) ** 2).sum(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norm, pa.float32())], names=["vec_id", "v", "codes", "norm"])

    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    return cut(vectors.mapInArrow(tidy(run), f"vec_id {kinds['vec_id']}, v {kinds['v']}, codes binary, norm float"), "ann-index")


def _best(scores: np.ndarray, n: int) -> np.ndarray:
    """Of each row, the places of its n highest scores in ascending order; of equals the first."""
    if n >= scores.shape[1]:
        return np.tile(np.arange(scores.shape[1]), (len(scores), 1))
    edge = np.partition(scores, scores.shape[1] - n, axis=1)[:, [scores.shape[1] - n]]
    above, equal = scores > edge, scores == edge
    room = n - above.sum(1, keepdims=True)
    return np.nonzero(above | equal & (np.cumsum(equal, axis=1) <= room))[1].reshape(len(scores), n)


def search(index: DataFrame, queries: DataFrame, quantizer: Quantizer, k: int = 20, rerank: int = RERANK, metric: str = "ip", block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query (vec_id, v) its k nearest found, itself left out.

    Nearest means the largest inner product ('ip') or the smallest squared distance ('l2', scored negative), exactly, in
    double precision; ties go to the smaller vec_id. Fewer candidates than k are all returned; rerank is raised to k + 1.

    Queries are dealt into blocks of about `block`, vectors into groups of about `group`, both by hashes, and each block
    meets each group once, in a task: rows of both, tables throughout, are shuffled and sorted so that a block's queries
    come first and the group's vectors stream past them. A task holds one block at a time; nothing passes the driver.
    """
    spark, rerank = index.sparkSession, max(rerank, k + 1)
    code = np.uint8 if quantizer.books.shape[1] <= 256 else np.uint16
    q = spark.sparkContext.broadcast(quantizer)  # BOOKS * WORDS codewords at most
    sizes = [-(-df.count() // n) or 1 for df, n in ((queries, block), (index, group))]
    dealt = lambda size, *by: F.pmod(F.xxhash64(*by), F.lit(size)).cast("int")
    each = lambda size: F.explode(F.sequence(F.lit(0), F.lit(size - 1)))
    none = {"codes": F.lit(None).cast("binary"), "norm": F.lit(None).cast("float")}
    asked = queries.select("vec_id", "v").withColumns(none).select(dealt(sizes[0], "vec_id").alias("block"), each(sizes[1]).alias("group"), F.lit(0).alias("kind"), "vec_id", "v", "codes", "norm")
    held = index.select(each(sizes[0]).alias("block"), dealt(sizes[1], "vec_id", "v").alias("group"), F.lit(1).alias("kind"), "vec_id", "v", "codes", "norm")
    rows = asked.unionByName(held).repartition(parts(spark), "block", "group").sortWithinPartitions("block", "group", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, near = None, None
        for b in batches:
            keys = np.stack([np.asarray(b.column(i)) for i in range(3)])
            edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), b.num_rows]
            for a, z in zip(edges, edges[1:], strict=False):
                if a == z:
                    continue
                if pair != (pair := tuple(keys[:2, a].tolist())):
                    if near is not None:
                        yield near.best(k)
                    near = _Nearest(q.value, code, rerank, metric)
                (near.scan if keys[2, a] else near.ask)(b.slice(a, z - a))
        if near is not None:
            yield near.best(k)

    out = rows.mapInArrow(tidy(run), "query_id long, vec_id long, score double")
    out = out.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))  # different vectors of one vec_id
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # at most k rows a query and group
    return out.repartition(parts(spark), "query_id").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


class _Nearest:
    """The best of a group of vectors for each query of a block."""

    def __init__(self, quantizer: Quantizer, code: type, rerank: int, metric: str):
        self.quantizer, self.code, self.rerank, self.metric = quantizer, code, rerank, metric
        self.asked: list[pa.RecordBatch] = []
        self.held: list[list[np.ndarray]] | None = None

    def ask(self, rows: pa.RecordBatch) -> None:
        self.asked.append(rows)

    def _begin(self) -> None:
        self.ids = np.concatenate([np.asarray(b.column(3)) for b in self.asked]) if self.asked else np.zeros(0, np.int64)
        self.own = np.concatenate([_matrix(b.column(4)) for b in self.asked]) if self.asked else np.zeros((0, self.quantizer.books.shape[2]), np.float32)
        self.tables = np.einsum("qd,mkd->qmk", self.own.astype(np.float32), self.quantizer.books)
        # of each query its best rows so far: approximate and exact score, vec_id
        self.held = [[np.zeros((len(part), 0), np.float32), np.zeros((len(part), 0)), np.zeros((len(part), 0), np.int64)] for part in np.split(self.ids, range(64, len(self.ids), 64))]

    def scan(self, rows: pa.RecordBatch) -> None:
        if self.held is None:
            self._begin()
        for at in range(0, rows.num_rows if len(self.ids) else 0, ROWS):
            part = rows.slice(at, ROWS)
            vec, x = np.asarray(part.column(3)), _matrix(part.column(4))
            order = np.argsort(vec, kind="stable")  # so that equal scores keep the smaller vec_ids
            vec, x = vec[order], x[order].astype(np.float64)
            codes = np.frombuffer(b"".join(part.column(5).to_pylist()), self.code).reshape(len(vec), -1)[order]
            norm = np.asarray(part.column(6))[order]
            for i, best in enumerate(self.held):
                mine = slice(64 * i, 64 * i + 64)
                s = self.quantizer.scores(self.tables[mine], codes)
                if self.metric == "l2":
                    s = 2 * s - norm
                s[self.ids[mine, None] == vec] = -np.inf
                near, v = _best(s, self.rerank), self.own[mine].astype(np.float64)
                exact = np.stack([x[n] @ y if self.metric == "ip" else -((x[n] - y) ** 2).sum(1) for n, y in zip(near, v, strict=True)])
                new = np.take_along_axis(s, near, 1), exact, vec[near]
                best[:] = [np.concatenate(z, axis=1) for z in zip(best, new, strict=True)]
                by_id = np.argsort(best[2], axis=1, kind="stable")
                best[:] = [np.take_along_axis(z, by_id, 1) for z in best]
                keep = _best(best[0], self.rerank)
                best[:] = [np.take_along_axis(z, keep, 1) for z in best]

    def best(self, k: int) -> pa.RecordBatch:
        got = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for i, (approximate, exact, vec) in enumerate(self.held or []):
            for who, s, e, f in zip(self.ids[64 * i : 64 * i + 64], approximate, exact, vec, strict=True):
                e, f = e[s > -np.inf], f[s > -np.inf]
                order = np.lexsort((f, -e))
                once = np.sort(np.unique(f[order], return_index=True)[1])[:k]  # the best of each vec_id
                got.append((np.full(len(once), who), f[order][once], e[order][once]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([g[j] for g in got])) for j in range(3)], names=["query_id", "vec_id", "score"])
