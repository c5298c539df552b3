"""Operator 9: Jaccard self-join of documents on word shingles, by several global token orders.

A document's tokens are the 64-bit hashes of its distinct five-word shingles. Two sets link at Jaccard >= 0.75, and then
share a token among the first n - ceil(0.75 n) + 1 of each, under any global order of tokens. The steps:

1. Equal sets become one class. Every class has, in each of a few hash orders, its first token; classes that share one
   and have like sizes are tried against the smallest class there (a star, not all pairs). Verified links give first
   components, into which large groups of near copies collapse.
2. Tokens that many documents share are found among the documents of crowded stars and moved to the end of all orders.
3. Prefixes under the first order are packed by token. Only tokens whose documents lie in different components go on:
   components need no links within. Their pairs, with size and position filters, are the first candidates. Parity
   signatures, a lower bound of two sets' difference, take out most pairs that share little else.
4. Prefixes of the candidates' documents under a second order give pairs in the same way; only pairs that both orders
   found are verified exactly.
5. Components of all verified links.

Sets of ids or tokens reach the scans as bitmaps of a fixed size, which let some others through; an exact join follows.
No partner, token or candidate is dropped or capped.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_TABLE, Tables, cut, drop, parts, slabs, small, tidy, utf8
from .graph import components
from .hashing import Rolling, Words

SHINGLE = 5
#: Jaccard threshold as a fraction.
NUMERATOR, DENOMINATOR = 3, 4
STARS = 2
#: Bytes of text that a worker takes at a time.
SLAB = 1 << 19
#: Least and most bits of a bitmap that is broadcast (2 MB, 32 MB): about eight for each document, in between.
BITMAP, LARGEST = 1 << 24, 1 << 28
#: A token with more postings, of which half a million pairs would be compared, is joined by bands of sizes, each BAND times
#: the one before.
HOT, BAND = 1024, 1 + 1 / 32
#: Hot tokens up to which their table is broadcast; a larger one is joined by shuffle.
BROADCAST_TOKENS = 500_000
#: A star of more classes is crowded; a token in more documents of such stars goes last in all orders.
CROWDED, FREQUENT = 16, 32

def _mix(x: np.ndarray, order: int) -> np.ndarray:
    x = (x ^ np.uint64(0xD6E8FEB86659FD93 * (order + 1) & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def shingles(texts: list[str | None], width: int = SHINGLE) -> list[np.ndarray]:
    """Each text's set of tokens, sorted. Fewer words than width: the whole sequence is one; no words: none."""
    own = Words(texts, lower=True)
    size = own.end - own.begin
    many = np.where(size >= width, size - width + 1, np.minimum(size, 1))
    ends = np.cumsum(many)
    at = np.repeat(own.begin - ends + many, many) + np.arange(many.sum())
    tokens = Rolling(own.hash).of(at, np.minimum(at + width, np.repeat(own.end, many)))
    return [np.unique(tokens[a:z]) for a, z in zip((ends - many).tolist(), ends.tolist(), strict=True)]


def prefix_size(n: int) -> int:
    return n - -(-n * NUMERATOR // DENOMINATOR) + 1


def needed(n1, n2):
    """The least overlap of two linked sets."""
    return np.ceil((n1 + n2) * NUMERATOR / (NUMERATOR + DENOMINATOR) - 1e-9)


def prefix(tokens: np.ndarray, order: int, late: np.ndarray) -> np.ndarray:
    """The first tokens under an order: those in the bitmap `late` go last."""
    key = _mix(tokens, order) >> np.uint64(1) | _has(late, tokens).astype(np.uint64) << np.uint64(63)
    return tokens[np.argsort(key)[: prefix_size(len(tokens))]]


def signature(tokens: np.ndarray) -> bytes:
    """Parities of the tokens in each of at least as many bins, a power of two: they differ no more than the sets do."""
    bins = 1 << max(6, len(tokens).bit_length())
    return np.packbits((np.bincount((tokens & np.uint64(bins - 1)).astype(np.int64), minlength=bins) & 1).astype(np.uint8)).tobytes()


def parities_apart(x: bytes, y: bytes) -> int:
    """How many parities of two signatures differ; the longer one is folded to the shorter's bins."""
    x, y = sorted((x, y), key=len)
    a, b, size = int.from_bytes(x), int.from_bytes(y), len(y)
    while size > len(x):
        size //= 2
        b = (b >> 8 * size) ^ (b & (1 << 8 * size) - 1)
    return (a ^ b).bit_count()


def bitmap(values: DataFrame, bits: int) -> np.ndarray:
    """The bitmap (uint8) of the top bits of a single long column: bits / 32768 rows of 4 KB, whatever the table's size."""
    shift = 64 - (bits.bit_length() - 1)
    at = values.select((F.shiftrightunsigned(values.columns[0], shift) + 1).alias("at"))  # Spark's bitmaps count from 1
    rows = at.groupBy(F.call_function("bitmap_bucket_number", F.col("at")).alias("n")).agg(F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", F.col("at"))).alias("bits")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        out[(r.n - 1) * 4096 : r.n * 4096] = np.frombuffer(r.bits, np.uint8)
    return out


def _has(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = (values >> np.uint64(64 - ((8 * len(bits)).bit_length() - 1))).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _hashed(ids: np.ndarray) -> np.ndarray:
    """What Spark's xxhash64 makes of longs (the public XXH64 algorithm, seed 42)."""
    p1, p2, p3, p4, p5 = map(np.uint64, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda x, k: x << np.uint64(k) | x >> np.uint64(64 - k)
    h = np.full(len(ids), 50, np.uint64) + p5
    h = turn(h ^ turn(ids.astype(np.uint64) * p2, 31) * p1, 27) * p1 + p4
    h = (h ^ h >> np.uint64(33)) * p2
    h = (h ^ h >> np.uint64(29)) * p3
    return h ^ h >> np.uint64(32)


class Join:
    """One run of the operator over docs (doc_id long, text)."""

    def __init__(self, docs: DataFrame):
        self.docs, self.spark, self.bits, self.tables = docs, docs.sparkSession, BITMAP, Tables(docs.sparkSession)

    def send(self, value):
        return self.spark.sparkContext.broadcast(value)

    def ids_bitmap(self, ids: DataFrame):
        return self.send(bitmap(ids.select(F.xxhash64(ids.columns[0])), self.bits))

    def scan(self, make: Callable, schema: str, only=None, without=None) -> DataFrame:
        """make(doc_id, tokens) -> rows' tuple or None, for each document with tokens; only and without: bitmaps of ids."""
        names = [x.split()[0] for x in schema.split(", ")]
        kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
        types = [kinds[x.split()[1]] for x in schema.split(", ")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slabs(batches, 1, SLAB):
                ids = np.asarray(b.column(0))
                pick = np.full(len(ids), True)
                if only is not None:
                    pick &= _has(only.value, _hashed(ids))
                if without is not None:
                    pick &= ~_has(without.value, _hashed(ids))
                texts = b.column(1).filter(pa.array(pick)).to_pylist()
                rows = [r for d, t in zip(ids[pick].tolist(), shingles(texts), strict=True) if (r := make(d, t)) is not None]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(types)], names=names)

        return self.docs.mapInArrow(tidy(run), schema)

    def possible(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """The pairs (a, b) of class ids whose sizes and signatures leave a link possible; written out."""
        sig = classes.select("id", "n", "sig")
        both = pairs.join(sig.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa")), "a").join(sig.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb")), "b")

        def may(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                na, nb = np.asarray(b.column(2)).astype(np.int64), np.asarray(b.column(3)).astype(np.int64)
                apart = np.fromiter(map(parities_apart, b.column(4).to_pylist(), b.column(5).to_pylist()), np.int64, b.num_rows)
                yield b.select([0, 1]).filter(pa.array((apart <= na + nb - 2 * needed(na, nb)) & (np.minimum(na, nb) >= needed(na, nb))))

        return cut(both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(tidy(may), "a long, b long"), "pairs")

    def verified(self, left: DataFrame) -> DataFrame:
        """The links (a, b) among pairs of class ids."""
        ids = left.select("a").union(left.select(F.col("b").alias("a"))).distinct()
        sets = cut(self.scan(lambda d, t: (d, t.tobytes()) if len(t) else None, "a long, set binary", only=self.ids_bitmap(ids)), "sets")
        full = left.join(sets, "a").join(sets.select(F.col("a").alias("b"), F.col("set").alias("other")), "b")

        def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in small(batches):
                ok = []
                for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(common * DENOMINATOR >= NUMERATOR * (len(x) + len(y) - common))
                yield b.select([0, 1]).filter(pa.array(ok, pa.bool_()))

        return cut(full.select("a", "b", "set", "other").mapInArrow(tidy(exact), "a long, b long"), "links")

    def posted(self, rows: DataFrame) -> DataFrame:
        """The distinct pairs (a, b) of different components from postings (token, id, comp, n, at).

        Postings of hot tokens meet by size too: one with n tokens, at a place in its prefix, meets only those sizes for
        which what follows in it could still be enough. So many documents that share a part which is too small to link
        them never meet, however many they are.
        """
        rows = self.tables.cut(rows, "postings")
        hot = self.tables.cut(rows.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select("token"), "hot-tokens")
        total = F.col("n1") + F.col("n2")
        least = F.ceil(total * NUMERATOR / (NUMERATOR + DENOMINATOR) - 1e-9)
        fits = (F.col("comp1") < F.col("comp2")) & (F.least("n1", "n2") * DENOMINATOR >= F.greatest("n1", "n2") * NUMERATOR) & (F.least(F.col("n1") - F.col("at1"), F.col("n2") - F.col("at2")) >= least)

        def side(df: DataFrame, s: str) -> DataFrame:
            return df.select(*[F.col(c).alias(f"{c}{s}") for c in df.columns])

        def met(x: DataFrame, y: DataFrame, on: list[str]) -> DataFrame:
            same = fits
            for c in on:
                same = same & (F.col(f"{c}1") == F.col(f"{c}2"))
            return side(x, "1").join(side(y, "2"), same).select(F.least("id1", "id2").alias("a"), F.greatest("id1", "id2").alias("b"))

        number = hot.count()
        if not number:
            return met(rows, rows, ["token"]).distinct()
        known = F.broadcast(hot) if number <= BROADCAST_TOKENS else hot
        cold, warm = rows.join(known, "token", "left_anti"), self.tables.cut(rows.join(known, "token", "left_semi"), "hot-postings")
        band = lambda n: F.floor(F.log(n.cast("double")) / math.log(BAND)).cast("int")
        low = F.ceil(F.col("n") * NUMERATOR / DENOMINATOR - 1e-9)
        high = F.least(F.floor(F.col("n") * DENOMINATOR / NUMERATOR + 1e-9), F.floor((F.col("n") - F.col("at")) * (NUMERATOR + DENOMINATOR) / NUMERATOR + 1e-9) - F.col("n"))
        own = warm.withColumns({"low": low, "high": high}).where("low <= high")
        wanted = own.select("token", "id", "comp", "n", "at", F.explode(F.sequence(band(F.col("low")), band(F.col("high")))).alias("band"))
        return met(cold, cold, ["token"]).union(met(own.withColumn("band", band(F.col("n"))).drop("low", "high"), wanted, ["token", "band"])).distinct()

    def run(self) -> DataFrame:
        spark = self.spark
        # 1. classes and stars
        feats = cut(self.scan(lambda d, t: (d, len(t), xxhash.xxh3_64_intdigest(t.tobytes()) - (1 << 63), xxhash.xxh64_intdigest(t.tobytes(), 3) - (1 << 63), [int(_mix(t, i + 1).min().view(np.int64)) for i in range(STARS)] if len(t) else [], signature(t)), "doc_id long, n int, s1 long, s2 long, stars array<long>, sig binary"), "features")
        key = ["s1", "s2", "n"]
        self.bits = min(LARGEST, max(BITMAP, 1 << (8 * feats.count()).bit_length()))
        classes = cut(feats.where("n > 0").groupBy(*key).agg(F.min("doc_id").alias("id"), F.first("stars").alias("stars"), F.first("sig").alias("sig")), "classes")
        stars = classes.select("id", F.posexplode("stars").alias("i", "token"), F.floor(F.log("n") / math.log(DENOMINATOR / NUMERATOR)).cast("int").alias("band"))
        centres = stars.groupBy("i", "token", "band").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("size"))
        centres = cut(centres, "stars")
        tried = stars.select("i", "token", F.col("id").alias("b"), F.explode(F.array("band", F.col("band") - 1)).alias("band")).join(centres, ["i", "token", "band"]).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        links = self.verified(self.possible(tried, classes))
        first = cut(components(links), "first-components")
        # 2. tokens that go last
        crowded = self.tables.cut(centres.groupBy("i", "token").agg(F.sum("size").alias("size")).where(F.col("size") > CROWDED).select("i", "token"), "crowded")
        crowd = self.tables.cut(stars.join(crowded, ["i", "token"], "left_semi").select("id").distinct(), "crowd")
        late = self.send(bitmap(self.frequent(crowd), self.bits))
        drop(spark, centres)
        # 3. candidates by the first order. Ids that are in no link and not in a larger class are their own component.
        found = feats.where("n > 0").join(classes.select(*key, "id"), key)
        busy = found.where("doc_id <> id").select("doc_id").union(first.select("id")).distinct()
        known = self.ids_bitmap(busy)
        own = classes.select("id").join(first, "id", "left").select("id", F.coalesce("component", "id").alias("comp"))
        make = lambda order: lambda d, t: (d, len(t), prefix(t, order, late.value).tobytes()) if len(t) else None
        alone = self.scan(make(1), "id long, n int, prefix binary", without=known).select("id", F.col("id").alias("comp"), "n", "prefix")
        rest = self.scan(make(1), "id long, n int, prefix binary", only=known).join(own, "id").select("id", "comp", "n", "prefix")
        prefixes = cut(alone.union(rest), "prefixes")
        cross = self.send(self.crossing(prefixes))
        pairs = self.possible(self.posted(self.postings(prefixes, cross)), classes)
        drop(spark, prefixes)
        # 4. and by the second
        ids = pairs.select("a").union(pairs.select(F.col("b").alias("a"))).distinct().withColumnRenamed("a", "id")
        second = self.scan(make(2), "id long, n int, prefix binary", only=self.ids_bitmap(ids)).join(own.join(ids, "id", "left_semi"), "id")
        second = cut(second.select("id", "comp", "n", "prefix"), "prefixes")
        cross = self.send(self.crossing(second))
        pairs = pairs.join(self.posted(self.postings(second, cross)), ["a", "b"], "left_semi")
        more = self.verified(cut(pairs, "candidates"))
        drop(spark, second)
        # 5.
        last = components(links.union(more).union(self.of_one_id(feats, classes, key)))
        self.tables.drop()
        named = classes.select(*key, "id").join(last, "id", "left").select(*key, F.coalesce("component", "id").alias("component_id"))
        linked = feats.where("n > 0").join(named, key).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")
        return linked.union(feats.where("n = 0").select("doc_id", F.lit(0).cast("long"), "doc_id"))

    def of_one_id(self, feats: DataFrame, classes: DataFrame, key: list[str]) -> DataFrame:
        """Links between a doc_id and the classes of its texts, where it has several."""
        several = self.tables.cut(feats.where("n > 0").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id"), "several")
        return self.tables.cut(feats.join(several, "doc_id").select("doc_id", *key).distinct().join(classes.select(*key, "id"), key).where("doc_id <> id").select(F.col("doc_id").alias("a"), F.col("id").alias("b")), "own-links")

    def frequent(self, crowd: DataFrame) -> DataFrame:
        """Tokens in more than FREQUENT of the documents in crowd."""
        only = self.ids_bitmap(crowd)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0

            def emit() -> pa.RecordBatch:
                values, counts = np.unique(np.concatenate(held or [np.zeros(0, np.uint64)]), return_counts=True)
                return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts, pa.int64())], names=["token", "n"])

            for b in slabs(batches, 1, SLAB):
                pick = pa.array(_has(only.value, _hashed(np.asarray(b.column(0)))))
                held += shingles(b.column(1).filter(pick).to_pylist())
                size = sum(map(len, held))
                if size > 1_000_000:
                    yield emit()
                    held, size = [], 0
            yield emit()

        return self.docs.mapInArrow(tidy(run), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") > FREQUENT).select("token")

    def crossing(self, prefixes: DataFrame) -> np.ndarray:
        """The bitmap of tokens whose documents lie in more than one component.

        Each task packs, for each range of tokens, the smallest and largest component of each of its tokens: at most two
        entries a token and task, however many documents share it. The owner of a range merges them and marks its part.
        """
        ranges = 1 << max(4, (4 * parts(self.spark) - 1).bit_length())
        ranges = min(ranges, 1 << 20)
        shift = np.uint64(64 - (ranges.bit_length() - 1))

        def ends(token: np.ndarray, comp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            order = np.lexsort((comp, token))
            token, comp = token[order], comp[order]
            new = np.concatenate([[True], token[1:] != token[:-1]])
            last = np.concatenate([new[1:], [True]])
            keep = new | (last & (comp != comp[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]))
            return token[keep], comp[keep]

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0

            def emit() -> pa.RecordBatch:
                token, comp = ends(*(np.concatenate([h[i] for h in held]) for i in (0, 1)))
                at = np.searchsorted(token >> shift, np.arange(ranges + 1, dtype=np.uint64))
                some = np.flatnonzero(np.diff(at))
                return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([token[at[i] : at[i + 1]].tobytes() for i in some], pa.binary()), pa.array([comp[at[i] : at[i + 1]].tobytes() for i in some], pa.binary())], names=["r", "tokens", "comps"])

            for b in batches:
                if not b.num_rows:
                    continue
                raw = b.column(1).to_pylist()
                held.append((np.frombuffer(b"".join(raw), np.uint64), np.repeat(np.asarray(b.column(0)), [len(x) // 8 for x in raw])))
                size += len(held[-1][0])
                if size > 3_000_000:
                    yield emit()
                    held, size = [], 0
            if held:
                yield emit()

        def merge(table: pa.Table) -> pa.Table:
            token, comp = ends(*(np.frombuffer(b"".join(table.column(c).to_pylist()), k) for c, k in (("tokens", np.uint64), ("comps", np.int64))))
            found = np.unique(token[1:][token[1:] == token[:-1]])
            return pa.table({"token": pa.array(found.view(np.int64))})

        packed = prefixes.select("comp", "prefix").mapInArrow(tidy(pack), "r int, tokens binary, comps binary")
        return bitmap(packed.groupBy("r").applyInArrow(merge, "token long"), self.bits)

    def postings(self, prefixes: DataFrame, tokens) -> DataFrame:
        """A row (token, id, comp, n, at) for each prefix token that is in the bitmap."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                raw = b.column(3).to_pylist()
                sizes = np.array([len(x) // 8 for x in raw], np.int64)
                token = np.frombuffer(b"".join(raw), np.uint64)
                row = np.repeat(np.arange(len(raw)), sizes)
                at = np.arange(len(token)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                hit = np.flatnonzero(_has(tokens.value, token))
                pick = pa.array(row[hit])
                yield pa.RecordBatch.from_arrays([pa.array(token[hit].view(np.int64)), *(b.column(i).take(pick) for i in range(3)), pa.array(at[hit], pa.int32())], names=["token", "id", "comp", "n", "at"])

        return prefixes.select("id", "comp", "n", "prefix").mapInArrow(tidy(run), "token long, id long, comp long, n int, at int")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row (doc_id, n_shingles, component_id) for each of docs.

    Null, empty and blank texts have no shingles and are their own component; texts of fewer than five words have one.
    component_id is the smallest doc_id that links reach. doc_ids (integers) name documents; rows with a null doc_id are
    in no link (n_shingles as counted, component_id null). Repeated rows each get a row; rows that share a doc_id are one
    document, linked to all that any of their texts links to. Other columns are ignored. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = Join(rows.where("doc_id is not null")).run()
    lost = rows.where("doc_id is null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slabs(batches, 1, SLAB):
            n = list(map(len, shingles(b.column(1).to_pylist())))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), b.column(0)], names=["doc_id", "n_shingles", "component_id"])

    return out.union(lost.mapInArrow(tidy(count), "doc_id long, n_shingles long, component_id long"))


def brute_force(texts: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    """doc_id -> (n_shingles, component_id), by comparing all pairs."""
    sets = {}
    for d, t in texts.items():
        w = utf8(t).translate(LOWER_TABLE).split()
        sets[d] = {tuple(w[i : i + SHINGLE]) for i in range(max(1, len(w) - SHINGLE + 1))} if w else set()
    root = {d: d for d in texts}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}
