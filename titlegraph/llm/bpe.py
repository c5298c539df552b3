"""Operator 10: byte-level BPE through a minimal acyclic transducer of the corpus' frequent pieces.

1. Pieces (the units that BPE merges on their own) are counted over the whole corpus; the most frequent ones, at most
   ``entries``, enter the lexicon, each with its ids.
2. The lexicon is compiled into a minimal acyclic automaton: pieces with equal tails share states. Each transition
   carries the number of pieces that sort before its branch; their sum along a path is the piece's number, which points
   to its ids. The file is shipped to each executor once, by Spark, and memory-mapped by its Python workers.
3. Encoding looks pieces up in the automaton, all new pieces of a batch at once; pieces that it lacks are merged
   exactly. Decoding maps ids to bytes.
"""

from __future__ import annotations

import heapq
import json
import mmap
import uuid
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, scratch, slabs, tidy
from .pretokens import byte_characters, encode, keep_half, split_listed, split_usual, splitter, usual

#: Pieces in the lexicon; bounds the automaton (about 6 MB) and what the driver gets.
ENTRIES = 131_072
REMEMBERED = 60_000
LONG = 256  # bytes; from here on merges go through a heap


class Merges:
    """A byte-level BPE model read from a tokenizer file, with merges of our own."""

    def __init__(self, path: str):
        model = json.load(open(path, encoding="utf-8"))
        vocab = model["model"]["vocab"]
        char = byte_characters()
        byte = {c: b for b, c in char.items()}
        self.first = [vocab[char[b]] for b in range(256)]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.text = {i: bytes(byte[c] for c in s) for s, i in vocab.items() if i not in self.special.values()}
        self.text |= {i: s.encode() for s, i in self.special.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        self.made = [vocab[a + b] for a, b in pairs]
        self.first_of, self.made_of = np.array(self.first), np.array(self.made)
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs])
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks = keys[order], order

    @cached_property
    def rank(self) -> dict[tuple[int, int], int]:
        """The rank of each pair; for pieces that are merged alone."""
        return {(k >> 32, k & (1 << 32) - 1): r for k, r in zip(self.pair_keys.tolist(), self.pair_ranks.tolist(), strict=True)}

    def merge(self, piece: bytes) -> list[int]:
        """Merges the pair of the lowest rank, the leftmost of equals, until no pair can be merged."""
        ids = list(map(self.first.__getitem__, piece))
        if len(ids) > LONG:
            return self._merge_long(ids)
        get, none = self.rank.get, len(self.made)
        ranks = [get(p, none) for p in zip(ids, ids[1:])]
        while ranks:
            r = min(ranks)
            if r == none:
                break
            i = ranks.index(r)
            new = self.made[r]
            ids[i : i + 2] = [new]
            del ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], new), none)
            if i < len(ranks):
                ranks[i] = get((new, ids[i + 1]), none)
        return ids

    def merge_many(self, pieces: list[bytes], kind: str) -> list[bytes]:
        """merge() of many pieces together, a merge of each a round; ids as bytes of `kind`."""
        out: list[bytes] = [b""] * len(pieces)
        short = [i for i, p in enumerate(pieces) if len(p) <= LONG]
        for i in set(range(len(pieces))).difference(short):
            out[i] = np.array(self.merge(pieces[i]), kind).tobytes()
        none, width = len(self.made), np.dtype(kind).itemsize
        own, size = np.array(short, np.int64), np.array([len(pieces[i]) for i in short], np.int64)
        own, size = own[size > 0], size[size > 0]
        ids = self.first_of[np.frombuffer(b"".join([pieces[i] for i in short]), np.uint8)]
        row = np.repeat(np.arange(len(own)), size)
        # of each id, the rank of its pair with the next one of its piece
        rank = np.full(len(ids), none)

        def rate(at: np.ndarray) -> None:
            key = ids[at] << 32 | ids[at + 1]
            k = np.minimum(np.searchsorted(self.pair_keys, key), none - 1)
            rank[at] = np.where(self.pair_keys[k] == key, self.pair_ranks[k], none)

        rate(np.flatnonzero(row[1:] == row[:-1]))
        while len(own):
            best = np.minimum.reduceat(rank, np.cumsum(size) - size)
            live = best < none
            if not live.all():  # pieces that are done leave
                done = ~live
                raw = ids[done[row]].astype(kind).tobytes()
                ends = np.cumsum(size[done]) * width
                for i, a, z in zip(own[done].tolist(), (ends - size[done] * width).tolist(), ends.tolist(), strict=True):
                    out[i] = raw[a:z]
                keep = live[row]
                ids, rank, own, size, best = ids[keep], rank[keep], own[live], size[live], best[live]
                row = np.repeat(np.arange(len(own)), size)
                if not len(own):
                    break
            hit = np.flatnonzero(rank == best[row])
            hit = hit[np.concatenate([[True], row[hit[1:]] != row[hit[:-1]]])]  # the leftmost of each piece
            ids[hit] = self.made_of[best]
            keep = np.full(len(ids), True)
            keep[hit + 1] = False
            ids, rank, row = ids[keep], rank[keep], row[keep]
            size -= 1
            at = hit - np.arange(len(hit))  # a piece before has lost one id
            rank[at] = none
            rate(at[(at + 1 < len(ids)) & (row[np.minimum(at + 1, len(ids) - 1)] == row[at])])
            rate((at - 1)[(at > 0) & (row[at - 1] == row[at])])
        return out

    def _merge_long(self, ids: list[int]) -> list[int]:
        n, get = len(ids), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = self.made[r], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := get((ids[i], ids[k]))) is not None:
                    heapq.heappush(heap, (r, i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (r := get((ids[h], ids[i]))) is not None:
                heapq.heappush(heap, (r, h, ids[h], ids[i]))
        return [x for x in ids if x >= 0]


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The minimal automaton of the pieces, as one file: six int64 sizes, then its arrays."""
    words = sorted(w for w in entries if w)
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []

    def settle(node: list) -> int:
        """node: [final, {label: state}]. The state's number: an equal state's, if there is one."""
        key = (node[0], tuple(node[1].items()))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    path, last = [[False, {}]], b""
    for w in words:  # sorted, so what differs from the word before is never touched again
        common = 0
        while common < min(len(w), len(last)) and w[common] == last[common]:
            common += 1
        while len(path) > common + 1:
            done = path.pop()
            path[-1][1][last[len(path) - 1]] = settle(done)
        for _ in w[common:]:
            path.append([False, {}])
        path[-1][0], last = True, w
    while len(path) > 1:
        done = path.pop()
        path[-1][1][last[len(path) - 1]] = settle(done)
    root = settle(path[0])
    below = []  # pieces from each state on; targets come first
    keys, targets, outputs = [], [], []
    for s, (final, edges) in enumerate(states):
        total = int(final)
        for label, target in edges:
            keys.append(s << 8 | label)
            targets.append(target)
            outputs.append(total)
            total += below[target]
        below.append(total)
    order = np.argsort(keys, kind="stable") if keys else np.zeros(0, int)
    ids = [entries[w] for w in words]
    arrays = [
        np.array(keys, "<i8")[order], np.array(targets, "<i4")[order], np.array(outputs, "<i4")[order], np.array([f for f, _ in states], np.uint8),
        np.cumsum([0, *map(len, ids)]).astype("<i4"), np.array([i for x in ids for i in x], "<u4"),
    ]
    head = np.array([root, len(keys), len(states), len(words), len(arrays[5]), 0], "<i8")
    blobs = [head.tobytes()]
    for a in arrays:
        blobs.append(a.tobytes() + bytes(-a.nbytes % 8))
    return b"".join(blobs)


class Lexicon:
    """A compiled lexicon in a buffer, such as a memory-mapped file."""

    def __init__(self, buffer):
        self.root, edges, states, self.words, ids, _ = np.frombuffer(buffer, "<i8", 6).tolist()
        at, self.arrays = 48, []
        for kind, n in (("<i8", edges), ("<i4", edges), ("<i4", edges), ("u1", states), ("<i4", self.words + 1), ("<u4", ids)):
            self.arrays.append(np.frombuffer(buffer, kind, n, at))
            at += -(-self.arrays[-1].nbytes // 8) * 8

    @classmethod
    def open(cls, path: str) -> Lexicon:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def look_up(self, pieces: pa.Array) -> np.ndarray:
        """Each piece's number, or -1. All pieces walk the automaton together, a byte at a time, on Arrow's own bytes."""
        keys, targets, outputs, final, _, _ = self.arrays
        found = np.full(len(pieces), -1)
        if not len(keys) or not len(pieces):
            return found
        at = np.frombuffer(pieces.buffers()[1], "<i4")[pieces.offset : pieces.offset + len(pieces) + 1].astype(np.int64)
        at, end = at[:-1], at[1:]
        text = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)
        live = np.flatnonzero(end > at)
        at, end = at[live], end[live]
        state, number = np.full(len(live), self.root, np.int64), np.zeros(len(live), np.int64)
        while len(live):
            want = state << 8 | text[at]
            edge = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            hit = np.flatnonzero(keys[edge] == want)
            live, edge, at, end = live[hit], edge[hit], at[hit] + 1, end[hit]
            state = targets[edge].astype(np.int64)
            number = number[hit] + outputs[edge]
            ended = at == end
            whole = ended & (final[state] > 0)
            found[live[whole]] = number[whole]
            on = np.flatnonzero(~ended)
            live, at, end, state, number = live[on], at[on], end[on], state[on], number[on]
        return found

    def ids(self, numbers: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces of these numbers in turn, and how many each has."""
        _, _, _, _, offsets, ids = self.arrays
        sizes = offsets[numbers + 1] - offsets[numbers]
        ends = np.cumsum(sizes)
        return ids[np.repeat(offsets[numbers] - ends + sizes, sizes) + np.arange(sizes.sum())].astype(kind), sizes


class Coder:
    """Encodes and decodes with a lexicon and, for other pieces, merges."""

    def __init__(self, tokenizer_path: str, lexicon: Lexicon | None):
        self.merges, self.lexicon = Merges(tokenizer_path), lexicon
        self.split = splitter(tokenizer_path)
        size = max(self.merges.text) + 1
        self.kind = "<u2" if size <= 0x10000 else "<u4"
        self.bytes_of = pa.array([self.merges.text.get(i, b"") for i in range(size)], pa.binary())
        self.name_of = pa.array(list(map(str, range(size))))
        # the memo of merged pieces; strings of special tokens have ids of their own
        self.known = {s.encode(): np.array([i], self.kind).tobytes() for s, i in self.merges.special.items()}

    def merged(self, pieces: pa.StringArray) -> pa.ListArray:
        """The ids of each of the distinct pieces: the lexicon's, else merged here."""
        found = self.lexicon.look_up(pieces) if self.lexicon else np.full(len(pieces), -1)
        lacks = np.flatnonzero(found < 0)
        raw = pieces.take(pa.array(lacks)).cast(pa.binary()).to_pylist()
        if len(self.known) > REMEMBERED:
            keep_half(self.known)
        new = [p for p in raw if p not in self.known]
        self.known.update(zip(new, self.merges.merge_many(new, self.kind), strict=True))
        own = list(map(self.known.__getitem__, raw))
        has = np.flatnonzero(found >= 0)
        ids, sizes = self.lexicon.ids(found[has], self.kind) if len(has) else (np.zeros(0, self.kind), np.zeros(0, np.int64))
        sizes = np.concatenate([sizes, np.array(list(map(len, own)), np.int64) // np.dtype(self.kind).itemsize])
        both = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(np.concatenate([ids, np.frombuffer(b"".join(own), self.kind)])))
        order = np.empty(len(pieces), np.int64)
        order[np.concatenate([has, lacks])] = np.arange(len(pieces))
        return both.take(pa.array(order))

    def encode(self, texts: pa.StringArray | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, none of them null, and where each text ends in them, a zero first."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        return encode(texts, list(self.merges.special), self.split, self.merged, self.kind)

    def named(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Each text's ids in decimal, joined by commas."""
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), self.name_of.take(pa.array(ids))), ",")

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.StringArray:
        """Each text of its ids; bytes that are no UTF-8 become replacement characters."""
        raw = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), self.bytes_of.take(pa.array(ids))), b"")
        try:
            return raw.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.string())


def build_lexicon(docs: DataFrame, tokenizer_path: str, entries: int = ENTRIES, text_col: str = "text") -> str:
    """Counts docs' pieces and ships the lexicon of the most frequent to the executors. The name of its file there."""
    spark = docs.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(tokenizer_path)
        schema = pa.schema([("piece", pa.string()), ("n", pa.int64())])
        held = schema.empty_table()

        def summed() -> pa.Table:
            return held.group_by("piece", use_threads=False).aggregate([("n", "sum")]).rename_columns(["piece", "n"]).cast(schema)

        for b in slabs(batches, 0, 1 << 20):
            texts = b.column(0).drop_null()
            plain = usual(texts)
            for part in (split_usual(texts.filter(plain)), split_listed([split(t) for t in texts.filter(pc.invert(plain)).to_pylist()])):
                n = part.counts()  # zero for what only would follow if a text's first chunk had a space in front
                held = pa.concat_tables([held, pa.table([part.pieces, pa.array(n)], schema=schema).filter(pa.array(n > 0))])
            if held.num_rows > 400_000:  # bounded memory; the sums below are exact all the same
                held = summed()
                if held.num_rows > 200_000:
                    yield from held.to_batches(max_chunksize=100_000)
                    held = schema.empty_table()
        yield from summed().to_batches(max_chunksize=100_000)

    counts = docs.select(F.col(text_col).cast("string").alias("t")).mapInArrow(tidy(count), "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    counts = cut(counts.where(F.length("piece") <= 64).withColumn("level", F.floor(F.log2("n") * 8).cast("int")), "pieces")
    # how many pieces are as frequent as each of some 500 levels tells from which level on there are at most `entries`
    least, total = 1 << 30, 0
    for r in sorted(counts.groupBy("level").count().collect(), reverse=True):
        total += r["count"]
        if total > entries:
            break
        least = r.level
    top = counts.where(F.col("level") >= least).select("piece").collect()
    merges = Merges(tokenizer_path)
    blob = compile_lexicon({r.piece.encode(): merges.merge(r.piece.encode()) for r in top})
    return ship(spark, blob)


def ship(spark: SparkSession, blob: bytes) -> str:
    """Puts a file in the shared folder and has Spark copy it to each executor. Its name for SparkFiles.get()."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{scratch(spark, 'lexicon')}/{name}")
    out = path.getFileSystem(conf).create(path)
    for i in range(0, len(blob), 1 << 20):
        out.write(bytearray(blob[i : i + (1 << 20)]))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def bpe_encode(docs: DataFrame, tokenizer_path: str, lexicon: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """A row (doc_id, n_tokens, ids array<int>, decoded) for each of docs; with digests, ids and decoded as sha256 in hex.

    A null text is empty: no ids. Repeated rows give repeated results; an empty table none; other columns are ignored.
    Texts and pieces of any length are encoded whole.
    """
    from hashlib import sha256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # made anew for each task: the worker lives on, for other operators, and others wait beside it
        coder = Coder(tokenizer_path, Lexicon.open(SparkFiles.get(lexicon)))
        for b in slabs(batches, 1, 1 << 20):
            ids, ends = coder.encode(b.column(1).fill_null(""))
            second = coder.decode(ids, ends)
            if digests:
                first = pa.array([sha256(x.encode()).hexdigest() for x in coder.named(ids, ends).to_pylist()], pa.string())
                second = pa.array([sha256(x.encode()).hexdigest() for x in second.to_pylist()], pa.string())
            else:
                first = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(ends)), first, second], names=names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["doc_id", "n_tokens", "ids", "decoded"]
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(tidy(run), f"doc_id {kind}, n_tokens long, {names[2]} {'string' if digests else 'array<int>'}, {names[3]} string")
