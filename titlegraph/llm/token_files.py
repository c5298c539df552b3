"""Operator 2: token ids in binary files: frequency-ranked, in byte-aligned variable-length coding.

A file holds one contiguous range of doc_ids in ascending order. Layout, little-endian::

    magic  b"TGRANK2\\n"
    int64  documents, ids, table entries, data bytes
    int64  doc_id of each document; int64 ids of each document; uint8 of each document, 0 where its doc_id is null
    uint32 id of each rank, the file's most frequent id first
    uint8  controls, two bits an id: the number of data bytes of its rank, less one (four ids a control byte)
    uint8  data, each rank in 1 to 4 bytes

The decoder turns control bytes into lengths by a 256 x 4 table and gathers the data bytes with numpy, with no loop over
ids. Each file has its own ranks, so no pass over the corpus is needed before the first file is written.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, parts, scratch, slabs, tidy
from .pretokens import byte_characters, encode, keep_half, splitter

MAGIC = b"TGRANK2\n"
#: Ids from which on a file is closed: bounds what a task holds, however large its partition is.
FILE_IDS = 1 << 22
#: Lengths of the four ranks of each control byte.
LENGTHS = np.array([[(c >> (2 * i) & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)
#: Entries of an encoder's memo of pieces; then it forgets half of them.
REMEMBERED = 400_000
#: Bytes of text that are encoded at a time.
SLAB = 8 << 20


class Encoder:
    """The tokenizers library's encode(text, add_special_tokens=False).ids, remembering what it has merged.

    The library splits text into pieces that its model merges on their own, so the ids of a text are those of its pieces.
    Texts are split on Arrow arrays; the library's model makes the ids of each new piece, and a memo serves the rest. A
    text with a special token's string goes to the library whole.
    """

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        self.library = library = Tokenizer.from_file(tokenizer_path)
        library.no_truncation()
        library.no_padding()
        self.special = [t.content for t in library.get_added_tokens_decoder().values()]
        self.kind = kind = "<u2" if library.get_vocab_size() <= 0x10000 else "<u4"
        self.split, tokenize = splitter(tokenizer_path), library.model.tokenize
        latin = byte_characters()
        le = [i.to_bytes(np.dtype(kind).itemsize, "little") for i in range(library.get_vocab_size())]
        space = latin[ord(" ")]

        class Pieces(dict):
            def __missing__(self, piece: str) -> bytes:
                if piece.isascii() and piece[1:].isalpha() and piece[0] == " ":  # letters stand for themselves
                    mapped = space + piece[1:]
                else:
                    mapped = piece.encode().decode("latin-1").translate(latin)
                self[piece] = ids = b"".join([le[t.id] for t in tokenize(mapped)])
                return ids

        self.pieces = Pieces()

    def merged(self, pieces: pa.StringArray) -> pa.ListArray:
        """The ids of each of the distinct pieces."""
        if len(self.pieces) > REMEMBERED:
            keep_half(self.pieces)
        own = list(map(self.pieces.__getitem__, pieces.to_pylist()))
        ends = np.cumsum([0, *map(len, own)]) // np.dtype(self.kind).itemsize
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(own), self.kind)))

    def __call__(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, none of them null, and where each text ends in them, a zero first."""
        whole = np.zeros(len(texts), bool)
        for s in self.special:
            whole |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        if not whole.any():
            return encode(texts, [], self.split, self.merged, self.kind)
        ids, ends = encode(texts.filter(pa.array(~whole)), [], self.split, self.merged, self.kind) if not whole.all() else (np.zeros(0, self.kind), np.zeros(1, np.int64))
        parts = iter([ids[a:z] for a, z in zip(ends[:-1], ends[1:], strict=True)])
        each = [np.array(self.library.encode(t, add_special_tokens=False).ids, self.kind) if w else next(parts) for t, w in zip(texts.to_pylist(), whole, strict=True)]
        return np.concatenate(each), np.concatenate([[0], np.cumsum(list(map(len, each)))])


@cache
def encoder(tokenizer_path: str) -> Encoder:
    """One for all tasks of a worker."""
    return Encoder(tokenizer_path)


def pack(doc_ids: pa.Int64Array, counts: np.ndarray, flat: np.ndarray) -> bytes:
    """A file's bytes. counts: ids of each document; flat: all ids, unsigned integers."""
    if len(flat) and flat.max() < 1 << 22:
        seen = np.bincount(flat)
        table = np.argsort(-seen, kind="stable")[: np.count_nonzero(seen)].astype("<u4")
        rank_of = np.zeros(len(seen), "<u2" if len(table) <= 0x10000 else "<u4")
        rank_of[table] = np.arange(len(table))
        ranks = rank_of[flat]
    else:
        values, inverse, seen = np.unique(flat, return_inverse=True, return_counts=True)
        order = np.argsort(-seen, kind="stable")
        table, rank_of = values[order].astype("<u4"), np.zeros(len(values), "<u4")
        rank_of[order] = np.arange(len(values))
        ranks = rank_of[inverse]
    width = ranks.dtype.itemsize
    both = ranks.view(np.uint8).reshape(-1, width)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    for i in range(1, width):  # a rank's data bytes but the first
        padded[: len(ranks)] += ranks >= 1 << 8 * i
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    data = both[np.arange(width, dtype=np.uint8) <= padded[: len(ranks), None]]
    head = np.array([len(doc_ids), len(flat), len(table), len(data)], "<i8")
    return b"".join([MAGIC, head.tobytes(), np.asarray(doc_ids.fill_null(0)).astype("<i8").tobytes(), counts.astype("<i8").tobytes(), np.asarray(doc_ids.is_valid()).astype(np.uint8).tobytes(), table.tobytes(), control.tobytes(), data.tobytes()])


def unpack(blob: bytes) -> tuple[np.ma.MaskedArray, np.ndarray, np.ndarray]:
    """doc_ids (null ones masked), ids of each document, all ids (uint32)."""
    if blob[:8] != MAGIC:
        raise ValueError("not a token file")
    docs, n, ranks, size = np.frombuffer(blob, "<i8", 4, 8).tolist()
    at = 40
    doc_ids, counts = np.frombuffer(blob, "<i8", docs, at), np.frombuffer(blob, "<i8", docs, at + 8 * docs)
    doc_ids = np.ma.MaskedArray(doc_ids, np.frombuffer(blob, np.uint8, docs, at + 16 * docs) == 0)
    at += 17 * docs
    table = np.frombuffer(blob, "<u4", ranks, at)
    at += 4 * ranks
    quads = -(-n // 4)
    control = np.frombuffer(blob, np.uint8, quads, at)
    data = np.frombuffer(blob, np.uint8, size, at + quads)
    lengths = LENGTHS[control].reshape(-1)[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    at = ends - lengths
    value = data[at].astype(np.uint32)
    for i in range(1, 4):
        if len(more := np.flatnonzero(lengths > i)):
            value[more] |= data[at[more] + i].astype(np.uint32) << np.uint32(8 * i)
    return doc_ids, counts, table[value]


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, tasks: int | None = None, file_ids: int = FILE_IDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes docs' ids, end_id after each document, and returns the manifest: file, path, documents, ids, start.

    Files are in ascending doc_id order; start is the number of ids in the files before. A null text is empty (end_id
    only). Rows with a null doc_id come first; rows that share a doc_id are neighbours, in the order of a hash of their
    text; a doc_id that is no whole number is an error. An empty table makes no file. folder: a URI that all executors reach. A file is written under a name of its own
    for each attempt and the manifest names the one that counts, so a task can be run again.
    """
    n = tasks or parts(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # equal rows, of which there may be very many, are told apart by where they were read
    order = [F.col("doc_id").asc_nulls_first(), "h", "m"]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("m"))
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        own, task, part = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        store, root = fs.FileSystem.from_uri(folder)
        held, size = [], 0

        def close() -> pa.RecordBatch:
            store.create_dir(root, recursive=True)
            name = f"tokens-{uuid.uuid4().hex}.tgr"
            doc_ids = pa.concat_arrays([h[0] for h in held])
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(pack(doc_ids, np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])))
            return pa.RecordBatch.from_pydict({"task": pa.array([task], pa.int32()), "part": pa.array([part], pa.int32()), "path": [f"{folder}/{name}"], "documents": [len(doc_ids)], "ids": [size]})

        for b in slabs(batches, 1, SLAB):
            ids, ends = own(b.column(1))
            ids, ends = np.insert(ids, ends[1:], end_id), ends + np.arange(len(ends))
            at = 0
            while at < b.num_rows:  # up to the document with which the file is full
                to = min(b.num_rows, int(np.searchsorted(ends, ends[at] + file_ids - size)))
                to = max(to, at + 1)
                held.append((b.column(0).slice(at, to - at), np.diff(ends[at : to + 1]), ids[ends[at] : ends[to]]))
                size += int(ends[to] - ends[at])
                at = to
                if size >= file_ids:
                    yield close()
                    held, size, part = [], 0, part + 1
        if held:
            yield close()

    manifest = cut(rows.mapInArrow(tidy(write), "task int, part int, path string, documents long, ids long"), "token-manifest")
    order = Window.orderBy("task", "part")  # a row for each file
    return manifest.select((F.row_number().over(order) - 1).alias("file"), "path", "documents", "ids", F.coalesce(F.sum("ids").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """A row (doc_id, start, n_tokens, ids_crc32, ids) for each document in the files; ids is array<long>."""
    return _read(manifest, True)


def digest_token_files(manifest: DataFrame) -> DataFrame:
    """read_token_files() without the ids themselves."""
    return _read(manifest, False)


def _read(manifest: DataFrame, with_ids: bool) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for b in batches:
            for path, before in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                store, inside = fs.FileSystem.from_uri(path)
                with store.open_input_stream(inside) as f:
                    doc_ids, counts, ids = unpack(f.read())
                ends = np.cumsum(counts)
                starts = ends - counts
                raw = memoryview(ids.astype("<u4").tobytes())
                out = {"doc_id": pa.array(doc_ids.data, pa.int64(), mask=doc_ids.mask), "start": pa.array(starts + before, pa.int64()), "n_tokens": pa.array(counts, pa.int64())}
                out["ids_crc32"] = pa.array([zlib.crc32(raw[4 * a : 4 * z]) for a, z in zip(starts.tolist(), ends.tolist(), strict=True)], pa.int64())
                if with_ids:
                    out["ids"] = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int64()), pa.array(ids.astype(np.int64))).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    spark = manifest.sparkSession
    return manifest.select("path", "start").repartition(parts(spark)).mapInArrow(tidy(read), schema)


def token_folder(spark: SparkSession) -> str:
    return scratch(spark, "token-files")
