"""Operator 11: fill-in-middle, over an index of distinct texts.

1. Identical texts are grouped by their digest and by the texts themselves, copies combined on the map side; that is the
   only shuffle of texts. An entry of the index is a text with its documents. Digests of very many documents are spread
   over several entries by salts, so that an entry's documents are bounded.
2. Of each entry the ends of its text's tokens, in code points, become an Elias-Fano list, once.
3. The entries go back to their documents, each with the list. A document's seed gives two numbers of tokens; the list
   gives where these end (select), which is where the text is cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from .common import Tables, cut, slabs, tidy, with_settings
from .contents import salted, salts, sha256

#: Marks of the parts: prefix, suffix, middle.
MARKS = ("<P>", "<S>", "<M>")
#: Of 100 documents so many are cut, and of 100 that are cut so many have the suffix first.
CUT, SUFFIX_FIRST = 50, 80
#: Bytes of text that a worker takes at a time.
SLAB = 1 << 20
#: Rows of a batch between Spark and Python.
ROWS = 1_000


def token_ends(text: str) -> np.ndarray:
    """Where tokens end, in code points: ASCII white space with the word after it, or white space at the text's end."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    white = (points == 32) | (points >= 9) & (points <= 13)
    last = np.flatnonzero(~white & np.concatenate((white[1:], [True]))) + 1 if len(points) else np.zeros(0, np.int64)
    return np.concatenate((last, [len(points)])) if len(points) and white[-1] else last


class EliasFano:
    """A sorted list of numbers up to a bound: low bits packed, high bits in unary."""

    def __init__(self, size: int, width: int, low: bytes, high: bytes):
        self.size, self.width, self.low, self.high = size, width, low, high
        self.ones: np.ndarray | None = None

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        if n == 0:
            return cls(0, 0, b"", b"")
        values = values.astype(np.int64)
        width = max(0, int(values[-1] // n).bit_length() - 1)
        low = np.packbits((values[:, None] >> np.arange(width) & 1).astype(np.uint8), bitorder="little").tobytes()
        bits = np.zeros(int(values[-1] >> width) + n, np.uint8)
        bits[(values >> width) + np.arange(n)] = 1
        return cls(n, width, low, np.packbits(bits, bitorder="little").tobytes())

    def to_bytes(self) -> bytes:
        return self.size.to_bytes(5, "little") + bytes([self.width]) + len(self.low).to_bytes(5, "little") + self.low + self.high

    @classmethod
    def from_bytes(cls, raw: bytes) -> EliasFano:
        end = 11 + int.from_bytes(raw[6:11], "little")
        return cls(int.from_bytes(raw[:5], "little"), raw[5], raw[11:end], raw[end:])

    def select(self, i: int) -> int:
        """The i-th number, from 0: by the counts of ones in the bytes before it, then within its byte."""
        high = np.frombuffer(self.high, np.uint8)
        if self.ones is None:
            self.ones = np.cumsum(np.bitwise_count(high), dtype=np.int64)
        at = int(np.searchsorted(self.ones, i, "right"))
        rest = i - (int(self.ones[at - 1]) if at else 0)
        place = 8 * at + int(np.flatnonzero(np.unpackbits(high[at : at + 1], bitorder="little"))[rest])
        first = i * self.width
        low = int.from_bytes(self.low[first // 8 : (first + self.width + 7) // 8], "little") >> first % 8 & (1 << self.width) - 1
        return (place - i) << self.width | low


def seeds(doc_id: object, seed: int) -> list[int]:
    """Four numbers of 32 bits, from the SHA-256 of seed and doc_id; a null doc_id counts as an empty string."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def cut_text(text: str, ends: EliasFano, h: list[int], rate: int = CUT, suffix_first: int = SUFFIX_FIRST, marks: tuple[str, str, str] = MARKS) -> tuple[str, str, int | None, int | None]:
    """(form, output, code points of the prefix, of the middle). Texts that hold a mark, and empty ones, stay plain."""
    if not text or any(m in text for m in marks) or h[2] % 100 >= rate:
        return "plain", text, None, None
    a, b = sorted(x % (ends.size + 1) for x in h[:2])
    a, b = (ends.select(x - 1) if x else 0 for x in (a, b))
    p, s, m = marks
    if h[3] % 100 < suffix_first:
        return "spm", f"{s}{text[b:]}{p}{text[:a]}{m}{text[a:b]}", a, b - a
    return "psm", f"{p}{text[:a]}{s}{text[b:]}{m}{text[a:b]}", a, b - a


def restore(output: str, form: str, marks: tuple[str, str, str] = MARKS) -> str:
    """The text that was cut."""
    if form == "plain":
        return output
    p, s, m = marks
    first, second = (p, s) if form == "psm" else (s, p)
    head, middle = output[len(first) :].split(m, 1)
    one, other = head.split(second, 1)
    return one + middle + other if form == "psm" else other + middle + one


def build_index(docs: DataFrame, tables: Tables, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, documents array<struct<id>>, ends) of the distinct texts, null texts as empty; several entries of a text that
    very many documents have."""
    docs = with_settings(docs, spark__sql__execution__arrow__maxRecordsPerBatch=ROWS)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), sha256(text).alias("digest"), F.monotonically_increasing_id().alias("m"))
    repeated = tables.cut(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated-texts")
    large = salts(repeated, repeated.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    entries = salted(rows, large, F.col("m")).groupBy("digest", "salt", "text").agg(F.collect_list(F.struct("id")).alias("documents"))
    return entries.select("text", "documents", _list_of_ends("text").alias("ends"))


@F.arrow_udf(BinaryType())
def _list_of_ends(text: pa.Array) -> pa.Array:
    return pa.array([EliasFano.of(token_ends(t)).to_bytes() for t in text.to_pylist()], pa.binary())


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = CUT, suffix_first: int = SUFFIX_FIRST, marks: tuple[str, str, str] = MARKS, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """A row (doc_id, n, form, output, prefix_chars, middle_chars) for each row of docs; with digests, output_sha256 and
    restored_sha256 instead of output.

    n counts tokens (ASCII white space with the word after it). A null text counts as empty; a null doc_id has a seed of its
    own; rows that repeat a doc_id and a text are cut alike. Texts are whole, whatever their length. Other columns are not
    looked at, whatever their names. An empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    tables = Tables(docs.sparkSession)
    joined = build_index(docs, tables, id_col, text_col).select(F.explode("documents").alias("d"), "text", "ends").select("d.id", "text", "ends")
    sha = lambda t: hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, ends = None, None
        for b in slabs(batches, 1, SLAB):
            out = []
            for i, t, e in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if e != raw:
                    raw, ends = e, EliasFano.from_bytes(e)
                form, output, a, m = cut_text(t, ends, seeds(i, seed), rate, suffix_first, marks)
                out.append((ends.size, form, a, m, *((sha(output), sha(restore(output, form, marks))) if digests else (output,))))
            columns = list(zip(*out, strict=True)) if out else [[]] * (6 if digests else 5)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=False))], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", *(("output_sha256", "restored_sha256") if digests else ("output",))])

    last = "output_sha256 string, restored_sha256 string" if digests else "output string"
    out = cut(joined.mapInArrow(tidy(run), f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, {last}"), "fill-in-middle", docs.sparkSession)
    tables.drop()
    return out
