"""Operator 8: repeated lines and passages, across the whole corpus, by overlapping windows of three lines and of 51 words.

A window is three lines in a row that are not blank (a document of fewer such lines is one window). A window that stands
earlier, by (doc_id, text's hash, place), is removed where it stands again; overlapping windows merge.

1. One scan hashes the lines and writes a mark for each window.
2. Marks are counted by key. Only those of repeated keys go on, and meet the first mark of their key.

Counts are summed on the map side, so a window that a third of all documents share costs a row a task; its occurrences
meet what is known of it in a join that adaptive execution can split. No window is missed, dropped or capped.

The query and the pipeline look for windows of words too (`passage`): 51 words in a row, wherever they begin, within lines and across
line ends. Of these the first occurrence stays whole, also where a later one of the same text overlaps it.

1. The scan also marks *anchors*: a run of 25 words that has the least hash of the runs in some word window, its sign.
   Equal windows have equal signs, so a repeated window has a repeated sign; there is about one anchor to 14 words.
2. An anchor's context, its words and 26 on each side, holds all windows whose sign it is. A context that stands earlier
   repeats all of them, so long copies cost a row for each anchor. Only signs with several contexts, at the edges of
   passages, have their windows compared one by one, in a second scan of the documents that hold such signs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables, cut, give_back, slabs, tidy, utf8
from .hashing import BASES, Rolling, Words, mix

WINDOW = 3
#: Words of a passage, and of the runs one of which is its sign.
PASSAGE, GRAM = 51, 25
#: Keys or items of 8 bytes up to which a table is broadcast; a larger one is joined by shuffle.
BROADCAST_KEYS = 2_000_000
#: Bytes of text that a worker hashes at a time.
SLAB = 1 << 19

def _least(x: np.ndarray, n: int) -> np.ndarray:
    """Where the least of each n values in a row stands, the first of equals."""
    at = np.arange(len(x), dtype=np.int32)

    def step(x: np.ndarray, at: np.ndarray, by: int) -> tuple[np.ndarray, np.ndarray]:
        right = x[by:] < x[: len(x) - by]
        return np.where(right, x[by:], x[: len(x) - by]), np.where(right, at[by:], at[: len(at) - by])

    width = 1
    while 2 * width <= n:
        x, at = step(x, at, width)
        width *= 2
    return step(x, at, n - width)[1] if n > width else at


class Lines(Words):
    """Words with the windows that they make."""

    def rolling(self) -> tuple[Rolling, Rolling]:
        return Rolling(self.hash), Rolling(mix(~self.hash), BASES[1])

    def lines(self, width: int, rolling: tuple[Rolling, Rolling]) -> tuple[np.ndarray, ...]:
        """(h1, h2, first word, end) of each window of `width` lines that are not blank; of all of them, if a text has fewer."""
        first = np.flatnonzero(np.concatenate(([True], self.line[1:] != self.line[:-1]))) if len(self.line) else np.zeros(0, np.int64)
        after = np.concatenate((first[1:], [len(self.line)])) if len(first) else first
        own = self.text[first]
        n = np.minimum(np.bincount(own, minlength=len(self.begin))[own], width) if len(own) else own
        at = np.arange(len(first))
        last = at + n - 1
        ok = last < len(first)
        ok[ok] = own[last[ok]] == own[ok]
        at, last = at[ok], last[ok]
        h1, h2 = (Rolling(r.of(first, after), b).of(at, last + 1) for r, b in zip(rolling, BASES, strict=True))
        return h1, h2, first[at], after[last]

    def anchors(self, size: int, gram: int, rolling: tuple[Rolling, Rolling]) -> tuple[np.ndarray, ...]:
        """(sign, context, first window, end of the windows) of each anchor; windows by their first word."""
        none = np.zeros(0, np.int64)
        n, reach = len(self.text) - size + 1, size - gram
        if n < 1 or not (whole := self.text[:n] == self.text[size - 1 :]).any():
            return none.astype(np.uint64), none.astype(np.uint64), none, none
        at = np.arange(len(self.text) - gram + 1)
        grams = rolling[0].of(at, at + gram)
        place = _least(grams, reach + 1)[:n]
        windows = np.flatnonzero(whole)
        new = np.concatenate(([True], (place[windows[1:]] != place[windows[:-1]]) | (windows[1:] != windows[:-1] + 1)))
        starts = np.flatnonzero(new)
        low, high = windows[starts], windows[np.concatenate((starts[1:], [len(windows)])) - 1] + 1
        p = place[low]
        own = self.text[p]
        left, right = np.maximum(p - reach, self.begin[own]), np.minimum(p + size, self.end[own])
        # where the windows lie in the context belongs to it: it is cut off at the text's ends
        context = mix(rolling[1].of(left, right) ^ ((low - left) << 16 | (high - left)).astype(np.uint64) * np.uint64(BASES[0]))
        return grams[p], context, low, high


def _merged(ranges: np.ndarray) -> list[tuple[int, int]]:
    """The union of ranges start << 32 | end, as sorted ranges that do not touch."""
    out: list[tuple[int, int]] = []
    for r in np.unique(ranges).tolist():
        a, z = r >> 32, r & (1 << 32) - 1
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def without(text: str, ranges: np.ndarray) -> str:
    """text without the words in ranges (start << 32 | end, counted from 0), with the white space after each in its line.

    A line of which the last word goes loses the white space before it too; a line of which all words go, and a blank line
    between words that go, goes itself. All else stays as it is.
    """
    gone, out, at = _merged(ranges), [], 0
    k = 0  # the first range that ends after the words so far
    for line in utf8(text).split(b"\n"):
        words = line.split()
        end = at + len(words)
        while k < len(gone) and gone[k][1] <= at:
            k += 1
        if not words:
            inside = k < len(gone) and gone[k][0] < at < gone[k][1]
            if not inside:
                out.append(line)
            continue
        if k == len(gone) or gone[k][0] >= end:
            out.append(line)
        else:
            keep, j, last = [], k, True
            pos = 0
            for i, w in enumerate(words, at):
                while j < len(gone) and gone[j][1] <= i:
                    j += 1
                start = line.index(w, pos)
                after = start + len(w)
                following = line.index(words[i - at + 1], after) if i + 1 < end else len(line)
                last = not (j < len(gone) and gone[j][0] <= i)
                if last:
                    keep.append(line[0 if i == at else start : following])
                pos = after
            if keep:
                kept = b"".join(keep)
                out.append(kept if last else kept.rstrip(b" \t\r\x0b\x0c"))
        at = end
    return b"\n".join(out).decode("utf-8", "surrogatepass")


def _small(table: DataFrame, items: str | None = None) -> DataFrame:
    """A written table, with a hint to broadcast it if it has few rows, or few items in the arrays of a column."""
    size = table.count() if items is None else table.agg(F.sum(F.size(items))).first()[0] or 0
    return F.broadcast(table) if size <= BROADCAST_KEYS else table


def repeated(docs: DataFrame, tables: Tables, width: int | None = WINDOW, passage: int | None = None, gram: int = GRAM) -> DataFrame:
    """(doc_id, copy, gone array<long>): the words that repeat an earlier window, as ranges start << 32 | end.

    docs is (doc_id, copy, text), where copy tells texts of one doc_id apart. width None looks for no lines, passage None
    for no word windows. What is written on the way is in tables.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slabs(batches, 2, SLAB):
            own = Lines(b.column(2).to_pylist())
            rolling = own.rolling()
            rows = []
            if width is not None:
                h1, h2, low, high = own.lines(width, rolling)
                rows.append((h1, h2, np.zeros(len(h1), np.uint64), low, high))
            if passage is not None:
                sign, context, low, high = own.anchors(passage, gram, rolling)
                rows.append((sign, np.zeros(len(sign), np.uint64), context | np.uint64(1), low, high))
            if rows:
                h1, h2, context, low, high = (np.concatenate(c) for c in zip(*rows, strict=True))
                text = own.text[low]
                take, start = pa.array(text), own.begin[text]
                columns = [pa.array(x.view(np.int64)) for x in (h1, h2, context)]
                yield pa.RecordBatch.from_arrays([*columns, b.column(0).take(take), b.column(1).take(take), pa.array((low - start).astype(np.int32)), pa.array((high - start).astype(np.int32))], names=["h1", "h2", "context", "doc_id", "copy", "low", "high"])

    def window(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slabs(batches, 2, SLAB):
            own = Lines(b.column(2).to_pylist())
            row = np.repeat(np.arange(b.num_rows), b.column(3).value_lengths().to_numpy(zero_copy_only=False))
            ranges = b.column(3).flatten().to_numpy(zero_copy_only=False)
            low, size = (ranges >> 32) + own.begin[row], (ranges & (1 << 32) - 1) - (ranges >> 32)
            row = np.repeat(row, size)
            at = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
            h1, h2 = (r.of(at, at + passage) for r in own.rolling())
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array((at - own.begin[row]).astype(np.int32)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))], names=["doc_id", "copy", "at", "h1", "h2"])

    key, place = ["h1", "h2"], F.struct("doc_id", "copy", "low")
    packed = lambda low, high: (F.shiftleft(low.cast("long"), 32) + high).alias("gone")
    marks = tables.cut(docs.select("doc_id", "copy", "text").mapInArrow(tidy(mark), "h1 long, h2 long, context long, doc_id long, copy long, low int, high int"), "marks")
    again = tables.cut(marks.groupBy("h1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1"), "repeated-keys")
    hits = tables.cut(marks.join(_small(again), "h1", "left_semi"), "repeated-marks")
    first = tables.cut(hits.groupBy(*key, "context").agg(F.min(F.struct("doc_id", "copy", "low", "high")).alias("first"), F.count(F.lit(1)).alias("n")), "first-marks")
    later = tables.cut(hits.join(tables.cut(first.where("n > 1").select(*key, "context", "first"), "repeated-contexts"), [*key, "context"]).where(place > F.struct("first.doc_id", "first.copy", "first.low")), "later-marks")
    of_line = F.col("context") == 0
    # anchors close to their first in the same text: there the first window stays whole, so windows are compared one by one
    close = ~of_line & (F.col("first.doc_id") == F.col("doc_id")) & (F.col("first.copy") == F.col("copy")) & (F.col("low") - F.col("first.low") < 2 * (passage or 0))
    gone = later.where(~close).select("doc_id", "copy", packed(F.col("low"), F.when(of_line, F.col("high")).otherwise(F.col("high") + (passage or 1) - 1)))
    if passage is not None:
        several = tables.cut(first.where(~of_line).groupBy("h1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1"), "edge-signs")
        edges = first.where(~of_line).join(_small(several), "h1").select("first.*").union(later.where(close).select("doc_id", "copy", "low", "high")).union(later.where(close).select("first.*"))
        # a text's own anchors: no more than it has words
        own = tables.cut(edges.groupBy("doc_id", "copy").agg(F.collect_set(packed(F.col("low"), F.col("high"))).alias("own")).select(F.col("doc_id").alias("__id"), F.col("copy").alias("__copy"), "own"), "edge-anchors")
        hit = docs.join(_small(own, "own"), (F.col("doc_id") == F.col("__id")) & (F.col("copy") == F.col("__copy")))
        windows = tables.cut(hit.select("doc_id", "copy", "text", "own").mapInArrow(tidy(window), "doc_id long, copy long, at int, h1 long, h2 long"), "edge-windows")
        at = F.struct("doc_id", "copy", "at")
        known = tables.cut(windows.groupBy(*key).agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(*key, "first"), "first-windows")
        later = windows.join(known, key).where(at > F.col("first"))
        same = (F.col("first.doc_id") == F.col("doc_id")) & (F.col("first.copy") == F.col("copy"))
        start = F.when(same, F.greatest(F.col("at"), F.col("first.at") + passage)).otherwise(F.col("at"))
        gone = gone.union(later.select("doc_id", "copy", packed(start, F.col("at") + passage)))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.set_column(2, "gone", pa.array([[x << 32 | y for x, y in _merged(np.array(g, np.int64))] for g in b.column(2).to_pylist()], pa.list_(pa.int64())))

    # a text's own windows: no more than it has words
    return gone.groupBy("doc_id", "copy").agg(F.collect_set("gone").alias("gone")).mapInArrow(tidy(merge), "doc_id long, copy long, gone array<long>")


def dedup_lines(docs: DataFrame, width: int | None = WINDOW, passage: int | None = None, id_col: str = "doc_id", text_col: str = "text", report: bool = False) -> DataFrame:
    """docs without the lines that repeat an earlier window of `width` lines, and with `passage` without the words that
    repeat an earlier window of so many words; with report, also n_removed (long), how many words went.

    Null texts stay null and have no words; blank texts stay as they are. A text of which all goes is left empty. Rows that share
    a doc_id and a text are one document, and lose none to each other; different texts of one doc_id are two, in the order
    of a hash. Rows with a null doc_id stay as they are and take no part; one that is no whole number is an error. Other columns pass through, whatever their names.
    An empty table gives no rows. See without() for white space.
    """
    copy = F.xxhash64(F.col(text_col).cast("string"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), copy.alias("copy"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null and text is not null")
    # rows that repeat a doc_id and a text: one of them is looked at
    tables = Tables(docs.sparkSession)
    twice = tables.cut(rows.groupBy("doc_id", "copy").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id", "copy"), "repeated-rows")
    if twice.count():
        rows = rows.join(_small(twice), ["doc_id", "copy"], "left_anti").unionByName(rows.join(_small(twice), ["doc_id", "copy"]).groupBy("doc_id", "copy").agg(F.min("text").alias("text")))
    gone = cut(repeated(rows, tables, width, passage).select(F.col("doc_id").alias("__id"), F.col("copy").alias("__copy"), F.col("gone").alias("__gone")), "gone")
    tables.drop()
    joined = docs.join(_small(gone, "__gone"), (F.col(id_col).cast("long") == F.col("__id")) & (copy == F.col("__copy")), "left")

    @F.arrow_udf("string")
    def cleaned(text: pa.Array, drop: pa.Array) -> pa.Array:
        out = pa.array([None if t is None or d is None else without(t, np.array(d, np.int64)) for t, d in zip(text.to_pylist(), drop.to_pylist(), strict=True)], pa.string())
        give_back()
        return out

    hit = F.col("__gone").isNotNull()
    # only the texts that change are sent to Python
    text = F.when(hit, cleaned(F.when(hit, F.col(text_col)), F.col("__gone"))).otherwise(F.col(text_col))
    columns = [text.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    if report:
        size = lambda c: F.size(F.filter(F.split(c, r"[ \t\n\r\f\x0b]+"), lambda w: w != ""))
        columns.append(F.when(hit, size(F.col(text_col)) - size(text)).otherwise(0).cast("long").alias("n_removed"))
    return joined.select(*columns)


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """dedup_lines() by word windows alone."""
    return dedup_lines(docs, None, PASSAGE, id_col, text_col)
