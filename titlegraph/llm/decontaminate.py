"""Operator 5: benchmark passages in documents, found by an FM-index of each training shard.

A shard is what a task holds of its partition at a time. Its words become symbols: the number of the word among the
benchmark's words, 0 for any other. A 0 is in no benchmark window, so only runs of benchmark words that are as long as
the shortest window are indexed; nothing that could match is left out. All windows are searched at once, backward, by
wavelet-matrix ranks over the Burrows-Wheeler transform; occurrences are located by walking to sampled suffix positions,
and overlapping occurrences of a document merge into spans.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_TABLE, small, tidy, utf8, words

WINDOW = 10
#: Symbols of a shard: bounds a task's memory.
SHARD_SYMBOLS = 1 << 20
#: Bytes of benchmark text that are broadcast at a time, as arrays of about ten times that; a larger benchmark takes more
#: passes over the documents.
BLOCK_BYTES = 8 << 20
SAMPLE = 8
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class FMIndex:
    """Of a sequence of non-negative integers."""

    def __init__(self, seq: np.ndarray, sample: int = SAMPLE):
        text = np.concatenate([np.asarray(seq, np.int64) + 1, [0]])  # 0 ends the text
        n, self.sigma = len(text), int(text.max()) + 1
        sa = self._suffixes(text)
        bwt = text[sa - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(bwt, minlength=self.sigma))])
        self.bits = max(1, (self.sigma - 1).bit_length())
        self.ones, self.zeros, row = [], [], bwt
        for level in range(self.bits - 1, -1, -1):
            bit = row >> level & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(n - int(self.ones[-1][-1]))
            row = np.concatenate([row[bit == 0], row[bit == 1]])
        marked = sa % sample == 0
        self.marks = np.concatenate([[0], np.cumsum(marked, dtype=np.int32)]).astype(np.int32)
        self.samples, self.bwt, self.n = sa[marked], bwt, n

    @staticmethod
    def _suffixes(text: np.ndarray) -> np.ndarray:
        """By prefix doubling; ends as soon as all ranks differ."""
        n, k, rank = len(text), 1, text.copy()
        while True:
            second = np.zeros(n, np.int64)
            second[: n - k] = rank[k:] + 1
            key = rank * (n + text.max() + 3) + second
            sa = np.argsort(key, kind="stable")
            key = key[sa]
            rank = np.empty(n, np.int64)
            rank[sa] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
            k *= 2
            if rank[sa[-1]] == n - 1 or k >= 2 * n:
                return sa

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in the transform before each position."""
        start = np.zeros_like(at)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = symbols >> (self.bits - 1 - level) & 1
            a, z = ones[start], ones[at]
            start, at = np.where(bit, zeros + a, start - a), np.where(bit, zeros + z, at - z)
        return at - start

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """patterns: a row for each, all of one length. The range of suffixes of each, as [low, high)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for column in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[:, column].astype(np.int64) + 1
            known = c < self.sigma
            c = np.where(known, c, 0)
            low, high = self.before[c] + self.rank(c, low), self.before[c] + self.rank(c, high)
            high = np.where(known, high, low)
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text position of each suffix."""
        rows, out, steps = rows.astype(np.int64), np.zeros(len(rows), np.int64), 0
        left = np.arange(len(rows))
        while len(left):
            there = self.marks[rows + 1] > self.marks[rows]
            out[left[there]] = (self.samples[self.marks[rows[there]]] + steps) % self.n
            left, rows = left[~there], rows[~there]
            c = self.bwt[rows]
            rows = self.before[c] + self.rank(c, rows)
            steps += 1
        return out


class Windows:
    """A block of benchmark items, ready to be searched for."""

    def __init__(self, items: list[tuple[int, str | None]], width: int = WINDOW):
        self.vocab: dict[bytes, int] = {}
        found: dict[int, list[tuple[np.ndarray, int]]] = {}
        for item, text in items:
            own = np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words(text)], np.int32)
            if n := min(len(own), width):
                found.setdefault(n, []).append((np.lib.stride_tricks.sliding_window_view(own, n), item))
        # of each length: the different windows, and the items of window i at items[ends[i] : ends[i + 1]]
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n, rows in sorted(found.items()):
            patterns, which = np.unique(np.concatenate([w for w, _ in rows]), axis=0, return_inverse=True)
            own = np.repeat(np.array([i for _, i in rows], np.int64), [len(w) for w, _ in rows])
            order = np.argsort(which.reshape(-1), kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(which.reshape(-1), minlength=len(patterns)))])
            self.by_length[n] = patterns, ends, own[order]
        self.shortest = min(self.by_length, default=0)

    def scan(self, docs: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set]]:
        """Of each document, given as words: merged spans [start, end) of words, and the items that occur."""
        out: list[tuple[list[tuple[int, int]], set]] = [([], set()) for _ in docs]
        get, least, held, total = self.vocab.get, self.shortest, [], 0
        if not least:
            return out
        for d, own in enumerate(docs):
            if len(own) < least:
                continue
            sym = np.fromiter(map(get, own, repeat(0)), np.int64, len(own))
            edge = np.flatnonzero(np.diff(np.concatenate([[0], sym > 0, [0]]).astype(np.int8)))
            starts, ends = edge[::2], edge[1::2]
            long = ends - starts >= least
            for a, z in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
                held.append((d, a, sym[a:z]))
                total += z - a + 1
            if total > SHARD_SYMBOLS:
                self._search(held, out)
                held, total = [], 0
        self._search(held, out)
        return [(_merged(spans), items) for spans, items in out]

    def _search(self, runs: list, out: list) -> None:
        if not runs:
            return
        gap = np.zeros(1, np.int64)
        seq = np.concatenate([x for _, _, s in runs for x in (s, gap)])
        lengths = np.array([len(s) + 1 for _, _, s in runs])
        begin = np.cumsum(lengths) - lengths
        doc, at = np.array([r[0] for r in runs]), np.array([r[1] for r in runs])
        index = FMIndex(seq)
        for n, (patterns, ends, items) in self.by_length.items():
            low, high = index.search(patterns)
            hit = np.flatnonzero(high > low)
            count = (high - low)[hit]
            if not len(hit):
                continue
            rows = np.repeat(low[hit] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            where, which = index.locate(rows), np.repeat(hit, count)
            run = np.searchsorted(begin, where, side="right") - 1
            for d, a, w in zip(doc[run].tolist(), (at[run] + where - begin[run]).tolist(), which.tolist(), strict=True):
                out[d][0].append((a, a + n))
                out[d][1].update(items[ends[w] : ends[w + 1]].tolist())


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(z, out[-1][1])
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """text without the words in spans and what stands between them; one space where that would join two words."""
    raw = utf8(text)
    places = [m.span() for m in _WORD.finditer(raw.translate(LOWER_TABLE))]
    out, at = [], 0
    for a, z in spans:
        piece = raw[at : places[a][0]].rstrip(b" ")
        out.append(piece.lstrip(b" ") if at else piece)
        at = places[z - 1][1]
    out.append(raw[at:].lstrip(b" ") if at else raw)
    return b" ".join(x for x in out if x.strip()).decode("utf-8", "surrogatepass")


def mark(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES, clean: bool = False) -> DataFrame:
    """docs with n_words, spans array<struct<start,end>> (merged, in words) and items array<long> (sorted) added.

    A window is `width` consecutive words of an item; an item of fewer words, but not none, is one window. Null and
    empty texts have no words; items without words are in no document; repeated rows each get a result; an empty
    benchmark marks nothing. Columns of docs with the added names are replaced. The benchmark is read in blocks of at
    most block_bytes (or one item); each takes a narrow pass of its own. clean takes the spans out of the texts, after
    the last block.
    """
    keep = [c for c in docs.columns if c not in ("n_words", "spans", "items")]
    out = docs.select(*keep, F.lit(0).cast("long").alias("n_words"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"), F.array().cast("array<long>").alias("items"))
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(item_text_col).cast("string").alias("t")).where("i is not null and t is not null")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    at = keep.index(text_col)

    def pass_over(frame: DataFrame, block: int) -> DataFrame:
        rows = items.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == block).collect()  # about block_bytes
        windows = frame.sparkSession.sparkContext.broadcast(Windows([(r.i, r.t) for r in rows], width))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in small(batches, 512):
                own = [words(t) for t in b.column(at).to_pylist()]
                found = windows.value.scan(own)
                k = len(keep)
                spans, names = b.column(k + 1).to_pylist(), b.column(k + 2).to_pylist()
                spans = [_merged([(x["start"], x["end"]) for x in old] + new) for old, (new, _) in zip(spans, found, strict=True)]
                names = [sorted({*old, *new}) for old, (_, new) in zip(names, found, strict=True)]
                if clean and block == blocks - 1:
                    cut_out = [t if t is None or not s else without(t, s) for t, s in zip(b.column(at).to_pylist(), spans, strict=True)]
                    b = b.set_column(at, b.schema.field(at), pa.array(cut_out, b.schema.field(at).type))
                cols = [pa.array(list(map(len, own)), pa.int64()), pa.array([[{"start": a, "end": z} for a, z in s] for s in spans], b.schema.field(k + 1).type), pa.array(names, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*b.columns[:k], *cols], names=[f"c{i}" for i in range(k + 3)])

        schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(frame.schema))
        return frame.toDF(*[f"c{i}" for i in range(len(keep) + 3)]).mapInArrow(tidy(scan), schema).toDF(*keep, "n_words", "spans", "items")

    for block in range(blocks):
        out = pass_over(out, block)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """docs, same columns and other values, with benchmark passages removed from the text; documents without any stay as
    they are."""
    inner = [f"c{i}" for i in range(len(docs.columns))]  # names of our own, so that none clashes with what mark() adds
    marked = mark(docs.toDF(*inner), benchmark, text_col=inner[docs.columns.index(text_col)], clean=True, **options)
    return marked.select(*inner).toDF(*docs.columns)


def items_digest(items):
    """The sha256 of item_ids sorted as strings and joined by commas; a column for a column."""
    return F.sha2(F.array_join(F.array_sort(F.transform(items, lambda x: x.cast("string"))), ",").cast("binary"), 256)


def brute_force(text: str | None, items: list[tuple[int, str | None]], width: int = WINDOW) -> tuple[int, int, list[int], str]:
    """n_words, n_hit, items and their digest of one document, by comparing every window at every word."""
    own, hit, found = words(text), set(), set()
    for item, t in items:
        w = words(t)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            win = w[i : i + width]
            for p in range(len(own) - len(win) + 1):
                if own[p : p + len(win)] == win:
                    hit.update(range(p, p + len(win)))
                    found.add(item)
    return len(own), len(hit), sorted(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
