"""Operator 7: language ID by language-bitmask n-gram filters.

Each language has a Bloom filter of its frequent character n-grams. The filters are bit-sliced: one table whose slot i
holds, as a bitmask, bit i of every language's filter, so that probing an n-gram once returns all languages that may
contain it. A text's n-grams are probed together; the popcount of each language's bit, corrected for that language's
rate of false positives, decides. A text fits no language if, for each of them, that count is clearly below what a text
of the language has: of the n-grams of the labelled texts, the share that another labelled text of the language has too.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small, tidy

N = 4
PROBES = 3
#: An n-gram is a language's own if it makes up at least this share of the language's n-grams, so that a language has at
#: most 1 / SHARE of them.
SHARE = 1 / 20_000
#: Bound of the labelled sample: about so many different texts of each language, chosen by a hash of the text.
TRAINING_DOCS = 5_000
UNKNOWN = "und"
#: A text fits a language if its corrected count could come, within DEVIATIONS standard deviations, from a text that has
#: at least this part of the language's own share of known n-grams. A short text always fits.
FIT = 1 / 4
DEVIATIONS = 3
#: Whether each 16-bit character is a letter.
LETTER = np.array([chr(c).isalpha() for c in range(0x10000)])


def ngrams(texts: list[str | None], n: int = N) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the n-grams of all texts, the number of each text, and whether it has a letter.

    N-grams are of lower-cased letters, with every run of other characters as one space, and one at either end.
    """
    joined = "\0".join(["", *((t or "").lower().replace("\0", " ") for t in texts), ""])
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = code == 0
    letter = LETTER[np.minimum(code, 0xFFFF)]
    if len(high := np.flatnonzero(code > 0xFFFF)):
        letter[high] = [chr(c).isalpha() for c in code[high]]
    code = np.where(letter, code, 32).astype(np.uint64)
    # of a run of other characters the first one stays, unless a text starts or ends in the run
    other = np.concatenate([[False], ~letter, [False]]).astype(np.int8)
    edge, inside = np.flatnonzero(np.diff(other)), np.concatenate([[0], np.cumsum(ends)])
    first, after = edge[::2], edge[1::2]
    keep = letter | ends
    keep[first[inside[after] == inside[first]]] = True
    code, ends, letter = code[keep], ends[keep], letter[keep]
    doc = np.cumsum(ends) - 1
    has = np.bincount(doc[letter], minlength=len(texts) + 1)[: len(texts)] > 0
    if len(code) < n:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64), has
    m = len(code) - n + 1
    h = np.zeros(m, np.uint64)
    for i in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + code[i : i + m]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    inner = np.concatenate([[0], np.cumsum(ends)])
    # no separator within, but for the first and the last character
    whole = inner[n - 1 : n - 1 + m] - inner[1 : m + 1] == 0
    body = letter[:m].copy()
    for i in range(1, n):
        body |= letter[i : i + m]
    ok = whole & body
    return h[ok], np.bincount(doc[:m][ok], minlength=len(texts) + 1)[: len(texts)], has


class Filters:
    """Bit-sliced Bloom filters: a slot of the table has a bit for each language, in as many words as are needed."""

    def __init__(self, grams: dict[str, np.ndarray], probes: int = PROBES, known: dict[str, float] | None = None):
        self.languages, self.probes = sorted(grams), probes
        self.known = np.array([(known or {}).get(lang, 0.0) for lang in self.languages])
        most = max((len(g) for g in grams.values()), default=0)
        self.bits = max(12, (8 * most).bit_length())
        self.kind = kind = np.uint8 if len(grams) <= 8 else np.uint64
        self.width = np.dtype(kind).itemsize * 8
        self.table = np.zeros((1 << self.bits, max(1, -(-len(grams) // self.width))), kind)
        for i, lang in enumerate(self.languages):
            for at in self._slots(np.asarray(grams[lang], np.uint64)):
                self.table[at, i // self.width] |= kind(1 << i % self.width)
        self.false = np.array([float(np.mean(self.bit(self.table, i))) for i in range(len(self.languages))]) ** probes

    def bit(self, masks: np.ndarray, i: int) -> np.ndarray:
        """The bit of the language numbered i in each of some masks (n, words)."""
        return masks[:, i // self.width] >> self.kind(i % self.width) & self.kind(1)

    def _slots(self, h: np.ndarray) -> Iterator[np.ndarray]:
        mask = np.uint64((1 << self.bits) - 1)
        step = h >> np.uint64(40) | np.uint64(1)
        for i in range(self.probes):
            yield (h + np.uint64(i) * step) & mask

    def masks(self, h: np.ndarray) -> np.ndarray:
        """The languages, as a bitmask, that may contain each n-gram."""
        out = None
        for at in self._slots(h):
            out = self.table[at] if out is None else out & self.table[at]
        return out

    def predict(self, texts: list[str | None], n: int = N) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The language, the score and whether the text fits any language, of each text."""
        h, counts, has = ngrams(texts, n)
        mask, at = self.masks(h), np.cumsum(counts) - counts
        hits = np.zeros((len(texts), max(1, len(self.languages))))
        some = counts > 0
        for i in range(len(self.languages)):
            if some.any():
                hits[some, i] = np.add.reduceat(self.bit(mask, i).astype(np.int64), at[some])
        total = counts[:, None]
        true = np.clip((hits - total * self.false) / np.maximum(1 - self.false, 1e-9), 0, None) if self.languages else hits
        best = true.argmax(1)
        top = true[np.arange(len(texts)), best]
        sums = true.sum(1)
        score = np.where(has & (sums > 0), np.clip(top / np.maximum(sums, 1e-9), 0, 1), 0.0)
        least = total * self.known * FIT
        fits = has & ((true + DEVIATIONS * np.sqrt(least) >= least).any(1) if self.languages else False)
        return [self.languages[b] if ok and self.languages else UNKNOWN for b, ok in zip(best.tolist(), has.tolist(), strict=True)], score, fits


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", bound: int = TRAINING_DOCS, share: float = SHARE, n: int = N) -> Filters:
    """Filters from the labelled rows of docs (text and lang not null): about `bound` different texts of each language, or
    all that it has, so that neither a rare language nor a text with many copies is over- or underrated."""
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("t")).where("lang is not null and t is not null").withColumn("h", F.xxhash64("t", F.lit(11)))
    sizes = rows.select("lang", "h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("size"))  # a row for each language
    rows = rows.join(F.broadcast(sizes), "lang").where(F.pmod("h", F.lit(1 << 20)) < (F.lit(1 << 20) * F.least(F.lit(1.0), bound / F.col("size"))))
    rows = rows.groupBy("lang", "h").agg(F.min("t").alias("t")).select("lang", "t")

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            own: dict[str, list[str]] = {}
            for lang, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own.setdefault(lang, []).append(t)
            for lang, texts in own.items():
                h, counts, _ = ngrams(texts, n)
                text = np.repeat(np.arange(len(texts)), counts)
                order = np.lexsort((text, h))
                h, text = h[order], text[order]
                first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])[: len(h)])
                seen = np.diff(np.append(first, len(h)))
                new = np.ones(len(h), np.int64)
                new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
                held_by = np.add.reduceat(new, first) if len(h) else new
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(first), pa.string()), pa.array(h[first].view(np.int64)), pa.array(seen, pa.int64()), pa.array(held_by, pa.int64())], names=["lang", "gram", "n", "texts"])

    grams = rows.mapInArrow(tidy(count_grams), "lang string, gram long, n long, texts long").groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))
    totals = grams.groupBy("lang").agg(F.sum("n").alias("total"))  # a row for each language
    own = grams.join(F.broadcast(totals), "lang").where(F.col("n") >= F.col("total") * share)
    sums = {r.lang: r.total for r in totals.collect()}
    held: dict[str, list[int]] = {lang: [] for lang in sums}
    known = dict.fromkeys(sums, 0.0)
    for r in own.select("lang", "gram", "n", "texts").collect():  # at most 1 / share for each language
        held[r.lang].append(r.gram)
        known[r.lang] += r.n / sums[r.lang] if r.texts > 1 else 0
    return Filters({k: np.array(v, np.int64).view(np.uint64) for k, v in held.items()}, known=known)


def identify(docs: DataFrame, filters: Filters, text_col: str = "text", names: tuple[str, str, str] = ("lang_pred", "score", "fits")) -> DataFrame:
    """docs with lang_pred, score and fits (or other names) added; columns of these names are replaced. Only the text is used.

    A null text, or one without a letter, is 'und' with score 0 and fits none; a text whose n-grams are in no filter gets
    the first language with score 0, and fits none if it is long; filters without languages call everything 'und'.
    Repeated rows get equal results.
    """
    keep = [c for c in docs.columns if c not in names]
    at, held = keep.index(text_col), docs.sparkSession.sparkContext.broadcast(filters)  # at most 1 / SHARE n-grams for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 256):
            lang, score, fits = held.value.predict(b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(fits, pa.bool_())], names=[f"c{i}" for i in range(len(keep) + 3)])

    frame = docs.select(*keep)
    schema = ", ".join([f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(frame.schema)] + [f"c{len(keep)} string, c{len(keep) + 1} double, c{len(keep) + 2} boolean"])
    return frame.toDF(*[f"c{i}" for i in range(len(keep))]).mapInArrow(tidy(run), schema).toDF(*keep, *names)


def held_out(id_col):
    """Whether crc32(doc_id as text) mod 4 is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def tally(texts: list[str], n: int = N) -> Counter:
    """The n-grams of texts, counted one by one; for tests."""
    out: Counter = Counter()
    for t in texts:
        s = " " + "".join(c if c.isalpha() else " " for c in t.lower()) + " "
        s = " " + " ".join(s.split()) + " "
        out.update(s[i : i + n] for i in range(len(s) - n + 1) if s[i : i + n].strip())
    return out
