"""Conversion of phrases, such as simplified to traditional forms: at each place the longest phrase of a table counts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Phrases of a table at most; it is held by the driver and each worker.
LIMIT = 1_000_000
#: Stands between texts; no code point has so many bits.
_BETWEEN = np.array([(1 << 21) - 1], np.uint32)


class Phrases:
    """A trie of phrases as sorted edges, walked from all places of many texts at a time."""

    def __init__(self, pairs: dict[str, str]):
        edges: dict[int, int] = {}
        final = [-1]
        self.targets = list(pairs.values())
        for n, phrase in enumerate(pairs):
            state = 0
            for c in phrase:
                key = state << 21 | ord(c)
                if key not in edges:
                    edges[key] = len(final)
                    final.append(-1)
                state = edges[key]
            if phrase:
                final[state] = n
        self.sizes = np.array([len(p) for p in pairs], np.int64)
        self.edges = np.array(sorted(edges), np.int64)
        self.next = np.array([edges[k] for k in self.edges.tolist()], np.int64)
        self.final = np.array(final, np.int64)

    def longest(self, points: np.ndarray) -> np.ndarray:
        """At each place the number of the longest phrase that begins there; -1 if none does."""
        best = np.full(len(points), -1, np.int64)
        if not len(self.edges):
            return best
        at, state, depth = np.arange(len(points)), np.zeros(len(points), np.int64), 0
        while True:
            inside = at + depth < len(points)
            at, state = at[inside], state[inside]
            if not len(at):
                return best
            key = state << 21 | points[at + depth]
            edge = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            hit = self.edges[edge] == key
            at, state, depth = at[hit], self.next[edge[hit]], depth + 1
            ends = self.final[state]
            best[at[ends >= 0]] = ends[ends >= 0]

    def convert(self, texts: list[str | None]) -> list[str | None]:
        arrays = [np.zeros(0, np.uint32) if t is None else np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
        best = self.longest(np.concatenate([x for a in arrays for x in (a, _BETWEEN)]).astype(np.int64)) if arrays else None
        out, start = [], 0
        for t, a in zip(texts, arrays, strict=True):
            if t is None:
                out.append(None)
            else:
                parts, done = [], 0
                for i in np.flatnonzero(best[start : start + len(a)] >= 0).tolist():
                    if i >= done:
                        n = best[start + i]
                        parts += [t[done:i], self.targets[n]]
                        done = i + int(self.sizes[n])
                out.append("".join([*parts, t[done:]]))
            start += len(a) + 1
        return out


def convert(c: Column, pairs: dict[str, str]) -> Column:
    """c with phrases replaced from left to right, at each place the longest that begins there; null stays null."""
    if len(pairs) > LIMIT:
        raise ValueError(f"more than {LIMIT} phrases")
    table = Phrases(pairs)

    @F.arrow_udf(StringType())
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(table.convert(texts.to_pylist()), pa.string())

    return run(c)


def read_phrases(spark: SparkSession, path: str) -> dict[str, str]:
    """A table of phrases from files of lines 'phrase TAB target', or targets parted by blanks, of which the first counts.

    Of equal phrases the last, by the files' names and places in them, counts; lines without a tab are left out.
    """
    parts = F.split("value", "\t")
    lines = spark.read.text(path).where(F.contains("value", F.lit("\t"))).select(parts[0].alias("phrase"), F.split(F.trim(parts[1]), " ")[0].alias("target"), F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()).alias("at"))
    rows = lines.groupBy("phrase").agg(F.max_by("target", "at").alias("target")).limit(LIMIT + 1).collect()  # bounded
    if len(rows) > LIMIT:
        raise ValueError(f"more than {LIMIT} phrases at {path}")
    return {r.phrase: r.target for r in rows}
