"""What the training-data operators share: the shared folder, cut lineage, sizes, word splitting."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..storage import cut, drop, scratch, shared_dir  # noqa: F401

#: Bytes: A-Z to a-z, all but 0-9, a-z and bytes over 0x7F to a space.
WORD_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
#: Bytes: A-Z to a-z, the rest as it is.
LOWER_TABLE = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def words(text: str | None) -> list[bytes]:
    """Lower-cased runs of 0-9, a-z and non-ASCII characters; null has none."""
    return utf8(text).translate(WORD_TABLE).split()


def with_settings(df: DataFrame, **settings: object) -> DataFrame:
    """df in a session of its own with other settings; names have __ for a dot. The caller's session stays as it is."""
    own = df.sparkSession.newSession()
    for k, v in df.sparkSession.conf.getAll.items():
        if k.startswith("spark.sql.") and own.conf.isModifiable(k):
            own.conf.set(k, v)
    for k, v in settings.items():
        own.conf.set(k.replace("__", "."), v)
    plan = own._jvm.org.apache.spark.sql.classic.Dataset.ofRows(own._jsparkSession, df._jdf.queryExecution().analyzed())
    return DataFrame(plan, own)


class Tables:
    """Tables written with cut() that go together when nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.held = spark, []

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        self.held.append(cut(df, name))
        return self.held[-1]

    def drop(self) -> None:
        for df in self.held:
            drop(self.spark, df)
        self.held.clear()


def small(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows, so that a worker holds few texts and results as Python objects at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def give_back() -> None:
    """Returns freed memory to the system, which allocators keep otherwise; a worker lives on, beside others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, for mapInArrow(), giving memory back when it is through."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def slabs(batches: Iterator[pa.RecordBatch], column: int, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about `size` bytes of text in that column; a longer text is a slice of its own."""
    for b in batches:
        ends = np.cumsum(pc.binary_length(b.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            yield b.slice(at, end - at)
            at = end


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
