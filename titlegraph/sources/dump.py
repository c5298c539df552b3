"""SQL dumps as tables, a large file in many tasks.

Files are cut into ranges of bytes. Whether a range begins inside a string, and inside which statement, depends on all that
stands before it; so each range is first scanned as if it began outside a string, inside one, and inside one after a
backslash. These three outcomes of each range are put together file by file, a row a range, which gives every range its
true beginning. Then the ranges are read again: of each, the tuples that open in it, to the end of the last one. A task
takes blocks, ranges that lie side by side, whose bytes it reads once, so that small ranges cost no more tasks or reads.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import arrow_file

#: Bytes of a range, of each further piece that is read where a tuple goes on, and of a statement's head at most.
RANGE, MORE, HEAD = 32 << 20, 1 << 20, 64 << 10
#: Bytes of a block of ranges that are smaller, and of a task that takes smaller blocks (less where the cores have no work).
BLOCK, TASK = 64 << 10, 1 << 20
#: A beginning of a range: outside a string, inside one, inside one after a backslash.
OUT, IN, ESCAPED = range(3)

_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "0": "\0"}
_TOKEN = re.compile(r"'(?:[^'\\]|\\.|'')*'|[(),;]|[^'(),;]+", re.S)
_STRING = re.compile(rb"(?:[^'\\]|\\.)*+", re.S)
_OUTSIDE = re.compile(rb"['();]|INSERT(?=\s+INTO\b)", re.I)


def unescape(body: str) -> str:
    """A string literal's text: backslash escapes, and doubled quotes as one."""
    return re.sub(r"\\(.)|''", lambda m: "'" if m.group(1) is None else _ESCAPES.get(m.group(1), m.group(1)), body, flags=re.S)


def field(raw: str) -> str | None:
    """A field's value as text; NULL is null."""
    raw = raw.strip()
    if raw.startswith("_binary"):
        raw = raw[7:].strip()
    if raw[:1] == "'":
        return unescape(raw[1:-1])
    return None if raw.upper() == "NULL" or not raw else raw


def fields(body: str) -> list[str | None]:
    """The fields of a tuple, given what stands between its outer parentheses; inner parentheses belong to fields."""
    found, held, depth = [], [], 0
    for m in _TOKEN.finditer(body):
        t = m.group()
        if t == "," and depth == 0:
            found.append(field("".join(held)))
            held = []
            continue
        depth += (t == "(") - (t == ")")
        held.append(t)
    return [*found, field("".join(held))]


def _start(table: str) -> re.Pattern[bytes]:
    """The head of an INSERT into the table, with or without a column list."""
    return re.compile(rb"INSERT\s+INTO\s+`?" + re.escape(table.encode()) + rb"`?\s*(?:\([^)']*\)\s*)?VALUES", re.I)


class Block:
    """A file that is opened once, and whose bytes from `start` to `end`, and a head about them, are read once."""

    def __init__(self, path: str, start: int, end: int):
        store, at = arrow_file(path)
        self.file = store.open_input_file(at)
        self.length, self.start = self.file.size(), max(0, start - HEAD)
        self.held = self.file.read_at(min(end + HEAD, self.length) - self.start, self.start)

    def size(self) -> int:
        return self.length

    def read_at(self, n: int, at: int) -> bytes:
        low = at - self.start
        return self.held[low : low + n] if 0 <= low <= low + n <= len(self.held) else self.file.read_at(n, at)


class Range:
    """A file's bytes from `start` on; those up to `end` are its own, more are read when they are wanted."""

    def __init__(self, path: str | Block, start: int, end: int):
        self.file = path if isinstance(path, Block) else Block(path, start, end)
        self.size, self.start, self.end = self.file.size(), start, end
        self.data = self.file.read_at(min(end + HEAD, self.size) - start, start)  # a head may go on behind the end
        self.before = self.file.read_at(min(HEAD, start), max(0, start - HEAD))

    def more(self) -> bool:
        """Reads a piece more; False at the file's end."""
        have = self.start + len(self.data)
        piece = self.file.read_at(min(MORE, self.size - have), have) if have < self.size else b""
        self.data += piece
        return bool(piece)

    def head(self, start: re.Pattern[bytes], at: int) -> re.Match[bytes] | None:
        """The head of a statement at a place, also where it goes on behind what was read."""
        while (m := start.match(self.data, at)) is None and len(self.data) - at < HEAD and self.more():
            pass
        return m

    def inside_head(self, start: re.Pattern[bytes]) -> int:
        """Where a head ends that began before the range; 0 if there is none. Heads hold no quotes, so this is of use only
        where the range begins outside of a string."""
        if not self.before:
            return 0
        while len(self.data) < HEAD and self.more():
            pass
        before, after = self.before.rpartition(b"'")[2], self.data[:HEAD].partition(b"'")[0]
        edge = len(before)
        return next((m.end() - edge for m in start.finditer(before + after) if m.start() < edge < m.end()), 0)

    def events(self, start: re.Pattern[bytes], at: int, state: int, until: int | None = None) -> Iterator[tuple[int, bytes, int]]:
        """(place, token, where it goes on) of parentheses, semicolons and heads (b'INSERT') outside of strings; at last
        the state (b'end') at the end of what is looked at."""
        while True:
            limit = len(self.data) if until is None else until
            if state == ESCAPED and at < limit:
                state, at = IN, at + 1
            elif state == IN and at < limit:
                at = _STRING.match(self.data, at, limit).end()
                if at < limit and self.data[at : at + 1] == b"'":
                    state, at = OUT, at + 1
                elif at < limit:  # a backslash that is the last byte
                    state, at = ESCAPED, limit
            elif at < limit:
                m = _OUTSIDE.search(self.data, at, min(limit + 64, len(self.data)))
                if m is None or m.start() >= limit:
                    at = limit
                elif m.group() == b"'":
                    state, at = IN, m.end()
                elif len(m.group()) == 1:
                    at = m.end()
                    yield m.start(), m.group(), at
                else:
                    head = self.head(start, m.start())
                    at = m.end() if head is None else head.end()
                    if head is not None:
                        yield m.start(), b"INSERT", at
            else:
                yield state, b"end", at
                if until is not None or not self.more():
                    return


def outcome(part: Range, start: re.Pattern[bytes], state: int) -> tuple[int, int, int, bool, int]:
    """What a range that begins in that state leaves behind: the state at its end, where the list of tuples begins (-1: none,
    -2: as it was), the depth of parentheses (or its change), whether it was told anew, and how many heads it has."""
    values, depth, anew, heads = -2, 0, False, 0
    for at, token, after in part.events(start, part.inside_head(start) if state == OUT else 0, state, part.end - part.start):
        if token == b"end":
            state = at
        elif token == b"INSERT":
            values, depth, anew, heads = part.start + after, 0, True, heads + 1
        elif token == b";":
            values, depth, anew = -1, 0, True
        else:
            depth += 1 if token == b"(" else -1
    return state, values, depth, anew, heads


def beginnings(outcomes: Iterator[list]) -> list[tuple[int, int, int, int]]:
    """How a file's ranges truly begin, given their outcomes in order: (state, where the list began, depth, heads before)."""
    state, values, depth, heads, out = OUT, -1, 0, 0, []
    for found in outcomes:
        out.append((state, values, depth, heads))
        state, v, d, anew, h = map(int, found[state])
        values, depth, heads = values if v == -2 else v, d if anew else depth + d, heads + h
    return out


def tuples(part: Range, start: re.Pattern[bytes], state: int, values: int, depth: int, heads: int, first_only: bool) -> Iterator[list[str | None]]:
    """The tuples that open in the range, which begins in that state, `depth` parentheses deep, in a statement whose list
    begins at `values` (-1: in none that is wanted) and before which as many heads stood."""
    end, opened = part.end - part.start, None
    for place, token, after in part.events(start, max(0, values - part.start), state):
        if token == b"end":
            if place == OUT and opened is None and depth == 0 and after >= end:
                return
            continue
        if place >= end and opened is None:
            return
        if token == b"INSERT":
            values, depth, heads, opened = part.start + after, 0, heads + 1, None
        elif token == b";":
            values, depth, opened = -1, 0, None
        elif token == b"(":
            depth += 1
            if depth == 1 and values >= 0 and place < end:
                opened = after
        else:
            depth -= 1
            if depth == 0 and opened is not None:
                if heads == 1 or not first_only:
                    yield fields(part.data[opened:place].decode("utf-8"))
                opened = None


def rows(text: str, table: str, first_only: bool = False) -> Iterator[list[str | None]]:
    """The tuples of a table's INSERT statements in a text; quotes, escapes and inner parentheses are heeded. Of a statement
    that does not end, the whole tuples count."""
    part = Range.__new__(Range)
    part.data = text.encode("utf-8")
    part.start, part.end, part.before, part.more = 0, len(part.data), b"", lambda: False
    yield from tuples(part, _start(table), OUT, -1, 0, 0, first_only)


def read_dump(spark: SparkSession, path: str, table: str, first_only: bool = False, size: int = RANGE) -> DataFrame:
    """(row_pos, fields array<string>) of a table in a dump: a file, or a folder or glob of files.

    row_pos grows with the files by name and with the rows in each. first_only reads the first INSERT of each file.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length").where("length > 0")
    block = size * max(1, BLOCK // size)
    places = F.transform(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / block)), lambda i: (i * block).cast("long"))
    blocks = files.select("path", F.explode(places).alias("start"), "length").select("path", "start", F.least(F.col("start") + block, F.col("length")).alias("end"))
    count, total = files.agg(F.sum(F.ceil(F.col("length") / block)), F.sum("length")).first()
    n = max(1, min(count or 0, max(int(spark.conf.get("spark.sql.shuffle.partitions")), (total or 0) // max(block, TASK)), 100_000))
    start = _start(table)

    def ranges(r: dict) -> Iterator[Range]:
        whole = Block(r["path"], r["start"], r["end"])
        return (Range(whole, a, min(a + size, r["end"])) for a in range(r["start"], r["end"], size))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("found", pa.list_(pa.list_(pa.list_(pa.int64()))))])
        for b in batches:
            for r in b.to_pylist():
                found = [[list(map(int, outcome(part, start, s))) for s in (OUT, IN, ESCAPED)] for part in ranges(r)]
                yield pa.RecordBatch.from_pylist([r | {"found": found}], kind)

    def join(parts: pd.DataFrame) -> pd.DataFrame:
        """A row for each block of a file, not its bytes."""
        parts = parts.sort_values("start")
        begun = iter(beginnings(f for found in parts["found"] for f in found))
        return parts[["path", "start", "end"]].assign(begun=[[next(begun) for _ in found] for found in parts["found"]])

    scanned = blocks.repartition(n).mapInArrow(scan, "path string, start long, end long, found array<array<array<long>>>")
    begun = scanned.groupBy("path").applyInPandas(join, "path string, start long, end long, begun array<array<long>>")
    numbered = files.select("path", F.expr("cast(row_number() over (order by path) - 1 as int)").alias("file"))  # a row for each file
    placed = begun.join(numbered, "path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("file", pa.int32()), ("start", pa.int64()), ("i", pa.int64()), ("fields", pa.list_(pa.string()))])
        for b in batches:
            for r in b.to_pylist():
                held = []
                for part, begun in zip(ranges(r), r["begun"], strict=True):
                    for i, t in enumerate(tuples(part, start, *begun, first_only)):
                        held.append({"file": r["file"], "start": part.start, "i": i, "fields": t})
                        if len(held) == 10_000:
                            yield pa.RecordBatch.from_pylist(held, kind)
                            held = []
                yield pa.RecordBatch.from_pylist(held, kind)

    found = placed.repartition(n).mapInArrow(read, "file int, start long, i long, fields array<string>")
    # a tuple has two bytes at least, so places in a file are told apart by its range's start and the tuple's number
    return found.select((F.shiftleft(F.col("file").cast("long"), 44) + F.col("start") + F.col("i")).alias("row_pos"), "fields")


#: Position, name and type of the columns that matching reads.
TABLES = {
    "person_nt": [(0, "ind", "long"), (1, "person_id", "long"), (2, "dyn", "string"), (3, "fief", "string"), (4, "pn", "string"), (5, "pn_abr", "string"), (6, "nt", "string"), (7, "tn", "string"), (10, "start_year", "int"), (11, "end_year", "int"), (12, "dyn_id", "long")],
    "person": [(0, "id", "long"), (1, "name", "string")],
    "date_dynasties": [(0, "id", "long"), (1, "name", "string")],
}


def typed(raw: DataFrame, columns: list[tuple[int, str, str]]) -> DataFrame:
    return raw.select("row_pos", *[F.get("fields", F.lit(i)).try_cast(kind).alias(name) for i, name, kind in columns])


def load(spark: SparkSession, path: str, table: str, first_only: bool = False, size: int = RANGE) -> DataFrame:
    """A dump's table with row_pos and, for known tables, named and typed columns; a missing table is empty."""
    raw = read_dump(spark, path, table, first_only, size)
    return typed(raw, TABLES[table]) if table in TABLES else raw


def load_reference(spark: SparkSession, path: str, first_only: bool = False, size: int = RANGE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(titles, persons, dynasties) of a dump, as match.match() and review.plan() take them."""
    return tuple(load(spark, path, t, first_only, size) for t in TABLES)
