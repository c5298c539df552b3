"""Rows grouped by their content: digests, groups too large for one task, and hints for small tables. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows up to which a table of digests is broadcast (under 200 bytes each); a larger one is joined by shuffle.
BROADCAST_ROWS = 100_000
#: Rows of one group that may meet in a task; more are spread by a salt.
GROUP_ROWS = 1_000


def sha256(text: Column) -> Column:
    """The digest of a text in UTF-8, as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def small(table: DataFrame) -> DataFrame:
    """A written table, with a hint to broadcast it if it has few rows."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def share(rows: int) -> int:
    """Rows from which a group counts as large: at most BROADCAST_ROWS groups of so many rows can exist."""
    return max(GROUP_ROWS, -(-rows // BROADCAST_ROWS))


def salts(groups: DataFrame, rows: int, key: str = "digest", n: str = "n") -> DataFrame:
    """(key, salts) of the groups (key, n) that are large, to be broadcast: their number is bounded, see share()."""
    most = share(rows)
    return F.broadcast(groups.where(F.col(n) > most).select(key, F.ceil(F.col(n) / most).cast("int").alias("salts")))


def salted(rows: DataFrame, large: DataFrame, by: Column, key: str = "digest") -> DataFrame:
    """rows with a salt by a hash of `by`: 0 but for rows of large groups."""
    return rows.join(large, key, "left").withColumn("salt", F.pmod(F.xxhash64(by), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")


def replicated(groups: DataFrame, large: DataFrame, key: str = "digest") -> DataFrame:
    """groups with a row for each salt that their rows may have."""
    return groups.join(large, key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
