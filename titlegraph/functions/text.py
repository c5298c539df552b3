"""Column functions for text: trimming, normal forms, keys, and cells of CSV, SQL and URLs."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import WIKI_URL
from .phrases import convert


def trim(c: Column) -> Column:
    """Without Unicode white space and byte-order marks at either end."""
    return F.regexp_replace(c, r"(?U)^[\s\x{FEFF}]+|[\s\x{FEFF}]+\z", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_of(*cols: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*map(blank_to_null, cols))


def nfc(c: Column) -> Column:
    """Unicode normal form C. ASCII never reaches Python's result."""

    @F.pandas_udf("string")
    def normal(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))

    ascii_only = c.isNull() | c.rlike(r"^\p{ASCII}*$")
    return F.when(ascii_only, c).otherwise(normal(F.when(~ascii_only, c)))


def key(c: Column) -> Column:
    """A join key: null is empty, else normal form C, trimmed."""
    return F.coalesce(trim(nfc(c)), F.lit(""))


def without_note(c: Column) -> Column:
    """Without one parenthesis, ASCII or full-width, at the end; what does not fit stays. Empty is null."""
    # a fixed value
    pattern = r"^([^()（）]+?)(?:\s*[(（][^)）]+[)）])?\z"
    return blank_to_null(trim(F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1)).otherwise(c)))


def page_url(title: Column, base: str = WIKI_URL) -> Column:
    """The page's address: spaces as underscores, percent-encoded but for A-Z a-z 0-9 - _ . ! ~ * ' ( )."""
    out = F.url_encode(F.replace(title, F.lit(" "), F.lit("_")))
    for code, char in (("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        out = F.replace(out, F.lit(code), F.lit(char))
    return F.when(F.coalesce(title, F.lit("")) != "", F.concat(F.lit(base), out))


def csv_cell(c: Column) -> Column:
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(text.rlike('[",\n\r]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def sql_string(c: Column) -> Column:
    """A quoted literal; null and empty are NULL."""
    escaped = F.replace(F.replace(c.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''"))
    return F.coalesce(F.when(c.cast("string") != "", F.concat(F.lit("'"), escaped, F.lit("'"))), F.lit("NULL"))


def sql_int(c: Column) -> Column:
    """An integer literal, cut towards zero; what is no number is NULL."""
    return F.coalesce(c.try_cast("double").try_cast("bigint").cast("string"), F.lit("NULL"))


def translate(c: Column, pairs: dict[str, str] | None = None) -> Column:
    """By a table of characters and phrases, such as simplified to traditional forms; without pairs, as it is.

    The longest phrase that begins at a place counts. Tables of single characters alone stay within built-in functions.
    """
    if not pairs:
        return c
    if all(len(k) == len(v) == 1 for k, v in pairs.items()):
        return F.translate(c, "".join(pairs), "".join(pairs.values()))
    return convert(c, pairs)
