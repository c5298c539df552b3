"""Operator 4: host and path rules, looked up through a blocked Bloom filter and an exact hash join.

A rule (host, path, verdict) fits its host and all subdomains where the url's path starts with the rule's path. For each
different (host, path) of the pages the operator lists the canonical keys that could be listed: every suffix of the host
at a dot, with every prefix of the path that is as long as some listed path. A key's block of the Bloom filter (one
64-bit word, four bits a key) passes possible hits; an equi-join on the key itself removes false positives. The longest
rule wins. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_BLOCKS = 1 << 20  # of 12 bytes: bounds what is broadcast


def canonical(url):
    """Columns host (A-Z lower-cased) and path of a url; null or no '://': both empty."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    return F.translate(host, UPPER, LOWER), F.regexp_extract(tail, r"^[^?#]*", 0)


def key_mask(key):
    """The four bits of a key in its block."""
    h, mask = F.xxhash64(key, F.lit(1)), None
    for i in range(4):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftrightunsigned(h, 6 * i), F.lit(64)).cast("int"))
        mask = bit if mask is None else mask.bitwiseOR(bit)
    return mask


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, word): at most `blocks` rows."""
    return keys.groupBy(F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int").alias("block")).agg(F.bit_or(key_mask(F.col("key"))).alias("word"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", url_col: str = "url") -> DataFrame:
    """pages with host, path, rule (the listed key, else null) and verdict (the rule's, else default) added.

    A null url, or one without '://', has an empty host and path and no rule. Of rules with one key the smallest verdict
    counts. Columns of pages with these names are replaced. Repeated rows are each judged; empty tables give no rows.
    """
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    host, path = canonical(F.col(url_col))
    pages = pages.select(*keep, host.alias("host"), path.alias("path"))
    listed = rules.where((F.col("host") != "") & F.col("path").isNotNull()).select(F.concat("host", "path").alias("key"), F.length("path").alias("n"), "verdict").groupBy("key", "n").agg(F.min("verdict").alias("verdict"))
    # different path lengths: no more than the longest url has characters
    lengths, count = listed.agg(F.collect_set("n"), F.count(F.lit(1))).first()
    if not count:
        return pages.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    blocks = min(MAX_BLOCKS, max(64, 1 << (count // 4).bit_length()))
    labels = F.split("host", r"\.")
    most = rules.agg(F.max(F.size(F.split("host", r"\."))).alias("n")).first().n  # no rule has more labels
    hosts = F.transform(F.sequence(F.greatest(F.lit(1), F.size(labels) - most + 1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    paths = F.transform(F.filter(F.array(*[F.lit(n) for n in sorted(lengths)]), lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    seen = pages.where(F.col("host") != "").select("host", "path").distinct()
    keys = seen.withColumn("key", F.explode(F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))))
    keys = keys.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")).withColumn("mask", key_mask(F.col("key")))
    possible = keys.join(F.broadcast(bloom(listed, blocks)), "block").where(F.col("word").bitwiseAND(F.col("mask")) == F.col("mask"))
    hits = possible.join(listed.select("key", "verdict"), "key")
    # written, so that the join with very many pages of one url, or of none, can be split
    best = cut(hits.groupBy("host", "path").agg(F.max(F.struct(F.length("key").alias("n"), F.col("key"), F.col("verdict"))).alias("best")), "url-verdicts")
    return pages.join(best, ["host", "path"], "left").select(*keep, "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
