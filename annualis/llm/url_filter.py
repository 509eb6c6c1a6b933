"""URL filter: rules by host and path, and a blocked Bloom filter before an exact join.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annualis.session import stored_with

WORDS = 8  # a block is eight 64-bit words and an entry sets one bit in each
BITS_PER_ENTRY = 16
BROADCAST_BLOCKS = 100_000  # 72 bytes each, about 7 MB; beyond, the filter is joined by shuffle

# Fixed values: (host, path, verdict) of the rules.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    at = F.instr(url, "://")
    rest = url.substr(at + 3, F.length(url))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.when(url.isNull() | (at == 0), "").otherwise(_ascii_lower(host))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    at = F.instr(url, "://")
    rest = url.substr(at + 3, F.length(url))
    return F.when(url.isNull() | (at == 0), "").otherwise(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading ``www.`` and path without its last slash: one form for a page's addresses."""
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, "/$", ""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _bit(entry: Column, word: int) -> Column:
    """The bit an entry sets in a word of its block."""
    place = F.shiftrightunsigned(F.xxhash64(F.lit("bits"), entry), 6 * word).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def bloom_filter(entries: DataFrame, column: str, blocks: int) -> DataFrame:
    """One row per used block: ``block`` and its words ``w0`` to ``w7``."""
    entry = F.col(column)
    return entries.groupBy(F.pmod(F.xxhash64(entry), F.lit(blocks)).alias("block")).agg(
        *[F.bit_or(_bit(entry, k)).alias(f"w{k}") for k in range(WORDS)])


def judge_urls(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, listed (boolean) of every row of ``pages`` (page_id, url).

    ``listed`` (url) names blocked pages. Its canonical URLs fill a blocked Bloom filter, sized by
    their number; pages that it may hold go to a hash join on the canonical URL, which removes the
    false positives. The others are done. A rule outranks the list. Null URLs and URLs without
    ``://`` have empty host and path, no rule, and are never listed; repeated rows are judged each;
    an empty list allows all that no rule blocks. Only page_id and url are read, so other columns don't matter.
    """
    named = listed.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).filter("host <> ''")
    entries, seen = stored_with(named.select(canonical(F.col("host"), F.col("path")).alias("entry")).distinct(), "listed",
                                n=F.count(F.lit(1)))
    blocks = max(1, -(-int(seen["n"] or 0) * BITS_PER_ENTRY // (64 * WORDS)))
    bits = bloom_filter(entries, "entry", blocks)
    bits = F.broadcast(bits) if blocks <= BROADCAST_BLOCKS else bits

    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parts = parts.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    parts = parts.withColumn("entry", canonical(F.col("host"), F.col("path")))
    tested = parts.withColumn("block", F.pmod(F.xxhash64("entry"), F.lit(blocks))).join(bits, "block", "left")
    holds = F.col("host") != ""
    for k in range(WORDS):
        holds = holds & F.coalesce(F.col(f"w{k}").bitwiseAND(_bit(F.col("entry"), k)) != 0, F.lit(False))
    tested = tested.select("page_id", "host", "path", "rule", "entry", holds.alias("maybe"))

    hit = entries.withColumn("hit", F.lit(True))
    possible = tested.filter("maybe").join(hit, "entry", "left").withColumn("listed", F.col("hit").isNotNull())
    passed = tested.filter("not maybe").withColumn("listed", F.lit(False))
    columns = ["page_id", "host", "path", F.col("rule.rule").alias("rule"),
               F.coalesce(F.col("rule.verdict"), F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed"]
    return possible.select(*columns).unionAll(passed.select(*columns))


# Site names whose pages the registered query lists.
LISTED_SITES = "casino|pills|bets|spam|adult|ads-track"


def reported_urls(pages: DataFrame) -> DataFrame:
    """URLs of pages on sites whose name holds a listed word."""
    return pages.filter(host_of(F.col("url")).rlike(LISTED_SITES)).select("url")
