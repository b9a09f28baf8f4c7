"""Verdicts on URLs by host rules and a list of blocked canonical URLs.

The list is summed up in a blocked Bloom filter: one hash picks a block of eight 64-bit words, and
one bit is set in each word. The number of blocks is fixed, so the filter has the same few
megabytes whatever the length of the list; a longer list only lets more URLs through to the exact
hash join, which alone decides and removes every false hit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefile.session import durable

WORDS = 8
# Blocks of 64 bytes: 4 MB in all, about 30 bits a key for a million keys.
BLOCKS = 1 << 16
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


@dataclass(frozen=True)
class Rule:
    """`pattern` is a host, then the beginning of the path."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.split("/", 1)[1]


def _after_scheme(url: Column) -> Column:
    """What follows the first `://`; null without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    """From behind the first `://` to `/`, `?`, `#` or the end, A-Z in lower case; else empty."""
    raw = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """From behind the host to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host without port and leading `www.`, path without closing slashes, sorted query without tracking parts.

    Null where there is no `://`; scheme and fragment do not count.
    """
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":[0-9]*$", ""), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    parts = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    asked = F.when(F.size(parts) > 0, F.concat(F.lit("?"), F.array_join(parts, "&"))).otherwise(F.lit(""))
    return F.when(F.locate("://", url) > 0, F.concat(host, path, asked))


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest pattern that fits (of equally long ones the first listed), else null."""
    chosen = F.lit(None).cast("string")
    for rule in reversed(sorted(rules, key=lambda r: -len(r.pattern))):
        at_host = (host == rule.host) | host.endswith("." + rule.host)
        chosen = F.when(at_host & path.startswith(rule.path), F.lit(rule.pattern)).otherwise(chosen)
    return chosen


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks)).cast("int")


def _masks(key: Column) -> list[Column]:
    """One bit for each word of the key's block, six hash bits each."""
    h = F.xxhash64(F.lit("bits"), key)
    places = [F.shiftrightunsigned(h, 6 * w).bitwiseAND(F.lit(63)).cast("int") for w in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]


def blocked_bloom(keys: DataFrame, key: str, blocks: int = BLOCKS) -> DataFrame:
    """(block, w0..w7): the filter of all values of `key`, at most `blocks` rows."""
    bits = _masks(F.col(key))
    rows = keys.select(_block(F.col(key), blocks).alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(bits)])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list[Rule], blocks: int = BLOCKS, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """(page_id, host, path, canonical, possible, listed, rule, verdict): one row per row of `pages`.

    `listed` holds blocked URLs in `url`; any spelling of a URL means the same. A rule decides
    where one fits; else a listed URL is blocked and all others are allowed. A null URL or one
    without `://` has an empty host and path, is never listed and so is allowed. Repeated rows and
    null ids are kept; no pages give no rows; an empty list blocks nothing.
    """
    list_rows = listed.select(canonical_url(listed["url"].cast("string")).alias("key")).filter("key is not null").distinct()
    list_rows = durable(list_rows)
    bloom = F.broadcast(blocked_bloom(list_rows, "key", blocks))  # `blocks` rows of 68 bytes at most
    url = pages[url_column].cast("string")
    rows = pages.select(pages[id_column].alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), canonical_url(url).alias("canonical"))
    rows = rows.withColumn("block", F.when(F.col("canonical").isNotNull(), _block(F.col("canonical"), blocks)))
    probed = rows.join(bloom, "block", "left")
    hit = F.lit(True)
    for i, bit in enumerate(_masks(F.col("canonical"))):
        hit = hit & (F.col(f"w{i}").bitwiseAND(bit) != 0)
    probed = probed.withColumn("possible", F.coalesce(hit, F.lit(False)))
    # only possible hits carry a key into the exact join; the others are dealt out, not compared
    key = F.when(F.col("possible"), F.col("canonical"))
    maybe = probed.filter("possible").select(key.alias("key")).distinct()
    confirmed = maybe.join(list_rows, "key", "left_semi").select("key", F.lit(True).alias("sure"))
    judged = probed.select("page_id", "host", "path", "canonical", "possible").join(confirmed, F.col("canonical") == F.col("key"), "left")
    judged = judged.withColumn("listed", F.coalesce("sure", F.lit(False))).withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    of_rule = F.lit(None).cast("string")
    for rule in rules:
        of_rule = F.when(F.col("rule") == rule.pattern, F.lit(rule.verdict)).otherwise(of_rule)
    verdict = F.coalesce(of_rule, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow")))
    return judged.select("page_id", "host", "path", "canonical", "possible", "listed", "rule", verdict.alias("verdict"))
