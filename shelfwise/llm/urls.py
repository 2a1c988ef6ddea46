"""URL filter: rules, then a list of canonical URLs behind a blocked Bloom filter.

A rule (host, path) fits a URL if the URL's host is the rule's or a subdomain
of it and its path starts with the rule's; the longest rule that fits decides.
URLs without a rule are blocked if their canonical form is listed.  The list
may be of any size: its blocked Bloom filter has one row of four 64-bit lanes
per block, a URL sets two bits in each lane of its one block, and the URLs
whose bits are all set meet the list in an exact hash join that removes the
false positives.  The filter is broadcast when it has at most
``MAX_BROADCAST_BLOCKS`` rows of 40 bytes, else joined by its block number,
which is uniform.  The list is broadcast only below ``MAX_BROADCAST_BYTES``,
beyond which only the URLs that pass the filter are shuffled to it; popular URLs
are left to AQE's skew handling.

All in DataFrame functions.  Defined results: a null URL or one without
``://`` has an empty host and path and no rule; null entries of the list are
ignored, repeated ones count once; repeated pages are judged one by one; rules
of equal length that both fit go by text order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .decontaminate import _LOWER, _UPPER

ALLOW, BLOCK = "allow", "block"
#: bits of the filter per listed URL, and bits of a block
BITS_PER_URL, BLOCK_BITS = 16, 256
MAX_BROADCAST_BLOCKS = 1_000_000
MAX_BROADCAST_BYTES = 8 << 20
#: query parameters that don't change a page
TRACKING = r"^(utm_[a-z]+|ref)="

_URL = r"://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def canonical(url: Column) -> Column:
    """Host without ``www.`` or ``m.``, path without a closing slash, the
    query's parameters in order without tracking; null without a host."""
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    path = F.regexp_replace(path_of(url), "/$", "")
    query = F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1)
    params = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.when(host != "", F.concat(host, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&")))
                                       .otherwise("")))


def rule_fits(host: Column, path: Column, rule: tuple[str, str]) -> Column:
    own = (host == rule[0]) | host.endswith("." + rule[0])
    return own & path.startswith(rule[1])


def deciding_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null.  Rules
    are settings of the job; long lists belong into the listed URLs."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in reversed(ordered):
        out = F.when(rule_fits(host, path, (h, p)), F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _lane_bits(url: Column, lane: int) -> Column:
    """The two bits a URL sets in a lane."""
    h = F.xxhash64(url, F.lit("lanes"))
    one, two = (F.shiftrightunsigned(h, 12 * lane + s).bitwiseAND(F.lit(63)).cast("int") for s in (0, 6))
    return F.call_function("shiftleft", F.lit(1).cast("long"), one).bitwiseOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), two))


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """Rows (block, lane0..lane3) of the listed URLs ``url``."""
    rows = listed.select(_block(F.col("url"), blocks).alias("block"),
                         *[_lane_bits(F.col("url"), i).alias(f"bits{i}") for i in range(4)])
    return rows.groupBy("block").agg(*[F.bit_or(f"bits{i}").alias(f"lane{i}") for i in range(4)])


def filter_table(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, and whether the URL
    passed the filter and is listed."""
    listed = common.stored(listed.where(F.col("url").isNotNull()).select("url").distinct(), "listed-urls")
    blocks = max(1, -(-listed.count() * BITS_PER_URL // BLOCK_BITS))
    bloom = common.stored(bloom_filter(listed, blocks), "listed-bloom").withColumnRenamed("block", "_block")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = (pages.select("page_id", "url").withColumn("host", host).withColumn("path", path)
            .withColumn("r", deciding_rule(F.col("host"), F.col("path"), rules))
            .withColumn("key", F.when(F.col("r").isNull(), canonical(F.col("url")))))
    ruled = rows.where("r IS NOT NULL").select("page_id", "host", "path", "r.rule", "r.verdict",
                                               F.lit(False).alias("possible"), F.lit(False).alias("listed"))
    open_ = rows.where("r IS NULL").withColumn("block", _block(F.col("key"), blocks))
    bits = [_lane_bits(F.col("key"), i) for i in range(4)]
    inside = F.lit(True)
    for i, b in enumerate(bits):
        inside = inside & (F.col(f"lane{i}").bitwiseAND(b) == b)
    bloom = common.broadcast_if_small(bloom, MAX_BROADCAST_BLOCKS)
    probed = (open_.join(bloom, F.col("block") == F.col("_block"), "left")
              .withColumn("possible", F.col("key").isNotNull() & F.coalesce(inside, F.lit(False))))
    exact = common.broadcast_if_light(listed.withColumnRenamed("url", "_url"), F.octet_length("_url"), MAX_BROADCAST_BYTES)
    hit = (probed.where("possible").join(exact, F.col("key") == F.col("_url"), "left")
           .withColumn("listed", F.col("_url").isNotNull()))
    miss = probed.where("NOT possible").withColumn("listed", F.lit(False))
    free = hit.select("page_id", "host", "path", "possible", "listed").unionByName(
        miss.select("page_id", "host", "path", "possible", "listed"))
    free = free.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
                       F.when(F.col("listed"), BLOCK).otherwise(ALLOW).alias("verdict"), "possible", "listed")
    return ruled.unionByName(free)
