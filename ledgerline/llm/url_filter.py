"""URL filters: a blocked Bloom filter of listed canonical URLs before an exact hash join.

A listed URL is a host (with all its subdomains) and the start of a path. A page's URL is
brought into canonical form and spread into the keys under which it could be listed: each
suffix of its host with each path length that occurs in the list. The list's keys fill a
blocked Bloom filter: a key's bits lie in a single block of 512 bits, so a look-up reads one
row of the filter. Keys that pass go to an exact join with the list, which removes the false
positives; the longest listed key decides, among equal ones that of the longer host.

The filter's size follows from the list's length (``BITS_PER_KEY``). Up to
``BROADCAST_BLOCKS`` blocks, a proven 128 MB at most, it is sent to all executors. Beyond,
page keys are made distinct and meet their block in a shuffled join; the result is the same.

Defined cases: a null URL, or one without ``://``, has an empty host and path and fits no
rule, so it gets the default verdict; an empty host has no suffixes; equal keys listed with
different verdicts count as blocked; an empty list lets everything through; page rows are
judged one by one, repeated ones alike; other columns of the input are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 512 bits a block, as eight 64-bit words; each key sets one bit in every word
WORDS = 8
BITS_PER_KEY = 16
#: larger filters are joined by block instead of broadcast
BROADCAST_BLOCKS = 1 << 20


def host_and_path(url: F.Column) -> tuple[F.Column, F.Column]:
    """After the first ``://``: the host up to ``/ ? #``, lower-cased for A-Z, and the path up to ``? #``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, text.substr(at + 3, F.length(text))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def block_of(key: F.Column, blocks: int) -> F.Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(blocks))


def masks_of(key: F.Column) -> list[F.Column]:
    """One bit in each word of the block, from eight 6-bit pieces of a second hash."""
    h = F.xxhash64(key, F.lit(2))
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"),
                            F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(WORDS)]


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter: ``block`` and its words ``w0`` to ``w7``; blocks without a key are left out."""
    marked = keys.select(block_of(F.col(key), blocks).alias("block"),
                         *[m.alias(f"w{i}") for i, m in enumerate(masks_of(F.col(key)))])
    return marked.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def listed_keys(rules: DataFrame) -> DataFrame:
    """``host``, ``path``, ``verdict`` of the list as distinct ``key`` (host and path) with one verdict.

    A path without its leading slash is meant to start at the root.
    """
    path = F.coalesce(F.col("path"), F.lit(""))
    host = F.translate(F.trim("host"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rooted = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    return rules.filter("host is not null and host <> ''").select(
        host.alias("host"), rooted.alias("path"), "verdict").groupBy(
        F.concat("host", "path").alias("key"), F.length("path").alias("path_length"),
        F.size(F.split("host", r"\.")).alias("labels")).agg(
        F.max(F.when(F.col("verdict") == "allow", 0).otherwise(1)).alias("blocks"))


def candidate_keys(host: F.Column, path: F.Column, path_lengths: list[int], max_labels: int) -> F.Column:
    """All keys under which a URL could be listed: every host suffix with every listed path length."""
    labels = F.split(host, r"\.")
    count = F.when(host == "", F.lit(0)).otherwise(F.least(F.size(labels), F.lit(max_labels)))
    suffixes = F.transform(F.sequence(F.lit(1), count), lambda n: F.concat_ws(
        ".", F.slice(labels, F.size(labels) - n + 1, n)))
    suffixes = F.when(count > 0, suffixes).otherwise(F.array().cast("array<string>"))
    starts = F.filter(F.array(*[F.when(F.length(path) >= n, path.substr(F.lit(1), F.lit(n))) for n in path_lengths]),
                      lambda p: p.isNotNull())
    return F.flatten(F.transform(suffixes, lambda s: F.transform(starts, lambda p: F.concat(s, p))))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", broadcast_blocks: int = BROADCAST_BLOCKS) -> DataFrame:
    """``pages`` (``page_id``, ``url``) with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict`` ('allow' or 'block').
    """
    listed = listed_keys(rules)
    found = listed.agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("path_length")).alias("lengths"),
                       F.max("labels").alias("labels")).first()
    host, path = host_and_path(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"))
    if not found["n"]:
        return judged.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    blocks = 1 << max(0, math.ceil(math.log2(found["n"] * BITS_PER_KEY / (64 * WORDS))))
    bloom = bloom_blocks(listed, "key", blocks)
    keys = candidate_keys(F.col("host"), F.col("path"), found["lengths"], found["labels"])
    # distinct places first: a hot host with the same path is looked up once
    places = judged.select("host", "path").distinct()
    probes = places.select("host", "path", F.explode(keys).alias("key")).withColumn("block", block_of(F.col("key"), blocks))
    masks = masks_of(F.col("key"))
    passes = F.lit(True)
    for i, mask in enumerate(masks):
        passes = passes & (F.col(f"w{i}").bitwiseAND(mask) == mask)
    bloom = F.broadcast(bloom) if blocks <= broadcast_blocks else bloom
    possible = probes.join(bloom, "block").filter(passes).select("host", "path", "key")
    hits = possible.join(listed, "key").groupBy("host", "path").agg(
        F.max_by(F.struct("key", "blocks"), F.struct(F.length("key"), F.length("key") - F.col("path_length"))).alias("hit"))
    verdict = F.when(F.col("hit").isNull(), F.lit(default)).when(F.col("hit.blocks") == 1, F.lit("block")).otherwise(F.lit("allow"))
    return judged.join(hits, ["host", "path"], "left").select("page_id", "host", "path", F.col("hit.key").alias("rule"), verdict.alias("verdict"))
