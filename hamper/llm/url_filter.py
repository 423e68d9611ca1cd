"""URL rules behind a blocked Bloom filter (DataFrame functions only).

A rule is a listed canonical prefix ``host + path`` with a verdict. It fits a URL if the
URL's host is the rule's or one of its subdomains and the URL's path starts with the rule's.
A URL's candidate keys are its host suffixes times the prefixes of its path at the listed
path lengths. Each candidate probes a blocked Bloom filter of the listed keys (one block of
eight 64-bit words per key, one bit in each); only possible hits reach the exact hash join,
which removes the false positives. The longest rule that remains decides.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hamper.llm.common import pack, stage

WORDS = 8               # 64-bit words of a block; a key sets one bit in each
BITS_PER_KEY = 16
#: Odd multipliers that spread one 64-bit hash over the words of a block (fixed values).
MULTIPLIERS = [0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31]
#: Filters up to this size are sent to every executor; a larger one is joined by block.
BROADCAST_BYTES = 64 << 20


def host_path(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://``, A-Z lower-cased; null or no ``://``: both empty."""
    u = F.coalesce(url, F.lit(""))
    pattern = r"://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(u, pattern, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(u, pattern, 2)


def _probe(key: Column, n_blocks: int) -> list[Column]:
    """Block number, then one single-bit mask per word of the block."""
    h = F.xxhash64(key)
    low = h.bitwiseAND(F.lit(0xFFFFFFFF))
    block = F.pmod(F.shiftright(h, 32), F.lit(n_blocks)).alias("block")
    one = F.lit(1).cast("long")
    masks = []
    for i, m in enumerate(MULTIPLIERS):
        # the product's low 32 bits, of which the leading six name the bit; a 32 x 32 bit product
        # may leave the long's range, so split the multiplier
        hi, lo = m >> 16, m & 0xFFFF
        product = ((low * lo) + F.shiftleft((low * hi).bitwiseAND(F.lit(0xFFFF)), 16)).bitwiseAND(F.lit(0xFFFFFFFF))
        bit = F.shiftright(product, 26).cast("int")
        masks.append(F.call_function("shiftleft", one, bit).alias(f"m{i}"))
    return [block, *masks]


def build_bloom(keys: DataFrame, n_keys: int) -> tuple[DataFrame, int]:
    """Blocked Bloom filter of the distinct strings in column ``key``: (block, w0..w7), blocks."""
    n_blocks = max(1, -(-n_keys * BITS_PER_KEY // (WORDS * 64)))
    bloom = (keys.select(*_probe(F.col("key"), n_blocks)).groupBy("block")
             .agg(*(F.bit_or(f"m{i}").alias(f"w{i}") for i in range(WORDS))))
    return bloom, n_blocks


def possible_hits(candidates: DataFrame, bloom: DataFrame, n_blocks: int) -> DataFrame:
    """Candidates (column ``key`` and others) that the filter doesn't rule out."""
    names = candidates.columns
    if n_blocks * (WORDS + 1) * 8 <= BROADCAST_BYTES:
        bloom = F.broadcast(bloom)
    c = candidates.select("*", *_probe(F.col("key"), n_blocks)).alias("c")
    b = bloom.alias("b")
    hit = F.col("c.block") == F.col("b.block")
    for i in range(WORDS):
        hit = hit & (F.col(f"b.w{i}").bitwiseAND(F.col(f"c.m{i}")) == F.col(f"c.m{i}"))
    return c.join(b, hit, "left_semi").select(*names)


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Every row of ``pages`` with its host, path, deciding rule and verdict.

    ``rules``: host, path, verdict. Returns row struct (the input row), host, path, rule
    (host + path of the rule, null if none fits), verdict (the rule's, else ``default``:
    a URL that no listed entry matches passes).

    Defined cases: a null URL, or one without ``://``, has empty host and path and fits no
    rule with a host. Longest rule text wins, then the longer host, then the later rule text
    and verdict in code point order; rules with a null part are ignored, repeated rules count
    once; repeated pages get a row each, URLs of any length are judged whole, and the caller's
    columns stay in ``row``, whatever their names. Empty tables give empty results or the default.
    """
    listed = stage(rules.where("host is not null and path is not null and verdict is not null")
                   .select("host", "path", "verdict").distinct()
                   .select("host", "path", F.concat("host", "path").alias("key"), "verdict"), "rules")
    facts = listed.agg(F.countDistinct("key").alias("n"), F.collect_set(F.length("path")).alias("lengths")).first()
    n_keys, lengths = facts["n"], sorted(facts["lengths"])  # lengths: at most that of the longest listed path

    host, path = host_path(F.col(url_col))
    rows = pack(pages, host=host, path=path)
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels) - i + 1), "."))
    fitting = F.filter(F.array(*map(F.lit, lengths)) if lengths else F.array().cast("array<int>"),
                       lambda n: n <= F.length("path"))
    # the verdict depends on host and path alone, so each pair is judged once
    pairs = rows.select("host", "path").distinct()
    candidates = (pairs.select("host", "path", F.explode(suffixes).alias("suffix"))
                  .select("host", "path", "suffix", F.explode(F.transform(
                      fitting, lambda n: F.substring(F.col("path"), F.lit(1), n))).alias("prefix"))
                  .select("host", "path", "suffix", "prefix", F.concat("suffix", "prefix").alias("key")))
    bloom, n_blocks = build_bloom(listed, n_keys)
    hits = possible_hits(candidates, bloom, n_blocks)
    exact = listed.select("key", F.col("host").alias("suffix"), F.col("path").alias("prefix"), "verdict")
    judged = (hits.join(exact, ["key", "suffix", "prefix"])
              .groupBy("host", "path")
              .agg(F.max(F.struct(F.length("key").alias("n"), F.length("suffix").alias("h"), "key", "verdict"))
                   .alias("best"))
              .select("host", "path", F.col("best.key").alias("rule"), F.col("best.verdict").alias("verdict")))
    judged = stage(judged, "judged")
    return (rows.join(judged, ["host", "path"], "left")
            .select("row", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")))
