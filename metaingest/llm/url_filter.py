"""URL filters: host rules, and exact membership by a cascade of Bloom filters.

A cascade answers for every key of a known universe whether it is listed.
Level 1 is a Bloom filter of the listed keys, level 2 one of the keys that
level 1 accepts wrongly, level 3 one of the listed keys that level 2 accepts,
and so on until no key is wrong. The first level that rejects a key decides:
an odd one means not listed, an even one listed. Filters are bitmaps in scalar
subqueries, so that a row is judged by expressions alone, with no join.

Keys are dealt into ``n_blocks`` blocks by hash such that no bitmap passes
``MAX_KEYS`` keys; each block's bitmaps are subqueries of their own. All of it
is DataFrame operations.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage

BITS_A_KEY = 12
HASHES = 5
#: Keys of one bitmap at most on average: 6 MB at 12 bits.
MAX_KEYS = 4_000_000


class Rule(NamedTuple):
    action: str
    host: str
    path: str


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path: after the first ``://`` to ``/``, ``?`` or ``#``, A-Z
    lower-cased, and from there to ``?`` or ``#``. Both are empty if ``url`` is
    null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(host, F.lit("")), upper, upper.lower()), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and action of the longest rule that fits, else null. A rule fits
    its host and subdomains where the path starts with the rule's."""
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.host + rule.path).otherwise(text)
        action = F.when(fits, rule.action).otherwise(action)
    return text, action


class Cascade(NamedTuple):
    """Bitmaps by block and level, each a frame of one row with one array."""

    blocks: list[list[tuple[DataFrame, int]]]

    def contains(self, key: Column) -> Column:
        """Whether a key of the universe is listed. Null is not."""
        inside = F.lit(False)
        for block, levels in enumerate(self.blocks):
            answer = F.lit(len(levels) % 2 == 1)
            for level in range(len(levels), 0, -1):
                bitmap, bits = levels[level - 1]
                passed = _passes(bitmap.scalar(), key, level, bits)
                answer = F.when(passed, answer).otherwise(level % 2 == 0)
            inside = F.when(_block(key, len(self.blocks)) == block, answer).otherwise(inside)
        return F.coalesce(F.when(key.isNotNull(), inside), F.lit(False))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("block")), F.lit(blocks))


def _positions(key: Column, level: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(k)), F.lit(bits)) for k in range(HASHES)]


def _passes(bitmap: Column, key: Column, level: int, bits: int) -> Column:
    def is_set(position: Column) -> Column:
        word = F.get(bitmap, F.floor(position / 64).cast("int"))
        return F.getbit(word, (position % 64).cast("int")) == 1

    return reduce(lambda a, b: a & b, (is_set(p) for p in _positions(key, level, bits)))


def _bitmap(keys: DataFrame, level: int, bits: int) -> DataFrame:
    """One row with the filter's words in order, zero words included."""
    positions = keys.select(F.explode(F.array(*_positions(F.col("key"), level, bits))).alias("at"))
    words = positions.groupBy(F.floor(F.col("at") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(at % 64))")).alias("bits")
    )
    every = keys.sparkSession.range((bits + 63) // 64).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = words.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return words.agg(F.transform(ordered, lambda x: x["bits"]).alias("bitmap"))


def build_cascade(universe: DataFrame, key: str, is_listed: Column, max_keys: int = MAX_KEYS) -> Cascade:
    """A cascade over the distinct non-null ``key`` of ``universe``. A key is
    listed if ``is_listed`` holds in any of its rows."""
    keys = (
        universe.select(F.col(key).alias("key"), F.coalesce(is_listed, F.lit(False)).alias("listed"))
        .filter("key is not null")
        .groupBy("key")
        .agg(F.max("listed").alias("listed"))
    )
    keys = stage(keys, "url-keys")
    blocks = -(-max(1, keys.count()) // max_keys)
    return Cascade([_levels(keys.filter(_block(F.col("key"), blocks) == b), b) for b in range(blocks)])


def _levels(keys: DataFrame, block: int) -> list[tuple[DataFrame, int]]:
    """Levels until no key of the other kind passes. ``inside`` go into the
    next bitmap, ``others`` are those that must not pass it."""
    inside, others = keys.filter("listed").select("key"), keys.filter("not listed").select("key")
    levels: list[tuple[DataFrame, int]] = []
    while (count := inside.count()) or not levels:
        level, bits = len(levels) + 1, max(64, count * BITS_A_KEY)
        bitmap = stage(_bitmap(inside, level, bits), "url-bitmap")
        levels.append((bitmap, bits))
        wrong = others.filter(_passes(bitmap.scalar(), F.col("key"), level, bits))
        inside, others = stage(wrong, "url-wrong"), inside
    return levels


def judge_urls(
    pages: DataFrame, listed_host: Column, rules: list[Rule], url: str = "url", max_keys: int = MAX_KEYS
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; columns with
    these names are replaced.

    The longest fitting rule decides, else the host: it is blocked if it is in
    the cascade. ``listed_host`` says of a row whether its ``host`` is listed.
    An empty host is allowed.
    """
    host, path = url_parts(F.col(url))
    parts = pages.withColumns({"host": host, "path": path})
    cascade = build_cascade(parts.filter("host <> ''"), "host", listed_host, max_keys)
    rule, action = longest_rule(F.col("host"), F.col("path"), rules)
    other = F.when(cascade.contains(F.col("host")), "block").otherwise("allow")
    return parts.withColumns({"rule": rule, "verdict": F.coalesce(action, other)})


def listed_by_words(words: list[str]) -> Column:
    """Hosts with a label that holds one of ``words``."""
    return F.col("host").rlike("|".join(words))
