"""URL filters: longest-rule verdicts, and a Bloom filter cascade for all other urls.

A cascade encodes a list of keys exactly over a known universe. Level 1 is a Bloom filter of
the listed keys; level 2 one of the unlisted keys that pass level 1; level 3 one of the listed
keys that pass level 2, and so on until nothing passes wrongly. A key leaves the cascade at the
first level that it fails, and the level's parity says whether it is listed. Membership of
every universe key is therefore exact, and a test is a few bit reads: no join.

Only DataFrame functions are used. Keys travel as two 64-bit hashes; bits are set with
``bit_or`` per 32-bit word after a partial aggregation, so that neither many nor repeated keys
gather in a task. Filters are cut into shards of at most ``SHARD_KEYS`` listed keys by key hash.
One shard (a few MB) is a literal of the plan; more stay a table, and pages
meet their shard's filters in an equi-join.

Defined cases: a null url, or one without ``://``, has empty host and path, fits no rule, is in no
list and is allowed. Repeated rows are judged each. An empty list gives no levels and allows.
Extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import ascii_lower, written

#: (action, host, path); a rule fits its host and subdomains if the path starts with its path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
SHARD_KEYS = 4_000_000
MAX_LEVELS = 64


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, parts, i), F.lit("")) for i in (1, 2))
    return ascii_lower(host), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its action, or nulls."""
    name = action = F.lit(None).cast("string")
    for verb, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        action = F.when(fits, F.lit(verb)).otherwise(action)
    return name, action


def key_hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("cascade"), key).alias("h2")]


@dataclass(frozen=True)
class Level:
    """Size of one level's filters: 32-bit words per shard, and hash functions."""

    number: int
    words: int
    hashes: int


@dataclass(frozen=True)
class Cascade:
    """Levels, number of shards, and the filters as rows ``(shard, filters array<binary>)``."""

    levels: tuple[Level, ...]
    shards: int
    filters: DataFrame | None

    def test(self, df: DataFrame, h1: str, h2: str, out: str) -> DataFrame:
        """``df`` with the boolean column ``out``; null hashes are never listed."""
        if not self.levels:
            return df.withColumn(out, F.lit(False))
        if self.shards == 1:
            bits = self.filters.head()["filters"]
            return df.withColumn(out, self._listed([F.lit(bytearray(b)) for b in bits], h1, h2))
        return (
            df.withColumn("__shard", _shard(F.col(h1), self.shards))
            .join(self.filters.select(F.col("shard").alias("__shard"), F.col("filters").alias("__filters")), "__shard", "left")
            .withColumn(out, self._listed([F.get("__filters", F.lit(i)) for i in range(len(self.levels))], h1, h2))
            .drop("__shard", "__filters")
        )

    def _listed(self, bits: list[Column], h1: str, h2: str) -> Column:
        listed = F.lit(len(self.levels) % 2 == 1)
        for level, b in reversed(list(zip(self.levels, bits, strict=True))):
            listed = F.when(_passes(b, level, F.col(h1), F.col(h2)), listed).otherwise(F.lit(level.number % 2 == 0))
        return F.col(h1).isNotNull() & F.coalesce(listed, F.lit(False))


def _shard(h1: Column, shards: int) -> Column:
    return F.pmod(h1, F.lit(shards)).cast("int")


def _positions(level: Level, h1: Column, h2: Column) -> list[Column]:
    size = F.lit(level.words * 32).cast("long")
    return [F.pmod(F.xxhash64(h1, h2, F.lit(level.number), F.lit(i)), size) for i in range(level.hashes)]


def _passes(bits: Column, level: Level, h1: Column, h2: Column) -> Column:
    """All bits of the key are set; bytes are big-endian within the filter."""

    def is_set(at: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return byte.bitwiseAND(F.element_at(F.array(*[F.lit(128 >> i) for i in range(8)]), (at % 8 + 1).cast("int"))) != 0

    found = F.lit(True)
    for at in _positions(level, h1, h2):
        found = found & is_set(at)
    return found


def _encode(keys: DataFrame, level: Level, shards: int) -> DataFrame:
    """``(shard, bits)`` of one level: a bit set for each position of each key."""
    ones = keys.select(
        _shard(F.col("h1"), shards).alias("shard"),
        F.explode(F.array(*_positions(level, F.col("h1"), F.col("h2")))).alias("at"),
    ).select(
        "shard",
        F.floor(F.col("at") / 32).alias("word"),
        F.expr("shiftleft(1L, cast(31 - at % 32 as int))").alias("bit"),
    )
    blank = keys.sparkSession.range(shards * level.words).select(
        (F.col("id") / level.words).cast("int").alias("shard"),
        (F.col("id") % level.words).alias("word"),
        F.lit(0).cast("long").alias("bit"),
    )
    words = ones.unionByName(blank).groupBy("shard", "word").agg(F.bit_or("bit").alias("bits"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: F.lpad(F.hex(x["bits"]), 8, "0")), "")
    return words.groupBy("shard").agg(F.unhex(text).alias("bits"))


def build_cascade(universe: DataFrame, listed: DataFrame, shard_keys: int = SHARD_KEYS) -> Cascade:
    """The cascade of ``listed`` over ``universe``; both have one column ``key``, nulls drop out.

    A listed key outside the universe joins it. Counts and bits of each level are of all keys.
    """
    flagged = universe.select("key", F.lit(0).alias("l")).unionByName(listed.select("key", F.lit(1).alias("l")))
    keys = written(
        flagged.filter(F.col("key").isNotNull()).select(*key_hashes(F.col("key")), "l").groupBy("h1", "h2").agg(F.max("l").alias("l")),
        "cascade-keys",
    )
    count = {r["l"]: r["count"] for r in keys.groupBy("l").count().collect()}
    encoded, other = keys.filter("l = 1").drop("l"), keys.filter("l = 0").drop("l")
    n, rest = count.get(1, 0), count.get(0, 0)
    shards = max(1, math.ceil(n / shard_keys))
    levels: list[Level] = []
    filters: DataFrame | None = None
    while n:
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("the cascade does not end: two keys have the same hashes")
        hashes = max(2, math.ceil(math.log2(1 + rest / n)) + 2)
        level = Level(len(levels) + 1, max(2, math.ceil(1.45 * hashes * n / shards / 32)), hashes)
        levels.append(level)
        bits = _encode(encoded, level, shards).select("shard", F.array("bits").alias("filters"))
        filters = written(
            bits if filters is None else filters.join(bits.withColumnRenamed("filters", "more"), "shard").select("shard", F.concat("filters", "more").alias("filters")),
            "cascade-filters",
        )
        one = Cascade((level,), shards, filters.select("shard", F.slice("filters", level.number, 1).alias("filters")))
        wrong = written(_passing(one, other), "cascade-wrong")
        encoded, other, n, rest = wrong, encoded, wrong.count(), n
    return Cascade(tuple(levels), shards, filters)


def _passing(one: Cascade, keys: DataFrame) -> DataFrame:
    level = one.levels[0]
    if one.shards == 1:
        bits = F.lit(bytearray(one.filters.head()["filters"][0]))
        return keys.filter(_passes(bits, level, F.col("h1"), F.col("h2")))
    table = one.filters.select("shard", F.get("filters", F.lit(0)).alias("bits"))
    met = keys.withColumn("shard", _shard(F.col("h1"), one.shards)).join(table, "shard")
    return met.filter(_passes(F.col("bits"), level, F.col("h1"), F.col("h2"))).select("h1", "h2")


def judge_urls(pages: DataFrame, listed: DataFrame | None = None, rules=RULES, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """page_id, host, path, rule, verdict of every row; ``listed`` has a column ``key`` (host and path).

    The rule's action decides; without a rule, listed keys are blocked and others allowed.
    """
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    key = F.when(F.col("host") != "", F.concat("host", "path"))
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    keyed = parts.select("*", rule.alias("rule"), action.alias("action"), key.alias("key"))
    if listed is None:
        listed = listed_keys(keyed)
    cascade = build_cascade(keyed.select("key"), listed, shard_keys)
    h1, h2 = (F.when(F.col("key").isNotNull(), c) for c in (F.xxhash64("key"), F.xxhash64(F.lit("cascade"), "key")))
    tested = cascade.test(keyed.withColumns({"h1": h1, "h2": h2}), "h1", "h2", "listed")
    verdict = F.coalesce("action", F.when(F.col("listed"), "block").otherwise("allow"))
    return tested.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "listed")


#: Host labels of the block list of the query: a key is listed if a part of its host is one of them.
LISTED_LABELS = ("spam", "pills", "casino", "adult", "phish", "malware")


def listed_keys(keyed: DataFrame) -> DataFrame:
    """The keys whose host has a part, between dots and hyphens, on the list."""
    parts = F.split("host", "[.-]")
    return keyed.filter(F.arrays_overlap(parts, F.array(*map(F.lit, LISTED_LABELS)))).select("key")
