"""URL filters: prefix rules first, then a list of keys held in a Bloom filter cascade.

Level 1 encodes the listed keys.  Among all keys of the corpus that are not
listed some pass it by chance; level 2 encodes those.  Listed keys that pass
level 2 are encoded in level 3, and so on until nothing passes by chance.  A key
of the corpus is listed exactly if the first level that it fails has an even
number (counting from 1), so filtering needs no join: each level is handed to the
scan as scalar subqueries.  A level of many keys is dealt into shards by a hash of the key, one
array each, so no array grows beyond SHARD_WORDS; all of them together hold
``1.44 * log2(1 / passing)`` bits a key (at most about 8), which executors must have room for.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.llm.text import ascii_lower, filled
from linkmill.plans.lineage import materialize

#: the rules of the registered query: verdict, host, path
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: host labels whose hosts the registered query lists
LISTED_LABELS = ("spam-farm", "cheap-pills", "casino-win")
#: largest share of other keys that may pass a level
PASSING = 0.02
#: 64-bit words of one array (16 MB)
SHARD_WORDS = 1 << 21


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or a url without ://."""
    url = filled(url)
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct of the longest rule that fits, null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = (host == rule_host) | host.endswith("." + rule_host)
        named = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits & path.startswith(rule_path), named).otherwise(found)
    return found


@dataclass(frozen=True)
class Shape:
    """A level's number, shards, words of a shard and hashes of a key."""

    level: int
    shards: int
    words: int
    hashes: int

    def shard(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(self.level * 64 + 63)), F.lit(self.shards)).cast("int")

    def places(self, key: str) -> list[Column]:
        bits = F.lit(self.words * 64)
        return [F.pmod(F.xxhash64(key, F.lit(self.level * 64 + i)), bits) for i in range(self.hashes)]


def _all_set(places: list[Column], bits: Column) -> Column:
    """Whether all places are set in an array of words."""
    found = F.lit(True)
    for place in places:
        word = F.get(bits, F.shiftright(place, 6).cast("int"))
        bit = F.call_function("shiftrightunsigned", word, F.pmod(place, F.lit(64)).cast("int"))
        found = found & (bit.bitwiseAND(F.lit(1)) == 1)
    return found


def _passes(key: str, shape: Shape, arrays: DataFrame) -> Column:
    """Whether ``key`` passes the level whose arrays are the rows ``shard, bits``."""
    found = F.lit(False)
    for shard in range(shape.shards):
        bits = arrays.where(F.col("shard") == shard).select("bits").scalar()
        mine = _all_set(shape.places(key), bits)
        found = mine if shape.shards == 1 else F.when(shape.shard(key) == shard, mine).otherwise(found)
    return found


class Cascade:
    """The filters of all levels."""

    def __init__(self, levels: list[tuple[Shape, DataFrame]]) -> None:
        self.levels = levels

    @staticmethod
    def build(universe: DataFrame, listed: DataFrame, key: str = "key") -> Cascade:
        """Levels over ``universe`` (every key that will be asked) and ``listed`` keys.

        Null keys are left out of both; listed keys that are not in the universe
        are harmless.  A level lets about as many keys pass as it holds, or a
        fiftieth of the rest if that is less.  Each level is written, one row per shard.
        """
        keys = listed.select(F.col(key).alias("key")).where("key is not null").distinct()
        inside = materialize(keys, "listed")
        others = universe.select(F.col(key).alias("key")).where("key is not null").distinct()
        outside = materialize(others.join(inside, "key", "left_anti"), "unlisted")
        levels: list[tuple[Shape, DataFrame]] = []
        held, rest = inside.count(), outside.count()
        while held:
            passing = min(max(held / max(rest, 1), 1e-6), PASSING)
            words = max(1, math.ceil(held * 1.44 * math.log2(1 / passing) / 64))
            shards = -(-words // SHARD_WORDS)
            shape = Shape(len(levels), shards, -(-words // shards), max(1, round(math.log2(1 / passing))))
            levels.append((shape, _filter(inside, shape)))
            inside, outside = materialize(outside.where(_passes("key", *levels[-1])), "passing"), inside
            held, rest = inside.count(), held
        return Cascade(levels)

    def listed(self, rows: DataFrame, key: str = "key") -> DataFrame:
        """``rows`` with ``listed``: exact for keys of the universe; null is not listed."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for level, (shape, arrays) in reversed(list(enumerate(self.levels))):
            answer = F.when(_passes(key, shape, arrays), answer).otherwise(F.lit(level % 2 == 1))
        return rows.withColumn("listed", F.col(key).isNotNull() & answer)


def _filter(keys: DataFrame, shape: Shape) -> DataFrame:
    """One row per shard, each one array of words with the bits of its ``keys`` set."""
    places = F.explode(F.array(*shape.places("key"))).alias("place")
    placed = (
        keys.select(shape.shard("key").alias("shard"), places)
        .groupBy("shard", F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(place, 64) as int))")).alias("bits"))
    )
    word = F.col("id")
    every = keys.sparkSession.range(shape.shards * shape.words).select(
        F.floor(word / shape.words).cast("int").alias("shard"), F.pmod(word, F.lit(shape.words)).alias("word")
    )
    pair = F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits"))
    rows = every.join(placed, ["shard", "word"], "left").groupBy("shard").agg(F.sort_array(F.collect_list(pair)).alias("all"))
    return materialize(rows.select("shard", F.transform("all", lambda x: x["bits"]).alias("bits")), "level")


def judge_urls(pages: DataFrame, listed: DataFrame, rules=RULES, url: str = "url") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``.

    The longest fitting rule decides (a rule fits its host and subdomains and
    paths that start with its path); where none fits, hosts among ``listed(key)``
    are blocked and all others allowed, exactly.  Null or malformed urls have
    empty parts and are allowed.
    """
    host, path = url_parts(F.col(url))
    parted = pages.withColumns({"host": host, "path": path})
    cascade = Cascade.build(parted.select(F.col("host").alias("key")), listed)
    found = cascade.listed(parted, "host").withColumn("_rule", matching_rule(F.col("host"), F.col("path"), rules))
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    return found.withColumns(
        {"rule": F.col("_rule.rule"), "verdict": F.coalesce(F.col("_rule.verdict"), by_list)}
    ).drop("_rule", "listed")


def labelled_hosts(pages: DataFrame, labels=LISTED_LABELS, url: str = "url") -> DataFrame:
    """``key``: hosts of ``pages`` that have one of ``labels`` among their labels."""
    host, _ = url_parts(F.col(url))
    hosts = pages.select(host.alias("key")).distinct()
    return hosts.where(F.arrays_overlap(F.split("key", r"\."), F.array(*map(F.lit, labels))))
