"""URL filtering: longest-prefix rules, and a Bloom filter cascade for exact membership in a key list.

DataFrame functions only. Level 0 of the cascade holds the listed keys; level 1 the unlisted keys of
the corpus that level 0 lets through; level 2 the listed keys that level 1 lets through; and so on
until a level lets none through. Over the keys it was built for, the first level that rejects a key
says whether it is listed (an even level: no; an odd one: yes), so pages never meet the keys themselves.

Levels travel as literals of the plan, after a check of their size (`most_bits`, 2 MB, about two million
listed keys). A longer list has a cascade for each of many shards of the keys by their hash, of about
`shard_keys` listed keys each: a shard's levels are one row, which is sent to the pages of the shard. The
verdict comes from the same cascade then, and no level is larger than a shard.

Null url, or none with `://`: host and path are empty, no rule, and its key is looked up as any other.
Repeated rows and ties get the same verdict. Very long urls: whole. Null page_id: a page like others. Extra
columns pass through; own columns named host, path, rule or verdict are replaced. Empty table: no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm.common import fresh, materialize, table

#: Host suffix, start of the path, verdict.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
BITS_A_KEY, HASHES = 8, 4
#: Bits of a level that may be a literal; listed keys of a shard of a longer list.
MOST_BITS, SHARD_KEYS = 1 << 24, 1 << 14
_AZ, _az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_host_path(pages: DataFrame) -> DataFrame:
    rest = F.coalesce(F.regexp_extract("url", r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": F.translate(host, _AZ, _az), "path": path})


def rule_column(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits: the longest host suffix and path together; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, what in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _places(key: Column, level: int, bits: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level * 16 + j)), bits) for j in range(HASHES)]


def _hit(key: Column, level: int, bits: Column, cells: Column) -> Column:
    """Whether a level lets a key through; cells: its 32-bit words. False where there is no level."""
    hit = F.lit(True)
    for at in _places(key, level, bits):
        cell = F.get(cells, F.floor(at / 32).cast("int"))
        hit = hit & (F.call_function("bit_get", cell, (at % 32).cast("int")) == 1)
    return F.coalesce(hit, F.lit(False))


def _words(keys: DataFrame, level: int, bits: Column, *by: str) -> DataFrame:
    """(by, word, value): the 32-bit words of Bloom filters over keys; a partial aggregate of bit_or."""
    at = keys.select(*by, F.explode(F.array(*_places(F.col("key"), level, bits))).alias("at"))
    bit = at.select(*by, F.floor(F.col("at") / 32).cast("int").alias("word"), F.expr("shiftleft(1L, cast(at % 32 as int))").alias("bit"))
    return bit.groupBy(*by, "word").agg(F.bit_or("bit").alias("value"))


def _decide(hits: list[Column]) -> Column:
    """The first level that rejects a key decides; past the last level, its parity does."""
    out = F.lit(len(hits) % 2 == 1)
    for level in reversed(range(len(hits))):
        out = F.when(~hits[level], F.lit(level % 2 == 1)).otherwise(out)
    return out


def _bits_for(n):
    return F.greatest(F.lit(64), F.ceil(n * BITS_A_KEY / 64) * 64).cast("long")


class Cascade:
    """Levels as texts of comma-joined words, which Catalyst folds into one array literal each."""

    def __init__(self, levels: list[tuple[int, str]]):
        self.levels = levels

    @staticmethod
    def hit(key: Column, level: int, bits: int, words: str) -> Column:
        return _hit(key, level, F.lit(bits), F.split(F.lit(words), ",").cast("array<bigint>"))

    def judge(self, df: DataFrame, key: Column, name: str) -> DataFrame:
        """df with a column `name`: whether the key is listed."""
        return df.withColumn(name, _decide([self.hit(key, i, *x) for i, x in enumerate(self.levels)]))


class ShardedCascade:
    """(shard, l0, l1, ...): a row a shard, each level a struct of bits and words, null where the shard's cascade has ended."""

    def __init__(self, shards: int, levels: DataFrame, n: int):
        self.shards, self.levels, self.n = shards, levels, n

    def judge(self, df: DataFrame, key: Column, name: str) -> DataFrame:
        at, held = fresh(df, "shard_of_key"), fresh(df, "levels_of_shard")
        dealt = df.withColumn(at, shard_of(key, self.shards))
        rows = self.levels.select(F.col("shard").alias(at), F.struct(*(f"l{i}" for i in range(self.n))).alias(held))
        level = lambda i: F.col(held)[f"l{i}"]
        listed = _decide([_hit(key, i, level(i)["bits"], level(i)["words"]) for i in range(self.n)])
        return dealt.join(rows, at, "left").withColumn(name, listed).select(*(F.col(f"`{c}`") for c in df.columns if c != name), name)


def shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(shards)).cast("int")


def _literal_level(keys: DataFrame, level: int, n: int) -> tuple[int, str]:
    bits = max(64, math.ceil(n * BITS_A_KEY / 64) * 64)
    found = {r["word"]: r["value"] for r in _words(keys, level, F.lit(bits)).collect()}
    return bits, ",".join(str(found.get(i, 0)) for i in range(bits // 32))


def _row_level(keys: DataFrame, level: int) -> DataFrame:
    """(shard, l): keys (shard, key); every word of a level is a row before it is a cell, zeros too."""
    sizes = keys.groupBy("shard").agg(_bits_for(F.count("*")).alias("bits"))
    zeros = sizes.select("shard", "bits", F.explode(F.sequence(F.lit(0), (F.col("bits") / 32 - 1).cast("int"))).alias("word"), F.lit(0).cast("long").alias("value"))
    set_bits = _words(keys.join(sizes, "shard"), level, F.col("bits"), "shard", "bits")
    words = zeros.unionByName(set_bits).groupBy("shard", "bits", "word").agg(F.bit_or("value").alias("value"))
    lists = words.groupBy("shard", "bits").agg(F.array_sort(F.collect_list(F.struct("word", "value"))).alias("w"))
    return lists.select("shard", F.struct("bits", F.col("w")["value"].alias("words")).alias(f"l{level}"))


def build_cascade(keys: DataFrame, most_bits: int = MOST_BITS, shard_keys: int = SHARD_KEYS) -> Cascade | ShardedCascade:
    """keys: (key, listed), distinct: the corpus's complete key universe. Literal levels if each is within most_bits, else shards."""
    yes, no = keys.where("listed").select("key"), keys.where("not listed").select("key")
    levels: list[tuple[int, str]] = []
    held, against, n = yes, no, yes.count()
    if n * BITS_A_KEY > most_bits:
        return _build_shards(yes, no, max(1, -(-n // shard_keys)))
    while n:
        at = len(levels)
        levels.append(_literal_level(held, at, n))
        passed = materialize(against.where(Cascade.hit(F.col("key"), at, *levels[at])))
        held, against, n = passed, held, passed.count()
        if n * BITS_A_KEY > most_bits:  # a list much shorter than what is let through
            return _build_shards(yes, no, max(1, -(-n // shard_keys)))
    return Cascade(levels)


def _build_shards(yes: DataFrame, no: DataFrame, shards: int) -> ShardedCascade:
    held, against = (x.select(shard_of(F.col("key"), shards).alias("shard"), "key") for x in (yes, no))
    levels, at = None, 0
    while not held.isEmpty():
        level = materialize(_row_level(held, at))
        passed = against.join(level, "shard").where(_hit(F.col("key"), at, F.col(f"l{at}")["bits"], F.col(f"l{at}")["words"])).select("shard", "key")
        held, against = materialize(passed), held
        levels = level if levels is None else levels.join(level, "shard", "full_outer")
        at += 1
    return ShardedCascade(shards, materialize(levels), at)


def filter_urls(pages: DataFrame, is_listed: Column, rules: Sequence[tuple[str, str, str]] = RULES, most_bits: int = MOST_BITS, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """pages with host, path, rule and verdict.

    is_listed: whether a key (host + path) is on the block list, asked once for each distinct key
    when the cascade is built; pages are then judged by the cascade alone. A page without a rule is
    blocked if its key is listed.
    """
    rule, verdict = rule_column(rules)
    judged = with_host_path(pages).withColumns({"rule": rule, "verdict": verdict})
    key = F.concat("host", "path")
    universe = materialize(judged.where("rule is null").select(key.alias("key")).distinct().withColumn("listed", is_listed))
    name = fresh(judged, "is_listed")
    found = build_cascade(universe, most_bits, shard_keys).judge(judged, key, name)
    return found.withColumn("verdict", F.coalesce("verdict", F.when(F.col(name), "block").otherwise("allow"))).drop(name)


def stand_in_list(key: Column) -> Column:
    """No block list comes with the tables: one key in eight, by its MD5, stands in for it."""
    return F.substring(F.md5(key), 1, 1).isin("0", "1")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, stand_in_list(F.col("key"))).select("page_id", "host", "path", "rule", "verdict")


OP8_SQL = r"""
with cut as (select page_id, case when strpos(coalesce(url, ''), '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
parts as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut),
ruled as (select *, '.' || host as h, case
  when ends_with('.' || host, '.example.org') and starts_with(path, '/en/1') then 'example.org/en/1'
  when ends_with('.' || host, '.example.org') and starts_with(path, '/es/') then 'example.org/es/'
  when ends_with('.' || host, '.com') and starts_with(path, '/fr/') then 'com/fr/'
  when ends_with('.' || host, '.com') and starts_with(path, '/de/') then 'com/de/'
  when ends_with('.' || host, '.org') and starts_with(path, '/') then 'org/' end as rule from parts)
select page_id, host, path, rule, case
  when rule in ('example.org/en/1', 'example.org/es/', 'com/de/') then 'block' when rule is not null then 'allow'
  when substr(md5(host || path), 1, 1) in ('0', '1') then 'block' else 'allow' end as verdict
from ruled
"""
