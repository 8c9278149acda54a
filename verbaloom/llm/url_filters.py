"""Url rules and Bloom filter cascades (operator 10), in DataFrame operations only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbaloom.sources.tables import stage

# A cascade is evaluated as a constant in every task, so its size is checked: above this
# many bytes membership is found by an exact join instead.
MAX_CASCADE_BYTES = 64 << 20
WORD = 64


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. A null
    url or one without ``://`` has an empty host."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    capitals = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.translate(raw, capitals, capitals.lower())


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty where the host would be."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


@dataclass(frozen=True)
class Rule:
    """``block`` or ``allow`` for a host, its subdomains and a path prefix."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, of_host: Column, of_path: Column) -> Column:
        same = (of_host == self.host) | of_host.endswith("." + self.host)
        return same & of_path.startswith(self.path)


def longest_rule(rules: list[Rule], of_host: Column, of_path: Column) -> tuple[Column, Column]:
    """The text and the verdict of the longest rule that fits, or nulls. Of rules of one
    length the first given wins."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = rule.fits(of_host, of_path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


@dataclass
class Level:
    """One Bloom filter: its bits as a one-row table of 64-bit words."""

    number: int
    bits: int
    hashes: int
    words: DataFrame

    def might_contain(self, key: Column) -> Column:
        words = self.words.scalar()
        held = F.lit(True)
        for at in _positions(key, self.number, self.bits, self.hashes):
            word = F.get(words, F.floor(at / WORD).cast("int"))
            held &= F.getbit(word, (at % WORD).cast("int")) == 1
        return held


def _positions(key: Column, number: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(number), F.lit(i)), F.lit(bits)) for i in range(hashes)]


class Cascade:
    """Exact membership of a listed set among the keys of a universe.

    The first filter holds the listed keys. The second holds the keys of the universe that
    are not listed but pass the first; the third the listed keys that pass the second;
    and so on until no key passes wrongly. The parity of the first filter that a key
    fails then tells whether it is listed, without error for every key of the universe.
    """

    def __init__(self, levels: list[Level], exact: DataFrame | None = None):
        self.levels, self.exact = levels, exact

    def contains(self, key: Column) -> Column:
        """Whether a key of the universe is listed; null is not."""
        found = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            passes = level.might_contain(key)
            found = F.when(passes, found).otherwise(F.lit(level.number % 2 == 0))
        return F.when(key.isNull(), F.lit(False)).otherwise(found)

    def mark(self, df: DataFrame, key: str, name: str) -> DataFrame:
        """``df`` with a boolean column ``name``: the row's key is listed."""
        if self.exact is None:
            return df.withColumn(name, self.contains(F.col(key)))
        listed = self.exact.select(F.col("key").alias(key), F.lit(True).alias(name))
        return df.drop(name).join(listed, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def build_cascade(
    listed: DataFrame, universe: DataFrame, max_bytes: int = MAX_CASCADE_BYTES
) -> Cascade:
    """The cascade of two one-column tables of string keys, ``key``.

    Listed keys that the universe does not have are left out, and repeated and null keys
    of either table count once or not at all. An empty list has no filter: nothing is
    listed. Each filter is written as words of bits, which tasks set for their keys and
    merge before and after the shuffle, so no task holds the keys.
    """
    universe = stage(universe.where("key is not null").distinct(), "key-universe")
    members = stage(listed.where("key is not null").distinct().join(universe, "key", "left_semi"), "listed")
    others = universe.join(members, "key", "left_anti")
    n_in, n_out = members.count(), others.count()
    levels: list[Level] = []
    inside, outside, used = members, others, 0
    while n_in:
        # The sizes that keep the whole cascade short: one strict filter, then halves.
        rate = min(0.5, math.sqrt(0.5) * n_in / n_out) if not levels and n_out else 0.5
        hashes = max(1, round(math.log2(1 / rate)))
        words = max(1, math.ceil(n_in * 1.4427 * math.log2(1 / rate) / WORD))
        used += 8 * words
        if used > max_bytes:
            return Cascade([], members)
        level = Level(len(levels) + 1, words * WORD, hashes, None)
        level.words = stage(_filled(inside, level, words), "bloom-words")
        levels.append(level)
        passed = stage(outside.where(level.might_contain(F.col("key"))), "bloom-passed")
        inside, outside = passed, inside
        n_in, n_out = passed.count(), n_in
    return Cascade(levels)


def _filled(keys: DataFrame, level: Level, words: int) -> DataFrame:
    """One row: the words of a filter, in order. Their number is bounded by the caller."""
    at = F.explode(F.array(*_positions(F.col("key"), level.number, level.bits, level.hashes)))
    spots = keys.select(at.alias("at")).select(
        F.floor(F.col("at") / WORD).alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % WORD).cast("int")).alias("bits"),
    )
    empty = keys.sparkSession.range(words).select(
        F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits")
    )
    merged = spots.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return merged.agg(F.transform(ordered, lambda x: x["bits"]).alias("words"))


def judge(
    pages: DataFrame, rules: list[Rule], cascade: Cascade, url: str = "url"
) -> DataFrame:
    """``pages`` with host, path, rule, listed and verdict.

    The longest fitting rule decides; where none fits, a listed host is blocked and any
    other allowed. A null or malformed url has an empty host and path. Earlier columns of
    these names are replaced. No join and no shuffle, however many rows share a host.
    """
    found = pages.withColumns({"host": host(F.col(url)), "path": path(F.col(url))})
    found = cascade.mark(found, "host", "listed")
    text, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    other = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return found.withColumns({"rule": text, "verdict": F.coalesce(verdict, other)})
