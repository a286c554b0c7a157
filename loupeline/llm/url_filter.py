"""URL filter: override rules first, then exact list membership from a cascade of Bloom filters.

Level 1 encodes the listed keys, level 2 the unlisted keys of the corpus that level 1 lets through, level 3 the listed
keys that level 2 lets through, and so on until nobody is let through wrongly. A key is listed when the first level that
does not hold it is an even one (or, holding all, when the number of levels is odd). Over the keys the cascade was built from this is exact, and judging a url
needs no join: every level is one bit array, read as a scalar subquery. All of it is built-in column functions.

The arrays grow with the list (about 1.44 log2(corpus keys / listed keys) + 6 bits per listed key), not with the corpus;
``MAX_BITS`` bounds one level and a longer list is refused with an error instead of being broadcast.

Null urls and urls without ``://`` have an empty host and path, fit no rule and are allowed. Repeated rows are judged
each; other columns of the input are kept unless the result has a column of that name.
"""
from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from loupeline.session import written

MAX_BITS = 1 << 30
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise(F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def longest_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest fitting rule, null without one; of equally long rules a blocking one wins."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == "block")):
        fits = _fits(rule, host, path)
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def domain_keys(host: Column, labels: int) -> list[Column]:
    """The host's last 1 to ``labels`` labels: with the longest listed key's count, no other suffix can be listed."""
    return [F.substring_index(host, ".", -n) for n in range(1, labels + 1)]


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``bits`` is a stored one-row table with an array of 64-bit words."""

    bits: DataFrame
    size: int
    hashes: int
    seed: int

    def holds(self, key: Column) -> Column:
        found = F.lit(True)
        for place in _places(key, self.size, self.hashes, self.seed):
            word = F.get(self.bits.scalar(), F.shiftright(place, 6).cast("int"))
            found = found & (F.getbit(word, (place % 64).cast("int")) == 1)
        return found


def _places(key: Column, size: int, hashes: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed), F.lit(i)), F.lit(size)) for i in range(hashes)]


def _level(keys: DataFrame, n: int, rate: float, seed: int) -> Level:
    """A filter of the ``n`` keys with a false positive rate near ``rate``."""
    hashes = max(1, math.ceil(-math.log2(rate)))
    size = 64 * max(1, math.ceil(n * hashes / math.log(2) / 64))
    if size > MAX_BITS:
        raise ValueError(f"a level of {size} bits is over the bound of {MAX_BITS}; cut the list into several filters")
    place = F.explode(F.array(*_places(F.col("key"), size, hashes, seed)))
    words = (keys.select(place.alias("p")).select(F.shiftright("p", 6).alias("w"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("b"))
             .unionByName(keys.sparkSession.range(size // 64).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("b")))
             .groupBy("w").agg(F.bit_or("b").alias("b")))
    row = words.agg(F.transform(F.sort_array(F.collect_list(F.struct("w", "b"))), lambda x: x["b"]).alias("bits"))
    return Level(written(row, "url-level"), size, hashes, seed)


class Cascade:
    def __init__(self, levels: Sequence[Level]):
        self.levels = list(levels)

    def listed(self, key: Column) -> Column:
        """Exact for every key of the universe the cascade was built from."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels), 0, -1):
            answer = F.when(~self.levels[i - 1].holds(key), F.lit(i % 2 == 0)).otherwise(answer)
        return answer


def build_cascade(corpus_keys: DataFrame, listed: DataFrame) -> Cascade:
    """Cascade over the distinct keys of both tables (one column ``key`` each); nulls are left out."""
    keys = written(corpus_keys.select(F.col("key"), F.lit(False).alias("on")).unionByName(listed.select("key", F.lit(True).alias("on")))
                   .where("key is not null").groupBy("key").agg(F.max("on").alias("on")), "url-keys")
    count = {r["on"]: r["n"] for r in keys.groupBy("on").agg(F.count("*").alias("n")).collect()}
    here, there = keys.where("on"), keys.where("not on")
    n, m = count.get(True, 0), count.get(False, 0)
    levels: list[Level] = []
    while n:
        rate = min(0.5, max(math.sqrt(0.5) * n / max(m, 1), 2.0 ** -40)) if not levels else 0.25
        level = _level(here, n, rate, len(levels) + 1)
        levels.append(level)
        here, there = written(there.where(level.holds(F.col("key"))), "url-through"), here
        n, m = here.count(), n
    return Cascade(levels)


def judge_urls(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``listed`` (host or a parent domain is on the list) and ``verdict``."""
    host, path = url_parts(F.col(url))
    labels = listed.agg(F.max(F.size(F.split("key", r"\."))).alias("n")).first()["n"] or 1
    parts = (pages.select(host.alias("_host")).groupBy("_host").count()
             .select(F.explode(F.array(*domain_keys(F.col("_host"), labels))).alias("key")).where("key <> ''"))
    cascade = build_cascade(parts, listed)
    out = ("host", "path", "rule", "listed", "verdict")
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in out]
    text, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    on_list = F.lit(False)
    for key in domain_keys(F.col("host"), labels):
        on_list = on_list | ((key != "") & cascade.listed(key))
    return (pages.select(*kept, host.alias("host"), path.alias("path"))
            .select(*kept, "host", "path", text.alias("rule"), on_list.alias("listed"), verdict.alias("_verdict"))
            .select(*kept, "host", "path", "rule", "listed", F.coalesce("_verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict")))
