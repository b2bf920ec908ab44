"""URL rules behind a Bloom filter cascade.

A rule is a host with a path prefix (``net/es/``) and fits the host and its
subdomains.  A url has a candidate key for each (host suffix, path prefix) of
the lengths that rules have; the rules that fit it are its candidates that are
listed keys.  The longest wins (of equals, the longer host).

Membership comes from a cascade of Bloom filters.  Level 1 encodes the listed
keys; level 2 the keys of the corpus that level 1 takes for listed; level 3 the
listed keys that level 2 takes for those, and so on until a level takes none
wrongly.  A key is listed if the first level that lacks it is an even one.  As
the levels are built over the corpus's complete key universe, the answer is
exact for every key in it, without a join and without the key strings.

Level 1 is sized so that about as many false positives are expected as there
are listed keys, so every level's size follows the list, not the corpus; a
level's bits come to the driver pre-aggregated in words, and ``MAX_BYTES``
bounds a filter before it goes into the plan.  DataFrame expressions only.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import checkpointed, fresh, lower_ascii, ref

#: Largest filter of a level, in bytes (about 16 million listed keys).
MAX_BYTES = 64 << 20
ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @classmethod
    def parse(cls, rule: str, verdict: str) -> Rule:
        host, slash, path = rule.partition("/")
        return cls(host.lower(), slash + path, verdict)

    @property
    def key(self) -> str:
        return self.host + self.path


class Level(NamedTuple):
    number: int
    n_bits: int
    n_hashes: int
    bits: bytes

    def positions(self, key: Column) -> Column:
        return bit_positions(key, self.number, self.n_bits, self.n_hashes)

    def has(self, key: Column) -> Column:
        """All of the key's bits are set; stops at the first that is not."""
        def is_set(p: Column) -> Column:
            byte = F.substring(F.lit(bytearray(self.bits)), (p / 8).cast("int") + 1, F.lit(1))
            value = F.conv(F.hex(byte), 16, 10).cast("int")
            return F.pmod(F.floor(value / F.pow(F.lit(2.0), p % 8)), F.lit(2)) == 1

        return F.forall(self.positions(key), is_set)


def bit_positions(key: Column, number: int, n_bits: int, n_hashes: int) -> Column:
    """Double hashing with the halves of one 64-bit hash, seeded by the level."""
    h = F.xxhash64(F.lit(number), key)
    a, b = h.bitwiseAND(F.lit(0x7FFFFFFF)), F.shiftrightunsigned(h, 33)
    return F.transform(F.sequence(F.lit(0), F.lit(n_hashes - 1)), lambda i: F.pmod(a + i * b, F.lit(n_bits)))


class Cascade(NamedTuple):
    levels: list[Level]

    def has(self, key: Column) -> Column:
        """Exact membership for keys of the universe."""
        out = F.lit(len(self.levels) % 2 == 1)  # in all levels: the last one takes none wrongly
        for level in reversed(self.levels):
            out = F.when(~level.has(key), F.lit(level.number % 2 == 0)).otherwise(out)
        return out if self.levels else F.lit(False)


def level_of(keys: DataFrame, key: str, number: int, n: int, false_share: float) -> Level:
    """A Bloom filter of the ``n`` keys; at most n_bits / 64 words reach the driver."""
    n_hashes = max(1, round(-math.log2(false_share)))
    n_bits = 64 * math.ceil(max(1, n) * n_hashes / math.log(2) / 64)
    if n_bits > 8 * MAX_BYTES:
        raise ValueError(f"{n} keys need a filter of {n_bits // 8} bytes, over {MAX_BYTES}; split the list")
    words = (keys.select(F.explode(bit_positions(F.col(key), number, n_bits, n_hashes)).alias("p"))
             .groupBy((F.col("p") - F.col("p") % 64).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits")))
    bits = bytearray(n_bits // 8)
    for r in words.toLocalIterator():
        struct.pack_into("<q", bits, r["word"] // 8, r["bits"])
    return Level(number, n_bits, n_hashes, bytes(bits))


def build_cascade(universe: DataFrame, key: str, listed: str) -> Cascade:
    """Cascade over distinct keys, of which those with ``listed`` true are to be
    found.  Two passes over the universe; later levels touch only the listed keys
    and the false positives of level 1 (about as many)."""
    n_all, n_in = universe.agg(F.count("*"), F.count_if(listed)).first()
    if not n_in:
        return Cascade([])
    share = min(0.5, max(n_in * math.sqrt(0.5) / max(1, n_all - n_in), 1e-9))
    first = level_of(universe.where(F.col(listed)), key, 1, n_in, share)
    inside = universe.where(F.col(listed)).select(key)
    outside = checkpointed(universe.where(~F.col(listed)).where(first.has(F.col(key))).select(key))
    levels, turn, other = [first], outside, inside
    while n := turn.count():
        levels.append(level_of(turn, key, len(levels) + 1, n, 0.5))
        turn, other = checkpointed(other.where(levels[-1].has(F.col(key)))), turn
    return Cascade(levels)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    small letters; path: from there up to ``?``, ``#`` or the end."""
    full = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(full, r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(host), F.regexp_extract(full, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def candidates(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """A url's keys of the shapes that rules have, longest first."""
    labels = F.split(host, r"\.", -1)
    shapes = sorted({(r.host.count(".") + 1, len(r.path)) for r in rules}, reverse=True)
    keys = [F.when((F.size(labels) >= n) & (F.length(path) >= m) & (host != ""), F.concat(
        F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."), F.substring(path, 1, m))) for n, m in shapes]
    return F.array_sort(F.array_compact(F.array(*keys)), lambda a, b: F.length(b) - F.length(a))


def url_verdicts(pages: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = ALLOW) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (the key of the winning rule, or null) and
    ``verdict`` (the rule's; ``default`` for urls on neither list).

    A null url, or one without ``://``, has an empty host and path and no rule.
    Repeated rows get the same verdict; an empty table gives an empty result.
    Columns of the added names are replaced.
    """
    own = fresh(pages.columns, "candidates")
    host, path = host_and_path(ref(url))
    keyed = pages.withColumns({"host": host, "path": path})
    keyed = keyed.withColumn(own, candidates(F.col("host"), F.col("path"), rules) if rules else F.array().cast("array<string>"))
    spark, of_rule = pages.sparkSession, {}
    for r in rules:
        if of_rule.setdefault(r.key, r.verdict) != r.verdict:
            raise ValueError(f"rule {r.key} has two verdicts")
    listed = spark.createDataFrame([(k, v) for k, v in of_rule.items()], "key string, verdict string")
    # a union and one grouping mark the listed keys: no join, hot hosts pre-aggregate
    universe = checkpointed(
        keyed.select(F.explode(own).alias("key"), F.lit(None).cast("string").alias("verdict")).unionByName(listed)
        .groupBy("key").agg(F.max("verdict").alias("verdict")))
    cascade = {v: build_cascade(universe.select("key", (F.coalesce("verdict", F.lit("")) == v).alias("listed")), "key", "listed")
               for v in (ALLOW, BLOCK)}
    fits = F.filter(own, lambda k: cascade[ALLOW].has(k) | cascade[BLOCK].has(k))
    out = keyed.withColumn("rule", F.get(fits, F.lit(0)))
    verdict = F.when(F.col("rule").isNull(), F.lit(default)).when(cascade[BLOCK].has(F.col("rule")), BLOCK).otherwise(ALLOW)
    return out.withColumn("verdict", verdict).drop(own)
