"""URL filter: rules on hosts and path beginnings, looked up in Bloom filter cascades.

A cascade (levels of Bloom filters) answers "is this key listed?" exactly for every key
of a known universe. Level 0 encodes the listed keys; level 1 the keys of the universe
that level 0 takes for listed; level 2 the listed keys that level 1 takes for those; and
so on, until a level makes no mistake. A key is listed if the first level that does not
hold it is an odd one. The universe is every (host ending, path beginning) of the whole
corpus that has the shape of a rule, so no look-up needs a join, a shuffle or a list.

Size: with r listed keys and s keys in the universe, level 0 takes 1.44 r log2(1.41 s / r)
bits and leaves about r mistakes; all further levels together take about 4 r bits. What
is built on the driver and sent to the tasks so grows with the list and only with the
logarithm of the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sinks.files import Stage

WORD = 64
MAX_LEVELS = 200
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``n_hashes`` bits of ``n_words`` words of 64 for each key."""

    number: int
    n_words: int
    n_hashes: int
    words: tuple[int, ...] = ()

    def bit(self, key: Column, i: int) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(self.number * 64 + i)), F.lit(self.n_words * WORD))

    def holds(self, key: Column) -> Column:
        # One text literal that the optimizer folds into one array.
        words = F.split(F.lit(" ".join(map(str, self.words))), " ").cast("array<bigint>")
        found = F.lit(True)
        for i in range(self.n_hashes):
            at = self.bit(key, i)
            word = F.element_at(words, (F.shiftright(at, 6) + 1).cast("int"))
            found = found & (F.getbit(word, at.bitwiseAND(F.lit(63))) == 1)
        return found


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...] = field(default=())

    def lists(self, key: Column) -> Column:
        """True for listed keys, false for all other keys of the universe."""
        answer = F.lit(False)
        for level in reversed(self.levels):
            answer = level.holds(key) & ~answer
        return answer


def _filled(keys: DataFrame, number: int, n_keys: int, false_rate: float) -> Level:
    """The Bloom filter of distinct ``keys``; its words come to the driver as one row."""
    n_hashes = max(1, round(-math.log2(false_rate)))
    n_words = max(1, math.ceil(n_keys * -math.log2(false_rate) / math.log(2) / WORD))
    level = Level(number, n_words, n_hashes)
    bits = keys.select(F.explode(F.array(*[level.bit(F.col("key"), i) for i in range(n_hashes)])).alias("bit"))
    ones = bits.select(
        F.shiftright("bit", 6).alias("word"),
        F.expr("shiftleft(1L, CAST(bit & 63 AS INT))").alias("ones"),
    )
    every = keys.sparkSession.range(n_words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("ones"))
    words = ones.union(every).groupBy("word").agg(F.bit_or("ones").alias("ones"))
    row = words.agg(F.sort_array(F.collect_list(F.struct("word", "ones"))).alias("w")).first()
    return Level(number, n_words, n_hashes, tuple(x["ones"] for x in row["w"]))


def build_cascade(listed: DataFrame, universe: DataFrame, n_universe: int, stage: Stage, name: str) -> Cascade:
    """Cascade of ``listed.key`` over ``universe.key`` (both may repeat keys or hold NULLs).

    ``n_universe`` is at least the number of distinct keys of the universe. The corpus is
    read once: what level 0 lets through is made distinct (repeats fold before the shuffle)
    and is about twice the list; all further levels are built from that.
    """
    listed = stage.save(listed.select("key").where("key IS NOT NULL").distinct(), f"{name}-listed")
    n_listed = listed.count()
    if not n_listed:
        return Cascade()
    rate = min(0.5, math.sqrt(0.5) * n_listed / max(n_universe, n_listed))
    levels = [_filled(listed, 0, n_listed, rate)]
    passed = universe.where(F.col("key").isNotNull() & levels[0].holds(F.col("key"))).select("key").distinct()
    tagged = passed.withColumn("own", F.lit(0)).union(listed.withColumn("own", F.lit(1)))
    known = stage.save(tagged.groupBy("key").agg(F.max("own").alias("own")), f"{name}-known")
    # The keys that the last level must hold, and those that it must not take for them.
    inside, outside = known.where("own = 1"), known.where("own = 0")
    while n_wrong := outside.count():
        if len(levels) == MAX_LEVELS:
            raise ValueError(f"no exact cascade of {MAX_LEVELS} levels: {n_wrong} keys are left")
        levels.append(_filled(outside, len(levels), n_wrong, 0.5))
        inside, outside = outside, inside.where(levels[-1].holds(F.col("key")))
    return Cascade(tuple(levels))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered. Path:
    from there up to ``?``, ``#`` or the end. Both empty for NULL or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """Rules as rows: text such as ``example.org/es/`` and a verdict."""
    rows = [F.struct(F.lit(r).cast("string").alias("rule"), F.lit(v).alias("verdict")) for r, v in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = ALLOW, stage: Stage | None = None) -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` and ``verdict`` (replacing columns so named).

    A rule (``rule`` = host and path, ``verdict`` allow or block) fits its host and every
    subdomain of it, if the path starts with the rule's. The longest rule decides; one that
    is listed both ways blocks. Without a fitting rule ``rule`` is NULL and the verdict is
    ``default``: what is not listed is not blocked. Rules that are NULL or without a host
    fit nothing. Repeated rows and an empty table give as many rows as they have.
    """
    spark = urls.sparkSession
    stage = stage or Stage(spark)
    rule_host = F.regexp_extract("rule", "^[^/]*", 0)
    rules = rules.where("rule IS NOT NULL").select(
        rule_host.alias("host"),
        F.concat(F.translate(rule_host, UPPER, LOWER), F.expr("substring(rule, length(regexp_extract(rule, '^[^/]*', 0)) + 1)")).alias("key"),
        F.col("verdict"),
    ).where("host <> ''")
    shapes = rules.select(
        F.size(F.split("host", "[.]")).alias("labels"),
        (F.length("key") - F.length("host")).alias("chars"),
    ).distinct().collect()  # at most (labels of a host) x (lengths of a path) rows
    host, path = host_and_path(F.col(url))
    drop = [c for c in ("host", "path", "rule", "verdict") if c != url]
    parted = urls.drop(*drop).withColumns({"host": host, "path": path})
    endings = [
        F.concat(F.substring_index("host", ".", -s["labels"]), F.expr(f"left(path, {s['chars']})")) for s in shapes
    ]
    keys = F.array_distinct(F.array(*endings)) if endings else F.array().cast("array<string>")
    universe = parted.select(F.explode(keys).alias("key"))
    n_universe = urls.count() * max(1, len(shapes))
    lists = {
        v: build_cascade(rules.where(F.col("verdict") == v), universe, n_universe, stage, v) for v in (ALLOW, BLOCK)
    }
    fits = F.filter(keys, lambda k: lists[ALLOW].lists(k) | lists[BLOCK].lists(k))
    longest = F.array_max(F.transform(fits, lambda k: F.struct(F.length(k).alias("n"), k.alias("key"))))
    ruled = parted.withColumn("rule", longest["key"])
    verdict = F.when(F.col("rule").isNull(), default).when(lists[BLOCK].lists(F.col("rule")), BLOCK).otherwise(ALLOW)
    return ruled.withColumn("verdict", verdict)
