"""URL filter: fixed rules first, then a Bloom filter cascade over all keys of the corpus.

The first filter holds the listed keys, the second those unlisted keys of the corpus that pass
the first, the third the listed keys that pass the second, and so on until none is left. A key
of the corpus is then listed exactly if the first filter that it fails has an even number, or,
if it fails none, the last filter has an odd one. The pages need no join: every task tests its
own keys against a few bytes per listed key.

The filters are built from the distinct keys by hash tables of bits that tasks fill apart and
that are joined word by word. They are sent to the tasks in shards of bounded size: a list too
large for one shard is cut by a hash of the key, and each shard judges its own pages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, written

#: Bits for each key of a filter and hashes of a key; bits of a shard's filter at most (8 MB).
KEY_BITS, HASHES, SHARD_BITS = 10, 5, 1 << 26
#: Filters of a cascade; more mean that two keys cannot be told apart.
MOST_LEVELS = 40


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of an address; both empty without a ``://`` or for null."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(url)), "^[^?#]*", 0)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), F.coalesce(path, F.lit(""))


def rule_and_verdict(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """rules: (host and path, verdict). The longest rule that fits, and its verdict, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):  # later ones go in front
        domain, slash, below = text.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + below)
        rule = F.when(fits, text).otherwise(rule)
        verdict = F.when(fits, says).otherwise(verdict)
    return rule, verdict


def key_hashes(key: Column) -> list[Column]:
    """Two independent 64-bit hashes of a key; filters see nothing else of it."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit(1)).alias("h2")]


def places(h1: np.ndarray, h2: np.ndarray, level: int, bits: int) -> Iterator[np.ndarray]:
    """Each hash's bit numbers of the keys in the filter of a level."""
    with np.errstate(over="ignore"):
        odd = np.uint64((0x9E3779B97F4A7C15 * (2 * level + 1)) & (1 << 64) - 1)
        x = h1.astype(np.uint64) * odd
        x ^= x >> np.uint64(31)
        step = (h2.astype(np.uint64) * odd) | np.uint64(1)
        for _ in range(HASHES):
            yield ((x ^ (x >> np.uint64(29))) % np.uint64(bits)).astype(np.int64)
            x = x + step


class Cascade:
    """filters: (bits, bytes) from the first level on, of one shard."""

    def __init__(self, filters: list[tuple[int, np.ndarray]]):
        self.filters = filters

    def passes(self, h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
        bits, data = self.filters[level]
        out = np.ones(len(h1), bool)
        for at in places(h1, h2, level, bits):
            out &= (data[at >> 3] >> (at & 7) & 1).astype(bool)
        return out

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Exact for every key that the cascade was built over."""
        out = np.zeros(len(h1), bool)
        open_ = np.arange(len(h1))
        for level in range(len(self.filters)):
            ok = self.passes(h1[open_], h2[open_], level)
            out[open_[~ok]] = level % 2 == 1
            open_ = open_[ok]
        out[open_] = len(self.filters) % 2 == 1
        return out


def _hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2"))


def _filter_of(keys: DataFrame, level: int, bits: int) -> np.ndarray:
    """The bits of a level's keys: every task ors its own, words that are set are joined."""
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.zeros(-(-bits // 64) * 8, np.uint8)
        for b in batches:
            for at in places(*_hashes(b), level, bits):
                np.bitwise_or.at(mine, at >> 3, (1 << (at & 7)).astype(np.uint8))
        whole = mine.view("<i8")
        hit = np.flatnonzero(whole)
        for i in range(0, len(hit), 50_000):
            part = hit[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()),
                                              pa.array(whole[part], pa.int64())], ["at", "word"])

    joined = (map_batches(keys.select("h1", "h2"), words, "at long, word long")
              .groupBy("at").agg(F.bit_or("word").alias("word")))
    out = np.zeros(-(-bits // 64), "<i8")
    for r in joined.toLocalIterator():  # at most bits / 64 rows
        out[r.at] = r.word
    return out.view(np.uint8)


def build(keys: DataFrame, listed: DataFrame) -> list[Cascade]:
    """keys (key): every key of the corpus, repeats allowed. listed (key): the listed keys, in
    the corpus or not. One cascade for each shard; key k belongs to shard pmod(h1, shards)."""
    marks = listed.select(F.col("key").alias("k")).where("k is not null").distinct()
    # copies meet before the join, so a key that very many pages share is one row
    each = (keys.where("key is not null").distinct()
            .join(marks, F.col("key") == F.col("k"), "left")
            .select(*key_hashes(F.col("key")), F.col("k").isNotNull().alias("listed")))
    universe = written(each)
    n = universe.where("listed").count()
    shards = max(1, -(-n * KEY_BITS // SHARD_BITS))
    return [_cascade(universe.where(F.pmod("h1", F.lit(shards)) == s)) for s in range(shards)]


def _cascade(universe: DataFrame) -> Cascade:
    spark, found = universe.sparkSession, Cascade([])
    inside, others = universe.where("listed"), universe.where("not listed")
    while True:
        size = inside.count()
        if not size and found.filters:
            return found
        level = len(found.filters)
        if level == MOST_LEVELS:
            raise ValueError("two keys have the same hashes")
        bits = max(64, size * KEY_BITS)
        found.filters.append((bits, _filter_of(inside, level, bits)))
        sent = spark.sparkContext.broadcast(found)

        def passing(batches, sent=sent, level=level):
            for b in batches:
                keep = sent.value.passes(*_hashes(b), level)
                yield b.filter(pa.array(keep))

        # what passes falls off by a hundred from level to level, the first one aside
        over = map_batches(others.select("h1", "h2"), passing, "h1 long, h2 long")
        inside, others = written(over), inside


def is_listed(rows: DataFrame, cascades: list[Cascade], keep: list[str]) -> DataFrame:
    """rows (keep, h1, h2) -> keep and listed, by the cascade of each row's shard."""
    spark, out = rows.sparkSession, None
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", listed boolean"
    for s, cascade in enumerate(cascades):
        sent = spark.sparkContext.broadcast(cascade)  # at most SHARD_BITS a level

        def judge(batches, sent=sent):
            for b in batches:
                hit = sent.value.listed(*_hashes(b))
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in keep), pa.array(hit)], [*keep, "listed"])

        mine = rows.where(F.pmod("h1", F.lit(len(cascades))) == s)
        part = map_batches(mine, judge, schema)
        out = part if out is None else out.unionByName(part)
    return out


def judge(pages: DataFrame, rules: list[tuple[str, str]], listed: DataFrame) -> DataFrame:
    """pages (page_id, url, any others), listed (key: host and path joined) -> page_id, host,
    path, rule, verdict, one row per row of pages.

    A fitting rule decides; else a listed key is blocked and any other is allowed. Null urls
    and those without ``://`` have an empty host and path and so the empty key. An empty table
    gives no rows, an empty list blocks nothing."""
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    key = F.concat("host", "path")
    cascades = build(split.select(key.alias("key")), listed)
    rule, says = rule_and_verdict(F.col("host"), F.col("path"), rules)
    rows = split.select("page_id", "host", "path", rule.alias("rule"), says.alias("says"),
                        *key_hashes(key))
    found = is_listed(rows, cascades, ["page_id", "host", "path", "rule", "says"])
    return found.select("page_id", "host", "path", "rule", F.coalesce(
        "says", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))
