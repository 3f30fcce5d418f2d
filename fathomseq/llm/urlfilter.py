"""URL filters by Bloom filter cascades.

A cascade's first filter holds the listed keys, the second the unlisted keys
that pass the first, the third the listed keys that pass the second, and so on
until none passes. Over the key universe it was built from, a key is listed
exactly if the first filter that rejects it stands at an even place.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, Scratch, arrow_map, mix, signed

#: Listed keys of one cascade, at most: its filters stay under about 16 MB. More keys are dealt to more cascades.
SHARD_KEYS, SHARDS_AT_ONCE = 4_000_000, 8
_HASHES = ("h1", "h2")


@dataclass
class Bloom:
    bits: int
    probes: int
    words: np.ndarray

    def positions(self, h1: np.ndarray, h2: np.ndarray) -> Iterator[np.ndarray]:
        for p in range(self.probes):
            yield mix(h1 + U64(p) * (h2 | U64(1))) % U64(self.bits)

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out = np.ones(len(h1), bool)
        for at in self.positions(h1, h2):
            out &= (self.words[(at >> U64(6)).astype(np.int64)] >> (at & U64(63)) & U64(1)).astype(bool)
        return out

    @staticmethod
    def of(keys: DataFrame, n: int, rate: float, salt: int) -> Bloom:
        """Built where the keys are; its words, a bounded number, come to the driver."""
        bits = max(64, math.ceil(-n * math.log(rate) / math.log(2) ** 2))
        bloom = Bloom(bits, max(1, round(-math.log2(rate))), np.zeros(-(-bits // 64), U64))

        def mark(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            at = np.concatenate(list(bloom.positions(*hashes(batch, salt))))
            yield pa.RecordBatch.from_arrays([pa.array((at >> U64(6)).astype(np.int64)), signed(U64(1) << (at & U64(63)))], ["word", "value"])

        words = arrow_map(keys.select(*_HASHES), mark, "word long, value long").groupBy("word").agg(F.expr("bit_or(value)").alias("value")).toArrow()
        bloom.words[words.column("word").to_numpy()] = words.column("value").to_numpy().view(U64)
        return bloom


def hashes(batch: pa.RecordBatch, salt: int) -> tuple[np.ndarray, np.ndarray]:
    h1, h2 = (batch.column(c).to_numpy().view(U64) for c in _HASHES)
    return mix(h1 + U64(salt)), h2


def key_hashes(key: Column) -> list[Column]:
    """128 bits of hash of a key."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.concat(F.lit("2|"), key)).alias("h2")]


@dataclass
class Cascade:
    levels: list[Bloom]

    @staticmethod
    def of(listed: DataFrame, universe: DataFrame, scratch: Scratch, most_levels: int = 64) -> Cascade:
        """From keys (h1, h2); ``universe`` holds every key that will be asked for, listed or not."""
        inside = scratch.cut(listed.select(*_HASHES).distinct())
        outside = scratch.cut(universe.select(*_HASHES).distinct().join(inside, list(_HASHES), "left_anti"))
        levels: list[Bloom] = []
        sizes = [inside.count(), outside.count()]
        rate = min(0.5, max(1e-3, 0.7 * sizes[0] / max(sizes[1], 1)))
        while sizes[0]:
            if len(levels) == most_levels:
                raise RuntimeError("two keys have the same 128-bit hash")
            level = Bloom.of(inside, sizes[0], rate, salt := len(levels) + 1)
            levels.append(level)

            def passed(batch: pa.RecordBatch, level: Bloom = level, salt: int = salt) -> Iterator[pa.RecordBatch]:
                yield batch.filter(pa.array(level.has(*hashes(batch, salt))))

            inside, outside = scratch.cut(arrow_map(outside, passed, "h1 long, h2 long")), inside
            sizes, rate = [inside.count(), sizes[0]], 0.5
        return Cascade(levels)

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """For keys of the universe: whether each is listed."""
        out = np.zeros(len(h1), bool)
        live = np.arange(len(h1))
        for n, level in enumerate(self.levels):
            has = level.has(mix(h1[live] + U64(n + 1)), h2[live])
            out[live[~has]] = n % 2 == 1
            live = live[has]
        out[live] = len(self.levels) % 2 == 1
        return out


def lookup(cascade: Cascade, shard: int, shards: int, spark: SparkSession):
    """A function of arrays of key hashes: whether each key is of this shard and listed."""
    sent = spark.sparkContext.broadcast(cascade)

    @F.pandas_udf("array<boolean>")
    def has(h1: pd.Series, h2: pd.Series) -> pd.Series:
        ends = np.cumsum([0, *map(len, h1)])
        if not ends[-1]:
            return pd.Series([np.empty(0, bool)] * len(h1))
        first, second = (np.concatenate(list(h)).astype(np.int64) for h in (h1, h2))
        mine = np.flatnonzero(second % shards == shard)
        out = np.zeros(ends[-1], bool)
        out[mine] = sent.value.listed(first[mine].view(U64), second[mine].view(U64))
        return pd.Series([out[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)])

    return has


def flagged(rows: DataFrame, universe: DataFrame, lists: dict[str, DataFrame], scratch: Scratch) -> DataFrame:
    """``rows`` (h1, h2: arrays of key hashes) with an array of booleans for each name of ``lists``: which keys that list (key) holds.

    Exact for every key of ``universe`` (h1, h2), by cascades over it. A list
    of more than ``SHARD_KEYS`` keys is dealt by hash to several cascades. The
    rows are written between every ``SHARDS_AT_ONCE`` of them, so that no task
    holds more.
    """
    held = 0
    for name, listed in lists.items():
        hashed = listed.where("key is not null").select(*key_hashes(F.col("key")))
        shards = max(1, -(-hashed.count() // SHARD_KEYS))
        mine = F.pmod(F.col("h2"), F.lit(shards))
        rows = rows.withColumn(name, F.transform("h1", lambda _: F.lit(False)))
        for shard in range(shards):
            if held and held % SHARDS_AT_ONCE == 0:
                rows = scratch.cut(rows)
            held += 1
            has = lookup(Cascade.of(hashed.where(mine == shard), universe.where(mine == shard), scratch), shard, shards, rows.sparkSession)
            rows = rows.withColumn(name, F.zip_with(name, has("h1", "h2"), lambda a, b: a | b))
    return rows


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty if the url is null or has no ``://``."""
    found = url.contains("://")
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return tuple(F.when(found, x).otherwise("") for x in (low, path))


def judge(pages: DataFrame, rules: DataFrame, listed_hosts: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict, host_listed) for each row of ``pages``.

    ``rules`` has host, path and verdict (allow or block); a rule fits its
    host and all its subdomains where the url's path starts with its path, and
    the longest rule wins, then the one of the longer host; of a rule listed
    both ways, block. Where none fits, the url is blocked if its host or a
    parent of it is one of ``listed_hosts`` (host). Which of a url's hosts and
    path beginnings are rules is found by cascades over all such keys of all
    pages. Rows with null in a rule are no rule. Repeated pages stay; null ids
    pass through; other columns are not read.
    """
    spark, scratch = pages.sparkSession, Scratch(pages.sparkSession)
    rules = rules.where("host is not null and path is not null and verdict in ('allow', 'block')").select("host", "path", "verdict", F.concat("host", "path").alias("key"))
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().limit(10_001).collect()]
    if len(lengths) > 10_000:
        raise ValueError("rules have paths of more than 10,000 lengths")
    host, path = host_and_path(F.col("url"))
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))

    longest = max([0, *lengths])

    def with_keys(rows: DataFrame) -> DataFrame:
        """Adds the keys of each row: its host and the host's parents, each with every beginning of the path that is as long as a rule's."""
        labels = F.split("host", r"\.")
        of = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
        starts = F.array_compact(F.array(F.lit(""), *[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(lengths) if n]))
        pairs = F.flatten(F.transform(of, lambda h: F.transform(starts, lambda x: F.struct(h.alias("of"), F.concat(h, x).alias("key")))))
        return rows.withColumn("keys", pairs)

    # pages of one host whose paths begin alike have the same keys
    heads = urls.select("host", F.substring("path", 1, longest).alias("path")).distinct()
    universe = scratch.cut(with_keys(heads).select(F.explode("keys.key").alias("key")).distinct().select(*key_hashes(F.col("key"))))
    hash_of = [F.transform("keys", lambda x: key_hashes(x["key"])[0]).alias("h1"), F.transform("keys", lambda x: key_hashes(x["key"])[1]).alias("h2")]
    rows = with_keys(urls).select("*", *hash_of)
    lists = {
        "blocks": rules.where("verdict = 'block'").select("key"),
        "allows": rules.where("verdict = 'allow'").select("key"),
        "lists": listed_hosts.select(F.col("host").alias("key")),
    }
    rows = flagged(rows, universe, lists, scratch)
    each = F.arrays_zip("keys", "blocks", "allows", "lists")
    fits = F.filter(each, lambda x: x["blocks"] | x["allows"])
    best = F.array_max(F.transform(fits, lambda x: F.struct(F.length(x["keys"]["key"]).alias("long"), F.length(x["keys"]["of"]).alias("of"), x["blocks"].alias("blocks"), x["keys"]["key"].alias("key"))))
    listed = F.exists(each, lambda x: x["lists"] & (x["keys"]["key"] == x["keys"]["of"]))
    rows = rows.select("page_id", "host", "path", best.alias("best"), listed.alias("listed"))
    blocked = F.when(F.col("best").isNotNull(), F.col("best.blocks")).otherwise(F.col("listed"))
    return rows.select("page_id", "host", "path", F.col("best.key").alias("rule"), F.when(blocked, "block").otherwise("allow").alias("verdict"), F.col("listed").alias("host_listed"))
