"""Benchmark decontamination by greedy string tiling over shared-token seeds."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MARKS, U64, Scratch, Words, arrow_map, mix, signed, spans_hash, text_bytes

#: Bits of the seed filter are at most 2 to this power: 8 MB to each executor, however many items there are.
FILTER_BITS = 26
PROBES = 3
#: Pairs of equal windows that are listed at once.
MOST_PAIRS = 1_000_000


def tile(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (begin in doc, begin in item, length), longest first, none overlapping in either text.

    Karp-Rabin hashes of windows of ``least`` tokens give the matches; runs
    along a diagonal are maximal matches. The longest is marked, and what
    marks leave of the others is matched again while ``least`` tokens long.
    Texts that repeat themselves so much that ``MOST_PAIRS`` windows match are
    tiled alike with memory in proportion to their lengths.
    """
    if len(doc) < least or len(item) < least:
        return []
    begin_d, begin_i = np.arange(len(doc) - least + 1), np.arange(len(item) - least + 1)
    hash_d, hash_i = (spans_hash(x, b, b + least) for x, b in ((doc, begin_d), (item, begin_i)))
    order = np.argsort(hash_i, kind="stable")
    lo, hi = (np.searchsorted(hash_i[order], hash_d, side=s) for s in ("left", "right"))
    many = hi - lo
    if many.sum() > MOST_PAIRS:
        return tile_by_length(doc, item, least)
    d = np.repeat(begin_d, many)
    i = order[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)]
    along = np.lexsort((d, d - i))
    d, i = d[along], i[along]
    new = np.flatnonzero(np.append(True, (np.diff(d) != 1) | (np.diff(i) != 1))) if len(d) else np.empty(0, np.int64)
    length = np.diff(np.append(new, len(d))) + least - 1
    heap = [(-int(n), int(x), int(y)) for n, x, y in zip(length, d[new], i[new], strict=True)]
    heapq.heapify(heap)
    free_d, free_i = np.ones(len(doc), bool), np.ones(len(item), bool)
    tiles = []
    while heap:
        n, x, y = heapq.heappop(heap)
        n = -n
        free = free_d[x : x + n] & free_i[y : y + n]
        if free.all():
            free_d[x : x + n] = free_i[y : y + n] = False
            tiles.append((x, y, n))
        elif free_i.any():
            edge = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]]).astype(np.int8)))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                if b - a >= least:
                    heapq.heappush(heap, (a - b, x + a, y + a))
    return tiles


def tile_by_length(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """``tile`` without a list of matches: the greatest length that still matches is found by halving, and its matches are marked one by one."""
    free_d, free_i = np.ones(len(doc), bool), np.ones(len(item), bool)

    def windows(text: np.ndarray, free: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        total = np.concatenate([[0], np.cumsum(free)])
        begin = np.flatnonzero(total[n:] - total[:-n] == n)
        return begin, spans_hash(text, begin, begin + n)

    def matching(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        (begin_d, hash_d), (begin_i, hash_i) = windows(doc, free_d, n), windows(item, free_i, n)
        both = np.isin(hash_d, hash_i)
        return begin_d[both], hash_d[both], begin_i, hash_i

    tiles, most = [], min(len(doc), len(item))
    while True:
        lo, hi = least - 1, most
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if len(matching(mid)[0]) else (lo, mid - 1)
        if lo < least:
            return tiles
        most, (begin_d, hash_d, begin_i, hash_i) = lo, matching(lo)
        order = np.lexsort((begin_i, hash_i))
        by_hash, places = hash_i[order], begin_i[order]
        end = -1
        for x, h in zip(begin_d.tolist(), hash_d, strict=True):
            if x < end:
                continue
            a, b = np.searchsorted(by_hash, h, "left"), np.searchsorted(by_hash, h, "right")
            for y in places[a:b].tolist():
                if free_i[y] and free_i[y + lo - 1] and free_i[y : y + lo].all():
                    free_d[x : x + lo] = free_i[y : y + lo] = False
                    tiles.append((x, y, lo))
                    end = x + lo
                    break


def probes(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for p in range(PROBES):
        yield mix(hashes + U64(p * 0x9E3779B9 + 1)) >> U64(64 - bits)


def leaks(docs: DataFrame, benchmark: DataFrame, least: int = 5, coverage: float = 0.5) -> DataFrame:
    """(row_key, doc_id, item_id, n_tokens, covered, coverage, tiles) for documents that hold a benchmark text.

    Tokens are words without ASCII punctuation, A-Z lower-cased. A pair is
    returned when tiles of at least ``least`` tokens, in any order, cover at
    least the share ``coverage`` of the item's tokens. An item of fewer than
    ``least`` tokens is matched whole, as one tile. Null and empty texts, and
    those without a token, are never matched; rows of ``benchmark`` with one
    item_id and different texts are judged one by one
    and the best covered counts. Repeated rows of ``docs`` are one row here,
    known by ``row_key``, a hash of doc_id and text. Null ids pass through.
    Other columns aren't read. Empty tables give an empty result.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("row_key", F.xxhash64("doc_id", "text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))

    def read(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = Words(*text_bytes(batch.column("text")), MARKS)
        seeds, of = words.shingles(least)
        n = np.diff(words.first)
        worded = np.flatnonzero(n)
        own = [np.unique(seeds[of == i], return_counts=True) for i in worded.tolist()]
        tokens = [words.hash[words.first[i] : words.first[i + 1]].tobytes() for i in worded.tolist()]
        places = [[{"seed": s, "places": c} for s, c in zip(x.view(np.int64).tolist(), many.tolist(), strict=True)] for x, many in own]
        columns = [batch.column("item_id").take(pa.array(worded)), signed(spans_hash(words.hash, words.first[worded], words.first[worded + 1])), pa.array(n[worded], pa.int64()), pa.array(tokens, pa.binary())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(places, pa.list_(pa.struct([("seed", pa.int64()), ("places", pa.int64())])))], ["item_id", "item_key", "n_tokens", "item_tokens", "seeds"])

    items = scratch.cut(arrow_map(items, read, "item_id long, item_key long, n_tokens long, item_tokens binary, seeds array<struct<seed:long,places:long>>").dropDuplicates(["item_id", "item_key"]))
    seeds = scratch.cut(items.select(F.explode("seeds").alias("x"), "item_id", "item_key", "n_tokens").select("x.*", "item_id", "item_key", "n_tokens"))
    widths = [least, *sorted(r[0] for r in items.where(F.col("n_tokens") < least).select("n_tokens").distinct().collect())]

    bits = min(FILTER_BITS, max(20, int(seeds.count()).bit_length() + 6))
    marked = np.zeros(1 << bits - 6, U64)

    def mark(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at = np.concatenate(list(probes(batch.column("seed").to_numpy().view(U64), bits)))
        yield pa.RecordBatch.from_arrays([pa.array((at >> U64(6)).astype(np.int64)), signed(U64(1) << (at & U64(63)))], ["word", "value"])

    words = arrow_map(seeds.select("seed"), mark, "word long, value long").groupBy("word").agg(F.expr("bit_or(value)").alias("value")).toArrow()
    marked[words.column("word").to_numpy()] = words.column("value").to_numpy().view(U64)
    sent = spark.sparkContext.broadcast(marked)

    def scan(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = Words(*text_bytes(batch.column("text")), MARKS)
        found, of = zip(*(words.windows(k) for k in widths), strict=True)
        found, of = np.concatenate(found), np.concatenate(of)
        hits, filt = np.arange(len(found)), sent.value
        for p in range(PROBES):
            at = mix(found[hits] + U64(p * 0x9E3779B9 + 1)) >> U64(64 - bits)
            hits = hits[(filt[(at >> U64(6)).astype(np.int64)] >> (at & U64(63)) & U64(1)).astype(bool)]
        if not len(hits):
            return
        hits = hits[np.argsort(of[hits], kind="stable")]
        rows, begin = np.unique(of[hits], return_index=True)
        own = [np.unique(x).view(np.int64) for x in np.split(found[hits], begin[1:])]
        tokens = [words.hash[words.first[i] : words.first[i + 1]].tobytes() for i in rows.tolist()]
        take = pa.array(rows)
        yield pa.RecordBatch.from_arrays([batch.column("row_key").take(take), batch.column("doc_id").take(take), pa.array(tokens, pa.binary()), pa.array(own, pa.list_(pa.int64()))], ["row_key", "doc_id", "tokens", "seeds"])

    held = scratch.cut(arrow_map(docs, scan, "row_key long, doc_id long, tokens binary, seeds array<long>"))
    shared = held.select("row_key", F.explode("seeds").alias("seed")).join(seeds, "seed").groupBy("row_key", "item_id", "item_key", "n_tokens").agg(F.sum("places").alias("places"))
    # a shared window covers at most its own tokens
    pairs = shared.where(F.col("places") * F.least(F.lit(least), "n_tokens") >= F.lit(coverage) * F.col("n_tokens")).select("row_key", "item_id", "item_key")
    full = pairs.join(held.select("row_key", "doc_id", "tokens"), "row_key").join(items.select("item_key", F.col("item_id").alias("same_id"), "item_tokens"), "item_key").where("item_id <=> same_id")

    def judge(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows, of, covered, spans = [], [], [], []
        for r in range(batch.num_rows):
            item = np.frombuffer(batch.column("item_tokens")[r].as_py(), U64)
            own = tile(np.frombuffer(batch.column("tokens")[r].as_py(), U64), item, min(least, len(item)))
            if (share := sum(x[2] for x in own)) >= coverage * len(item):
                rows.append(r)
                of.append(len(item))
                covered.append(share)
                spans.append([{"doc_from": x, "item_from": y, "length": n} for x, y, n in own])
        kept = batch.select(["row_key", "doc_id", "item_id"]).take(pa.array(rows, pa.int64()))
        span = pa.list_(pa.struct([("doc_from", pa.int64()), ("item_from", pa.int64()), ("length", pa.int64())]))
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(of, pa.int64()), pa.array(covered, pa.int64()), pa.array(spans, span)], ["row_key", "doc_id", "item_id", "n_tokens", "covered", "tiles"])

    found = arrow_map(full, judge, "row_key long, doc_id long, item_id long, n_tokens long, covered long, tiles array<struct<doc_from:long,item_from:long,length:long>>")
    best = found.groupBy("row_key", "doc_id", "item_id").agg(F.max(F.struct((F.col("covered") / F.col("n_tokens")).alias("coverage"), "n_tokens", "covered", "tiles")).alias("best"))
    return best.select("row_key", "doc_id", "item_id", "best.n_tokens", "best.covered", "best.coverage", "best.tiles")


def decontaminate(docs: DataFrame, benchmark: DataFrame, least: int = 5, coverage: float = 0.5) -> DataFrame:
    """``docs`` without the rows that ``leaks`` finds; all columns and repeated clean rows stay."""
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = docs.select(F.struct(*docs.columns).alias("doc"), key.alias("row_key"))
    return rows.join(leaks(docs, benchmark, least, coverage).select("row_key").distinct(), "row_key", "left_anti").select("doc.*")
