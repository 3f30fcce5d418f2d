"""Exact top-k inner products by a bit-sliced index: bitmaps added as numbers, rows chosen from the highest slice down."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import U64

#: Rows of one index.
BLOCK_ROWS = 16_384


class BitSlices:
    """The bit slices of each attribute of a block of integer rows.

    Attribute d of row r is ``low[d] + sum(2**j * slices[d][j][r])``.
    """

    def __init__(self, values: np.ndarray):
        self.n, self.values = len(values), values
        words = -(-self.n // 64)
        self.full = np.zeros(words * 64, np.uint8)
        self.full[: self.n] = 1
        self.full = np.packbits(self.full, bitorder="little").view(U64)
        self.low = values.min(axis=0)
        self.slices: list[list[np.ndarray]] = []
        for column in (values.view(U64) - self.low.view(U64)).T:  # unsigned, for the span of longs is no long
            bits = int(column.max()).bit_length()
            padded = np.zeros(words * 64, U64)
            padded[: self.n] = column
            self.slices.append([np.packbits((padded >> U64(j) & U64(1)).astype(np.uint8), bitorder="little").view(U64) for j in range(bits)])
        self.flipped = [[~s & self.full for s in own] for own in self.slices]

    def products(self, query: np.ndarray) -> list[np.ndarray | None]:
        """Bit slices of each row's inner product with ``query``, lowest first, up to a constant.

        An attribute is added once for each set bit of its weight, shifted;
        a negative weight adds the complement. Adders of three bitmaps to two
        reduce each column of bitmaps to one.
        """
        most = max(map(len, self.slices)) + max(abs(w).bit_length() for w in query.tolist())
        columns: list[list[np.ndarray]] = [[] for _ in range(most + len(self.slices).bit_length() + 2)]
        for weight, plain, flipped in zip(query.tolist(), self.slices, self.flipped, strict=True):
            own = plain if weight > 0 else flipped
            weight = abs(weight)
            while weight:
                i = (weight & -weight).bit_length() - 1
                for j, s in enumerate(own):
                    columns[i + j].append(s)
                weight &= weight - 1
        out: list[np.ndarray | None] = []
        for c, column in enumerate(columns):
            while len(column) > 2:
                a, b, d = column.pop(), column.pop(), column.pop()
                both = a ^ b
                column.insert(0, both ^ d)
                columns[c + 1].append((a & b) | (both & d))
            if len(column) == 2:
                columns[c + 1].append(column[0] & column[1])
                column = [column[0] ^ column[1]]
            out.append(column[0] if column else None)
        return out

    def top(self, query: np.ndarray, k: int, allowed: np.ndarray) -> np.ndarray:
        """Row numbers of the ``k`` largest products among the rows of the bitmap ``allowed``; of equal ones, the first rows."""
        sure, tied = np.zeros_like(allowed), allowed
        for s in reversed(self.products(query)):
            if s is None:
                continue
            ahead = sure | (tied & s)
            count = int(np.bitwise_count(ahead).sum())
            if count > k:
                tied = tied & s
            else:
                sure, tied = ahead, tied & ~s
                if count == k:
                    return self.rows(sure)
        return np.concatenate([chosen := self.rows(sure), self.rows(tied)[: k - len(chosen)]])

    def rows(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[: self.n])


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, v) with floor(scale * x) of each component; rows that are null or hold null or non-finite components are left out."""
    x = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where("vec_id is not null and x is not null and size(x) > 0")
    rows = rows.where(F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return rows.select("vec_id", F.transform("x", lambda x: F.floor(x * scale).cast("long")).alias("v"))


def top_products(vectors: DataFrame, every: int, k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of each query with the other rows.

    Queries are the rows whose vec_id is divisible by ``every``. Components
    are quantised to floor(``scale`` * x), as longs, and their products summed
    exactly; a sum beyond a long is given as the nearest long and ranks within
    its block of rows by its true value. Equal scores are ranked by vec_id. A
    query is compared with the rows of its own number of components, but for
    those of its own vec_id. Equal rows count once; of different vectors with
    the vec_id of a query the least asks. Rows with a null id or vector, or a
    null or non-finite component, take no part. Rows are dealt to blocks, each
    of which is indexed once, and every query is sent to every block.
    """
    rows = quantised(vectors, scale).distinct()
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    stored = rows.select(F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), "vec_id", "v")
    sent = asked.select(F.size("v").alias("dim"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "vec_id", "v")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Holds one block's index and a batch of queries at a time; a block's rows come before its queries."""
        at, held, index, ids = None, [], None, None
        for batch in batches:
            places = np.stack([batch.column(c).to_numpy() for c in ("dim", "block", "kind")], 1)
            edges = np.flatnonzero((places[1:] != places[:-1]).any(1)) + 1
            for part in (batch.slice(a, b - a) for a, b in zip([0, *edges], [*edges, len(places)], strict=True) if b > a):
                own = tuple(part.column(c)[0].as_py() for c in ("dim", "block"))
                if own != at:
                    at, held, index = own, [], None
                if part.column("kind")[0].as_py() == 0:
                    held.append(pa.Table.from_batches([part]))
                elif held or index is not None:
                    if index is None:
                        block = pa.concat_tables(held)
                        held, ids, index = [], block.column("vec_id").to_numpy(), BitSlices(matrix(block))
                    yield answers(index, ids, pa.Table.from_batches([part]), k)

    found = stored.union(sent).repartition("dim", "block").sortWithinPartitions("dim", "block", "kind", "vec_id").mapInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def answers(index: BitSlices, ids: np.ndarray, queries: pa.Table, k: int) -> pa.RecordBatch:
    """(query_id, vec_id, score) of the ``k`` best rows of a block, whose ascending vec_ids are ``ids``."""
    found = [np.empty((3, 0), np.int64)]
    for query_id, query in zip(queries.column("vec_id").to_numpy(), matrix(queries), strict=True):
        allowed, (lo, hi) = index.full, np.searchsorted(ids, [query_id, query_id + 1])
        if hi > lo:
            allowed = allowed.copy()
            for own in range(lo, hi):
                allowed[own // 64] &= ~(U64(1) << U64(own % 64))
        best = index.top(query, k, allowed)
        found.append(np.stack([np.full(len(best), query_id), ids[best], products(index.values[best], query)]))
    out = np.concatenate(found, axis=1)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["query_id", "vec_id", "score"])


def products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, at the ends of the longs where they are beyond."""
    if np.abs(rows.astype(float)).max(initial=0) * np.abs(query.astype(float)).max(initial=0) * len(query) < 2.0**62:
        return rows @ query
    sums = [sum(a * b for a, b in zip(row, query.tolist(), strict=True)) for row in rows.tolist()]
    return np.array([min(max(x, -(1 << 63)), (1 << 63) - 1) for x in sums], np.int64)


def matrix(table: pa.Table) -> np.ndarray:
    """The rows of column v, which have one length."""
    v = table.column("v").combine_chunks()
    v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
    return np.ascontiguousarray(v.flatten().to_numpy().reshape(len(v), -1))
