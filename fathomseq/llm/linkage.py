"""Groups of linked things: keys with several ids, connected components, and links verified within clusters."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import Scratch, runs

#: Most members and most payload units that one chunk of a cluster holds; a task compares two chunks.
CHUNK_ROWS, CHUNK_UNITS = 1024, 1_500_000


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) for every end of an edge (a, b); the component is its smallest id.

    In each round every vertex learns the least of its neighbours and itself,
    takes it for its own and links its other neighbours to it. A vertex that is
    less than all its neighbours says nothing, for they link to it or to less
    themselves. The rounds end when no link but a vertex's own is left, so there
    are about as many as the logarithm of the longest path. A round is one
    shuffle by vertex, read as a sorted stream that holds one row of a vertex
    however many neighbours it has, and is written to the shared folder. Null
    ends are ignored; the result is such a table.
    """
    now = scratch.cut(edges.select("a", "b").where("a <> b"))
    while True:
        ways = F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("u")), F.struct(F.col("b").alias("v"), F.col("a").alias("u")))
        spread = now.where("a <> b").select(F.inline(ways))  # the least of a group has a row of its own, which is no link
        left = Observation()
        told = spread.repartition("v").sortWithinPartitions("v", "u").mapInArrow(adopt_least, "a long, b long, own boolean")
        after = scratch.cut(told.observe(left, F.count_if(~F.col("own")).alias("n")))
        scratch.drop(now)
        now = after
        if not left.get["n"]:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component"))


def adopt_least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One ``own`` row (vertex, least) of each vertex, and (neighbour, least) for the others' of a vertex that isn't the least.

    The input (v, u) has each vertex with each of its neighbours, sorted by both.
    """
    last = (None, None, None)  # vertex, neighbour and least so far
    for batch in batches:
        if not batch.num_rows:
            continue
        v, u = (batch.column(i).to_numpy() for i in range(2))
        same = np.append(v[0] == last[0], v[1:] == v[:-1])
        fresh = ~same | np.append(u[0] != last[1], u[1:] != u[:-1])
        v, u, same = v[fresh], u[fresh], same[fresh]
        if not len(v):
            continue
        run = np.cumsum(~same) - 1
        first = np.flatnonzero(~same)
        heads = np.minimum(v[first], u[first])
        least = np.where(run >= 0, heads[np.maximum(run, 0)], last[2]) if len(heads) else np.full(len(v), last[2])
        other = same & (least < v)
        last = (v[-1], u[-1], least[-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([v[first], u[other]])), pa.array(np.concatenate([heads, least[other]])), pa.array(np.arange(len(first) + int(other.sum())) < len(first))],
            ["a", "b", "own"],
        )


def shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct rows (key, id) whose key has other ids too; the input is sorted by both.

    Only one row is kept between batches, so that a key may have any number of ids.
    """
    key = one = None  # the last row
    told = False  # whether it was passed on
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, ids = (batch.column(i).to_numpy() for i in range(2))
        if key is not None:
            keys, ids = np.append(key, keys), np.append(one, ids)
        new = np.append(True, (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1]))
        keys, ids = keys[new], ids[new]
        alike = keys[1:] == keys[:-1]
        keep = np.append(alike, False) | np.append(False, alike)
        last, keep[0] = keep[-1] or (len(keep) == 1 and told), keep[0] and not told
        key, one, told = keys[-1], ids[-1], bool(last)
        yield pa.RecordBatch.from_arrays([pa.array(keys[keep]), pa.array(ids[keep])], ["key", "id"])


def tiles(members: DataFrame, units: str, scratch_key: str = "cluster", rows: int | None = None, most: int | None = None) -> DataFrame:
    """``members`` (cluster, id, ...) with a long ``tile`` and a boolean ``side``: every two members of a cluster meet in one tile.

    A cluster within the chunk limits (``rows`` members, ``most`` of ``units``)
    is one tile. A larger one is dealt into chunks by a hash of the id and each
    pair of chunks is a tile, so that no task holds more than two chunks however
    large the cluster is. In a tile of two chunks ``side`` tells them apart;
    members of one of them meet in that chunk's own tile.
    """
    sizes = members.groupBy(scratch_key).agg(
        F.greatest(F.ceil(F.count("*") / (rows or CHUNK_ROWS)), F.ceil(F.sum(F.expr(units)) / (most or CHUNK_UNITS)), F.lit(1)).cast("int").alias("chunks")
    )
    dealt = members.join(sizes, scratch_key).withColumn("own", F.pmod(F.xxhash64("id"), F.col("chunks")))
    return (
        dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("side", F.col("own") <= F.col("other"))
        .withColumn("tile", F.xxhash64(scratch_key, F.least("own", "other"), F.greatest("own", "other")))
        .drop("own", "other", "chunks", scratch_key)
    )


def sides(table: pa.Table) -> np.ndarray | None:
    """The side of each row of a tile of two chunks, whose rows need comparing with the other side's only; else None."""
    side = table.column("side").to_numpy()
    return None if side.all() or not side.any() else side


class Forest:
    """Union-find over 0 to n - 1."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        """False if they were joined before."""
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j

    def roots(self) -> np.ndarray:
        while (self.up[self.up] != self.up).any():
            self.up = self.up[self.up]
        return self.up


def together(tables: Iterator[pa.Table], small: int) -> Iterator[pa.Table]:
    """Joins tables of up to ``small`` rows to larger ones of some thousand rows or ``CHUNK_UNITS`` bytes; those of one row are left out."""
    held, rows, size = [], 0, 0
    for table in tables:
        if table.num_rows > small:
            yield table
        elif table.num_rows > 1:
            held.append(table)
            rows, size = rows + table.num_rows, size + table.nbytes
            if rows >= 4096 or size >= CHUNK_UNITS:
                yield pa.concat_tables(held)
                held, rows, size = [], 0, 0
    if held:
        yield pa.concat_tables(held)


def verified_edges(tiled: DataFrame, link: Callable[[pa.Table, Forest], Iterator[tuple[int, int]]], small: int = 0) -> DataFrame:
    """(a, b) for the links that ``link`` finds within each tile; a forest of them, not all pairs.

    ``link`` gets a tile's rows and the forest joined so far, and yields pairs
    of row numbers whose link it has verified. Tiles of up to ``small`` rows come
    to it many at a time, for it to keep their rows apart by ``tile``. Tiles are dealt to a fixed number
    of tasks, for they are small but take long.
    """
    parts = int(tiled.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[int] = []
        b: list[int] = []
        for table in together(runs(batches, "tile"), small):
            ids = table.column("id").to_numpy()
            if len(ids) > 1:
                forest = Forest(len(ids))
                for i, j in link(table.combine_chunks(), forest):
                    if forest.join(i, j):
                        a.append(int(ids[i]))
                        b.append(int(ids[j]))
            if len(a) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return tiled.repartition(parts, "tile").sortWithinPartitions("tile").mapInArrow(verify, "a long, b long")
