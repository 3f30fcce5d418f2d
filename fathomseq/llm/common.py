"""What the operators share: scratch tables, Arrow batches and vectorised hashing of words."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that are hashed at once; a longer text is hashed alone.
PIECE = 1 << 17

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_powers: dict[str, np.ndarray] = {}


# --- scratch tables -------------------------------------------------------


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share. A machine-local one serves only where a local master has none set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fathomseq-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a scratch table, wherever it is."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Tables written to the shared folder so that a lost executor costs no recomputation of the lineage."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.n = spark, f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}", 0
        atexit.register(self.close)

    def cut(self, df: DataFrame) -> DataFrame:
        """Writes ``df`` as Parquet and reads it again."""
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Deletes a table made by ``cut`` that no later step reads."""
        remove(self.spark, df._scratch_path)

    def close(self) -> None:
        try:
            remove(self.spark, self.root)
        except Exception:  # the session may have ended before
            return


# --- Arrow batches ---------------------------------------------------------


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """``fn`` over each Arrow batch, cut into pieces of bounded text where a column ``text`` is there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                yield from fn(piece)

    return df.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``PIECE`` bytes of column ``text`` each."""
    if batch.num_rows == 0:
        return
    if "text" not in batch.schema.names:
        yield batch
        return
    _, ends = text_bytes(batch.column("text"))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(ends, ends[at] + PIECE, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one behind the other, and where each begins and ends; null is empty."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, at - at[0]


def signed(x: np.ndarray) -> pa.Array:
    """64-bit hashes as the signed longs that Spark has."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows of the same ``key`` as one table each; the input is sorted by ``key``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if held and held[-1].column(key)[0].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        at = 0
        for to in edges:
            held.append(batch.slice(at, to - at))
            yield pa.Table.from_batches(held)
            held, at = [], to
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


# --- hashing ---------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values so that every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd base modulo 2**64, and their inverses."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, PIECE + 1024)
        inverse = U64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            x = np.full(size, base, U64)
            x[0] = 1
            _powers[name] = np.cumprod(x, dtype=U64)
    return _powers["up"][:n], _powers["down"][:n]


def _space(n: int) -> np.ndarray:
    """An array whose content the next call may overwrite; taking memory anew for each piece costs more than the sums."""
    if len(_powers.get("space", ())) < n:
        _powers["space"] = np.empty(max(n, PIECE + 1024), U64)
    return _powers["space"][:n]


def spans_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``values``, the same wherever the span lies."""
    up, down = powers(len(values) + 1)
    total = _space(len(values) + 1)
    own = total[1:]
    np.add(values, U64(1), out=own, casting="unsafe", dtype=U64)
    own *= up[:-1]
    total[0] = 0
    np.cumsum(own, out=own)
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(U64))


def _table(change: Callable[[int], int]) -> np.ndarray:
    return np.array([change(b) for b in range(256)], np.uint8)


#: Bytes that part words: space and 0x09 to 0x0D.
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: The same, and all other ASCII bytes that are neither letters nor digits.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = _table(lambda b: b + 32 if 65 <= b <= 90 else b)


def through(table: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """``table[raw]`` for a table of 256 bytes, without making indexes of the bytes."""
    return np.frombuffer(raw.tobytes().translate(table.astype(np.uint8).tobytes()), np.uint8).view(table.dtype)


class Words:
    """The words of many texts, as spans of bytes and as hashes.

    ``first[i]`` to ``first[i + 1]`` are the words of text i.
    """

    def __init__(self, raw: np.ndarray, at: np.ndarray, parts: np.ndarray = SPACES, lower: bool = True):
        self.raw = through(LOWER, raw) if lower else raw
        if not len(raw):
            self.start = self.end = np.empty(0, np.int64)
            self.hash, self.first = np.empty(0, U64), np.zeros(len(at), np.int64)
            return
        inside = through(~parts, raw)
        turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        turns = np.concatenate([[0] * int(inside[0]), turns, [len(raw)] * int(inside[-1])]).astype(np.int64)
        self.start, self.end = turns[::2], turns[1::2]
        cuts = np.unique(at[(at > 0) & (at < len(raw))])
        cuts = cuts[inside[cuts - 1] & inside[cuts]]  # where a text ends and the next begins within a run
        if len(cuts):
            self.start, self.end = (np.sort(np.concatenate([x, cuts])) for x in (self.start, self.end))
        self.hash = spans_hash(self.raw, self.start, self.end)
        self.first = np.searchsorted(self.start, at)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the windows of ``k`` words and the text of each; a shorter text has none."""
        n = np.diff(self.first)
        full = np.maximum(n - k + 1, 0)
        doc = np.repeat(np.arange(len(n)), full)
        begin = np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full) + self.first[doc]
        return self._window(begin, k), doc

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The same, but a shorter text is one window."""
        n = np.diff(self.first)
        hashes, doc = self.windows(k)
        for length in range(1, k):
            if len(short := np.flatnonzero(n == length)):
                hashes = np.concatenate([hashes, self._window(self.first[short], length)])
                doc = np.concatenate([doc, short])
        return hashes, doc

    def _window(self, begin: np.ndarray, k: int) -> np.ndarray:
        h = np.full(len(begin), U64(k))
        for j in range(k):
            h = mix(h * U64(0xD6E8FEB86659FD93) + self.hash[begin + j])
        return h

    def sets(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles of each text, sorted, and where each text's begin and end."""
        hashes, doc = self.shingles(k)
        order = np.lexsort((hashes, doc))
        hashes, doc = hashes[order], doc[order]
        keep = np.ones(len(doc), bool)
        keep[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        hashes, doc = hashes[keep], doc[keep]
        return hashes, np.searchsorted(doc, np.arange(len(self.first)))


def segment_sum(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum, modulo 2**64, of each segment."""
    total = np.zeros(len(values) + 1, U64)
    np.cumsum(values, out=total[1:])
    return total[at[1:]] - total[at[:-1]]
