"""Token counts kept as rollups by signed deltas with idempotent batch commits."""

from __future__ import annotations

import base64
import json
import os
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, remove

KEYS = ("source", "lang", "tokenizer")
#: Splits text before the merges of the rank files (GPT-2's published pattern).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARIES = "/opt/tokenizers"


@lru_cache(maxsize=4)
def _encoding(name: str, ranks: bytes):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def count_tokens(docs: DataFrame, name: str, folder: str = VOCABULARIES, to: str = "tokens", keep_text: bool = False) -> DataFrame:
    """``docs`` (text, ...) with the number of tokens of the vocabulary ``name``.tiktoken in ``folder`` as column ``to``; null text has 0.

    The text goes unless ``keep_text``; a former column ``to`` is replaced, all
    others stay. The vocabulary, under 1 MB, is read on the driver and sent to
    the executors.
    """
    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())
    kept = [c for c in docs.columns if c != to and (keep_text or c != "text")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema), f"`{to}` long"])

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(name, sent.value)
        tokens = [len(encoding.encode_ordinary(t)) if t else 0 for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(tokens, pa.int64())], [*kept, to])

    return arrow_map(docs.select(*kept, *([] if keep_text else ["text"])), count, schema)


class TokenRollups:
    """Additive totals of documents and tokens by source, language and tokenizer version.

    A batch of deltas (source, lang, tokenizer, docs, tokens; negative for
    what is taken away) is summed by key and written to a folder of its own.
    The commit is the rename of a small file of the batch's name that names
    this folder: as there is one such file at most, a batch counts once, also
    when it is run again or by two writers at a time; what the loser wrote is
    deleted. The totals over the batches committed so far are kept as a
    snapshot, written anew (``compact``) when ``compact_every`` batches came
    after it; ``totals`` adds only later batches to it. A snapshot is
    committed like a batch and names the batches that it holds. Null is a key
    like any other and null counts are 0.
    """

    SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long"

    def __init__(self, spark: SparkSession, path: str, compact_every: int = 16):
        self.spark, self.path, self.compact_every = spark, path.rstrip("/"), compact_every
        jvm = spark.sparkContext._jvm
        self._at, self._read_all = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.commons.io.IOUtils.toString
        self._fs = self._at(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for folder in ("batches", "snapshots", "data", "staging"):
            self._fs.mkdirs(self._at(f"{self.path}/{folder}"))

    def _names(self, folder: str) -> list[str]:
        return sorted(x.getPath().getName() for x in self._fs.listStatus(self._at(f"{self.path}/{folder}")))

    def _manifest(self, name: str) -> dict:
        stream = self._fs.open(self._at(f"{self.path}/{name}"))
        try:
            return json.loads(self._read_all(stream, "UTF-8"))
        finally:
            stream.close()

    def _claim(self, name: str, manifest: dict) -> bool:
        """Whether the file ``name`` is now there with this very content; one that is there stays."""
        staged, final = (self._at(f"{self.path}/{x}") for x in (f"staging/{uuid.uuid4().hex}", name))
        stream = self._fs.create(staged, False)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        if not self._fs.exists(final):
            self._fs.rename(staged, final)
        self._fs.delete(staged, False)
        return self._manifest(name) == manifest

    def _write(self, rows: DataFrame, name: str, **more: list[str]) -> bool:
        """Writes ``rows`` and commits them as ``name``."""
        folder = uuid.uuid4().hex
        rows.select(*[F.col(c).cast(t) for c, t in (x.split() for x in self.SCHEMA.split(", "))]).write.parquet(f"{self.path}/data/{folder}")
        if not (done := self._claim(name, {"data": folder, **more})):
            remove(self.spark, f"{self.path}/data/{folder}")
        return done

    def _rows(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(*[f"{self.path}/data/{f}" for f in folders])

    def committed(self) -> list[str]:
        return self._names("batches")

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """False if ``batch`` was committed before, or by another writer meanwhile; then nothing changes."""
        if not batch.replace("-", "").replace("_", "").isalnum():
            raise ValueError("a batch name has letters, digits, - and _ only")
        if self._fs.exists(self._at(f"{self.path}/batches/{batch}")):
            return False
        sums = deltas.groupBy(*KEYS).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("docs", "tokens")])
        done = self._write(sums.where("docs <> 0 or tokens <> 0"), f"batches/{batch}")
        if done and len(self._state()[1]) >= self.compact_every:
            self.compact()
        return done

    def _state(self) -> tuple[dict, list[str]]:
        """The last snapshot's manifest and the batches that came after it."""
        names = self._names("snapshots")
        last = self._manifest(f"snapshots/{names[-1]}") if names else {"data": None, "batches": []}
        return last, sorted(set(self.committed()) - set(last["batches"]))

    def compact(self) -> bool:
        """Writes the totals as the next snapshot; False if nothing came after the last one or another writer was first.

        Snapshots and batches that are no longer read stay, so that readers of them can end.
        """
        last, later = self._state()
        if not later:
            return False
        name = f"snapshots/{len(self._names('snapshots')):010d}"
        return self._write(self._totals(last, later), name, batches=sorted({*last["batches"], *later}))

    def _totals(self, last: dict, later: list[str]) -> DataFrame:
        folders = ([last["data"]] if last["data"] else []) + [self._manifest(f"batches/{b}")["data"] for b in later]
        rows = self._rows(folders) if folders else self.spark.createDataFrame([], self.SCHEMA)
        return rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens) where anything is left."""
        return self._totals(*self._state())


def signed(counts: DataFrame, sign: int, tokenizer: str | Column, tokens: str = "tokens") -> DataFrame:
    """Deltas that add (1) or take away (-1) the documents of ``counts`` (source, lang, and a column of tokens); ``tokenizer`` is a name or a column."""
    return counts.select(F.col("source").cast("string"), F.col("lang").cast("string"), F.lit(tokenizer).alias("tokenizer"), F.lit(sign).cast("long").alias("docs"), (F.coalesce(F.col(tokens), F.lit(0)) * sign).alias("tokens"))


def revised(counts: DataFrame, old: str, new: str, old_tokens: str, new_tokens: str) -> DataFrame:
    """Deltas that move documents from one count to another."""
    return signed(counts, -1, old, old_tokens).union(signed(counts, 1, new, new_tokens))
