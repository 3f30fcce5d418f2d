"""A bounded, repeatable sample of labelled rows, and the labels of a fold."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema


def fold(folds: int):
    """crc32 of the doc_id as text, modulo ``folds``; null where doc_id is null."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def labelled(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, label) with one row for each document; rows with null are dropped, and 1 wins where labels disagree."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    return rows.groupBy("doc_id").agg(F.max("label").alias("label"))


def sampled(labels: DataFrame, per_class: int) -> DataFrame:
    """At most ``per_class`` rows of each label, those with the smallest hashes of doc_id."""
    parts = [labels.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    return parts[0].union(parts[1])


def sampled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, text, label) of a bounded sample, which is small enough to send to every executor; repeated doc_ids count once."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.join(F.broadcast(sample), "doc_id")
    first = Window.partitionBy("doc_id").orderBy("text")
    return found.withColumn("n", F.row_number().over(first)).where("n = 1").drop("n")


def fitted(rows: DataFrame, fit: Callable[[pa.Table], object]) -> object:
    """What ``fit`` makes of all ``rows`` of a bounded sample, by doc_id, in one task; only that comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, schema).sort_by("doc_id")
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(table))], pa.binary())], ["model"])

    schema = to_arrow_schema(rows.schema)
    return pickle.loads(rows.repartition(1).mapInArrow(run, "model binary").first()[0])
