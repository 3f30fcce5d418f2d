"""Mixing sources to target weights by capped water-filling, with seeded whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

WORD = r"[^\x20\x09-\x0D]+"
#: Hexadecimal digits of the order that make a bucket: 16 to this power for each source.
BUCKET_DIGITS = 3
_EXACT = "decimal(38,0)"


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], epochs: int) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    The sum of all sizes is shared by weight; no source gets more than
    ``epochs`` times its size, and what is left over is shared again by weight
    until none is above. That ends where the sources of the least ``epochs *
    size / weight`` are capped and all others get the same for each unit of
    weight, which sums over the sources in that order find at once. Rows are
    one for each source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    rows = sizes.withColumn("weight", F.get(cycle, (F.row_number().over(by_name) - 1) % len(weights)).cast(_EXACT))
    rows = rows.withColumn("cap", (F.col("source_size") * epochs).cast(_EXACT))
    order = Window.orderBy((F.col("cap") / F.col("weight").cast("double")).asc(), F.col("source").asc_nulls_last())
    before, from_here, all_rows = (order.rowsBetween(a, b) for a, b in ((Window.unboundedPreceding, -1), (0, Window.unboundedFollowing), (Window.unboundedPreceding, Window.unboundedFollowing)))
    whole = Window.partitionBy()
    rows = rows.select(
        "*",
        (F.sum("source_size").over(whole).cast(_EXACT) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast(_EXACT).alias("left"),
        F.sum("weight").over(from_here).cast(_EXACT).alias("open"),
    )
    rows = rows.withColumn("capped", F.col("cap").cast("decimal(38,0)") * F.col("open").cast("decimal(18,0)") <= F.col("left") * F.col("weight").cast("decimal(18,0)"))
    first = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight").cast("double"), F.col("source").isNull(), "source", "left", "open"))).over(all_rows)
    rows = rows.withColumn("first", first)
    free = F.col("first.left").cast("double") * F.col("weight").cast("double") / F.col("first.open").cast("double")
    return rows.select("source", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(free).alias("target"))


def plan(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), epochs: int = 3, seed: int = 1) -> DataFrame:
    """``docs`` as a struct ``doc`` with size, source_size, target, copies and taken.

    A document's size is its number of words, 0 for null. Every document of a
    source is taken as many whole times as fit the target; for the rest, the
    documents first in the order of md5(seed, doc_id) are taken once more, as
    long as at least half of the document fits. The order is cut by key, so
    rows are not sorted: sums over buckets of the order find the bucket that
    holds the cut, and only that bucket's rows are summed one by one. Repeated
    rows stand or fall together. A null source is a source, ordered last; a
    null doc_id is ordered as the text "null". An empty table gives none.
    """
    own = docs.select(
        F.struct(*docs.columns).alias("doc"),
        F.col("source").alias("source"),
        word_count(F.col("text")).alias("size"),
        F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary")).alias("key"),
    )
    scratch = Scratch(docs.sparkSession)
    slim = scratch.cut(own.select("source", "size", "key"))
    buckets = slim.groupBy("source", F.substring("key", 1, BUCKET_DIGITS).alias("bucket")).agg(F.sum("size").alias("size"))
    sizes = buckets.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, epochs)
    targets = targets.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    targets = targets.withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))

    here = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    edge = buckets.withColumn("before", F.coalesce(F.sum("size").over(here), F.lit(0)))
    edge = edge.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).where("before <= part and before + size > part")
    edge = edge.select("of", "bucket", "before", "part")
    inside = slim.join(edge, F.col("source").eqNullSafe(F.col("of")) & (F.substring("key", 1, BUCKET_DIGITS) == F.col("bucket"))).select("of", "bucket", "before", "part", "size", "key")
    each = Window.partitionBy("of", "bucket").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("at", F.col("before") + F.coalesce(F.sum("size").over(each), F.lit(0)))
    last = F.max(F.when(F.col("at") + F.col("size") / 2 <= F.col("part"), F.struct("key", "size")))
    cuts = inside.groupBy("of").agg(F.coalesce(last, F.struct(F.min("bucket").alias("key"), F.lit(-1).cast("long").alias("size"))).alias("cut"))

    cuts = targets.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left").select(F.col("source").alias("of"), "source_size", "target", "whole", "cut")
    # a source's rows meet its cut under one of 256 parts of the order, so that a large source is dealt to many tasks
    digit = F.transform(F.sequence(F.lit(0), F.lit(255)), lambda i: F.lower(F.lpad(F.hex(i), 2, "0")))
    cuts = scratch.cut(cuts).withColumn("part", F.explode(digit))
    out = own.join(cuts, F.col("source").eqNullSafe(F.col("of")) & (F.substring("key", 1, 2) == F.col("part")))
    copies = F.col("whole") + F.when(F.struct("key", "size") <= F.col("cut"), 1).otherwise(0)
    return out.select("doc", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), epochs: int = 3, seed: int = 1) -> DataFrame:
    """``docs`` with every row as often as ``plan`` takes it and the number ``copy`` of each time, from 1; a former column ``copy`` is replaced."""
    kept = [c for c in docs.columns if c != "copy"]
    return plan(docs, weights, epochs, seed).where("copies > 0").select(*[F.col(f"doc.`{c}`").alias(c) for c in kept], F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
