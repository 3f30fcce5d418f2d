"""Interval algebra on 1-based closed intervals (start_pos, end_pos)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Width of the bins that overlapping intervals meet in.
BIN = 10_000


def merge(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, start_pos, end_pos) with overlapping intervals of a group made one; adjacent ones stay apart."""
    order = Window.partitionBy(*keys).orderBy("start_pos", "end_pos")
    reach = F.max("end_pos").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reach.isNull() | (F.col("start_pos") > reach), 1).otherwise(0)
    islands = rows.select(*keys, "start_pos", "end_pos").withColumn("begins", begins).withColumn("island", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(*keys, "island").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos")).drop("island")


def overlaps(left: DataFrame, right: DataFrame, width: int = BIN) -> DataFrame:
    """All pairs of rows (structs ``a`` and ``b``) on one ``chrom`` whose intervals share a base.

    Each interval stands in every bin it touches and bins are joined by
    equality; a pair counts in the bin of its later start only.
    """

    def binned(rows: DataFrame, name: str) -> DataFrame:
        bins = F.sequence(F.floor(F.col("start_pos") / width), F.floor(F.col("end_pos") / width))
        return rows.where("start_pos <= end_pos").select(F.struct(*rows.columns).alias(name), F.col("chrom"), F.explode(bins).alias("bin"))

    pairs = binned(left, "a").join(binned(right, "b"), ["chrom", "bin"])
    meet = (F.col("a.start_pos") <= F.col("b.end_pos")) & (F.col("b.start_pos") <= F.col("a.end_pos"))
    return pairs.where(meet & (F.col("bin") == F.floor(F.greatest("a.start_pos", "b.start_pos") / width))).select("a", "b")


def subtract(rows: DataFrame, pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Pieces of ``rows`` (keys, start_pos, end_pos) that no partner covers.

    ``pairs`` holds a row's keys and interval with its partners' (other_start,
    other_end). Partners are clipped and walked in order of start; what lies
    between the furthest end so far and the next start is a piece.
    """
    own = [*keys, "start_pos", "end_pos"]
    covers = pairs.select(*own, F.greatest("other_start", "start_pos").alias("s"), F.least("other_end", "end_pos").alias("e"))
    ends = rows.select(*own, (F.col("end_pos") + 1).alias("s"), (F.col("end_pos") + 1).alias("e"))
    walk = Window.partitionBy(*own).orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    free_from = F.coalesce(F.max("e").over(walk) + 1, F.col("start_pos"))
    pieces = covers.unionByName(ends).withColumn("from", free_from).where(F.col("from") <= F.col("s") - 1)
    return pieces.select(*keys, F.col("from").alias("start_pos"), (F.col("s") - 1).alias("end_pos"))


def without_single_base_groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the groups that have at least one piece of more than one base."""
    kept = rows.groupBy(*keys).agg(F.bool_or(F.col("end_pos") > F.col("start_pos")).alias("long")).where("long").drop("long")
    return rows.join(kept, keys, "left_semi")


def number_exons(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with ``exon_number`` from 1 along the strand: on ``-`` from the last start."""
    along = F.when(F.col("strand") == "-", -F.col("start_pos")).otherwise(F.col("start_pos"))
    return rows.withColumn("exon_number", F.row_number().over(Window.partitionBy(*keys).orderBy(along, "end_pos")))


def in_region(rows: DataFrame, chrom: str, start: int, end: int) -> DataFrame:
    """Rows that share a base with the region; reaches Parquet statistics where the table is sorted by place."""
    return rows.where((F.col("chrom") == chrom) & (F.col("start_pos") <= end) & (F.col("end_pos") >= start))
