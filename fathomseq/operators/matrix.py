"""Expression matrices in long form: (id, sample, value)."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ANNOTATED, ASSEMBLED = "ENST", "MSTRG"
#: Of each matrix flavour: what its path holds, its id column, columns dropped by name and by place, and whether counts are rounded.
FLAVOURS = {
    "talon": ("talon", "annot_transcript_id", (), 10, False),
    "cupcake": ("collapsed", "id", (), 0, False),
    "bambu": ("counts_transcript.txt", "TXNAME", ("GENEID",), 0, True),
    "isoquant": ("transcript_model_grouped_counts", "#feature_id", (), 0, False),
}


def flavour_of(path: str) -> str:
    """The flavour whose mark the path holds; the last of several."""
    found = [name for name, (mark, *_) in FLAVOURS.items() if mark in path]
    if not found:
        raise ValueError(f"no matrix flavour is known by the path {path}")
    return found[-1]


def to_long(wide: DataFrame, flavour: str) -> DataFrame:
    """(id, sample, value) of a wide matrix of that flavour."""
    _, key, dropped, leading, rounded = FLAVOURS[flavour]
    samples = [c for c in wide.columns if c != key and c not in dropped][leading:]
    long = wide.select(F.col(f"`{key}`").alias("id"), *[F.col(f"`{c}`").cast("double").alias(c) for c in samples]).unpivot("id", samples, "sample", "value")
    return long.withColumn("value", F.bround("value")) if rounded else long


def to_wide(long: DataFrame, samples: list[str]) -> DataFrame:
    """One column for each of ``samples``; null where a sample has no value."""
    return long.groupBy("id").pivot("sample", samples).agg(F.sum("value"))


def round_half_even(long: DataFrame) -> DataFrame:
    return long.withColumn("value", F.bround("value"))


def bind_samples(frames: dict[str, DataFrame]) -> DataFrame:
    """(id, sample, value) of one (id, value) frame for each sample, matched by id and not by place."""
    return reduce(DataFrame.unionByName, [df.select("id", F.lit(name).alias("sample"), "value") for name, df in frames.items()])


def rename_samples(long: DataFrame, pattern: str = ".aligned.md", to: str = "") -> DataFrame:
    """Sample names with each match of a regular expression replaced; ``.`` fits any character."""
    return long.withColumn("sample", F.regexp_replace("sample", F.lit(pattern), F.lit(to)))


def presence(long: DataFrame, at_least: float | None = None) -> DataFrame:
    """(id, n_samples): in how many samples an id has a value above 0, or of ``at_least`` that much."""
    there = F.col("value") > 0 if at_least is None else F.col("value") >= at_least
    return long.groupBy("id").agg(F.count_if(there).alias("n_samples"))


def is_annotated(name: Column) -> Column:
    return name.contains(ANNOTATED)


def kept_ids(long: DataFrame, annotated: int = 1, novel: int = 2) -> DataFrame:
    """Ids present in enough samples: annotated ones in 1, others in 2."""
    return presence(long).where(F.col("n_samples") >= F.when(is_annotated(F.col("id")), annotated).otherwise(novel)).select("id")


def kept_ids_assembled(long: DataFrame, min_samples: int = 2) -> DataFrame:
    """Annotated or assembled ids present in ``min_samples`` samples; ids of neither kind are dropped."""
    kind = F.col("id").contains(ANNOTATED) | F.col("id").contains(ASSEMBLED)
    return presence(long).where(kind & (F.col("n_samples") >= min_samples)).select("id")


def kept_ids_by_support(long: DataFrame, min_reads: float, min_samples: float, n_samples: int | None = None) -> DataFrame:
    """Ids with at least ``min_reads`` in ``min_samples`` samples, or in that share of all samples if under 1."""
    counted = presence(long, min_reads)
    if min_samples >= 1:
        return counted.where(F.col("n_samples") >= min_samples).select("id")
    if n_samples is not None:
        return counted.where(F.col("n_samples") >= F.floor(F.lit(min_samples * n_samples))).select("id")
    total = long.agg(F.count_distinct("sample").alias("all_samples"))
    return counted.join(F.broadcast(total), how="cross").where(F.col("n_samples") >= F.floor(F.col("all_samples") * min_samples)).select("id")


def cpm(long: DataFrame) -> DataFrame:
    """Values as millionths of their sample's total, over the unfiltered matrix; null where the total is 0.

    Totals are summed per sample before they meet the rows, so a large sample isn't gathered in one task.
    """
    totals = long.groupBy("sample").agg(F.sum("value").alias("total"))
    return long.join(totals, "sample").select("id", "sample", (F.try_divide("value", "total") * 1e6).alias("value"))


def only(rows: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose ``key`` is one of ``ids`` (id)."""
    return rows.join(ids.select(F.col("id").alias(key)), key, "left_semi")


def in_order_of(rows: DataFrame, ordered: DataFrame) -> DataFrame:
    """Rows with ``ord``, the place where their id first stands in ``ordered`` (id, ord); others are dropped."""
    return rows.join(ordered.groupBy("id").agg(F.min("ord").alias("ord")), "id")


def cap_per_group(rows: DataFrame, groups: list[str], order: list[str], most: int) -> DataFrame:
    """The first ``most`` rows of each group."""
    first = Window.partitionBy(*groups).orderBy(*order)
    return rows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= most).drop("place")


def sample_of_file(path: Column, ending: str) -> Column:
    """The file's name without its folder and ``ending`` (a regular expression)."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), re.compile(ending).pattern + "$", "")


def in_order_or_fail(rows: DataFrame, ordered: DataFrame, key: str) -> DataFrame:
    """Rows with ``ord``, one for each row of ``ordered`` (id, ord), sorted by it; an id without a row is an error."""
    found = F.when(F.col(key).isNotNull(), F.col(key)).otherwise(F.raise_error(F.concat(F.lit("nothing is named "), F.coalesce("id", F.lit("null")))))
    joined = ordered.select("id", F.col("ord").alias("place")).join(rows.drop("ord"), F.col("id") == F.col(key), "left").withColumn(key, found)
    return joined.orderBy("place").select(*[c for c in rows.columns if c != "ord"], F.col("place").alias("ord"))
