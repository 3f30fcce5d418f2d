"""Samples, cells and molecules: demultiplexing, deduplication, barcode correction, whitelists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def demultiplex(members: DataFrame, stats: DataFrame, classified: DataFrame) -> DataFrame:
    """(isoform, sample, n_reads) from isoforms to keep (isoform), reads of isoforms (isoform, read) and samples of reads (read, sample)."""
    kept = stats.join(members.select("isoform").distinct(), "isoform", "left_semi")
    return kept.join(classified, "read").groupBy("isoform", "sample").agg(F.count("*").alias("n_reads"))


def attach_abundance(isoforms: DataFrame, stats: DataFrame) -> DataFrame:
    """Isoforms with their number of reads, 0 where there are none."""
    counts = stats.groupBy("isoform").agg(F.count("*").alias("n_reads"))
    return isoforms.join(counts, "isoform", "left").withColumn("n_reads", F.coalesce("n_reads", F.lit(0)))


def count_molecules(reads: DataFrame) -> DataFrame:
    """(isoform, n_molecules)."""
    return reads.groupBy("isoform").agg(F.count_distinct("molecule").alias("n_molecules"))


def umi_dedup(reads: DataFrame, keys: tuple[str, ...] = ("cell", "umi", "type"), molecule: str = "molecule") -> DataFrame:
    """One molecule, the least, for each cell, UMI and type."""
    first = Window.partitionBy(*keys).orderBy(molecule)
    return reads.withColumn("place", F.row_number().over(first)).where("place = 1").drop("place")


def correct_barcodes(counts: DataFrame) -> DataFrame:
    """(tag, corrected): each tag, or the most frequent tag one edit away that has more reads.

    ``counts`` is (tag, n). One edit leaves one half of a tag unchanged, so
    tags meet by their halves and no other pairs are compared; of equal counts
    the least tag is taken.
    """
    tags = counts.groupBy("tag").agg(F.sum("n").alias("n"))
    size = F.length("tag")

    def halves(length) -> list:  # noqa: ANN001
        """The first and the last part of a tag as one of ``length`` characters would be cut, with their sizes."""
        first = F.floor(length / 2).cast("int")
        last = (length - first).cast("int")
        return [F.concat_ws("|", F.lit("<"), first, F.left("tag", first)), F.concat_ws("|", F.lit(">"), last, F.right("tag", last))]

    keyed = tags.withColumn("half", F.explode(F.array(*halves(size))))
    others = tags.select(F.col("tag").alias("other"), F.col("n").alias("other_n"), F.explode(F.array_distinct(F.array(*[h for d in (-1, 0, 1) for h in halves(size + d)]))).alias("half"))
    near = keyed.join(others, "half").where((F.col("other_n") > F.col("n")) & (F.levenshtein("tag", "other", 1) != -1))
    best = near.groupBy("tag").agg(F.min(F.struct((-F.col("other_n")).alias("rank"), "other")).alias("best"))
    return tags.join(best, "tag", "left").select("tag", F.coalesce("best.other", "tag").alias("corrected"))


def collate(groups: DataFrame, molecules: DataFrame, classes: DataFrame) -> DataFrame:
    """(molecule, cell, umi, isoform, category): members of isoform groups (isoform, members) with their molecule's tags and their isoform's class."""
    members = groups.select("isoform", F.explode("members").alias("molecule"))
    return members.join(molecules, "molecule").join(classes, "isoform").select("molecule", "cell", "umi", "isoform", "category")


def whitelist(reads: DataFrame, max_frac_a: float, min_count: int, min_datasets: int) -> DataFrame:
    """(transcript) with at least ``min_count`` reads, not primed within A, in each of at least ``min_datasets`` datasets."""
    counts = reads.where(F.col("frac_a") <= max_frac_a).groupBy("transcript", "dataset").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= min_count).groupBy("transcript").agg(F.count("*").alias("sets")).where(F.col("sets") >= min_datasets).select("transcript")


def abundance(reads: DataFrame, allowed: DataFrame, datasets: list[str]) -> DataFrame:
    """A row for each allowed transcript with its number of reads in each dataset, 0 where there are none."""
    kept = reads.join(allowed.select("transcript").distinct(), "transcript", "left_semi")
    return kept.groupBy("transcript").pivot("dataset", datasets).agg(F.count(F.lit(1))).na.fill(0)
