"""Gene models: features as rows (chrom, source, type, start_pos, end_pos, strand, gene_id, transcript_id, ...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import intervals

RETAINED, READTHROUGH = "retained_intron", "readthrough_transcript"
UNSTRANDED = "*"


def stranded(features: DataFrame) -> DataFrame:
    """Features of a known strand; a null strand is unknown."""
    return features.where(F.col("strand") != UNSTRANDED)


def drop_excluded(transcripts: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """Transcripts that are not in ``excluded`` (transcript_id), of type retained_intron, or tagged retained or readthrough."""
    bad = F.coalesce(F.arrays_overlap("tags", F.array(F.lit(RETAINED), F.lit(READTHROUGH))), F.lit(False))
    kept = transcripts.where(~bad & ~F.coalesce(F.col("transcript_type") == RETAINED, F.lit(False)))
    return kept if excluded is None else kept.join(excluded.select("transcript_id").distinct(), "transcript_id", "left_anti")


def multi_exon_by_records(features: DataFrame, least: int = 3) -> DataFrame:
    """(id) of the transcripts with more than two records: their own and at least two exons."""
    return features.groupBy(F.col("transcript_id").alias("id")).count().where(F.col("count") >= least).select("id")


def multi_exon_by_attribute(transcripts: DataFrame) -> DataFrame:
    return transcripts.where("num_exons > 1").select("id")


def distinct_features(features: DataFrame) -> DataFrame:
    """One of the features alike in place, strand, type and ids."""
    return features.dropDuplicates(["chrom", "start_pos", "end_pos", "strand", "type", "gene_id", "transcript_id"])


def tx2gene(features: DataFrame) -> DataFrame:
    return features.select("gene_id", "transcript_id").distinct()


def novel(features: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column`` that ``known`` lacks; null is a value."""
    return features.select(column).subtract(known.select(column))


def novel_in_known_genes(features: DataFrame, known: DataFrame) -> DataFrame:
    """(gene_id, transcript_id) of novel transcripts of genes that are not novel."""
    pairs = tx2gene(features).join(novel(features, known, "transcript_id"), "transcript_id", "left_semi")
    return pairs.join(novel(features, known, "gene_id"), "gene_id", "left_anti").select("gene_id", "transcript_id")


def gene_extents(features: DataFrame) -> DataFrame:
    """A record for each (gene_id, chrom, strand), from its least start to its greatest end."""
    return features.groupBy("gene_id", "chrom", "strand").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"))


def gene_records(features: DataFrame, kind: str = "isoseq") -> DataFrame:
    """A gene record for each gene_id, with names and types filled in; fails where a gene lies on two chromosomes or strands."""
    one = F.assert_true((F.min("chrom") == F.max("chrom")) & (F.min("strand") == F.max("strand")), "a gene lies on two chromosomes or strands")
    rows = features.groupBy("gene_id").agg(
        F.min("chrom").alias("chrom"), F.min("strand").alias("strand"), F.min("source").alias("source"), F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), one.alias("checked")
    )
    return rows.where("checked is null").select(
        "gene_id", "chrom", F.lit("gene").alias("type"), "source", "start_pos", "end_pos", "strand", F.lit(".").alias("phase"), F.col("gene_id").alias("gene_name"), F.lit(kind).alias("gene_type"), F.lit(0).alias("level")
    )


def with_genes(features: DataFrame, kind: str = "isoseq") -> DataFrame:
    """Features with their transcript's and gene's name, type and level, and a record for each gene; ``gene_first`` orders it before its features."""
    named = features.withColumns({"transcript_name": F.col("transcript_id"), "transcript_type": F.lit(kind), "gene_name": F.col("gene_id"), "gene_type": F.lit(kind), "level": F.lit(0), "gene_first": F.lit(1)})
    return gene_records(features, kind).withColumn("gene_first", F.lit(0)).unionByName(named, allowMissingColumns=True)


def combine(known: DataFrame, features: DataFrame, novel_genes: bool = False) -> DataFrame:
    """``known`` features with the novel transcripts of ``features``.

    Without ``novel_genes`` only those of known genes are added; with it all
    are, and a gene record for each novel gene.
    """
    if not novel_genes:
        added = features.join(novel_in_known_genes(features, known).select("transcript_id").distinct(), "transcript_id", "left_semi")
        return known.unionByName(added, allowMissingColumns=True)
    added = features.join(novel(features, known, "transcript_id"), "transcript_id", "left_semi")
    genes = gene_extents(features.join(novel(features, known, "gene_id"), "gene_id", "left_semi"))
    genes = genes.withColumns({"type": F.lit("gene"), "source": F.lit("PacBio")})
    return known.unionByName(added, allowMissingColumns=True).unionByName(genes, allowMissingColumns=True)


def collapse(exons: DataFrame, transcripts: DataFrame | None = None, excluded: DataFrame | None = None, collapse_only: bool = False) -> DataFrame:
    """(gene_id, chrom, strand, start_pos, end_pos, exon_number): one model for each gene.

    Exons of the transcripts that stay are merged for each gene; unless
    ``collapse_only``, what merged exons of other genes of the chromosome
    cover is taken away, on whatever strand, and genes left with single bases
    only are dropped. ``exons`` needs gene_id, chrom, strand, start_pos and
    end_pos, and transcript_id where ``transcripts`` is given.
    """
    keys = ["gene_id", "chrom", "strand"]
    if transcripts is not None:
        exons = exons.join(drop_excluded(transcripts, excluded).select("transcript_id").distinct(), "transcript_id", "left_semi")
    merged = intervals.merge(exons, keys)
    if collapse_only:
        return intervals.number_exons(merged, keys)
    pairs = intervals.overlaps(merged, merged).where("a.gene_id <> b.gene_id")
    pairs = pairs.select("a.*", F.col("b.start_pos").alias("other_start"), F.col("b.end_pos").alias("other_end"))
    pieces = intervals.without_single_base_groups(intervals.subtract(merged, pairs, keys), keys)
    return intervals.number_exons(pieces, keys)


def attach_parents(lines: DataFrame) -> DataFrame:
    """Lines of one file with the ids of the gene and transcript above them, for files whose own ids are not to be trusted (line_no, type, gene_id, transcript_id)."""
    above = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    last = lambda kind, c: F.last(F.when(F.col("type") == kind, F.col(c)), ignorenulls=True).over(above)
    return lines.withColumn("gene_id", last("gene", "gene_id")).withColumn("transcript_id", F.when(F.col("type") != "gene", last("transcript", "transcript_id")))


def number_missing_exons(exons: DataFrame) -> DataFrame:
    """Exons with a number and id where they have none: their place in the transcript by line_no."""
    place = F.row_number().over(Window.partitionBy("transcript_id").orderBy("line_no"))
    return exons.withColumn("exon_number", F.coalesce("exon_number", place)).withColumn("exon_id", F.coalesce("exon_id", F.concat("transcript_id", F.lit("_"), F.col("exon_number").cast("string"))))


def in_file_order(features: DataFrame) -> DataFrame:
    """Sorted by place, parents before children, as an index needs them."""
    rank = F.when(F.col("type") == "gene", 0).when(F.col("type") == "transcript", 1).otherwise(2)
    return features.orderBy("chrom", "start_pos", F.desc("end_pos"), rank)
