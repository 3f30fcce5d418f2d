"""Whole workflows as lazy plans; nothing is computed before a sink or an action."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import annotation, matrix, quality


def filter_expression(long: DataFrame, features: DataFrame, drop_mono_exonic: bool = False, drop_unstranded: bool = True, assembled: bool = False, min_samples: int = 2) -> dict[str, DataFrame]:
    """Counts, CPM and features of transcripts present in enough samples.

    CPM is over the unfiltered matrix. ``assembled`` takes the rule of
    assembled ids with ``min_samples``. All three hold the same transcripts.
    """
    ids = matrix.kept_ids_assembled(long, min_samples) if assembled else matrix.kept_ids(long)
    kept = matrix.only(annotation.distinct_features(features), ids, "transcript_id")
    if drop_mono_exonic:
        kept = kept.join(annotation.multi_exon_by_records(kept).withColumnRenamed("id", "transcript_id"), "transcript_id", "left_semi")
    if drop_unstranded:
        kept = annotation.stranded(kept)
    final = kept.select(F.col("transcript_id").alias("id")).distinct()
    return {"features": kept, "counts": matrix.only(long, final), "cpm": matrix.only(matrix.cpm(long), final)}


def filter_by_quality(classified: DataFrame, counts: DataFrame, cpm: DataFrame | None, features: DataFrame, sequences: DataFrame) -> dict[str, DataFrame]:
    """Tables cut down to the transcripts that pass the quality rule, and the reasons of the others.

    Sequences are in the order of the classified transcripts, and a transcript without one is an error.
    """
    passed = quality.passing(classified)
    ids = passed.select(F.col("isoform").alias("id"))
    out = {"classified": passed, "counts": matrix.only(counts, ids), "features": matrix.only(features, ids, "transcript_id"), "sequences": matrix.in_order_or_fail(sequences, ids.withColumn("ord", F.monotonically_increasing_id()), "name"), "reasons": quality.reject_reasons(classified)}
    return out if cpm is None else out | {"cpm": matrix.only(cpm, ids)}


def combine_with_known(known: DataFrame, known_sequences: DataFrame, features: DataFrame, sequences: DataFrame, novel_genes: bool = False) -> dict[str, DataFrame]:
    """Known and novel features and sequences as one annotation."""
    combined = annotation.combine(known, features, novel_genes)
    new = annotation.novel(features, known, "transcript_id") if novel_genes else annotation.novel_in_known_genes(features, known).select("transcript_id").distinct()
    added = sequences.join(new.select(F.col("transcript_id").alias("name")), "name", "left_semi")
    return {"features": combined, "sequences": known_sequences.unionByName(added)}


def collapse_annotation(features: DataFrame, excluded: DataFrame | None = None, collapse_only: bool = False) -> DataFrame:
    """Gene models of an annotation read by ``sources.read_gtf``."""
    value = lambda k: F.try_element_at("attributes", F.lit(k))
    transcripts = features.where("type = 'transcript'").select("transcript_id", value("transcript_type").alias("transcript_type"), "tags")
    exons = features.where("type = 'exon'").select("gene_id", "transcript_id", "chrom", "strand", "start_pos", "end_pos")
    return annotation.collapse(exons, transcripts, excluded, collapse_only)
