"""Rule-based quality of classified transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import a_richness, leading_a_run, plain_category

FULL_MATCH = "full splice match"
#: Limits of the rule: fewer leading A, a smaller percentage of A, and no greater A-richness.
MOST_RUN, MOST_PERCENT, MOST_RICHNESS = 6, 60, 15
#: Coverage of junctions that is low below: in a sample, and in all.
LEAST_SAMPLE_COVERAGE, LEAST_COVERAGE = 5, 50


def with_scores(table: DataFrame) -> DataFrame:
    """Adds the A scores of the sequence after the end site and makes categories plain."""
    seq = F.col("seq_A_downstream_TTS")
    return table.withColumns({"structural_category": plain_category(F.col("structural_category")), "N_A_downstream_TTS": leading_a_run(seq), "rc_score": a_richness(seq)})


def judge(scored: DataFrame) -> DataFrame:
    """Adds ``filter_pass``: full matches pass; others need no RT switching, and either the gene's own end or few A after it. Null counts as not met."""
    few_a = (F.col("N_A_downstream_TTS") < MOST_RUN) & (F.col("perc_A_downstream_TTS") < MOST_PERCENT) & (F.col("rc_score") <= MOST_RICHNESS)
    end = (F.col("diff_to_gene_TTS") == 0) | few_a
    passed = F.when(F.col("structural_category") == FULL_MATCH, True).when((F.col("RTS_stage") == F.lit(False)) & end, True).otherwise(False)
    return scored.withColumn("filter_pass", passed)


def passing(table: DataFrame) -> DataFrame:
    return judge(with_scores(table)).where("filter_pass")


def reject_reasons(table: DataFrame) -> DataFrame:
    """(isoform, not_full_match, rts, low_coverage, a_run, a_percent, a_rich) of the transcripts that do not pass; an unknown coverage is low."""
    rejected = judge(with_scores(table)).where("not filter_pass")
    return rejected.select(
        "isoform",
        F.coalesce(F.col("structural_category") != FULL_MATCH, F.lit(True)).alias("not_full_match"),
        F.coalesce(F.col("RTS_stage"), F.lit(False)).alias("rts"),
        F.coalesce((F.col("min_sample_cov") < LEAST_SAMPLE_COVERAGE) | (F.col("min_cov") < LEAST_COVERAGE), F.lit(True)).alias("low_coverage"),
        (F.col("N_A_downstream_TTS") >= MOST_RUN).alias("a_run"),
        F.coalesce(F.col("perc_A_downstream_TTS") >= MOST_PERCENT, F.lit(False)).alias("a_percent"),
        F.coalesce(F.col("rc_score") > MOST_RICHNESS, F.lit(False)).alias("a_rich"),
    )


def rules_filter(table: DataFrame, max_run: int = 6, max_share: float = 0.6, drop_mono_exonic: bool = True) -> DataFrame:
    """The stricter rule by thresholds alone: short A run, low A share, no RT switching, and more than one exon."""
    scored = with_scores(table)
    keep = (F.col("structural_category") == FULL_MATCH) | ((F.col("N_A_downstream_TTS") < max_run) & (F.col("perc_A_downstream_TTS") < 100 * max_share) & (F.col("RTS_stage") == F.lit(False)))
    return scored.where(keep & (F.col("exons") > 1) if drop_mono_exonic else keep)
