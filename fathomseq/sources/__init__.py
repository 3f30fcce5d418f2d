"""Readers of annotation, sequence, alignment and table files into DataFrames."""

from .annotation import read_blacklist, read_gtf
from .sequences import read_fasta, read_sam
from .tables import read_cluster_reports, read_config, read_events, read_matrix, read_read_lengths, read_sheet, read_t_data

__all__ = ["read_blacklist", "read_cluster_reports", "read_config", "read_events", "read_fasta", "read_gtf", "read_matrix", "read_read_lengths", "read_sam", "read_sheet", "read_t_data"]
