"""Nothing here keeps state: the workflows are batches of files.

Row-local operators (flags, tails, tags, categories, quality rules) take a
streaming DataFrame as they take a batch; ``tail_stream`` shows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.alignments import poly_a_reads
from ..sources.sequences import parse_sam


def tail_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Reads with a poly-A tail from SAM text files as they arrive in ``folder``."""
    return poly_a_reads(parse_sam(spark.readStream.text(folder)).where("not is_header"))
