"""FASTA and SAM text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The eleven mandatory fields of a SAM line.
SAM_FIELDS = ["qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"]
_NUMBERS = {"flag": "int", "pos": "long", "mapq": "int", "pnext": "long", "tlen": "long"}


def parse_fasta(records: DataFrame) -> DataFrame:
    """(name, description, seq) of records (value) without their ``>``; empty records are left out."""
    lines = F.split("value", r"\r?\n")
    head = F.split(F.get(lines, F.lit(0)), r"\s+", 2)
    return records.where(F.trim("value") != "").select(
        head[0].alias("name"), F.coalesce(F.get(head, F.lit(1)), F.lit("")).alias("description"), F.array_join(F.slice(lines, 2, F.size(lines)), "").alias("seq")
    )


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(ord, name, description, seq); ``ord`` rises in the order of the file. A gzip file is one task."""
    records = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("value"))  # a file's first has its mark still
    return parse_fasta(records).select(F.monotonically_increasing_id().alias("ord"), "name", "description", "seq")


def parse_sam(lines: DataFrame) -> DataFrame:
    """SAM fields and ``tags`` of lines (value); header lines have their first field as qname and the rest as tags."""
    f = F.split("value", "\t")
    header = F.get(f, F.lit(0)).contains("@")
    cols = [F.when(~header | (F.lit(n) == 0), F.get(f, F.lit(n))).try_cast(_NUMBERS.get(c, "string")).alias(c) for n, c in enumerate(SAM_FIELDS)]
    tags = F.when(header, F.slice(f, 2, F.size(f))).otherwise(F.slice(f, 12, F.size(f)))
    return lines.where("value <> ''").select(*cols, tags.alias("tags"), header.alias("is_header"))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    return parse_sam(spark.read.text(path))
