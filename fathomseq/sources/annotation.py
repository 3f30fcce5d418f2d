"""GTF, GFF3 and blacklists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import attributes as A


def parse_gtf_lines(lines: DataFrame, gff3: bool | None = False) -> DataFrame:
    """Features of lines (value): comments and lines without nine fields are left out; strand ``.`` is ``*``.

    With ``gff3`` None each line tells by its first attribute whether it has ``key=value`` or ``key "value"``.
    """
    fields = F.split("value", "\t")
    rows = lines.where(~F.col("value").startswith("#")).select(*[c for c in lines.columns if c != "value"], fields.alias("f")).where("size(f) = 9")
    text = F.get("f", F.lit(8))
    parsed = A.pairs(text, gff3) if gff3 is not None else F.when(text.rlike(r'^\s*[^\s=;"]+='), A.pairs(text, True)).otherwise(A.pairs(text, False))
    own = A.attribute_map(F.col("parsed"))
    rows = rows.withColumn("parsed", parsed)
    return rows.select(
        *[c for c in lines.columns if c != "value"],
        F.get("f", F.lit(0)).alias("chrom"), F.get("f", F.lit(1)).alias("source"), F.get("f", F.lit(2)).alias("type"),
        F.get("f", F.lit(3)).try_cast("long").alias("start_pos"), F.get("f", F.lit(4)).try_cast("long").alias("end_pos"), F.get("f", F.lit(5)).alias("score"),
        F.when(F.get("f", F.lit(6)) == ".", "*").otherwise(F.get("f", F.lit(6))).alias("strand"), F.get("f", F.lit(7)).alias("phase"),
        own.alias("attributes"), A.tags(F.col("parsed")).alias("tags"),
    ).withColumns({k: F.try_element_at("attributes", F.lit(k)) for k in ("gene_id", "transcript_id")})


def read_gtf(spark: SparkSession, path: str, gff3: bool | None = None) -> DataFrame:
    """Features of GTF or GFF3 files, by the look of each line's attributes if not told: files named ``.gff`` hold either. Ids of GFF3 are under its own keys.

    Text files are split and read in parallel; order, where it matters, is by place.
    """
    return parse_gtf_lines(spark.read.text(path), gff3)


def read_blacklist(spark: SparkSession, path: str) -> DataFrame:
    """(transcript_id): the distinct values of the first column of a TSV with a header."""
    table = spark.read.csv(path, sep="\t", header=True)
    return table.select(F.col(f"`{table.columns[0]}`").alias("transcript_id")).where("transcript_id is not null").distinct()
