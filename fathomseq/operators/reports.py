"""Sample sheets, reports and the configuration files of other tools."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed lines of the chaining tool's configuration.
CHAIN_FILES = ["GROUP_FILENAME=cupcake.collapsed.group.txt", "COUNT_FILENAME=cupcake.collapsed.abundance.txt", "GFF_FILENAME=cupcake.collapsed.filtered.gff"]


def merge_reports(reports: dict[str, DataFrame]) -> DataFrame:
    """Rows of all samples' reports, with ``primer`` set to the sample's name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn("primer", F.lit(name)) for name, df in reports.items()])


def lookup(rows: DataFrame, sheet: DataFrame, columns: list[str], key: str = "sample") -> DataFrame:
    """Rows with columns of their sample's row of the sheet, null where the sheet lacks the sample."""
    return rows.join(sheet.select(key, *columns), key, "left")


def tama_config(sheet: DataFrame) -> DataFrame:
    """(value): a line for each sample: its BED file, capping, merge order and name."""
    s = F.col("sample")
    return sheet.select(F.concat(s, F.lit("/TAMA/"), s, F.lit(".bed\tno_cap\t1,1,1\t"), s).alias("value"))


def chain_config(sheet: DataFrame) -> DataFrame:
    """(ord, value): a line for each sample, an empty one, and the three file names."""
    samples = sheet.select(F.lit(0).alias("ord"), F.concat(F.lit("SAMPLE="), "sample", F.lit(";"), "sample", F.lit("/cupcake/chain/")).alias("value"))
    rest = sheet.sparkSession.createDataFrame([(i + 1, v) for i, v in enumerate(["", *CHAIN_FILES])], "ord int, value string")
    return samples.unionByName(rest)


def talon_config(sheet: DataFrame) -> DataFrame:
    """(sample, description, platform, file) as written without a header."""
    return sheet.select("sample", "description", "platform", F.concat("sample", F.lit("/label_reads/"), "sample", F.lit(".aligned.md.labelled.sam")).alias("file"))


def output_paths(sheet: DataFrame, templates: dict[str, str]) -> DataFrame:
    """(sample, kind, path): each template with ``{sample}`` as the sample's name."""
    kinds = sheet.sparkSession.createDataFrame(list(templates.items()), "kind string, template string")
    return sheet.select("sample").join(F.broadcast(kinds), how="cross").select("sample", "kind", F.replace("template", F.lit("{sample}"), F.col("sample")).alias("path"))


def is_hybrid(sheet: DataFrame, column: str = "short_read_bam_path") -> bool:
    """Whether a sample sheet has short reads beside the long ones, told by its columns."""
    return column in sheet.columns


def header_fields(sequences: DataFrame) -> DataFrame:
    """(name, fields): the ``key=value`` parts of FASTA descriptions, parted by ``;`` or spaces; the last of a repeated key wins."""
    parts = F.filter(F.transform(F.split("description", "[; ]+"), lambda x: F.split(x, "=", 2)), lambda x: F.size(x) == 2)
    last = F.filter(parts, lambda x, i: ~F.exists(F.slice(parts, i + 2, F.size(parts)), lambda y: y[0] == x[0]))
    return sequences.select("name", F.map_from_entries(F.transform(last, lambda x: F.struct(x[0], x[1]))).alias("fields"))
