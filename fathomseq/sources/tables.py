"""Sample sheets, matrices, per-sample tables and configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import matrix


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A sample sheet as text columns, by extension: ``.tsv``, or ``.xlsx`` where pandas can read it."""
    if ".tsv" in path:
        return spark.read.csv(path, sep="\t", header=True)
    if ".xlsx" in path:
        try:
            import openpyxl  # noqa: F401
            import pandas as pd
        except ImportError as e:
            raise RuntimeError(f"{path}: reading .xlsx needs openpyxl; save the sheet as .tsv") from e
        return spark.createDataFrame(pd.read_excel(path, dtype=str))
    raise ValueError(f"{path} is neither .tsv nor .xlsx")


def read_matrix(spark: SparkSession, path: str, flavour: str | None = None) -> DataFrame:
    """(id, sample, value) of a matrix; the separator is the comma of a ``.csv`` and the tab of others."""
    wide = spark.read.csv(path, sep="," if ".csv" in path else "\t", header=True)
    return matrix.to_long(wide, flavour or matrix.flavour_of(path))


def _with_sample(rows: DataFrame, pattern: str) -> DataFrame:
    return rows.withColumn("sample", F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))


def read_t_data(spark: SparkSession, folder: str, run_code: str = "", name: str = "t_data.ctab") -> DataFrame:
    """(t_name, num_exons, FPKM, sample) of all non-empty files ``name`` below ``folder`` whose path holds ``run_code``; the sample is the file's folder without ``sample_``."""
    wide = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name).csv(folder, sep="\t", header=True)
    rows = wide.where((F.col("_metadata.file_size") > 0) & F.col("_metadata.file_path").contains(run_code))
    rows = _with_sample(rows, rf"([^/]*)/{name}$").withColumn("sample", F.replace("sample", F.lit("sample_"), F.lit("")))
    return rows.select("t_name", F.col("num_exons").cast("int").alias("num_exons"), F.col("FPKM").cast("double").alias("FPKM"), "sample")


def read_cluster_reports(spark: SparkSession, path: str, name: str = "*") -> DataFrame:
    """(cluster_id, read_id, read_type) of all reports ``name`` at or below ``path``, each with a header, by tab where a line has one and else by comma."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name).text(path)
    f = F.split("value", F.when(F.contains("value", F.lit("\t")), "\t").otherwise(","))
    rows = lines.where(F.regexp_replace("value", "\t", ",") != "cluster_id,read_id,read_type")
    return rows.select(F.get(f, F.lit(0)).alias("cluster_id"), F.get(f, F.lit(1)).alias("read_id"), F.get(f, F.lit(2)).alias("read_type")).where("cluster_id <> ''")


#: How the names of files of read lengths end.
LENGTHS_END = r"[._]((?:un)?mapped)[._](?:read)?lengths\.txt(?:\.gz)?$"


def read_read_lengths(spark: SparkSession, path: str) -> DataFrame:
    """(sample, type, line_no, read_length) of files with one number a line at or below ``path``; a file's name is its sample and ``LENGTHS_END``, line_no rises in the file."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*mapped*lengths.txt*").text(path)
    rows = lines.select("value", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line_no")).where(F.col("file").rlike(LENGTHS_END))
    return rows.select(
        F.regexp_replace("file", LENGTHS_END, "").alias("sample"), F.regexp_extract("file", LENGTHS_END, 1).alias("type"), "line_no", F.trim("value").try_cast("double").alias("read_length")
    ).where("read_length is not null")


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """(event, inclusion, total) of splicing event files, each with its own header line."""
    rows = spark.read.csv(path, sep="\t", header=True)
    return rows.select(F.col("event_id").alias("event"), F.split("alternative_transcripts", ",").alias("inclusion"), F.split("total_transcripts", ",").alias("total"))


#: Configuration keys of the older files, by the newer name.
OLD_KEYS = {"dataCode": "data_code", "inFolder": "in_folder", "rawFolder": "raw_folder", "outFolder": "out_folder", "referenceGenome": "ref_genome", "genomeCode": "genome_code", "sampleConfig": "metadata", "metadata": "metadata"}


def read_config(path: str) -> dict:
    """A flat YAML file as a dict, with the older camelCase keys under their newer names; values are text, numbers or booleans."""
    out: dict = {}
    with open(path) as file:
        for line in file:
            line = line.split(" #")[0].strip()
            if not line or line.startswith("#") or ":" not in line:
                continue
            key, value = (x.strip() for x in line.split(":", 1))
            value = value.strip("'\"")
            low = value.lower()
            out[OLD_KEYS.get(key, key)] = {"true": True, "false": False, "": None}.get(low, int(value) if value.lstrip("-").isdigit() else value)
    return out
