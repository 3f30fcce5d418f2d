"""Writers; each gives lines or rows in a defined order and leaves files to Spark's own writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import attributes as A
from ..operators import matrix

#: The comment that a collapsed annotation carries after the source's own ``##`` lines.
COLLAPSED_COMMENT = "##collapsed version generated by fathomseq"


def gtf_lines(features: DataFrame) -> DataFrame:
    """(chrom, start_pos, value): a GTF line for each feature; ``*`` is written as ``.``, null fields as ``.``."""
    dot = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(".")) if c in features.columns else F.lit(".")
    strand = F.when(F.col("strand") == "*", ".").otherwise(F.col("strand"))
    text = F.array_join(F.transform(F.array_sort(F.map_keys("attributes")), lambda k: F.concat(k, F.lit(' "'), F.element_at("attributes", k), F.lit('";'))), " ")
    if "tags" in features.columns:
        text = F.concat_ws(" ", F.when(text != "", text), F.when(F.size("tags") > 0, F.array_join(F.transform("tags", lambda t: F.concat(F.lit('tag "'), t, F.lit('";'))), " ")))
    return features.select("chrom", "start_pos", F.concat_ws("\t", dot("chrom"), dot("source"), dot("type"), dot("start_pos"), dot("end_pos"), dot("score"), F.coalesce(strand, F.lit(".")), dot("phase"), text).alias("value"))


def write_gtf(features: DataFrame, path: str, **options: str) -> None:
    """Sorted text parts; with ``compression="gzip"`` compressed ones."""
    gtf_lines(features).orderBy("chrom", "start_pos", "value").select("value").write.options(**options).text(path)


def collapsed_lines(model: DataFrame, genes: DataFrame, header: list[str]) -> DataFrame:
    """(ord, gene_id, level, exon_number, value): header lines, then for each gene its gene, transcript and exon lines.

    ``model`` is what ``annotation.collapse`` gives, ``genes`` holds a gene's
    (gene_id, ord, source, phase, attributes). Exon ids are well formed.
    """
    spark = model.sparkSession
    extent = model.groupBy("gene_id").agg(F.min("start_pos").alias("from"), F.max("end_pos").alias("to"))
    full = genes.join(extent, "gene_id").withColumn("text", A.collapsed_attributes(F.col("attributes")))
    rows = model.join(full, "gene_id")
    line = lambda kind, a, b, text: F.concat_ws("\t", "chrom", "source", F.lit(kind), a, b, F.lit("."), "strand", "phase", text)
    exon = F.concat(F.col("text"), F.lit(' exon_id "'), "gene_id", F.lit("_"), F.col("exon_number").cast("string"), F.lit('"; exon_number '), F.col("exon_number").cast("string"), F.lit(";"))
    exons = rows.select("ord", "gene_id", F.lit(2).alias("level"), "exon_number", line("exon", F.col("start_pos"), F.col("end_pos"), exon).alias("value"))
    once = rows.where("exon_number = 1")
    heads = [once.select("ord", "gene_id", F.lit(i).alias("level"), F.lit(0).alias("exon_number"), line(kind, F.col("from"), F.col("to"), F.col("text")).alias("value")) for i, kind in enumerate(("gene", "transcript"))]
    top = spark.createDataFrame([(-1, "", i, 0, x) for i, x in enumerate([*header, COLLAPSED_COMMENT])], "ord long, gene_id string, level int, exon_number int, value string")
    return top.unionByName(heads[0]).unionByName(heads[1]).unionByName(exons)


def write_collapsed_gtf(model: DataFrame, genes: DataFrame, header: list[str], path: str) -> None:
    collapsed_lines(model, genes, header).orderBy("ord", "gene_id", "level", "exon_number").select("value").write.text(path)


def fasta_lines(sequences: DataFrame, width: int = 80) -> DataFrame:
    """(ord, value): a record for each sequence, wrapped to ``width``."""
    body = F.array_join(F.regexp_extract_all("seq", F.lit(f"(.{{1,{width}}})"), 1), "\n")
    head = F.concat(F.lit(">"), "name", F.when(F.coalesce(F.col("description"), F.lit("")) != "", F.concat(F.lit(" "), "description")).otherwise(""))
    return sequences.select("ord", F.concat(head, F.lit("\n"), body).alias("value"))


def write_fasta(sequences: DataFrame, path: str, width: int = 80) -> None:
    fasta_lines(sequences, width).orderBy("ord").select("value").write.text(path)


def write_wide_csv(long: DataFrame, samples: list[str], path: str) -> None:
    """A matrix with ``id`` first."""
    matrix.to_wide(long, samples).orderBy("id").write.csv(path, header=True)


def write_tsv(rows: DataFrame, path: str, header: bool = True) -> None:
    """Gzip-compressed if the path ends in .gz."""
    rows.write.csv(path, sep="\t", header=header, compression="gzip" if path.endswith(".gz") else "none")


def write_headerless_csv(rows: DataFrame, path: str) -> None:
    rows.write.csv(path, header=False)


def row_named_lines(wide: DataFrame, key: str = "id") -> DataFrame:
    """(ord, value): a TSV whose header lacks the name of the key column."""
    samples = [c for c in wide.columns if c != key]
    top = wide.sparkSession.createDataFrame([(0, "\t".join(samples))], "ord int, value string")
    return top.unionByName(wide.select(F.lit(1).alias("ord"), F.concat_ws("\t", F.col(f"`{key}`"), *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NA")) for c in samples]).alias("value")))


def write_row_named_tsv(wide: DataFrame, path: str, key: str = "id") -> None:
    row_named_lines(wide, key).orderBy("ord", "value").coalesce(1).select("value").write.text(path)


def write_indexed(features: DataFrame, path: str) -> None:
    """Parquet sorted by place and partitioned by chromosome: pruning by folder and statistics stands in for an index."""
    rank = F.when(F.col("type") == "gene", 0).when(F.col("type") == "transcript", 1).otherwise(2)
    features.repartitionByRange("chrom", "start_pos").sortWithinPartitions("chrom", "start_pos", F.desc("end_pos"), rank).write.partitionBy("chrom").parquet(path)


def save(rows: DataFrame, path: str) -> None:
    """A cache of a parsed table, left alone if it is there."""
    rows.write.mode("ignore").parquet(path)
