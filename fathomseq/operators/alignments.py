"""Alignment records: (qname, flag, rname, pos, cigar, seq, tags)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sequences as S


def tail_scores(reads: DataFrame, strict_softclip: bool = False) -> DataFrame:
    """(qname, strand, n_clipped, clipped, fraction): the end of each read beyond its alignment and its share of A, or T on the reverse strand.

    The clip's length is that of the last operation (the first on the reverse
    strand), whatever it is, or with ``strict_softclip`` of a soft clip only.
    Forward clips hold two bases before the clip as well, unless strict.
    """
    kept = reads.where("cigar <> '*' and seq <> '*'")
    reverse = S.is_reverse(F.col("flag"))
    n = F.when(reverse, S.first_op_length(F.col("cigar"), strict_softclip)).otherwise(S.last_op_length(F.col("cigar"), strict_softclip))
    # made by inline, which filters above aren't pushed through, so that each is worked out once
    kept = kept.select("qname", "seq", F.inline(F.array(F.struct(n.alias("n_clipped"), F.when(reverse, "-").otherwise("+").alias("strand")))))
    start = F.length("seq") - F.col("n_clipped") + (1 if strict_softclip else -1)
    start = F.when(start < -F.length("seq"), 1).otherwise(start)
    end = F.substring(F.col("seq"), start.cast("int"), F.length("seq"))
    clipped = F.when(F.col("strand") == "-", F.substring(F.col("seq"), F.lit(1), F.col("n_clipped").cast("int"))).otherwise(end)
    kept = kept.select("qname", "n_clipped", "strand", F.inline(F.array(F.struct(clipped.alias("clipped")))))
    fraction = F.when(F.col("strand") == "-", S.share_of(F.col("clipped"), "T")).otherwise(S.share_of(F.col("clipped"), "A"))
    return kept.select("qname", "strand", "n_clipped", "clipped", fraction.alias("fraction"))


def poly_a_reads(reads: DataFrame, least: int = 10, fraction: float = 0.8, strict_softclip: bool = False) -> DataFrame:
    """Reads whose clipped end is long and nearly all A."""
    return tail_scores(reads, strict_softclip).where((F.col("n_clipped") >= least) & (F.col("fraction") > fraction))


def unclipped(reads: DataFrame) -> DataFrame:
    return reads.where(~F.col("cigar").rlike("S$|^[0-9]+S"))


def split_mapped(reads: DataFrame) -> DataFrame:
    """Reads with ``mapped`` and ``strand`` by their flags."""
    return reads.withColumns({"mapped": S.is_mapped(F.col("flag")), "strand": F.when(S.is_reverse(F.col("flag")), "-").otherwise("+")})


def spliced_within(records: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Header rows (a ``@`` in the first field), and spliced rows whose last tag is at most ``threshold``."""
    return records.where(F.col("qname").contains("@") | (S.is_spliced(F.col("cigar")) & S.last_tag_within(F.col("tags"), threshold)))


def read_lengths(reads: DataFrame, sample: str = "sample") -> DataFrame:
    """(sample, type, read_length): type is mapped or unmapped."""
    return reads.select(sample, F.when(S.is_mapped(F.col("flag")), "mapped").otherwise("unmapped").alias("type"), F.length("seq").cast("long").alias("read_length"))


def merge_mapped(*files: DataFrame) -> DataFrame:
    """The mapped reads of all files."""
    out = files[0]
    for f in files[1:]:
        out = out.unionByName(f)
    return out.where(S.is_mapped(F.col("flag")))


def coordinate_sort(records: DataFrame) -> DataFrame:
    """Rows but headers, by reference name and position; range-partitioned, so that each part is a region."""
    return records.where(~F.col("qname").contains("@")).orderBy("rname", "pos", "qname")


def flagstat(reads: DataFrame) -> DataFrame:
    """One row: total, mapped, unmapped, reverse and forward (mapped) reads."""
    flag = F.col("flag")
    return reads.agg(
        F.count("*").alias("total"), F.count_if(S.is_mapped(flag)).alias("mapped"), F.count_if(~S.is_mapped(flag)).alias("unmapped"),
        F.count_if(S.is_mapped(flag) & S.is_reverse(flag)).alias("reverse"), F.count_if(S.is_mapped(flag) & ~S.is_reverse(flag)).alias("forward"),
    )


def idxstats(reads: DataFrame) -> DataFrame:
    """(rname, mapped, unmapped)."""
    return reads.groupBy("rname").agg(F.count_if(S.is_mapped(F.col("flag"))).alias("mapped"), F.count_if(~S.is_mapped(F.col("flag"))).alias("unmapped"))


def junctions(reads: DataFrame, anchor: int = 8, least: int = 50, most: int = 500_000) -> DataFrame:
    """(rname, start_pos, end_pos, n_reads) of the introns of mapped reads, both blocks beside them of at least ``anchor`` bases."""
    sizes = F.transform(F.regexp_extract_all("cigar", F.lit(rf"(\d+)[{S.CIGAR_OPS}]"), 1), lambda x: x.cast("long"))
    ops = F.regexp_extract_all("cigar", F.lit(rf"\d+([{S.CIGAR_OPS}])"), 1)
    # within one read, so a running sum over its own short array
    steps = F.zip_with(ops, sizes, lambda o, n: F.struct(o.alias("op"), n.alias("size")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("block"), F.array().cast("array<struct<at:bigint,size:bigint,left:bigint,right:bigint>>").alias("found"))

    def walk(state, step):  # noqa: ANN001, ANN202
        op, size = step["op"], step["size"]
        consumes = op.isin(*S.REFERENCE_OPS)
        matches = op.isin("M", "=", "X")
        found = state["found"]
        last = F.size(found) - 1
        grown = F.transform(found, lambda x, i: F.struct(x["at"].alias("at"), x["size"].alias("size"), x["left"].alias("left"), F.when(i == last, x["right"] + size).otherwise(x["right"]).alias("right")))
        added = F.array_append(found, F.struct(state["at"].alias("at"), size.alias("size"), state["block"].alias("left"), F.lit(0).cast("long").alias("right")))
        return F.struct(
            F.when(consumes, state["at"] + size).otherwise(state["at"]).alias("at"),
            F.when(op == "N", F.lit(0).cast("long")).when(matches, state["block"] + size).otherwise(state["block"]).alias("block"),
            F.when(op == "N", added).when(matches, grown).otherwise(found).alias("found"),
        )

    found = F.aggregate(steps, start, walk, lambda s: s["found"])
    rows = reads.where(S.is_mapped(F.col("flag")) & S.is_spliced(F.col("cigar"))).select("rname", "pos", F.inline(found))
    rows = rows.where((F.col("left") >= anchor) & (F.col("right") >= anchor) & F.col("size").between(least, most))
    return rows.groupBy("rname", (F.col("pos") + F.col("at")).alias("start_pos"), (F.col("pos") + F.col("at") + F.col("size") - 1).alias("end_pos")).agg(F.count("*").alias("n_reads"))


def dedup_reads(reads: DataFrame, keys: list[str], best: list[str]) -> DataFrame:
    """The first row, by ``best``, of each molecule known by ``keys``."""
    first = Window.partitionBy(*keys).orderBy(*best)
    return reads.withColumn("place", F.row_number().over(first)).where("place = 1").drop("place")
