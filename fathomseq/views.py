"""Inputs of the queries, made from the driver's tables by SQL that Spark and DuckDB both read."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_SEQ = "TRANSLATE(LOWER(text), 'aeioubcdfghjklmnpqrstvwxyz', 'AAAAACGTCGTCGTCGTCGTCGTCGT')"
_START = "(l_partkey - l_partkey % 25) * 24 + l_orderkey % 700 + 1"
_TENTHS = "CAST(ROUND(l_discount * 100) AS BIGINT)"

VIEWS = {
    # expression: many ids are absent from some samples
    "expression": """SELECT CASE l_partkey % 3 WHEN 0 THEN 'ENST' WHEN 1 THEN 'MSTRG' ELSE 'NOVEL' END || CAST(l_partkey AS STRING) AS id,
        's' || CAST(l_suppkey % 8 AS STRING) AS sample, CAST(SUM(CASE WHEN l_quantity >= 46 THEN l_quantity ELSE 0 END) AS DOUBLE) AS value
        FROM {lineitem} GROUP BY 1, 2""",
    # exons: they overlap within a gene and with those of neighbouring genes
    "exons": f"""SELECT CAST(l_partkey AS STRING) AS gene_id, CAST(l_partkey AS STRING) || '.' || CAST(l_suppkey % 4 AS STRING) AS transcript_id,
        'chr' || CAST(l_partkey % 25 AS STRING) AS chrom, 'exon' AS type, 'sim' AS source, {_START} AS start_pos, {_START} + CAST(l_quantity AS BIGINT) - 1 AS end_pos,
        CASE WHEN l_partkey % 10 = 0 THEN '*' WHEN l_partkey % 2 = 1 THEN '+' ELSE '-' END AS strand, l_partkey AS gene_no, l_suppkey % 4 AS class
        FROM {{lineitem}}""",
    "transcripts": f"""SELECT CAST(l_partkey AS STRING) AS gene_id, CAST(l_partkey AS STRING) || '.' || CAST(l_suppkey % 4 AS STRING) AS transcript_id,
        'chr' || CAST(l_partkey % 25 AS STRING) AS chrom, CASE WHEN l_partkey % 10 = 0 THEN '*' WHEN l_partkey % 2 = 1 THEN '+' ELSE '-' END AS strand,
        CASE WHEN (l_partkey + l_suppkey % 4) % 6 = 0 THEN 'retained_intron' WHEN (l_partkey + l_suppkey % 4) % 6 = 1 THEN NULL ELSE 'protein_coding' END AS transcript_type,
        CASE (l_partkey + 2 * (l_suppkey % 4)) % 9 WHEN 0 THEN 'basic,readthrough_transcript' WHEN 1 THEN 'CCDS,retained_intron' WHEN 2 THEN NULL ELSE 'basic' END AS tag_text,
        MIN({_START}) AS start_pos, MAX({_START} + CAST(l_quantity AS BIGINT) - 1) AS end_pos, COUNT(*) AS num_exons
        FROM {{lineitem}} GROUP BY l_partkey, l_suppkey % 4""",
    "sequences": f"SELECT doc_id AS ord, 't' || CAST(doc_id AS STRING) AS name, source AS description, {_SEQ} AS seq FROM {{documents}}",
    "classified": f"""SELECT 't' || CAST(d.doc_id AS STRING) AS isoform,
        CASE d.doc_id % 5 WHEN 0 THEN 'full-splice_match' WHEN 1 THEN 'incomplete-splice_match' WHEN 2 THEN 'novel_in_catalog' WHEN 3 THEN 'novel_not_in_catalog' ELSE 'genic_intron' END AS structural_category,
        l.toxic = 1 AS RTS_stage, d.doc_id % 7 AS diff_to_gene_TTS, CAST(d.doc_id * 37 % 101 AS DOUBLE) AS perc_A_downstream_TTS, {_SEQ} AS seq_A_downstream_TTS,
        CASE WHEN d.doc_id % 11 = 0 THEN NULL ELSE CAST(d.doc_id % 4 * 20 AS DOUBLE) END AS min_cov, CASE WHEN d.doc_id % 13 = 0 THEN NULL ELSE CAST(d.doc_id % 9 AS DOUBLE) END AS min_sample_cov, d.doc_id % 3 + 1 AS exons
        FROM {{documents}} d LEFT JOIN {{labels}} l ON d.doc_id = l.doc_id""",
    "reads": f"""SELECT CAST(l_orderkey AS STRING) || '/' || CAST(l_linenumber AS STRING) AS qname,
        CASE WHEN l_returnflag = 'R' THEN 4 WHEN l_linestatus = 'O' THEN 16 ELSE 0 END AS flag, 'chr' || CAST(l_partkey % 25 + 1 AS STRING) AS rname, l_orderkey AS pos,
        CASE WHEN l_suppkey % 50 = 7 THEN '*' ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) || 'S50M' ||
          CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_linenumber * 30 AS STRING) || 'N' || CAST(l_suppkey % 20 + 1 AS STRING) || 'M2D60M1000N20M' ELSE '3I20M' END ||
          CAST(l_suppkey % 30 + 1 AS STRING) || CASE WHEN l_suppkey % 3 = 0 THEN 'M' ELSE 'S' END END AS cigar,
        REPEAT('T', CAST(l_quantity AS INT)) || REPEAT('ACGT', 10 + l_linenumber) || REPEAT('A', CAST(l_suppkey % 30 AS INT)) || 'A' AS seq,
        'NM:i:1,XC:Z:' || CAST(l_suppkey AS STRING) || ',XM:Z:u,' || CASE WHEN l_linenumber = 5 THEN 'none' WHEN l_linenumber = 6 THEN 'fA:f:' WHEN l_linenumber = 7 THEN 'fA:f:abc'
          ELSE 'fA:f:' || CAST(CAST(FLOOR({_TENTHS} / 10.0) AS BIGINT) AS STRING) || '.' || CAST({_TENTHS} % 10 AS STRING) END AS tag_text,
        's' || CAST(l_suppkey % 8 AS STRING) AS sample, l_discount * 10 AS frac_a, l_partkey AS isoform_no, l_orderkey AS order_no, l_linenumber AS line_no
        FROM {{lineitem}}""",
    "molecules": "SELECT user_id AS cell, event_id % 997 AS umi, event_type AS type, event_id AS molecule FROM {events}",
    "sheet": "SELECT s_name AS sample, 'supplier ' || CAST(s_suppkey AS STRING) AS description, 'nation' || CAST(s_nationkey AS STRING) AS platform FROM {supplier}",
}


def tables_of(name: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", VIEWS[name])))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(VIEWS[name], **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables_of(name)})


def with_views(body: str, *names: str) -> str:
    """DuckDB SQL with these views before it; ``body`` may begin with further ``name AS (...)`` parts and a semicolon."""
    parts = [f"{n} AS ({VIEWS[n].format(**{t: t for t in tables_of(n)})})" for n in names]
    more, _, rest = body.rpartition(";;")
    return "WITH " + ", ".join([*parts, *([more.strip()] if more.strip() else [])]) + " " + rest
