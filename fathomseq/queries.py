"""Queries over the driver's tables, one for each operator, and SQL for DuckDB that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import attributes as A
from .functions import sequences as S
from .operators import alignments, annotation, intervals, matrix, quality, reports, singlecell, splicing
from .plans import filter_by_quality, filter_expression
from .sources.annotation import parse_gtf_lines
from .sources.sequences import parse_fasta
from .views import view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
SAMPLES = [f"s{i}" for i in range(8)]


def query(sql: str, *views: str):
    """Registers a function of views as the query of its name, with its SQL over the same views."""

    def register(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(*(view(spark, sf_dir, v) for v in views))
        ORACLE_SQL[fn.__name__] = with_views(sql, *views)
        return fn

    return register


def tagged(rows: DataFrame) -> DataFrame:
    return rows.withColumn("tags", F.split("tag_text", ","))


# --- expression matrices -----------------------------------------------------

_WIDE = ", ".join(f"sum(value) FILTER (sample = '{s}') AS {s}" for s in SAMPLES)


@query(f"SELECT id, {_WIDE} FROM expression GROUP BY id", "expression")
def q_matrix_pivot(x):
    return matrix.to_wide(x, SAMPLES)


@query("SELECT id, sample, round_even(value, 0) AS value FROM expression", "expression")
def q_matrix_unpivot(x):
    wide = matrix.to_wide(x, SAMPLES).withColumnRenamed("id", "TXNAME").withColumn("GENEID", F.lit("g"))
    return matrix.to_long(wide, "bambu").where("value is not null")


@query("SELECT id, sample, value FROM expression", "expression")
def q_matrix_bind(x):
    return matrix.bind_samples({s: x.where(F.col("sample") == s).select("id", "value") for s in SAMPLES})


@query("SELECT id, sample, round_even(value * 0.5, 0) AS value FROM expression", "expression")
def q_round_half_even(x):
    return matrix.round_half_even(x.withColumn("value", F.col("value") * 0.5))


@query("SELECT id, sample, round(value / nullif(sum(value) OVER (PARTITION BY sample), 0) * 1e6, 6) AS value FROM expression", "expression")
def q_cpm(x):
    return matrix.cpm(x).withColumn("value", F.round("value", 6))


@query("SELECT id, count(*) FILTER (value > 0) AS n_samples FROM expression GROUP BY id", "expression")
def q_presence_count(x):
    return matrix.presence(x)


_KEPT = "SELECT id FROM expression GROUP BY id HAVING count(*) FILTER (value > 0) >= CASE WHEN contains(id, 'ENST') THEN 1 ELSE 2 END"


@query(_KEPT, "expression")
def q_missingness(x):
    return matrix.kept_ids(x)


@query("SELECT id FROM expression WHERE contains(id, 'ENST') OR contains(id, 'MSTRG') GROUP BY id HAVING count(*) FILTER (value > 0) >= 2", "expression")
def q_missingness_stringtie(x):
    return matrix.kept_ids_assembled(x, 2)


@query("SELECT id FROM expression GROUP BY id HAVING count(*) FILTER (value >= 50) >= floor((SELECT count(DISTINCT sample) FROM expression) * 0.3)", "expression")
def q_missingness_param(x):
    return matrix.kept_ids_by_support(x, 50, 0.3)


@query(
    """passed AS (SELECT isoform FROM classified WHERE structural_category = 'full-splice_match'), own AS (SELECT 't' || regexp_extract(id, '[0-9]+') AS id, sample, value FROM expression);;
    SELECT id, sample, value FROM own WHERE id IN (SELECT isoform FROM passed)""",
    "expression",
    "classified",
)
def q_semi_matrix(x, c):
    own = x.withColumn("id", F.concat(F.lit("t"), F.regexp_extract("id", "[0-9]+", 0)))
    return matrix.only(own, c.where("structural_category = 'full-splice_match'").select(F.col("isoform").alias("id")))


@query("SELECT id, 'run_' || sample AS sample, value FROM expression", "expression")
def q_sample_rename(x):
    return matrix.rename_samples(x.withColumn("sample", F.concat(F.lit("run_"), "sample", F.lit("-aligned.md"))))


@query("SELECT id, sample, value, CAST(regexp_extract(id, '[0-9]+') AS BIGINT) AS ord FROM expression WHERE id IN (SELECT id FROM expression WHERE value > 0)", "expression")
def q_matrix_reindex(x):
    order = x.where("value > 0").select("id", F.regexp_extract("id", "[0-9]+", 0).cast("long").alias("ord"))
    return matrix.in_order_of(x, order)


# --- intervals and annotation ---------------------------------------------------

_MERGED = """merged AS (
  SELECT gene_id, chrom, strand, min(start_pos) AS start_pos, max(end_pos) AS end_pos FROM (
    SELECT *, sum(begins) OVER (PARTITION BY gene_id ORDER BY start_pos, end_pos ROWS UNBOUNDED PRECEDING) AS island FROM (
      SELECT *, CASE WHEN start_pos <= max(end_pos) OVER (PARTITION BY gene_id ORDER BY start_pos, end_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS begins FROM (SELECT DISTINCT gene_id, chrom, strand, start_pos, end_pos FROM {0})))
  GROUP BY gene_id, chrom, strand, island)"""
_PIECES = (
    _MERGED
    + """, covers AS (
  SELECT a.gene_id, a.chrom, a.strand, a.start_pos, a.end_pos, greatest(b.start_pos, a.start_pos) AS s, least(b.end_pos, a.end_pos) AS e
  FROM merged a JOIN merged b ON a.chrom = b.chrom AND a.gene_id <> b.gene_id AND a.start_pos <= b.end_pos AND b.start_pos <= a.end_pos
  UNION ALL SELECT gene_id, chrom, strand, start_pos, end_pos, end_pos + 1, end_pos + 1 FROM merged
), pieces AS (
  SELECT gene_id, chrom, strand, past + 1 AS start_pos, s - 1 AS end_pos FROM (
    SELECT *, coalesce(max(e) OVER (PARTITION BY gene_id || '|' || start_pos ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), start_pos - 1) AS past FROM covers)
  WHERE past + 1 <= s - 1
)"""
)
_GOOD = """good AS (SELECT * FROM transcripts WHERE coalesce(transcript_type <> 'retained_intron', true) AND NOT coalesce(contains(tag_text, 'retained_intron') OR contains(tag_text, 'readthrough_transcript'), false)
  AND transcript_id NOT IN (SELECT transcript_id FROM transcripts WHERE num_exons > 12))"""
_ALONG = "CASE WHEN strand = '-' THEN -start_pos ELSE start_pos END, end_pos"
_OWN = ["gene_id", "chrom", "strand"]


def excluded(t: DataFrame) -> DataFrame:
    return t.where("num_exons > 12").select("transcript_id")


@query(_MERGED.format("exons") + ";;SELECT gene_id, chrom, strand, start_pos, end_pos FROM merged", "exons")
def q_interval_union(e):
    return intervals.merge(e, _OWN)


@query(
    _MERGED.format("exons") + """;;SELECT a.gene_id, a.start_pos, a.end_pos, b.gene_id AS other_gene, b.start_pos AS other_start, b.end_pos AS other_end
    FROM merged a JOIN merged b ON a.chrom = b.chrom AND a.gene_id <> b.gene_id AND a.start_pos <= b.end_pos AND b.start_pos <= a.end_pos""",
    "exons",
)
def q_interval_overlap(e):
    merged = intervals.merge(e, _OWN)
    pairs = intervals.overlaps(merged, merged).where("a.gene_id <> b.gene_id")
    return pairs.select("a.gene_id", "a.start_pos", "a.end_pos", F.col("b.gene_id").alias("other_gene"), F.col("b.start_pos").alias("other_start"), F.col("b.end_pos").alias("other_end"))


@query(_PIECES.format("exons") + ";;SELECT * FROM pieces", "exons")
def q_interval_subtract(e):
    merged = intervals.merge(e, _OWN)
    pairs = intervals.overlaps(merged, merged).where("a.gene_id <> b.gene_id").select("a.*", F.col("b.start_pos").alias("other_start"), F.col("b.end_pos").alias("other_end"))
    return intervals.subtract(merged, pairs, _OWN)


@query("SELECT gene_id, chrom, start_pos, end_pos FROM exons WHERE transcript_id IN (SELECT transcript_id FROM exons GROUP BY transcript_id HAVING max(end_pos - start_pos) > 0)", "exons")
def q_single_base_genes(e):
    return intervals.without_single_base_groups(e, ["transcript_id"]).select("gene_id", "chrom", "start_pos", "end_pos")


@query(
    _GOOD + ", kept AS (SELECT * FROM exons WHERE transcript_id IN (SELECT transcript_id FROM good)), " + _PIECES.format("kept")
    + f""";;SELECT gene_id, chrom, strand, start_pos, end_pos, row_number() OVER (PARTITION BY gene_id ORDER BY {_ALONG})::INTEGER AS exon_number
    FROM pieces WHERE gene_id IN (SELECT gene_id FROM pieces GROUP BY gene_id HAVING max(end_pos - start_pos) > 0)""",
    "exons",
    "transcripts",
)
def q_collapse_annotation(e, t):
    return annotation.collapse(e, tagged(t), excluded(t))


@query(_MERGED.format("exons") + f";;SELECT gene_id, chrom, strand, start_pos, end_pos, row_number() OVER (PARTITION BY gene_id ORDER BY {_ALONG})::INTEGER AS exon_number FROM merged", "exons")
def q_exon_numbering(e):
    return annotation.collapse(e, collapse_only=True)


@query(_GOOD + ";;SELECT transcript_id, transcript_type, tag_text FROM good", "transcripts")
def q_transcript_exclusion(t):
    return annotation.drop_excluded(tagged(t), excluded(t)).select("transcript_id", "transcript_type", "tag_text")


@query("SELECT transcript_id AS id FROM exons GROUP BY 1 HAVING count(*) > 2", "exons")
def q_multiexon_records(e):
    return annotation.multi_exon_by_records(e)


@query("SELECT transcript_id AS id FROM transcripts WHERE num_exons > 1", "transcripts")
def q_multiexon_attr(t):
    return annotation.multi_exon_by_attribute(t.withColumnRenamed("transcript_id", "id"))


@query("SELECT DISTINCT gene_id, transcript_id, chrom, type, source, start_pos, end_pos, strand FROM exons", "exons")
def q_distinct_records(e):
    return annotation.distinct_features(e).select("gene_id", "transcript_id", "chrom", "type", "source", "start_pos", "end_pos", "strand")


@query("SELECT gene_id, transcript_id, start_pos, end_pos, strand FROM exons WHERE strand <> '*'", "exons")
def q_strand_filter(e):
    return annotation.stranded(e).select("gene_id", "transcript_id", "start_pos", "end_pos", "strand")


@query(f"kept AS ({_KEPT});;SELECT gene_id, transcript_id, start_pos, end_pos FROM exons WHERE gene_id IN (SELECT regexp_extract(id, '[0-9]+') FROM kept)", "exons", "expression")
def q_semi_gtf(e, x):
    ids = matrix.kept_ids(x).select(F.regexp_extract("id", "[0-9]+", 0).alias("id"))
    return matrix.only(e, ids, "gene_id").select("gene_id", "transcript_id", "start_pos", "end_pos")


_SPLIT = "known AS (SELECT * FROM exons WHERE gene_no % 5 <> 0 AND class <= 2), fresh AS (SELECT * FROM exons WHERE class >= 2)"


def split(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    return e.where("gene_no % 5 <> 0 and class <= 2"), e.where("class >= 2")


@query("SELECT DISTINCT gene_id, transcript_id FROM exons", "exons")
def q_tx2gene(e):
    return annotation.tx2gene(e)


@query("SELECT gene_id, chrom, strand, min(start_pos) AS start_pos, max(end_pos) AS end_pos FROM exons GROUP BY ALL", "exons")
def q_gene_extent(e):
    return annotation.gene_extents(e)


@query("SELECT gene_id, min(chrom) AS chrom, 'gene' AS type, min(source) AS source, min(start_pos) AS start_pos, max(end_pos) AS end_pos, min(strand) AS strand, '.' AS phase, gene_id AS gene_name, 'isoseq' AS gene_type, 0 AS level FROM exons GROUP BY gene_id", "exons")
def q_gene_records(e):
    return annotation.gene_records(e)


@query(
    """SELECT gene_id, NULL AS transcript_id, 'gene' AS type, min(start_pos) AS start_pos, max(end_pos) AS end_pos, gene_id AS gene_name, NULL AS transcript_name, 0 AS gene_first FROM exons GROUP BY gene_id
    UNION ALL SELECT gene_id, transcript_id, type, start_pos, end_pos, gene_id, transcript_id, 1 FROM exons""",
    "exons",
)
def q_add_genes(e):
    return annotation.with_genes(e).select("gene_id", "transcript_id", "type", "start_pos", "end_pos", "gene_name", "transcript_name", "gene_first")


@query(
    """SELECT gene_id, CASE WHEN gene_no % 3 = 0
      THEN 'gene_id "' || gene_id || '"; transcript_id "' || gene_id || '"; gene_type "pc"; gene_status "K"; gene_name "n' || gene_id || '"; transcript_type "pc"; transcript_status "K"; transcript_name "n' || gene_id || '"; level "2"; tag "x";'
      ELSE 'gene_id "' || gene_id || '"; transcript_id "' || gene_id || '"; gene_type "pc"; gene_name "n' || gene_id || '"; transcript_type "pc"; transcript_name "n' || gene_id || '"; level "2"; tag "x";' END AS attributes
    FROM (SELECT DISTINCT gene_id, gene_no FROM exons)""",
    "exons",
)
def q_gene_attributes(e):
    own = {"gene_id": F.col("gene_id"), "gene_type": F.lit("pc"), "gene_name": F.concat(F.lit("n"), "gene_id"), "level": F.lit("2"), "tag": F.lit("x")}
    base = F.create_map(*[x for k, v in own.items() for x in (F.lit(k), v)])
    full = F.when(F.col("gene_no") % 3 == 0, F.map_concat(base, F.create_map(F.lit("gene_status"), F.lit("K")))).otherwise(base)
    return e.select("gene_id", "gene_no").distinct().select("gene_id", A.collapsed_attributes(full).alias("attributes"))


@query(
    "SELECT chrom, start_pos, end_pos, CASE WHEN strand = '*' THEN '*' ELSE strand END AS strand, gene_id, transcript_id, 'second' AS note, 'basic,CCDS' AS tags FROM exons",
    "exons",
)
def q_gtf_attributes(e):
    text = F.concat(F.lit('gene_id "'), "gene_id", F.lit('"; transcript_id "'), "transcript_id", F.lit('"; tag "basic"; note "first one"; tag "CCDS"; note "second two";'))
    line = F.concat_ws("\t", "chrom", F.lit("s"), F.lit("exon"), "start_pos", "end_pos", F.lit("."), F.when(F.col("strand") == "*", ".").otherwise(F.col("strand")), F.lit("."), text)
    parsed = parse_gtf_lines(e.select(line.alias("value")))
    return parsed.select("chrom", "start_pos", "end_pos", "strand", "gene_id", "transcript_id", F.element_at("attributes", "note").alias("note"), F.array_join("tags", ",").alias("tags"))


@query(_SPLIT + ";;SELECT transcript_id FROM fresh EXCEPT SELECT transcript_id FROM known", "exons")
def q_novel_ids(e):
    known, fresh = split(e)
    return annotation.novel(fresh, known, "transcript_id")


@query(_SPLIT + ";;SELECT DISTINCT gene_id, transcript_id FROM fresh WHERE transcript_id NOT IN (SELECT transcript_id FROM known) AND gene_id IN (SELECT gene_id FROM known)", "exons")
def q_novel_known_gene(e):
    known, fresh = split(e)
    return annotation.novel_in_known_genes(fresh, known)


_COLS = "gene_id, transcript_id, type, chrom, start_pos, end_pos, strand"


@query(
    _SPLIT + f""";;SELECT {_COLS} FROM known UNION ALL SELECT {_COLS} FROM fresh
    WHERE transcript_id NOT IN (SELECT transcript_id FROM known) AND gene_id IN (SELECT gene_id FROM known)""",
    "exons",
)
def q_combine_features(e):
    return annotation.combine(*split(e)).select(*_COLS.split(", "))


@query(
    _SPLIT + f""";;SELECT {_COLS} FROM known UNION ALL SELECT {_COLS} FROM fresh WHERE transcript_id NOT IN (SELECT transcript_id FROM known)
    UNION ALL SELECT gene_id, NULL, 'gene', chrom, min(start_pos), max(end_pos), strand FROM fresh WHERE gene_id NOT IN (SELECT gene_id FROM known) GROUP BY gene_id, chrom, strand""",
    "exons",
)
def q_combine_with_genes(e):
    return annotation.combine(*split(e), novel_genes=True).select(*_COLS.split(", "))


@query("SELECT gene_id, transcript_id, start_pos, end_pos FROM exons WHERE chrom = 'chr3' AND start_pos <= 20000 AND end_pos >= 1000", "exons")
def q_region_lookup(e):
    return intervals.in_region(e, "chr3", 1000, 20_000).select("gene_id", "transcript_id", "start_pos", "end_pos")


# --- sequences and quality --------------------------------------------------------

_SCORED = """scored AS (SELECT *, coalesce(length(regexp_extract(seq_A_downstream_TTS, '^A*')), 0) AS run,
    length(regexp_replace(substr(seq_A_downstream_TTS, 1, 6), '[^A]', '', 'g')) + length(regexp_replace(substr(seq_A_downstream_TTS, 1, 19), '[^A]', '', 'g')) AS rich FROM classified),
  judged AS (SELECT *, CASE WHEN structural_category = 'full-splice_match' THEN true WHEN RTS_stage = false AND (diff_to_gene_TTS = 0 OR (run < 6 AND perc_A_downstream_TTS < 60 AND rich <= 15)) THEN true ELSE false END AS ok FROM scored)"""


@query("SELECT name, coalesce(length(regexp_extract(seq, '^A*')), 0) AS n FROM sequences", "sequences")
def q_polya_run(s):
    return s.select("name", S.leading_a_run(F.col("seq")).alias("n"))


@query("SELECT name, length(regexp_replace(substr(seq, 1, 6), '[^A]', '', 'g')) + length(regexp_replace(substr(seq, 1, 19), '[^A]', '', 'g')) AS n FROM sequences", "sequences")
def q_rc_score(s):
    return s.select("name", S.a_richness(F.col("seq")).alias("n"))


@query("SELECT isoform, translate(structural_category, '-_', '  ') AS category FROM classified", "classified")
def q_category_normalise(c):
    return c.select("isoform", S.plain_category(F.col("structural_category")).alias("category"))


@query(_SCORED + ";;SELECT isoform, translate(structural_category, '-_', '  ') AS structural_category, run AS n_a, rich AS rc_score, ok AS filter_pass FROM judged", "classified")
def q_quality_rule(c):
    return quality.judge(quality.with_scores(c)).select("isoform", "structural_category", F.col("N_A_downstream_TTS").alias("n_a"), "rc_score", "filter_pass")


@query(
    _SCORED + """;;SELECT isoform, true AS not_full_match, coalesce(RTS_stage, false) AS rts, (coalesce(min_sample_cov, 0) < 5 OR coalesce(min_cov, 0) < 50) AS low_coverage, run >= 6 AS a_run, perc_A_downstream_TTS >= 60 AS a_percent, rich > 15 AS a_rich FROM judged WHERE NOT ok""",
    "classified",
)
def q_reject_reasons(c):
    return quality.reject_reasons(c)


@query(_SCORED + ";;SELECT isoform FROM scored WHERE (structural_category = 'full-splice_match' OR (run < 6 AND perc_A_downstream_TTS < 60 AND RTS_stage = false)) AND exons > 1", "classified")
def q_rules_filter(c):
    return quality.rules_filter(c).select("isoform")


@query(_SCORED + ";;SELECT name, description, seq, CAST(substr(name, 2) AS BIGINT) * -1 AS ord FROM sequences WHERE name IN (SELECT isoform FROM judged WHERE ok)", "sequences", "classified")
def q_fasta_subset(s, c):
    """The passing transcripts' sequences, in an order of the transcripts' own."""
    passed = quality.passing(c).select(F.col("isoform").alias("id"), (F.substring("isoform", 2, 20).cast("long") * -1).alias("ord"))
    return matrix.in_order_or_fail(s, passed, "name").select("name", "description", "seq", "ord")


@query("SELECT name, description, regexp_replace(seq, '[>\\r\\n]', '', 'g') AS seq FROM sequences", "sequences")
def q_fasta_parse(s):
    body = F.translate("seq", ">\r\n", "")
    half = (F.length(body) / 2).cast("int")
    record = F.concat("name", F.lit(" "), "description", F.lit("\n"), F.substring(body, F.lit(1), half), F.lit("\n"), F.substring(body, half + 1, F.length(body)), F.lit("\n"))
    return parse_fasta(s.select(record.alias("value")))


@query("SELECT name || '0000000000' || CASE ord % 27 WHEN 24 THEN '24' WHEN 23 THEN '23' WHEN 25 THEN '25' ELSE (ord % 27)::VARCHAR END AS id, description FROM sequences", "sequences")
def q_id_suffix(s):
    number = (F.col("ord") % 27).cast("string")
    chromosome = F.when(number == "23", "X").when(number == "24", "Y").when(number == "25", "M").otherwise(number)
    return s.select(S.suffixed_id(F.col("name"), chromosome).alias("id"), "description")


# --- alignments ----------------------------------------------------------------------


@query("SELECT qname, try_cast(nullif(regexp_extract(cigar, '^([0-9]+)[MIDNSHPX=]', 1), '') AS BIGINT) AS first, try_cast(nullif(regexp_extract(cigar, '([0-9]+)[MIDNSHPX=]$', 1), '') AS BIGINT) AS last FROM reads", "reads")
def q_cigar_ends(r):
    return r.select("qname", S.first_op_length(F.col("cigar")).alias("first"), S.last_op_length(F.col("cigar")).alias("last"))


_TAILS = """ends AS (SELECT qname, seq, (flag & 16) <> 0 AS rev, CASE WHEN (flag & 16) <> 0 THEN regexp_extract(cigar, '^([0-9]+)[MIDNSHPX=]', 1) ELSE regexp_extract(cigar, '([0-9]+)[MIDNSHPX=]$', 1) END::BIGINT AS n FROM reads WHERE cigar <> '*' AND seq <> '*'),
  clips AS (SELECT qname, CASE WHEN rev THEN '-' ELSE '+' END AS strand, n AS n_clipped, CASE WHEN rev THEN substr(seq, 1, n) ELSE substr(seq, greatest(length(seq) - n - 1, 1)) END AS clipped FROM ends),
  tails AS (SELECT *, length(regexp_replace(clipped, CASE strand WHEN '-' THEN '[^T]' ELSE '[^A]' END, '', 'g'))::DOUBLE / nullif(length(clipped), 0) AS fraction FROM clips)"""


@query(_TAILS + ";;SELECT qname, strand, n_clipped, clipped, round(fraction, 9) AS fraction FROM tails WHERE n_clipped >= 10 AND fraction > 0.8", "reads")
def q_polya_tail(r):
    return alignments.poly_a_reads(r).withColumn("fraction", F.round("fraction", 9))


@query("SELECT qname, (flag & 4) = 0 AS mapped, CASE WHEN (flag & 16) <> 0 THEN '-' ELSE '+' END AS strand FROM reads", "reads")
def q_flag_filters(r):
    return alignments.split_mapped(r).select("qname", "mapped", "strand")


_TAG = "string_split(list_last(string_split(tag_text, ',')), ':')[3]"
_WITHIN = f"CASE WHEN coalesce({_TAG}, '') = '' THEN true WHEN try_cast({_TAG} AS DOUBLE) IS NOT NULL THEN try_cast({_TAG} AS DOUBLE) <= {{0}} ELSE {_TAG} <= '{{0}}' END"


@query("SELECT qname, cigar FROM reads WHERE contains(qname, '@') OR (contains(cigar, 'N') AND " + _WITHIN.format("1") + ")", "reads")
def q_spliced_filter(r):
    return alignments.spliced_within(tagged(r), 1.0).select("qname", "cigar")


@query("SELECT qname, " + _WITHIN.format("0.5") + " AS kept FROM reads", "reads")
def q_last_tag_threshold(r):
    return tagged(r).select("qname", S.last_tag_within(F.col("tags"), 0.5).alias("kept"))


@query("SELECT sample, CASE WHEN (flag & 4) = 0 THEN 'mapped' ELSE 'unmapped' END AS type, length(seq) AS read_length FROM reads", "reads")
def q_read_lengths(r):
    return alignments.read_lengths(r)


@query(
    """SELECT sample, type, order_no, line_no, read_length FROM (SELECT *, row_number() OVER (PARTITION BY sample, type ORDER BY order_no, line_no) AS place FROM
    (SELECT sample, order_no, line_no, CASE WHEN (flag & 4) = 0 THEN 'mapped' ELSE 'unmapped' END AS type, length(seq) AS read_length FROM reads)) WHERE place <= 1000""",
    "reads",
)
def q_cap_per_group(r):
    kind = F.when(S.is_mapped(F.col("flag")), "mapped").otherwise("unmapped").alias("type")
    rows = r.select("sample", "order_no", "line_no", kind, F.length("seq").cast("long").alias("read_length"))
    return matrix.cap_per_group(rows, ["sample", "type"], ["order_no", "line_no"], 1000)


@query("SELECT qname, rname, pos FROM reads WHERE NOT contains(qname, '@') ORDER BY rname, pos, qname", "reads")
def q_coordinate_sort(r):
    return alignments.coordinate_sort(r).select("qname", "rname", "pos")


@query("SELECT count(*) AS total, count(*) FILTER ((flag & 4) = 0) AS mapped, count(*) FILTER ((flag & 4) <> 0) AS unmapped, count(*) FILTER ((flag & 4) = 0 AND (flag & 16) <> 0) AS reverse, count(*) FILTER ((flag & 20) = 0) AS forward FROM reads", "reads")
def q_flagstat(r):
    return alignments.flagstat(r)


@query("SELECT rname, count(*) FILTER ((flag & 4) = 0) AS mapped, count(*) FILTER ((flag & 4) <> 0) AS unmapped FROM reads GROUP BY rname", "reads")
def q_idxstats(r):
    return alignments.idxstats(r)


@query(
    """own AS (SELECT row_number() OVER () AS read, * FROM reads WHERE (flag & 4) = 0 AND contains(cigar, 'N')),
    ops AS (SELECT read, rname, pos, unnest(range(1, len(o) + 1)) AS i, unnest(o) AS op, unnest(n)::BIGINT AS size FROM
      (SELECT read, rname, pos, regexp_extract_all(cigar, '[0-9]+([MIDNSHPX=])', 1) AS o, regexp_extract_all(cigar, '([0-9]+)[MIDNSHPX=]', 1) AS n FROM own)),
    placed AS (SELECT *, coalesce(sum(CASE WHEN op IN ('M','D','N','=','X') THEN size ELSE 0 END) OVER (PARTITION BY read ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS shift,
      sum(CASE WHEN op = 'N' THEN 1 ELSE 0 END) OVER (PARTITION BY read ORDER BY i ROWS UNBOUNDED PRECEDING) AS seg FROM ops),
    blocks AS (SELECT read, seg, sum(CASE WHEN op IN ('M','=','X') THEN size ELSE 0 END) AS block FROM placed GROUP BY read, seg);;
    SELECT rname, pos + shift AS start_pos, pos + shift + size - 1 AS end_pos, count(*) AS n_reads FROM placed p JOIN blocks l ON l.read = p.read AND l.seg = p.seg - 1 JOIN blocks r ON r.read = p.read AND r.seg = p.seg
    WHERE op = 'N' AND l.block >= 8 AND r.block >= 8 AND size BETWEEN 50 AND 500000 GROUP BY 1, 2, 3""",
    "reads",
)
def q_junctions(r):
    return alignments.junctions(r)


# --- samples, cells, splicing, reports ---------------------------------------------------


@query("SELECT qname, replace(string_split(tag_text, ',')[2], 'XC:Z:', '') AS barcode FROM reads", "reads")
def q_barcode_extract(r):
    return tagged(r).select("qname", S.barcode(F.col("tags")).alias("barcode"))


@query("SELECT cell, umi, type, min(molecule) AS molecule FROM molecules GROUP BY ALL", "molecules")
def q_umi_dedup(m):
    return singlecell.umi_dedup(m)


_TAGS = "tags AS (SELECT (cell % 100)::VARCHAR || chr((65 + umi % 4)::INTEGER) || chr((65 + cell % 3)::INTEGER) AS tag, count(*) AS n FROM molecules GROUP BY 1)"


@query(
    _TAGS + """;;SELECT tag, coalesce(corrected, tag) AS corrected FROM tags LEFT JOIN
    (SELECT a.tag AS own, first(b.tag ORDER BY b.n DESC, b.tag) AS corrected FROM tags a JOIN tags b ON b.n > a.n AND levenshtein(a.tag, b.tag) <= 1 GROUP BY a.tag) ON own = tag""",
    "molecules",
)
def q_barcode_correct(m):
    letter = lambda c, n: F.char(65 + F.col(c) % n)
    tag = F.concat((F.col("cell") % 100).cast("string"), letter("umi", 4), letter("cell", 3))
    return singlecell.correct_barcodes(m.groupBy(tag.alias("tag")).agg(F.count("*").alias("n")))


@query(
    """dedup AS (SELECT cell, umi, min(molecule) AS molecule FROM molecules GROUP BY cell, umi, type);;
    SELECT d.molecule, d.cell, d.umi, 'iso' || (d.molecule % 50)::VARCHAR AS isoform, CASE WHEN d.molecule % 50 % 2 = 0 THEN 'known' ELSE 'novel' END AS category FROM dedup d""",
    "molecules",
)
def q_sc_collate(m):
    isoform = F.concat(F.lit("iso"), (F.col("molecule") % 50).cast("string")).alias("isoform")
    groups = m.groupBy(isoform).agg(F.collect_list("molecule").alias("members"))
    classes = m.select(isoform, F.when(F.col("molecule") % 50 % 2 == 0, "known").otherwise("novel").alias("category")).distinct()
    return singlecell.collate(groups, singlecell.umi_dedup(m), classes)


@query("SELECT r.isoform_no AS isoform, c.sample, count(*) AS n_reads FROM reads r JOIN reads c ON r.qname = c.qname WHERE r.flag <> 4 AND r.isoform_no IN (SELECT isoform_no FROM reads WHERE contains(cigar, 'N')) GROUP BY 1, 2", "reads")
def q_demultiplex(r):
    members = r.where(S.is_spliced(F.col("cigar"))).select(F.col("isoform_no").alias("isoform"))
    stats = r.where("flag <> 4").select(F.col("isoform_no").alias("isoform"), F.col("qname").alias("read"))
    return singlecell.demultiplex(members, stats, r.select(F.col("qname").alias("read"), "sample"))


@query("SELECT isoform_no AS isoform, count(*) FILTER (flag <> 4) AS n_reads FROM reads GROUP BY 1", "reads")
def q_abundance_attach(r):
    isoforms = r.select(F.col("isoform_no").alias("isoform")).distinct()
    return singlecell.attach_abundance(isoforms, r.where("flag <> 4").select(F.col("isoform_no").alias("isoform")))


@query("SELECT type AS isoform, count(DISTINCT umi) AS n_molecules FROM molecules GROUP BY 1", "molecules")
def q_molecule_count(m):
    return singlecell.count_molecules(m.select(F.col("type").alias("isoform"), F.col("umi").alias("molecule")))


_LISTED = "listed AS (SELECT isoform_no AS transcript FROM (SELECT isoform_no, sample, count(*) AS n FROM reads WHERE frac_a <= 0.6 GROUP BY ALL) WHERE n >= 2 GROUP BY 1 HAVING count(*) >= 5)"


def long_reads(r: DataFrame) -> DataFrame:
    return r.select(F.col("isoform_no").alias("transcript"), F.col("sample").alias("dataset"), "frac_a")


@query(_LISTED + ";;SELECT transcript FROM listed", "reads")
def q_talon_whitelist(r):
    return singlecell.whitelist(long_reads(r), 0.6, 2, 5)


@query(_LISTED + f""";;SELECT isoform_no AS transcript, {', '.join(f"count(*) FILTER (sample = '{s}') AS {s}" for s in SAMPLES)} FROM reads WHERE isoform_no IN (SELECT transcript FROM listed) GROUP BY 1""", "reads")
def q_talon_abundance(r):
    rows = long_reads(r)
    return singlecell.abundance(rows, singlecell.whitelist(rows, 0.6, 2, 5), SAMPLES)


@query(
    """events AS (SELECT 'e' || (regexp_extract(id, '[0-9]+')::BIGINT // 10)::VARCHAR AS event, id, regexp_extract(id, '[0-9]+')::BIGINT % 10 < 4 AS included FROM (SELECT DISTINCT id FROM expression));;
    SELECT event, sample, round(sum(CASE WHEN included THEN value ELSE 0 END) / nullif(sum(value), 0), 9) AS psi FROM events JOIN expression USING (id) GROUP BY event, sample""",
    "expression",
)
def q_psi(x):
    number = F.regexp_extract("id", "[0-9]+", 0).cast("long")
    ids = x.select("id").distinct().select(F.concat(F.lit("e"), F.floor(number / 10).cast("string")).alias("event"), "id", (number % 10 < 4).alias("included"))
    events = ids.groupBy("event").agg(F.collect_list("id").alias("total"), F.collect_list(F.when(F.col("included"), F.col("id"))).alias("inclusion"))
    return splicing.psi(events, x).withColumn("psi", F.round("psi", 9))


@query("SELECT qname AS id, 'low' AS primer, NULL AS length FROM reads WHERE flag = 4 UNION ALL SELECT qname, 'high', length(seq) FROM reads WHERE flag <> 4", "reads")
def q_merge_reports(r):
    low = r.where("flag = 4").select(F.col("qname").alias("id"), F.lit("p").alias("primer"))
    high = r.where("flag <> 4").select(F.col("qname").alias("id"), F.lit("q").alias("primer"), F.length("seq").cast("long").alias("length"))
    return reports.merge_reports({"low": low, "high": high})


@query("SELECT qname, s.sample, s.description, s.platform FROM (SELECT *, 'Supplier#' || lpad((line_no * 7)::VARCHAR, 9, '0') AS sample FROM (SELECT qname, line_no FROM reads)) r LEFT JOIN sheet s USING (sample) WHERE s.sample IS NOT NULL UNION ALL SELECT qname, 'Supplier#' || lpad((line_no * 7)::VARCHAR, 9, '0'), NULL, NULL FROM reads WHERE 'Supplier#' || lpad((line_no * 7)::VARCHAR, 9, '0') NOT IN (SELECT sample FROM sheet)", "reads", "sheet")
def q_metadata_lookup(r, s):
    rows = r.select("qname", F.concat(F.lit("Supplier#"), F.lpad((F.col("line_no") * 7).cast("string"), 9, "0")).alias("sample"))
    return reports.lookup(rows, s, ["description", "platform"])


@query("SELECT sample || '/TAMA/' || sample || '.bed' || chr(9) || 'no_cap' || chr(9) || '1,1,1' || chr(9) || sample AS value FROM sheet", "sheet")
def q_tama_config(s):
    return reports.tama_config(s)


@query(
    """SELECT 0 AS ord, 'SAMPLE=' || sample || ';' || sample || '/cupcake/chain/' AS value FROM sheet
    UNION ALL SELECT * FROM (VALUES (1, ''), (2, 'GROUP_FILENAME=cupcake.collapsed.group.txt'), (3, 'COUNT_FILENAME=cupcake.collapsed.abundance.txt'), (4, 'GFF_FILENAME=cupcake.collapsed.filtered.gff'))""",
    "sheet",
)
def q_chain_config(s):
    return reports.chain_config(s)


@query("SELECT sample, description, platform, sample || '/label_reads/' || sample || '.aligned.md.labelled.sam' AS file FROM sheet", "sheet")
def q_talon_config(s):
    return reports.talon_config(s)


@query("SELECT sample, kind, replace(template, '{sample}', sample) AS path FROM sheet, (VALUES ('bam', '{sample}/pbmm2/{sample}.bam'), ('gtf', '{sample}/{sample}.gtf')) t(kind, template)", "sheet")
def q_output_paths(s):
    return reports.output_paths(s, {"bam": "{sample}/pbmm2/{sample}.bam", "gtf": "{sample}/{sample}.gtf"})


@query("SELECT name, source_name, part FROM (SELECT name, description AS source_name, (ord % 9)::VARCHAR AS part FROM sequences)", "sequences")
def q_header_fields(s):
    described = s.withColumn("description", F.concat(F.lit("part=x;source="), "description", F.lit(" part="), (F.col("ord") % 9).cast("string"), F.lit("; bare")))
    return reports.header_fields(described).select("name", F.element_at("fields", "source").alias("source_name"), F.element_at("fields", "part").alias("part"))


@query("SELECT qname, cigar FROM reads WHERE NOT regexp_matches(cigar, 'S$|^[0-9]+S')", "reads")
def q_unclipped(r):
    return alignments.unclipped(r).select("qname", "cigar")


@query("SELECT qname, flag FROM reads WHERE (flag & 4) = 0", "reads")
def q_merge_mapped(r):
    parts = [r.where(F.col("sample") == s).select("qname", "flag") for s in SAMPLES]
    return alignments.merge_mapped(*parts)


@query(
    """lines AS (SELECT DISTINCT transcript_id, start_pos AS line_no FROM exons);;
    SELECT transcript_id, line_no, row_number() OVER (PARTITION BY transcript_id ORDER BY line_no)::INTEGER AS exon_number, transcript_id || '_' || (row_number() OVER (PARTITION BY transcript_id ORDER BY line_no))::VARCHAR AS exon_id FROM lines""",
    "exons",
)
def q_exon_fallback(e):
    lines = e.select("transcript_id", F.col("start_pos").alias("line_no")).distinct()
    return annotation.number_missing_exons(lines.withColumns({"exon_number": F.lit(None).cast("int"), "exon_id": F.lit(None).cast("string")}))


@query(
    """lines AS (SELECT chrom AS file, gene_no * 1000 AS line_no, 'gene' AS type, gene_id, NULL AS transcript_id FROM exons GROUP BY ALL
      UNION ALL SELECT chrom, gene_no * 1000 + 1 + class * 200, 'transcript', NULL, transcript_id FROM exons GROUP BY ALL
      UNION ALL SELECT chrom, gene_no * 1000 + 1 + class * 200 + 1, 'exon', NULL, NULL FROM exons GROUP BY ALL);;
    SELECT file, line_no, type, (line_no // 1000)::VARCHAR AS gene_id, CASE WHEN type <> 'gene' THEN (line_no // 1000)::VARCHAR || '.' || ((line_no % 1000 - 1) // 200)::VARCHAR END AS transcript_id FROM lines""",
    "exons",
)
def q_parent_attachment(e):
    none = F.lit(None).cast("string")
    at = F.col("gene_no") * 1000 + 1 + F.col("class") * 200
    genes = e.select(F.col("chrom").alias("file"), (F.col("gene_no") * 1000).alias("line_no"), F.lit("gene").alias("type"), "gene_id", none.alias("transcript_id"))
    transcripts = e.select("chrom", at, F.lit("transcript"), none, "transcript_id")
    exons = e.select("chrom", at + 1, F.lit("exon"), none, none)
    return annotation.attach_parents(genes.union(transcripts).union(exons).distinct())


@query(
    f"""kept AS ({_KEPT}), feats AS (SELECT DISTINCT CASE gene_no % 3 WHEN 0 THEN 'ENST' WHEN 1 THEN 'MSTRG' ELSE 'NOVEL' END || gene_id AS transcript_id, chrom, type, start_pos, end_pos, strand FROM exons),
    stay AS (SELECT * FROM feats WHERE transcript_id IN (SELECT id FROM kept)), many AS (SELECT transcript_id FROM stay GROUP BY 1 HAVING count(*) > 2),
    final AS (SELECT DISTINCT transcript_id FROM stay WHERE transcript_id IN (SELECT transcript_id FROM many) AND strand <> '*');;
    SELECT id, sample, round(value / nullif(total, 0) * 1e6, 6) AS value FROM (SELECT *, sum(value) OVER (PARTITION BY sample) AS total FROM expression) WHERE id IN (SELECT transcript_id FROM final)""",
    "expression",
    "exons",
)
def q_plan_filter_expression(x, e):
    kind = F.when(F.col("gene_no") % 3 == 0, "ENST").when(F.col("gene_no") % 3 == 1, "MSTRG").otherwise("NOVEL")
    features = e.withColumn("transcript_id", F.concat(kind, "gene_id"))
    return filter_expression(x, features, drop_mono_exonic=True)["cpm"].withColumn("value", F.round("value", 6))


@query(_SCORED + ";;SELECT 't' || regexp_extract(id, '[0-9]+') AS id, sample, value FROM expression WHERE 't' || regexp_extract(id, '[0-9]+') IN (SELECT isoform FROM judged WHERE ok)", "expression", "classified", "exons", "sequences")
def q_plan_filter_quality(x, c, e, s):
    own = x.withColumn("id", F.concat(F.lit("t"), F.regexp_extract("id", "[0-9]+", 0)))
    return filter_by_quality(c, own, None, e, s)["counts"]
