"""Hand-computed cases of the operators."""

import random

import pytest
from pyspark.sql import functions as F

from fathomseq import sinks, sources
from fathomseq.functions import attributes as A
from fathomseq.functions import sequences as S
from fathomseq.operators import alignments, annotation, intervals, matrix, quality, reports, singlecell, splicing
from fathomseq.plans import collapse_annotation, combine_with_known
from fathomseq.sources.annotation import parse_gtf_lines
from fathomseq.sources.sequences import parse_fasta, parse_sam


def col(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("x"))).collect()]


def pieces(rows):
    return sorted((r.gene_id, r.start_pos, r.end_pos) for r in rows.collect())


SEQS = ["AAAACGT", "CAAA", "", None, "aAAA"]


def test_sequence_scores(spark):
    assert col(spark, SEQS, S.leading_a_run) == [4, 0, 0, 0, 0]
    assert col(spark, SEQS, S.a_richness) == [8, 6, 0, None, 6]
    assert col(spark, ["full-splice_match", None], S.plain_category) == ["full splice match", None]
    cigars = ["10S50M3N20M12S", "50M", "*", None]
    assert col(spark, cigars, S.first_op_length) == [10, 50, None, None]
    assert col(spark, cigars, S.last_op_length) == [12, 50, None, None]
    assert col(spark, ["50M12S", "50M"], lambda c: S.last_op_length(c, True)) == [12, None]


def test_half_even(spark):
    rows = spark.createDataFrame([("a", "s", x) for x in (0.5, 1.5, 2.5, -0.5)], "id string, sample string, value double")
    assert sorted(r.value for r in matrix.round_half_even(rows).collect()) == [0, 0, 2, 2]


def test_last_tag(spark):
    tags = [["a:b:9", "x:f:0.4"], ["x:f:1.4"], ["notag"], ["x:f:"], ["x:f:abc"], [], None]
    assert col(spark, tags, lambda t: S.last_tag_within(t, 1.0), "array<string>") == [True, False, True, True, False, True, True]
    assert col(spark, [["XC:Z:AC", "b", "c"], ["b"]], S.barcode, "array<string>") == ["AC", None]


def test_ids(spark):
    assert col(spark, ["M", "Y", "X", "7"], S.chromosome_number) == ["25", "24", "23", "7"]
    assert col(spark, ["t1"], lambda x: S.suffixed_id(x, F.lit("X"))) == ["t1000000000023"]


G1 = [("g1", "c", "+", 1, 10), ("g1", "c", "+", 10, 20), ("g1", "c", "+", 21, 30), ("g1", "c", "+", 2, 4)]
EXON = "gene_id string, chrom string, strand string, start_pos long, end_pos long"


def test_intervals(spark):
    merged = intervals.merge(spark.createDataFrame(G1, EXON), ["gene_id", "chrom", "strand"])
    assert pieces(merged) == [("g1", 1, 20), ("g1", 21, 30)]
    rows = spark.createDataFrame([*G1, ("g2", "c", "-", 5, 12), ("g2", "c", "-", 40, 40)], EXON)
    assert pieces(annotation.collapse(rows)) == [("g1", 1, 4), ("g1", 13, 20), ("g1", 21, 30)]
    minus = rows.where("gene_id = 'g1'").withColumn("strand", F.lit("-")).unionByName(rows.where("gene_id = 'g2'"))
    assert sorted((r.exon_number, r.start_pos) for r in annotation.collapse(minus).collect()) == [(1, 21), (2, 13), (3, 1)]
    assert annotation.collapse(rows.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_collapse_against_sets_of_bases(spark, seed):
    r = random.Random(seed)
    rows = [(f"g{r.randrange(6)}", "c", "+", a := r.randrange(1, 25_000), a + r.choice([0, 3, 40, 4000])) for _ in range(60)]
    frame = spark.createDataFrame(rows, EXON)
    keys = ["gene_id", "chrom", "strand"]
    merged = intervals.merge(frame, keys)
    again = intervals.merge(merged, keys)
    assert pieces(merged) == pieces(again)
    bases = {}
    for g, _, _, a, b in rows:
        bases.setdefault(g, set()).update(range(a, b + 1))
    found = {}
    for g, a, b in pieces(merged):
        assert not found.setdefault(g, set()) & set(range(a, b + 1))
        found[g] |= set(range(a, b + 1))
    assert found == bases
    left = {}
    for g, a, b in pieces(annotation.collapse(frame)):
        left.setdefault(g, set()).update(range(a, b + 1))
    for g in bases:
        others = set().union(*(bases[o] for o in bases if o != g))
        assert left.get(g, set()) in (bases[g] - others, set())
    pairs = {(x.a.gene_id, x.a.start_pos, x.b.gene_id, x.b.start_pos) for x in intervals.overlaps(merged, merged).collect()}
    m = pieces(merged)
    assert pairs == {(g, a, h, c) for g, a, b in m for h, c, d in m if a <= d and c <= b}


def test_tails(spark):
    rows = [("a", 0, "5M1S", "ABCDE"), ("b", 0, "5M2S", "ABCDE"), ("c", 0, "5M4S", "ABCDE"), ("d", 16, "2S5M", "TTACG"), ("e", 0, "*", "A"), ("f", 0, "5M", "*")]
    got = {r.qname: r.clipped for r in alignments.tail_scores(spark.createDataFrame(rows, "qname string, flag int, cigar string, seq string")).collect()}
    assert got == {"a": "CDE", "b": "BCDE", "c": "ABCDE", "d": "TT"}
    rows = [("a", 0, "50M10S", "C" * 50 + "CC" + "A" * 8 + "AC"), ("b", 0, "50M11S", "C" * 40 + "A" * 13), ("c", 0, "50M9S", "A" * 60)]
    frame = spark.createDataFrame(rows, "qname string, flag int, cigar string, seq string")
    assert [r.qname for r in alignments.poly_a_reads(frame).collect()] == ["b"]


def test_junctions(spark):
    rows = [(0, "c", 100, "10S50M200N30M2D60M1000N20M"), (4, "c", 1, "10M100N10M"), (0, "c", 1, "7M100N10M"), (0, "c", 1, "10M49N10M"), (0, "c", 100, "50M200N30M")]
    got = alignments.junctions(spark.createDataFrame(rows, "flag int, rname string, pos long, cigar string"))
    assert sorted(map(tuple, got.collect())) == [("c", 150, 349, 2), ("c", 442, 1441, 1)]


LONG = "id string, sample string, value double"


def test_matrices(spark):
    rows = spark.createDataFrame([("ENST1", "a", 3.0), ("N1", "a", 1.0), ("ENST1", "b", 0.0), ("N1", "b", 5.0), ("N2", "a", 0.0), ("N2", "b", 4.0)], LONG)
    two = rows.where("id <> 'N2'")
    assert {(r.id, r.sample): r.value for r in matrix.cpm(two).collect()} == {("ENST1", "a"): 750000, ("N1", "a"): 250000, ("ENST1", "b"): 0, ("N1", "b"): 1000000}
    assert sorted(r.id for r in matrix.kept_ids(rows).collect()) == ["ENST1", "N1"]
    named = spark.createDataFrame([("ENST1", "a", 3.0), ("ENST1", "b", 0.0), ("MSTRG1", "a", 1.0), ("MSTRG1", "b", 5.0), ("X1", "a", 1.0), ("X1", "b", 5.0)], LONG)
    assert [r.id for r in matrix.kept_ids_assembled(named, 2).collect()] == ["MSTRG1"]
    zero = spark.createDataFrame([("a", "s", 0.0)], LONG)
    assert matrix.cpm(zero).first().value is None
    assert matrix.flavour_of("x/talon_abundance.tsv") == "talon"
    with pytest.raises(ValueError):
        matrix.flavour_of("other.tsv")
    assert [r.sample for r in matrix.rename_samples(spark.createDataFrame([("a", "s1.aligned.md", 1.0)], LONG)).collect()] == ["s1"]
    assert sorted(r.id for r in matrix.kept_ids_by_support(rows, 3, 1).collect()) == ["ENST1", "N1", "N2"]


def test_quality_rule(spark):
    cases = [("full-splice_match", None, None, None, None, True), ("incomplete", False, 0, None, None, True), ("nic", False, 5, "AAAAACAAAACAAAACCCC", 59.0, None), ("nic", True, 0, "C", 1.0, False), ("nic", False, None, "AAAAAAC", 1.0, False)]
    rows = spark.createDataFrame([(str(i), *c[:5], 2.0) for i, c in enumerate(cases)], "isoform string, structural_category string, RTS_stage boolean, diff_to_gene_TTS long, seq_A_downstream_TTS string, perc_A_downstream_TTS double, min_cov double")
    rows = rows.withColumns({"min_sample_cov": F.lit(5.0), "min_cov": F.when(F.col("isoform") == "3", 50.0).otherwise(F.col("min_cov"))})
    got = {int(r.isoform): r for r in quality.judge(quality.with_scores(rows)).collect()}
    for i, c in enumerate(cases):
        assert got[i].filter_pass == (got[i].rc_score <= 15 if c[5] is None else c[5])
    reasons = {r.isoform: r for r in quality.reject_reasons(rows).collect()}
    assert reasons["3"].rts and reasons["4"].a_run and "0" not in reasons
    assert not reasons["3"].low_coverage and reasons["4"].low_coverage


GTF = """##description: x
#!other
chr1\tsrc\tgene\t1\t100\t.\t+\t.\tgene_id "G1"; gene_type "pc"; gene_name "N"; level 2;
chr1\tsrc\ttranscript\t1\t100\t.\t+\t.\tgene_id "G1"; transcript_id "T1"; tag "basic"; tag "CCDS"; note "two words"; note "last one"; level 2;
chr1\tsrc\texon\t1\t50\t.\t.\t0\tgene_id "G1"; transcript_id "T1";
chr1\tsrc\texon\t40\t100\t.\t.\t0\tgene_id "G1"; transcript_id "T1";
broken line
"""


def test_gtf_files(spark, tmp_path):
    (tmp_path / "a.gtf").write_text(GTF)
    rows = sources.read_gtf(spark, str(tmp_path / "a.gtf"))
    t = rows.where("type = 'transcript'").first()
    assert (t.attributes, t.tags) == ({"gene_id": "G1", "transcript_id": "T1", "note": "last", "level": "2"}, ["basic", "CCDS"])
    assert {r.strand for r in rows.where("type = 'exon'").collect()} == {"*"}
    sinks.write_gtf(rows, str(tmp_path / "out"))
    again = sources.read_gtf(spark, str(tmp_path / "out"))
    assert sorted(map(str, again.collect())) == sorted(map(str, rows.collect()))
    gff = parse_gtf_lines(spark.createDataFrame([("c\ts\tgene\t1\t2\t.\t-\t.\tID=g1;Name=n one",)], "value string"), gff3=True).first()
    assert gff.attributes == {"ID": "g1", "Name": "n one"}
    model = collapse_annotation(rows)
    assert pieces(model) == [("G1", 1, 100)]
    genes = rows.where("type = 'gene'").select("gene_id", F.lit(0).cast("long").alias("ord"), "source", "phase", "attributes")
    sinks.write_collapsed_gtf(model, genes, ["##description: x"], str(tmp_path / "collapsed"))
    lines = "".join(p.read_text() for p in sorted((tmp_path / "collapsed").glob("part-*"))).splitlines()
    assert lines[:2] == ["##description: x", sinks.COLLAPSED_COMMENT]
    assert [x.split("\t")[2] for x in lines[2:]] == ["gene", "transcript", "exon"]
    assert lines[4].endswith('level "2"; exon_id "G1_1"; exon_number 1;')
    sinks.write_indexed(rows, str(tmp_path / "indexed"))
    assert intervals.in_region(spark.read.parquet(str(tmp_path / "indexed")), "chr1", 101, 200).count() == 0


def test_files_that_mislead(spark, tmp_path):
    """A .gff in GTF's style, '>' within a header, sample names that look like endings, rows that look like headers, escaped patterns."""
    (tmp_path / "x.collapsed.gff").write_text('c\ts\texon\t1\t2\t.\t+\t.\tgene_id "PB.1"; transcript_id "PB.1.1";\nc\ts\tgene\t1\t2\t.\t-\t.\tID=g1;note=a "b" c\n')
    rows = sources.read_gtf(spark, str(tmp_path / "x.collapsed.gff")).orderBy("type").collect()
    assert (rows[0].gene_id, rows[0].transcript_id, rows[1].attributes["ID"]) == ("PB.1", "PB.1.1", "g1")
    (tmp_path / "odd.fa").write_text(">t1 len>100 x\nAC\nGT\n>t2\nTT\n")
    assert [(r.name, r.description, r.seq) for r in sources.read_fasta(spark, str(tmp_path / "odd.fa")).orderBy("ord").collect()] == [("t1", "len>100 x", "ACGT"), ("t2", "", "TT")]
    (tmp_path / "lengths" / "deep").mkdir(parents=True)
    (tmp_path / "lengths" / "deep" / "a_mapped_b.mapped.readlengths.txt").write_text("7\n")
    (tmp_path / "lengths" / "a.unmapped.readlengths.txt").write_text("5\n")
    got = sources.read_read_lengths(spark, str(tmp_path / "lengths")).collect()
    assert sorted((r.sample, r.type, r.read_length) for r in got) == [("a", "unmapped", 5), ("a_mapped_b", "mapped", 7)]
    (tmp_path / "reports" / "s1").mkdir(parents=True)
    (tmp_path / "reports" / "s1" / "p.cluster_report.csv").write_text("cluster_id\tread_id\tread_type\ncluster_id_7\tr,1\tFL\n")
    (tmp_path / "reports" / "q.cluster_report.csv").write_text("cluster_id,read_id,read_type\nc2,r2,FL\n")
    got = sources.read_cluster_reports(spark, str(tmp_path / "reports"), "*cluster_report.csv").collect()
    assert sorted(tuple(r) for r in got) == [("c2", "r2", "FL"), ("cluster_id_7", "r,1", "FL")]
    names = spark.createDataFrame([("a", x, 1.0) for x in ("s.aligned.md", "sXalignedXmd", "it's")], LONG)
    assert [r.sample for r in matrix.rename_samples(names, r"\.aligned\.md").collect()] == ["s", "sXalignedXmd", "it's"]
    assert [r.sample for r in matrix.rename_samples(names, "'s", "").collect()][2] == "it"


def test_sequences_in_order_or_error(spark):
    sequences = spark.createDataFrame([(1, "t1", "A"), (2, "t2", "C"), (3, "t3", "G")], "ord long, name string, seq string")
    wanted = lambda *names: spark.createDataFrame([(n, i) for i, n in enumerate(names)], "id string, ord long")
    assert [tuple(r) for r in matrix.in_order_or_fail(sequences, wanted("t3", "t1"), "name").select("name", "seq", "ord").collect()] == [("t3", "G", 0), ("t1", "A", 1)]
    with pytest.raises(Exception, match="nothing is named t9"):
        matrix.in_order_or_fail(sequences, wanted("t3", "t9"), "name").collect()


def test_missing_attribute_fails(spark):
    rows = spark.createDataFrame([({"gene_id": "g"},)], "a map<string,string>")
    with pytest.raises(Exception, match="is missing"):
        rows.select(A.collapsed_attributes(F.col("a"))).collect()


def test_fasta_files(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">t1 d\nACG\nTTT\n>t2\nGGG\n")
    rows = sources.read_fasta(spark, str(tmp_path / "a.fa"))
    assert [(r.name, r.description, r.seq) for r in rows.orderBy("ord").collect()] == [("t1", "d", "ACGTTT"), ("t2", "", "GGG")]
    sinks.write_fasta(rows, str(tmp_path / "out"), width=4)
    again = sources.read_fasta(spark, str(tmp_path / "out"))
    assert [(r.name, r.seq) for r in again.orderBy("ord").collect()] == [("t1", "ACGTTT"), ("t2", "GGG")]
    assert parse_fasta(spark.createDataFrame([("",)], "value string")).count() == 0


def test_sam_files(spark, tmp_path):
    lines = ["@SQ\tSN:c", "r1\t0\tc\t5\t60\t10M50N10M\t*\t0\t0\tACGT\t*\tNM:i:0\tfA:f:0.5", "r2\t16\tc\t4\t60\t10M\t*\t0\t0\tACGT\t*"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.sam").write_text("\n".join(lines) + "\n")
    rows = sources.read_sam(spark, str(tmp_path / "in"))
    assert [r.qname for r in alignments.spliced_within(rows).orderBy("qname").collect()] == ["@SQ", "r1"]
    assert [r.qname for r in alignments.coordinate_sort(rows).collect()] == ["r2", "r1"]
    assert rows.where("qname = 'r1'").first().tags == ["NM:i:0", "fA:f:0.5"]

    from fathomseq.streaming import tail_stream

    (tmp_path / "in" / "b.sam").write_text("r3\t0\tc\t5\t60\t50M12S\t*\t0\t0\t" + "C" * 50 + "A" * 14 + "\t*\n")
    stream = tail_stream(spark, str(tmp_path / "in")).writeStream.format("memory").queryName("tails").trigger(availableNow=True).start()
    stream.awaitTermination(60)
    assert [r.qname for r in spark.table("tails").collect()] == ["r3"]
    assert parse_sam(spark.createDataFrame([("",)], "value string")).count() == 0


def test_tables(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("sample\tfastq\na\tx\n")
    assert sources.read_sheet(spark, str(tmp_path / "s.tsv")).collect()[0].sample == "a"
    with pytest.raises(ValueError):
        sources.read_sheet(spark, "s.csv")
    (tmp_path / "counts_transcript.txt").write_text("TXNAME\tGENEID\ta\tb\nT\tG\t1.5\t2.5\n")
    assert sorted((r.sample, r.value) for r in sources.read_matrix(spark, str(tmp_path / "counts_transcript.txt")).collect()) == [("a", 2), ("b", 2)]
    for s in ("a", "b"):
        (tmp_path / "run1" / f"sample_{s}").mkdir(parents=True)
        (tmp_path / "run1" / f"sample_{s}" / "t_data.ctab").write_text("t_name\tnum_exons\tFPKM\nT\t2\t1.5\n" if s == "a" else "")
    assert [tuple(r) for r in sources.read_t_data(spark, str(tmp_path), "run1").collect()] == [("T", 2, 1.5, "a")]
    (tmp_path / "x.mapped_lengths.txt").write_text("10\n20\n")
    (tmp_path / "x.unmapped_lengths.txt").write_text("5\n")
    got = sources.read_read_lengths(spark, str(tmp_path / "x.*_lengths.txt"))
    assert sorted((r.sample, r.type, r.read_length) for r in got.collect()) == [("x", "mapped", 10), ("x", "mapped", 20), ("x", "unmapped", 5)]
    (tmp_path / "r1.csv").write_text("cluster_id,read_id,read_type\nc1,r1,FL\n")
    (tmp_path / "r2.csv").write_text("cluster_id\tread_id\tread_type\nc2\tr2\tFL\n")
    assert sorted(r.cluster_id for r in sources.read_cluster_reports(spark, str(tmp_path / "r*.csv")).collect()) == ["c1", "c2"]
    (tmp_path / "black.tsv").write_text("id\twhy\nT1\tx\nT1\ty\n")
    assert [r[0] for r in sources.read_blacklist(spark, str(tmp_path / "black.tsv")).collect()] == ["T1"]
    (tmp_path / "c.yaml").write_text("dataCode: 'x'\n# note\nmin_samples: 2\nflag: True # yes\n")
    assert sources.read_config(str(tmp_path / "c.yaml")) == {"data_code": "x", "min_samples": 2, "flag": True}
    wide = spark.createDataFrame([("t", 1.0, None)], "id string, a double, b double")
    sinks.write_row_named_tsv(wide, str(tmp_path / "named"))
    assert "".join(p.read_text() for p in (tmp_path / "named").glob("part-*")) == "a\tb\nt\t1.0\tNA\n"
    sinks.write_tsv(wide, str(tmp_path / "w.tsv.gz"))
    assert list((tmp_path / "w.tsv.gz").glob("*.gz"))
    sinks.save(wide, str(tmp_path / "cache"))
    sinks.save(wide.limit(0), str(tmp_path / "cache"))
    assert spark.read.parquet(str(tmp_path / "cache")).count() == 1


FEATURES = "gene_id string, transcript_id string, chrom string, strand string, type string, source string, start_pos long, end_pos long"


def test_combination(spark):
    known = spark.createDataFrame([("g1", "t1", "c", "+", "exon", "h", 1, 9)], FEATURES)
    new = spark.createDataFrame([("g1", "t1", "c", "+", "exon", "p", 1, 9), ("g1", "t2", "c", "+", "exon", "p", 1, 9), ("g2", "t3", "c", "+", "exon", "p", 20, 29), ("g2", "t3", "c", "+", "exon", "p", 40, 49)], FEATURES)
    seqs = lambda *names: spark.createDataFrame([(n, "A") for n in names], "name string, seq string")
    out = combine_with_known(known, seqs("t1"), new, seqs("t1", "t2", "t3"))
    assert sorted(r.transcript_id for r in out["features"].collect()) == ["t1", "t2"]
    assert sorted(r.name for r in out["sequences"].collect()) == ["t1", "t2"]
    out = combine_with_known(known, seqs("t1"), new, seqs("t1", "t2", "t3"), novel_genes=True)
    assert sorted((r.type, r.transcript_id or "", r.start_pos) for r in out["features"].collect()) == [("exon", "t1", 1), ("exon", "t2", 1), ("exon", "t3", 20), ("exon", "t3", 40), ("gene", "", 20)]
    bad = spark.createDataFrame([("g", "t", "c", "+", "exon", "p", 1, 2), ("g", "t", "d", "+", "exon", "p", 1, 2)], FEATURES)
    with pytest.raises(Exception, match="two chromosomes"):
        annotation.gene_records(bad).collect()
    lines = spark.createDataFrame([("f", 1, "gene", "G", None), ("f", 2, "transcript", "x", "T"), ("f", 3, "exon", None, None)], "file string, line_no int, type string, gene_id string, transcript_id string")
    assert [(r.gene_id, r.transcript_id) for r in annotation.attach_parents(lines).orderBy("line_no").collect()] == [("G", None), ("G", "T"), ("G", "T")]


def test_cells_and_events(spark):
    counts = spark.createDataFrame([("ACGT", 10), ("ACGA", 2), ("CCGT", 1), ("ACG", 1), ("TTTT", 1), ("A", 5), ("", 1)], "tag string, n long")
    got = {r.tag: r.corrected for r in singlecell.correct_barcodes(counts).collect()}
    assert got == {"ACGT": "ACGT", "ACGA": "ACGT", "CCGT": "ACGT", "ACG": "ACGT", "TTTT": "TTTT", "A": "A", "": "A"}
    events = spark.createDataFrame([("e", ["a"], ["a", "b"])], "event string, inclusion array<string>, total array<string>")
    tpm = spark.createDataFrame([("a", "s", 1.0), ("b", "s", 3.0), ("a", "z", 0.0)], LONG)
    assert sorted((r.sample, r.psi) for r in splicing.psi(events, tpm).collect()) == [("s", 0.25), ("z", None)]
    reports_in = {"x": spark.createDataFrame([("r", "p")], "id string, primer string")}
    assert reports.merge_reports(reports_in).first().primer == "x"
