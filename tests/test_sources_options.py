"""Report readers and writers, and run options."""

import gzip
import random

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from linkweave import options
from linkweave.functions import seq as S
from linkweave.sources import reports, text


def _file(tmp_path, name, *lines):
    (tmp_path / name).write_text("\n".join(lines) + "\n")
    return str(tmp_path / name)


def _set(df):
    return {tuple(r) for r in df.collect()}


def test_presets():
    assert options.resolve_qc({})[0] == "balanced"
    assert options.resolve_qc({}, {"suggested_qc_preset": "high_div"})[0] == "high_div"
    assert options.resolve_qc({"qc_preset": "Soil", "max_span_ratio": 0.5}) == ("high_div", options.QcSettings(True, 0.5, 0.0))
    assert options.resolve_qc({"qc_preset": False})[0] == "none"
    for wrong in (True, "best"):
        with pytest.raises(ValueError, match="preset"):
            options.resolve_qc({"qc_preset": wrong})


def test_gate_limits_and_placeholders():
    assert options.gate_limits("standard", True, False) == (4, 30)
    assert options.gate_limits("standard", False, False, min_mapq=10) == (2, 10)
    assert options.gate_limits("random_bc", True, True, min_reads=7) == (7, 0)
    assert options.filled({"a": "/path/to/x", "b": "y", "c": ""}, {"a": 1, "b": 2, "c": 3, "d": 4}) == {"a": 1, "b": "y", "c": 3, "d": 4}


def test_tables(spark, tmp_path):
    counts = _file(tmp_path, "c.txt", "# made", "Geneid\tChr\tLength\tx.bam", "A\tc\t100\t7", "B\tc\t90\tNA")
    assert _set(reports.read_feature_counts(spark, counts)) == {("A", 100.0, 7.0), ("B", 90.0, 0.0)}
    gc = _file(tmp_path, "gc.csv", "1,2", "3,x,4")
    assert _set(reports.read_gc_reference(spark, gc, 21)) == {(0, 3.0), (2, 4.0)}
    chimera = _file(tmp_path, "u.txt", "\t".join(["0", "bc1>x"] + ["*"] * 15 + ["N"]), "short\tline", "\t".join(["0", "bc1>y"] + ["*"] * 15 + ["Y"]))
    assert _set(reports.read_chimera_flags(spark, chimera)) == {("bc1", "Y")}
    tsv = _file(tmp_path, "r.tsv", "barcode\tplaced_reads\textra", "b\t3\tz")
    assert _set(reports.read_tsv(spark, tsv, "barcode string, placed_reads int")) == {("b", 3)}
    with pytest.raises(ValueError, match="breadth"):
        reports.read_tsv(spark, tsv, "barcode string, breadth double")
    with pytest.raises(ValueError, match="ERCC ID"):
        reports.read_spike_truth(spark, tsv)
    fai = _file(tmp_path, "f.fai", "chr1\t100\t6", "chr2\t50\t200")
    assert _set(reports.read_contig_names(spark, fai)) == {("chr1", 100, 0), ("chr2", 50, 1)}


def test_key_values_and_report(spark, tmp_path):
    log = _file(tmp_path, "m.txt", "Mapping rate: 91.5%", "Duplicate rate:\t3%", "other 4")
    found = _set(reports.read_key_values(spark, log, {"map": "Mapping rate", "dup": "Duplicate rate", "none": "Missing"}))
    assert found == {("map", "91.5%"), ("dup", "3%")}
    table = spark.createDataFrame([(1, None)], "a int, b string")
    assert _set(reports.long_report({"x": table})) == {("x", 0, "a", "1"), ("x", 1, "b", None)}


def test_covered_snps_in_both_layouts(spark, tmp_path):
    path = _file(tmp_path, "frag.txt", "2 id 3 01 9 1 III", "1 id 0 -1 -1 4 11 II")
    assert _set(reports.covered_snps(spark, path)) == {(2,), (3,), (8,), (4,)}


def test_fan_out_lists_empty_barcodes(spark, tmp_path):
    reads = spark.createDataFrame([("a", "h1", "AC", "II"), ("c", "h2", "GG", "II")], "barcode string, header string, seq string, qual string")
    asked = spark.createDataFrame([("a",), ("b",)], "barcode string")
    assert _set(reports.write_by_barcode(reads, asked, str(tmp_path / "out"))) == {("a", 1), ("b", 0)}
    assert _set(spark.read.text(str(tmp_path / "out")).select("barcode").distinct()) == {("a",)}


def test_unknown_contigs(spark):
    rows = spark.createDataFrame([("chr1",)], "rname string")
    assert reports.unknown_contigs(["chr1", "chr9"], rows) == ["chr9"]


def test_names(spark):
    row = spark.range(1).select(
        S.read_identity(F.lit("r1#bc/1")).alias("a"), S.read_identity(F.lit("r1")).alias("b"), S.spike_id(F.lit("none")).alias("c"), S.motif_place(F.lit("AACG"), "CG").alias("d")
    ).first()
    assert (tuple(row.a), tuple(row.b), row.c, row.d) == (("r1", "bc/1"), ("r1", "NA"), None, 3)


def _fastq(n, seed=1):
    r = random.Random(seed)
    rows = [("@" + f"r{i}" * r.randrange(1, 4), "".join(r.choice("ACGT") for _ in range(r.randrange(1, 90)))) for i in range(n)]
    return [(h, s, "+", "@" * len(s)) for h, s in rows]


@pytest.mark.parametrize("size", ["1k", "90", "128m"])
def test_fastq_records_across_input_splits(spark, tmp_path, size):
    """Records come out whole and numbered however small the input splits are, even below a record; quality lines may begin with @."""
    first, second = _fastq(300), _fastq(7, 2)
    (tmp_path / "a.fq").write_text("\n".join(x for r in first for x in r) + "\n")
    with gzip.open(tmp_path / "b.fq.gz", "wt") as f:
        f.write("\n".join(x for r in second for x in r))
    (tmp_path / "c.fq").write_text("")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        found = text.read_fastq(spark, str(tmp_path)).collect()
        lines = text._lines(spark, str(tmp_path / "a.fq"), "r1").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for name, want in (("a.fq", first), ("b.fq.gz", second)):
        got = sorted((r["ord"], tuple(r[2:])) for r in found if r["file"].endswith(name))
        assert got == list(enumerate(want))
    flat = [x for r in first for x in r]
    assert [r["line"] for r in sorted(lines, key=lambda r: r["ord"])] == flat
    marks = 0
    for r in sorted(lines, key=lambda r: r["ord"]):
        marks += "r1" in r["line"]
        assert r["section"] == marks


def test_truncated_fastq_is_an_error(spark, tmp_path):
    path = _file(tmp_path, "x.fq", "@a", "ACGT", "+", "IIII", "@b", "AC")
    with pytest.raises(PythonException, match="truncated"):
        text.read_fastq(spark, path).collect()


def test_fasta_and_names_of_split_bed(spark, tmp_path):
    path = _file(tmp_path, "x.fa", ">a one", "ACGT", "", "GG", ">b", ">a two", "T" * 70, "C")
    assert _set(text.read_fasta(spark, path)) == {("a", "a one", "ACGTGG"), ("b", "b", ""), ("a", "a two", "T" * 70 + "C")}
    assert ("a", "a two", "T" * 70 + "C") in _set(text.read_fasta(spark, path, keep="longest"))
    bed = _file(tmp_path, "x.bed", "chr1\t5\t90\tread1#1_2_3/2\t9\t+", "chr1\t7\t92\tread2#4_5_6\t9\t-")
    rows = text.named_reads(text.read_bed(spark, bed)).select("read_id", "barcode", "mate")
    assert _set(rows) == {("read1", "1_2_3", 2), ("read2", "4_5_6", 1)}


def test_contigs_by_confidence(spark, tmp_path):
    rows = spark.createDataFrame([("a", "ACGT", 0), ("b", "GG", 1)], "barcode string, seq string, low_confidence int")
    text.write_by_confidence(rows, str(tmp_path / "out"))
    for side, want in (("highconf", {(">a",), ("ACGT",)}), ("flagged", {(">b",), ("GG",)})):
        assert _set(spark.read.text(str(tmp_path / "out" / f"side={side}"))) == want
