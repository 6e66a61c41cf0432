"""Hand-made cases for sources, phasing, streaming and edge rules."""

import gzip
import random

from pyspark.sql import functions as F

from linkweave.functions import seq as S
from linkweave.kernels.assembly import AssembleOptions
from linkweave.operators import assemble, demux, fragments, intervals, phasing
from linkweave.sources import text
from linkweave.streaming import sessions


def test_sequence_functions(spark):
    df = spark.createDataFrame([("ACGTN", "10M2I5M3S", "r1#ACG/1")], "s string, c string, n string")
    row = df.select(
        S.reverse_complement(F.col("s")), S.kmers(F.col("s"), 3), S.kmers(F.col("s"), 9), S.cigar_matched(F.col("c")), S.barcode_of(F.col("n")), S.low_complexity(F.lit("AAAAC")),
        S.hamming(F.lit("ACGT"), F.lit("ACCA")), F.size(S.neighbours(F.lit("ACGT"), 4)),
    ).first()
    assert list(row) == ["NACGT", ["ACG", "CGT", "GTN"], [], 15, "ACG", True, 2, 13]


def test_gap_exactly_at_the_limit_splits(spark):
    reads = spark.createDataFrame([("b", "c", p, 0, i) for i, p in enumerate((0, 9, 19, 28))], "barcode string, chrom string, pos long, flag int, read_id long")
    found = fragments.call_fragments(reads, gap=10, read_length=1).orderBy("frag").collect()
    assert [(r["min_pos"], r["max_pos"], r["n_reads"]) for r in found] == [(0, 9, 2), (19, 28, 2)]


def test_first_failed_test_counts(spark):
    reads = spark.createDataFrame([(None, 0x904, 0), ("0_0_0", 0, 60), ("a", 0x904, 0), ("a", 4, 0), ("a", 0, 1), ("a", 0, 60)], "barcode string, flag int, mapq int")
    counts = {r["reason"]: r["n_reads"] for r in fragments.gate_counts(reads).collect()}
    assert counts == {"bc_flag_failed": 2, "read_flag_failed": 1, "mapped_flag_failed": 1, "poor_quality": 1, "passed": 1}


def test_merge_touching_nested_and_gap(spark):
    rows = [("c", 0, 10), ("c", 10, 12), ("c", 3, 5), ("c", 13, 20), ("c", 13, 20)]
    merged = intervals.merge_intervals(spark.createDataFrame(rows, "chrom string, start long, end long")).orderBy("start").collect()
    assert [(r["start"], r["end"], r["n_merged"], r["span"]) for r in merged] == [(0, 12, 3, 13), (13, 20, 2, 8)]
    assert intervals.merge_intervals(spark.createDataFrame([], "chrom string, start long, end long")).count() == 0


def test_last_whitelist_line_wins(spark):
    white = spark.createDataFrame([("1", 1, "AAAAAAAAAA"), ("2", 2, "AAAAAAAAAC")], "barcode_id string, line_no long, barcode string")
    near = {r["segment"]: r["barcode_id"] for r in demux.neighbourhood(white, 10).collect()}
    assert near["AAAAAAAAAA"] == "2" and near["CAAAAAAAAA"] == "1"


def test_switch_and_mismatch(spark):
    def errors(bits):
        rows = [("c", 1, i, b, 1) for i, b in enumerate(bits)]
        r = phasing.switch_errors(spark.createDataFrame(rows, "chrom string, block long, ord long, a1 int, t1 int")).first()
        return r["switches"], r["mismatches"]

    assert errors([1, 1, 0, 1, 1, 1]) == (0, 1)
    assert errors([1, 1, 1, 0, 0, 0]) == (1, 0)
    assert errors([1, 1, 1, 1, 1, 0]) == (0, 1)
    assert errors([1, 1, 1]) == (0, 0)


def test_fastq_fasta_sam_vcf(spark, tmp_path):
    with gzip.open(tmp_path / "a_read_1.fq.gz", "wt") as f:
        f.write("@x/1\nACGT\n+\nIIII\n@y/1\nGG\n+\nII\n")
    assert [(r["ord"], r["header"], r["seq"]) for r in text.read_fastq(spark, str(tmp_path / "a_read_1.fq.gz")).orderBy("ord").collect()] == [(0, "@x/1", "ACGT"), (1, "@y/1", "GG")]
    (tmp_path / "a.fa").write_text(">n one\nAC\nGT\n>n two\nA\n>m\nTTT\n")
    assert {(r["name"], r["seq"]) for r in text.read_fasta(spark, str(tmp_path / "a.fa"), keep="longest").collect()} == {("n", "ACGT"), ("m", "TTT")}
    (tmp_path / "a.sam").write_text("@HD\tVN:1\nq#B1/1\t16\tchr1\t11\t60\t4M\t*\t0\t0\tACGT\tIIII\tBX:Z:B1\tNM:i:2\n")
    row = text.read_sam(spark, str(tmp_path / "a.sam")).first()
    assert (row["pos"], row["tags"]["BX"], row["tags"]["NM"]) == (10, "B1", "2")
    (tmp_path / "a.vcf").write_text("##x\n#CHROM\nc\t5\t.\tA\tG\t.\t.\t.\tGT\t0|1:3\nc\t6\t.\tA\tG\t.\t.\t.\tGT\t1/1\nshort\t1\n")
    assert [r["pos"] for r in text.heterozygous(text.read_vcf(spark, str(tmp_path / "a.vcf"))).collect()] == [5]


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.sql("select cast(id % 3 as string) barcode, 'c' chrom, timestamp_seconds(1600000000 + id * 37 + (id div 10) * 600) ts from range(100)")
    rows.write.parquet(str(tmp_path / "in"))
    batch = {tuple(r) for r in sessions.stream_sessions(rows, 300).collect()}
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = sessions.stream_sessions(stream, 300).writeStream.format("memory").queryName("s").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    assert {tuple(r) for r in spark.table("s").collect()} == batch


def test_barcodes_without_contigs(spark):
    r = random.Random(3)
    reads = spark.createDataFrame([("b1", "".join(r.choice("ACGT") for _ in range(240))), ("b2", "ACG")], "barcode string, seq string")
    limits = AssembleOptions(min_contig=100)
    found = assemble.assemble_barcodes(reads, limits)
    assert [r["barcode"] for r in found.collect()] == ["b1"]
    assert assemble.assemble_barcodes(reads, AssembleOptions(min_contig=1000)).count() == 0
    judged = assemble.junction_qc(found, reads)
    assert [r["barcode"] for r in judged.collect()] == ["b1"]
