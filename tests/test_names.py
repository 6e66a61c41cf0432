"""Names, pieces, clips and lane files on known cases."""

import gzip

import pytest
from pyspark.sql import functions as F

from linkweave.functions import names as N
from linkweave.sources import text


def test_pieces_are_slices(spark):
    cases = [(s, n) for s in range(-12, 14) for n in (0, 1, 3, 20)]
    rows = spark.createDataFrame([("ACGTACGTAC",), ("",), ("ACG",), (None,)], "seq string")
    found = rows.select("seq", *[N.piece(F.col("seq"), s, n).alias(f"c{i}") for i, (s, n) in enumerate(cases)])
    for r in found.collect():
        want = [None if r["seq"] is None else r["seq"][s - 1 : s - 1 + n] for s, n in cases]
        assert [r[f"c{i}"] for i in range(len(cases))] == want


def test_names(spark):
    row = spark.createDataFrame([("a#b#UMI9/1", 7, None)], "n string, p int, t string")
    out = row.select(
        N.umi_of(F.col("n"), 3), N.umi_of(F.lit("plain")), N.placed_name(F.col("n"), F.col("p"), 4, True), N.tagged_name(F.col("n"), F.col("t")),
        N.known_contig(F.lit("chr7"), F.array(F.lit("7"))), N.known_contig(F.lit("9"), F.array(F.lit("7"))), N.is_main_chromosome(F.lit("chr23")),
    ).first()
    assert tuple(out) == ("UMI", None, "UMI9#7#a#b#UMI9", "a#b#UMI9/1", "7", "9", False)


def test_clips(spark):
    rows = spark.createDataFrame([("30S70M",), ("70M30S",), ("100M",), (None,), ("5S95M",)], "c string")
    assert [r[0] for r in rows.select(N.clipped(F.col("c"), "right", 50, 20)).collect()] == [True, False, False, False, False]
    with pytest.raises(ValueError):
        N.clipped(F.col("c"), "middle", 1, 1)


def test_lane_files_and_bases(spark, tmp_path):
    for lane, name in (("L1", "x_read_1.fq.gz"), ("L1", "x_read_2.fq.gz"), ("L2", "y_discard_read_1.fq.gz"), ("L2", "y_read_1.fq.gz")):
        (tmp_path / lane).mkdir(exist_ok=True)
        (tmp_path / lane / name).write_bytes(gzip.compress(b"@r\nacgN\n+\nIIII\n"))
    ends = lambda mate: [p.rsplit("/", 2)[1:] for p in text.lane_files(spark, str(tmp_path), ["L1", "L2", "L3"], mate)]
    assert ends(1) == [["L1", "x_read_1.fq.gz"], ["L2", "y_read_1.fq.gz"]]
    assert ends(None) == [["L1", "x_read_1.fq.gz"], ["L1", "x_read_2.fq.gz"], ["L2", "y_read_1.fq.gz"]]
    both = text.bases_of_fastq(spark, text.lane_files(spark, str(tmp_path), ["L1"]))
    assert sorted(map(tuple, both.collect())) == [(1, "ACGN"), (2, "ACGN")]
    sam = tmp_path / "a.sam"
    sam.write_text("@HD\tVN:1\n" + "".join(f"r\t{f}\tc\t1\t9\t3M\t*\t0\t0\tacg\tIII\n" for f in (64, 128, 4, 0)))
    assert sorted(text.bases_of_sam(spark, str(sam), only_mapped=True).collect(), key=repr) == [(1, "ACG"), (2, "ACG"), (None, "ACG")]
