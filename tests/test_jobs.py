"""Module switches, tables and provenance of a job over a small SAM file."""

import random

import pytest

from linkweave import jobs
from linkweave.kernels import assembly as K
from linkweave.sources import text


@pytest.fixture(scope="module")
def sam(tmp_path_factory):
    seq = "ACGTTGCAAC" * 10
    rows = [f"r{i}#bc{i % 2}/1\t{16 * (i % 2)}\tchr1\t{1000 * i + 1}\t60\t100M\t*\t0\t0\t{seq}\t{'I' * 100}\tNM:i:{i % 3}" for i in range(20)]
    rows += [f"x\t4\t*\t0\t0\t*\t*\t0\t0\t{seq}\t{'I' * 100}\tBX:Z:tagged"]
    path = tmp_path_factory.mktemp("sam") / "a.sam"
    path.write_text("@HD\tVN:1\n" + "\n".join(rows) + "\n")
    return str(path)


def test_targets(spark, sam):
    reads = jobs.tagged_reads(spark, sam)
    assert {r["barcode"] for r in reads.collect()} == {"bc0", "bc1", "tagged"}
    options = jobs.JobOptions(split_distances=(2000, 5000))
    found = jobs.targets(reads, {"LFR": True, "eval_metrics": True, "frag_de_novo": False}, options)
    assert "contigs" not in found and {"fragments_2000", "fragments_5000", "fragment_summary_5000"} <= set(found)
    assert found["fragments_2000"].count() == 20 and found["fragments_5000"].count() == 2
    totals = found["align_metrics"].first()
    assert (totals["clean"], totals["mapped"], totals["mismatches"]) == (21, 20, sum(i % 3 for i in range(20)))
    assert jobs.targets(reads, {}) == {}
    with pytest.raises(ValueError):
        jobs.targets(reads, {"plots": True})


def test_main_writes_tables(spark, sam, tmp_path):
    jobs.main(["--reads", sam, "--out", str(tmp_path), "--module", "eval_metrics", "--module", "frag_de_novo", "--min-mapq", "20"])
    assert {r["reason"]: r["n_reads"] for r in spark.read.parquet(f"{tmp_path}/read_gate").collect()} == {"passed": 20, "mapped_flag_failed": 1}
    made = {r["key"]: r["value"] for r in spark.read.parquet(f"{tmp_path}/provenance").collect()}
    assert made["min_mapq"] == "20" and "align_metrics" in made["tables"]


def test_denovo_modules(spark, tmp_path):
    """Contigs and verdicts of a molecule that its reads tile; references come from the header; an unknown one is an error."""
    r = random.Random(4)
    truth = "".join(r.choice("ACGT") for _ in range(900))
    rows = [f"r{i}#bc/1\t0\tchr1\t{i + 1}\t60\t250M\t*\t0\t0\t{truth[i : i + 250]}\t{'I' * 250}" for i in range(0, 651, 10)]
    path = tmp_path / "a.sam"
    path.write_text("@HD\tVN:1\n@SQ\tSN:chr1\tLN:900\n@SQ\tSN:chr2\tLN:5\n" + "\n".join(rows) + "\n")
    assert {tuple(x) for x in text.sam_references(spark, str(path)).collect()} == {("chr1", 900), ("chr2", 5)}
    out = tmp_path / "out"
    jobs.main(["--reads", str(path), "--out", str(out), "--module", "denovo_qc", "--module", "gc_bias", "--module", "duplicates", "--read-length", "250", "--chrom", "chr1"])
    table = lambda n: spark.read.parquet(f"{out}/{n}")
    assert [x["seq"] for x in table("contigs").collect()] in ([truth], [K.rc(truth)])
    assert table("read_filter").filter("kept = 0").count() == 0 and table("pools").first()["n_groups"] == 1
    assert table("junction").first()["junction_suspect"] == 0 and table("verdict").first()["low_confidence"] == 0 and table("readback").first()["breadth_1x"] == 1.0
    assert {(x["metric"], x["n"]) for x in table("verdict_counts").collect()} == {("all", 1), ("low_confidence", 0)}
    assert table("gc_both").count() == 251 and table("duplicate_totals").first()["n_reads"] == 66
    with pytest.raises(SystemExit):
        jobs.main(["--reads", str(path), "--out", str(out), "--module", "gc_bias", "--chrom", "chrX"])


def test_first_by_membership(spark):
    reads = spark.createDataFrame([(i, f"n{i}") for i in range(20)], "ord long, name string")
    names = spark.createDataFrame([(f"n{i}",) for i in range(0, 20, 2)] * 2, "name string")
    inside, outside = text.first_by_membership(reads, names, 3)
    assert [x["ord"] for x in inside.collect()] == [0, 2, 4] and [x["ord"] for x in outside.collect()] == [1, 3, 5]
