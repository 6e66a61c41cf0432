"""Rows cut from sequences stay inside their barcode: no query gathers them on the driver, and the kernels give what the longer way gives."""

import random

import pytest

from linkweave.kernels import assembly
from linkweave.operators import contigs, placement
from linkweave.plans import catalogue

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["kmer_placement", "readback_support", "shortfall_classes", "base_votes", "drop_contained", "kmer_identity"])
def test_nothing_is_broadcast(spark, name):
    assert "Broadcast" not in catalogue.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def test_placements_equal_single_ones(spark):
    r = random.Random(5)
    reads, targets = [], []
    for b in range(40):
        letters, unit = r.choice(["ACGT", "AC", "ACN"]), "".join(r.choices("ACGT", k=r.randint(1, 9)))
        own = ["".join(r.choices(letters, k=r.randint(0, 60))) + unit * r.randint(0, 15) for _ in range(r.randint(1, 3))]
        targets += [(f"b{b}", f"t{i}", s) for i, s in enumerate(own)]
        cut = [(s := r.choice(own))[r.randint(0, 9) :] + "".join(r.choices(letters, k=3)) for _ in range(3)]
        reads += [(f"b{b}", i, assembly.rc(s) if i == 1 else s) for i, s in enumerate(cut)]
    limits = {"k": 5, "min_anchors": 3, "min_span": 10, "max_hits": 2}
    want = {
        (b, i, t, assembly.place(s if strand == "+" else assembly.rc(s), seq, **limits), strand)
        for b, i, s in reads for c, t, seq in targets if b == c
        for strand in "+-" if (assembly.place(s, seq, **limits) is None) == (strand == "-") and assembly.oriented(s, seq, **limits)
    }
    odd = [(None, 0, targets[0][2]), ("b0", 9, None), ("b0", None, None), ("none", 0, "ACGT" * 9)]
    found = placement.placements(spark.createDataFrame(reads + odd, "barcode string, read_id int, seq string"), spark.createDataFrame([*targets, (None, "x", targets[0][2])], "barcode string, target_id string, seq string"), **limits)
    rows = [tuple(x) for x in found.select("barcode", "read_id", "target_id", "start", "strand").collect()]
    assert len(rows) == len(want) > 40
    assert set(rows) == want


def test_votes_over_ends_and_several_contigs(spark):
    aligned = [("a", -2, "GGCC"), ("a", -1, "TCC"), ("a", 0, "CCAATTT"), ("a", 9, "G"), ("a", None, "G"), ("a", 0, None), (None, 0, "CC"), ("b", 0, "A")]
    own = [("a", "CAAA"), ("a", "CC"), ("b", "T"), (None, "AA"), ("c", None)]
    found = contigs.base_votes(spark.createDataFrame(aligned, "barcode string, start int, seq string"), spark.createDataFrame(own, "barcode string, seq string"), share=0.5)
    assert found.schema.simpleString() == "struct<barcode:string,at:bigint,old:string,new:string,votes:bigint,total:bigint>"
    assert sorted(tuple(x) for x in found.collect()) == [("a", 1, "A", "C", 4, 5)]


def test_contained_sequences(spark):
    r = random.Random(7)
    rows = [("a", "ACGTACGTAC"), ("a", "CGTACG"), ("a", "CGTACG"), ("a", "GT"), ("a", "TT"), ("a", ""), ("a", None), ("b", "CGTACG"), (None, "ACGT"), (None, "CG"), (None, "CG")]
    for b in "cdefgh":
        whole = "".join(r.choices("AC", k=60))
        rows += [(b, whole[i : i + r.randint(1, 30)]) for i in r.choices(range(50), k=25)]
    want = {(b, s) for b, s in rows if b is None or s is None or not any(b == c and s in x and len(x) > len(s) for c, x in rows if x)}
    found = [tuple(x) for x in contigs.drop_contained(spark.createDataFrame(rows, "barcode string, seq string"), k=5).collect()]
    assert len(found) == len(set(found))
    assert set(found) == want


def test_identity_of_all_pairs(spark):
    r = random.Random(9)
    rows = [(b, i, "".join(r.choices("ACG", k=r.randint(0, 12)))) for b in "ab" for i in r.sample(range(99), 9)]
    words = {(b, i): {s[j : j + 3] for j in range(len(s) - 2)} for b, i, s in rows}
    want = {(b, i, j, n, round((n / min(len(x), len(y))) ** (1 / 3), 6)) for (b, i), x in words.items() for (c, j), y in words.items() if b == c and i < j and (n := len(x & y))}
    odd = [(None, 1, "ACGACG"), (None, 2, "ACGACG"), ("a", None, "ACGACG"), ("a", 100, None)]
    found = contigs.kmer_identity(spark.createDataFrame(rows + odd, "barcode string, read_id int, seq string"), 3)
    assert {tuple(x) for x in found.collect()} == want
