"""Shortfall classes on cases with known answers."""

import random

from linkweave.operators import contigs


def test_classes(spark):
    r = random.Random(3)
    ref = {b: "".join(r.choice("ACGT") for _ in range(300)) for b in "abcde"}
    own = {"a": ref["a"], "b": ref["b"][100:200], "c": ref["c"][100:200], "d": ref["d"][100:200], "e": "".join(r.choice("ACGT") for _ in range(100))}
    left, right = [(50, 150), (60, 160)], [(150, 250), (155, 255)]
    spans = {"a": [], "b": left + right, "c": left + right[:1], "d": left[:1] + [(85, 185)], "e": left}
    reads = [(b, ref[b][s:e]) for b, pairs in spans.items() for s, e in pairs]
    frame = lambda rows: spark.createDataFrame(rows, "barcode string, seq string")
    found = contigs.shortfall_classes(frame(reads + reads[:1]), frame(list(own.items())), frame(list(ref.items())))
    want = {("a", 0, 0, "covers"), ("b", 2, 2, "bridged_both"), ("c", 2, 1, "bridged_one"), ("d", 1, 0, "no_bridge"), ("e", 0, 0, "unplaced")}
    assert {tuple(x) for x in found.collect()} == want
