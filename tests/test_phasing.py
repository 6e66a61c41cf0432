"""Switch errors against a one-by-one fold, and the rates built on them."""

import random

from linkweave.operators import phasing


def fold(bits):
    """Switches and mismatches of agreement bits (None: missing), walked one by one."""
    known = [i for i, b in enumerate(bits) if b is not None]
    if not known:
        return 0, 0
    lead, at = 0, known[0]
    while at + 1 < len(bits) and bits[at + 1] is not None and bits[at + 1] != bits[at]:
        lead, at = lead + 1, at + 1
    switches, wrong, open_ = 0, 0, lead % 2 == 1
    for i, j in zip(known, known[1:], strict=False):
        if bits[i] == bits[j]:
            open_ = False
        elif open_:
            switches, wrong, open_ = max(0, switches - 1), wrong + 1, False
        else:
            switches, open_ = switches + 1, True
    return (max(0, switches - 1), wrong + 1) if open_ else (switches, wrong)


def test_known_cases():
    bits = lambda pairs: [int(a == t) for a, t in pairs]
    assert fold(bits([(0, 0), (0, 1), (1, 1), (0, 1), (0, 1), (1, 1)])) == (0, 3)
    assert fold([1, 1, 0, 0]) == (1, 0) and fold([1, 1, 0, 1, 1]) == (0, 1) and fold([1, 0, 0, 0]) == (0, 1) and fold([1, 1, 1, 0]) == (0, 1)


def test_switch_errors_of_random_blocks(spark):
    r, rows, want = random.Random(6), [], {}
    for block in range(500):
        bits = [None if r.random() < 0.12 else int(r.random() < r.choice([0.2, 0.5, 0.9])) for _ in range(r.randrange(1, 14))]
        want[block] = fold(bits)
        for i, b in enumerate(bits):
            t = r.randrange(2)
            missing = r.choice([("-", str(t)), (str(t), "-"), (None, str(t))])
            rows.append(("c", block, i, *(missing if b is None else (str(t if b else 1 - t), str(t)))))
    r.shuffle(rows)
    alleles = spark.createDataFrame(rows, "chrom string, block long, ord long, a1 string, t1 string")
    found = {x["block"]: (x["switches"], x["mismatches"]) for x in phasing.switch_errors(alleles).collect()}
    assert found == want and len({w for w in want.values()}) > 10


def test_second_haplotype_decides_with_fewer_switches(spark):
    rows = [("c", 1, i, a, b, "0") for i, (a, b) in enumerate(zip("001100", "111-11", strict=True))]
    alleles = spark.createDataFrame(rows, "chrom string, block long, ord long, a1 string, a2 string, t1 string")
    assert [tuple(r) for r in phasing.switch_errors(alleles).collect()] == [("c", 1, 0, 0)]
    assert [tuple(r) for r in phasing.flat_error(alleles).collect()] == [("c", 1, 1, 5)]


def test_an50_and_total(spark):
    rows = [("x", 1, i, 10 * i, "0", "0") for i in range(6)] + [("x", 2, i, 100 + 5 * i, "-" if i % 2 else "1", "1") for i in range(7)] + [("y", 3, 0, 7, "0", "1")]
    alleles = spark.createDataFrame(rows, "chrom string, block long, ord long, pos long, a1 string, t1 string")
    sizes = spark.createDataFrame([("x", 13, 13, 60), ("y", 1, 1, 5)], "chrom string, n_snps long, n_covered long, length long")
    found = {r["chrom"]: r for r in phasing.completeness(alleles, sizes).collect()}
    assert found["x"]["an50"] == round(30 * 4 / 7, 6) and found["x"]["n50"] == 50 and found["x"]["missing_rate"] == round(3 / 13, 6)
    assert found["total"]["phased"] == 11 and found["total"]["max_block_share"] == round(7 / 14, 6) and found["y"]["an50"] == 0
    empty = alleles.filter("false")
    assert phasing.switch_errors(empty).count() == 0 and phasing.completeness(empty, sizes.filter("false")).count() == 0
