"""Haplotype blocks: bounds, N50 and AN50, flat and switch errors, rates.

Alleles are rows (chrom, block, ord, a1, t1): the assembled and the true allele at a block's SNPs in order. An
allele that is null or ``-`` is missing. The second haplotype is the complement of the first, or ``a2`` where given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def block_bounds(snps: DataFrame) -> DataFrame:
    """First and last SNP position and SNP count of each block."""
    return snps.groupBy("chrom", "block").agg(
        F.min_by("pos", "ord").alias("first_pos"), F.max_by("pos", "ord").alias("last_pos"), F.count(F.lit(1)).alias("n_snps")
    )


def _known(*columns: str) -> Column:
    """All of these alleles are there."""
    out = F.lit(True)
    for c in columns:
        out = out & F.coalesce(F.col(c).cast("string") != "-", F.lit(False))
    return out


def _half(spans: DataFrame, by: str, weight: str, total: Column | None) -> DataFrame:
    """(by, span): the first span, from the longest on, where the running sum of ``weight`` exceeds half of ``total``.

    Equal spans are summed up first, so a window holds the distinct spans of a group, not its rows.
    """
    sums = spans.groupBy(by, "span").agg(F.sum(weight).alias("_w"), *([F.max(total).alias("_all")] if total is not None else []))
    order = Window.partitionBy(by).orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if total is None:
        sums = sums.withColumn("_all", F.sum("_w").over(Window.partitionBy(by)))
    return sums.withColumn("_run", F.sum("_w").over(order)).filter(F.col("_run") * 2 > F.col("_all")).groupBy(by).agg(F.max("span").alias("span"))


def n50(spans: DataFrame, total: float | None = None, by: str = "group") -> DataFrame:
    """First span, from the longest on, where the running sum exceeds half of ``total`` (default: of the spans)."""
    return _half(spans.withColumn("_weight", F.col("span")), by, "_weight", None if total is None else F.lit(total)).withColumnRenamed("span", "n50")


def flat_error(alleles: DataFrame) -> DataFrame:
    """Per block the lesser of the mismatches of both haplotypes to the truth, over the SNPs where no allele is missing."""
    second = "a2" in alleles.columns
    known = _known("a1", "t1", *["a2"] * second)
    wrong = F.count_if(known & (F.col("a1") != F.col("t1")))
    n = F.count_if(known)
    other = F.count_if(known & (F.col("a2") != F.col("t1"))) if second else n - wrong
    return alleles.groupBy("chrom", "block").agg(F.least(wrong, other).alias("flat"), n.alias("n_snps"))


def opportunities(alleles: DataFrame) -> DataFrame:
    """Places where switches and mismatches can occur: known SNPs, less three for switches."""
    n = F.count_if(_known("a1", "t1"))
    return alleles.groupBy("chrom", "block").agg(
        F.when(n >= 4, n - 3).otherwise(0).alias("poss_sw"), F.when(n >= 2, n).otherwise(0).alias("poss_mm")
    )


def _fold(bits: Column) -> Column:
    """(switches, mismatches) of agreement bits in block order, null where an allele is missing.

    A change against the known bit before is a switch, unless the change before it is an open switch: then
    both are one mismatch. A switch left open by the last bit is a mismatch. An odd number of changes right
    behind the first known bit, with no gap, counts as mismatches alone, as if a switch were open before it.
    """
    ahead0 = F.struct(F.lit(None).cast("int").alias("prev"), F.lit(0).alias("n"), F.lit(False).alias("over"))

    def look(s: Column, bit: Column) -> Column:
        begun = s["prev"].isNotNull()
        turned = begun & bit.isNotNull() & (bit != s["prev"])
        return F.struct(F.coalesce(bit, s["prev"]).alias("prev"), (s["n"] + F.when(turned & ~s["over"], 1).otherwise(0)).alias("n"), (s["over"] | (begun & ~F.coalesce(turned, F.lit(False)))).alias("over"))

    first_open = F.aggregate(bits, ahead0, look, lambda s: s["n"] % 2 == 1)
    state = F.struct(F.lit(None).cast("int").alias("prev"), first_open.alias("open"), F.lit(0).cast("long").alias("sw"), F.lit(0).cast("long").alias("mm"))

    def settled(s: Column) -> tuple[Column, Column]:
        """An open switch becomes a mismatch."""
        return F.greatest(s["sw"] - 1, F.lit(0)).cast("long"), (s["mm"] + 1).cast("long")

    def step(s: Column, bit: Column) -> Column:
        turned = s["prev"].isNotNull() & (bit != s["prev"])
        sw, mm = settled(s)
        counted = F.struct(
            bit.alias("prev"),
            F.when(s["prev"].isNull(), s["open"]).otherwise(turned & ~s["open"]).alias("open"),
            F.when(turned & s["open"], sw).when(turned, s["sw"] + 1).otherwise(s["sw"]).cast("long").alias("sw"),
            F.when(turned & s["open"], mm).otherwise(s["mm"]).cast("long").alias("mm"),
        )
        return F.when(bit.isNull(), s).otherwise(counted)

    def finish(s: Column) -> Column:
        sw, mm = settled(s)
        return F.struct(F.when(s["open"], sw).otherwise(s["sw"]).alias("switches"), F.when(s["open"], mm).otherwise(s["mm"]).alias("mismatches"))

    return F.aggregate(bits, state, step, finish)


def switch_errors(alleles: DataFrame) -> DataFrame:
    """Switches and mismatches per block (see ``_fold``), of the haplotype with fewer switches, else of the second."""
    second = "a2" in alleles.columns

    def bit(c: str) -> Column:
        return F.when(_known(c, "t1"), (F.col(c) == F.col("t1")).cast("int")).alias(c)

    listed = alleles.groupBy("chrom", "block").agg(F.array_sort(F.collect_list(F.struct("ord", bit("a1"), *[bit("a2")] * second))).alias("l"))
    errors = [_fold(F.col(f"l.{c}")) for c in ["a1", "a2"][: 1 + second]]
    found = listed.select("chrom", "block", *[e.alias(f"e{i}") for i, e in enumerate(errors)])
    best = F.when(F.col("e0.switches") < F.col("e1.switches"), F.col("e0")).otherwise(F.col("e1")) if second else F.col("e0")
    return found.select("chrom", "block", best.alias("e")).select("chrom", "block", "e.switches", "e.mismatches")


def block_spans(alleles: DataFrame) -> DataFrame:
    """Per block: its phased SNPs, the distance from the first to the last of them, and that distance scaled by
    the share of phased ones among the SNPs (by ``ord``, the SNP's number) between."""
    phased = alleles.filter(_known("a1")).groupBy("chrom", "block").agg(
        F.count(F.lit(1)).alias("phased"), F.min("ord").alias("i"), F.max("ord").alias("j"), F.min_by("pos", "ord").alias("a"), F.max_by("pos", "ord").alias("b")
    )
    span = F.col("b") - F.col("a")
    return phased.select("chrom", "block", "phased", span.alias("span"), F.round(span * F.col("phased") / (F.col("j") - F.col("i") + 1), 6).alias("adjusted"))


def phasing_rates(switches: DataFrame, places: DataFrame, flat: DataFrame) -> DataFrame:
    """Per chromosome and in total (chrom ``total``): summed errors over summed opportunities, 0 where there are none."""
    joined = switches.join(places, ["chrom", "block"]).join(flat, ["chrom", "block"])
    rate = lambda a, b: F.round(F.coalesce(F.try_divide(F.sum(a), F.sum(b)), F.lit(0.0)), 6)
    return joined.rollup("chrom").agg(
        rate("switches", "poss_sw").alias("switch_rate"), rate("mismatches", "poss_mm").alias("mismatch_rate"),
        rate(F.col("switches") + F.col("mismatches"), "poss_mm").alias("combined_rate"), rate("flat", "poss_mm").alias("flat_rate"),
    ).withColumn("chrom", F.coalesce("chrom", F.lit("total")))


def completeness(alleles: DataFrame, sizes: DataFrame) -> DataFrame:
    """Per chromosome and in total: phased SNPs, the missing rate, AN50, N50 and the share of SNPs in the largest blocks.

    ``sizes`` has a row (chrom, n_snps, n_covered, length) per chromosome: its heterozygous SNPs, those that fragments
    cover, and its length in bases. AN50 is the scaled span at which half of all SNPs are phased, N50 the span at which
    half of the length is reached; 0 where it never is.
    """
    either = F.explode(F.array("chrom", F.lit("total")))
    spans = block_spans(alleles)
    top = spans.groupBy("chrom").agg(F.max("phased").alias("top"), F.sum("phased").alias("phased"))
    totals = sizes.join(top, "chrom", "left").withColumn("chrom", either)
    totals = totals.groupBy("chrom").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_snps", "n_covered", "length", "phased", "top")])
    own = spans.withColumn("chrom", either).join(F.broadcast(totals.select("chrom", "n_snps", "length")), "chrom")  # one row a chromosome
    an50 = _half(own.select("chrom", F.col("adjusted").alias("span"), "phased", "n_snps"), "chrom", "phased", F.col("n_snps")).withColumnRenamed("span", "an50")
    n50_ = _half(own.select("chrom", "span", F.col("span").alias("w"), "length"), "chrom", "w", F.col("length")).withColumnRenamed("span", "n50")
    rate = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    missing = F.when(F.col("n_covered") > 0, 1 - rate("phased", "n_covered")).otherwise(0.0)
    return totals.join(an50, "chrom", "left").join(n50_, "chrom", "left").select(
        "chrom", F.col("phased").cast("long").alias("phased"), F.round(missing, 6).alias("missing_rate"), F.coalesce("an50", F.lit(0.0)).alias("an50"),
        F.coalesce("n50", F.lit(0)).cast("long").alias("n50"), F.round(rate("top", "n_snps"), 6).alias("max_block_share"),
    )


def numbered_snps(blocks: DataFrame, variants: DataFrame) -> DataFrame:
    """Haplotype-block rows (chrom, block, ord, a1, and a position ``pos`` or null) with the position that the variant
    table (chrom, ord, pos) has for the SNP number; rows whose own position or chromosome disagrees are flagged."""
    known = variants.select("chrom", "ord", F.col("pos").alias("vcf_pos"))
    joined = blocks.join(known, ["chrom", "ord"], "left")
    wrong = F.col("vcf_pos").isNull() | (F.col("pos").isNotNull() & (F.col("pos") != F.col("vcf_pos")))
    return joined.withColumn("conflict", F.coalesce(wrong, F.lit(False)).cast("int")).withColumn("pos", F.coalesce("vcf_pos", "pos")).drop("vcf_pos")
