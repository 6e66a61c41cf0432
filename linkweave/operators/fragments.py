"""Fragments of co-barcoded reads: gate, gap sessions, summaries by barcode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.seq import gc_count
from .intervals import merge_intervals


def gate_reason(min_mapq: int = 30, mask: int = 0x900) -> Column:
    """First failed test of a read (barcode, flag mask, mapped, mapping quality), or null for a good read."""
    barcode, flag = F.col("barcode"), F.col("flag")
    return (
        F.when(barcode.isNull() | (barcode == "0_0_0"), "bc_flag_failed")
        .when(flag.bitwiseAND(F.lit(mask)) != 0, "read_flag_failed")
        .when(flag.bitwiseAND(F.lit(4)) != 0, "mapped_flag_failed")
        .when(F.col("mapq") < min_mapq, "poor_quality")
    )


def gate_counts(reads: DataFrame, **options) -> DataFrame:
    reason = F.coalesce(gate_reason(**options), F.lit("passed"))
    return reads.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n_reads"))


def passed_reads(reads: DataFrame, **options) -> DataFrame:
    return reads.filter(gate_reason(**options).isNull())


def call_fragments(reads: DataFrame, gap: int, read_length: int = 100, tie: str = "read_id") -> DataFrame:
    """Splits each (barcode, chrom) in position order where two reads are ``gap`` or more apart.

    Strand is 0 iff reverse reads strictly outnumber forward ones. One exchange on (barcode, chrom).
    """
    order = Window.partitionBy("barcode", "chrom").orderBy("pos", tie)
    start = (F.col("pos") - F.lag("pos").over(order) >= gap).cast("long")
    numbered = reads.withColumn("_start", F.coalesce(start, F.lit(0))).withColumn(
        "frag", F.sum("_start").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    reverse = F.sum((F.col("flag").bitwiseAND(F.lit(16)) != 0).cast("long"))
    return numbered.groupBy("barcode", "chrom", "frag").agg(
        F.count(F.lit(1)).alias("n_reads"),
        F.min("pos").alias("min_pos"),
        F.max("pos").alias("max_pos"),
        (F.max("pos") - F.min("pos") + read_length).alias("length"),
        F.when(reverse * 2 > F.count(F.lit(1)), 0).otherwise(1).cast("long").alias("strand"),
        F.sum((F.col("flag").bitwiseAND(F.lit(1024)) != 0).cast("long")).alias("n_dup"),
        F.sort_array(F.collect_list("pos")).alias("positions"),
    )


def fragment_gate(fragments: DataFrame, min_reads: int, min_length: int) -> DataFrame:
    """Counts of fragments and reads by the gate they pass or fail first."""
    state = F.when(F.col("n_reads") < min_reads, "few_reads").when(F.col("length") < min_length, "short").otherwise("passed")
    return fragments.groupBy(state.alias("gate")).agg(F.count(F.lit(1)).alias("n_fragments"), F.sum("n_reads").alias("n_reads"))


def fragment_gaps(fragments: DataFrame, read_length: int) -> DataFrame:
    """Gaps between the reads of a fragment (only positive ones, with a leading 0) and what follows from them."""
    p, n = F.col("positions"), F.size("positions")
    between = F.zip_with(F.slice(p, 2, F.greatest(n - 1, F.lit(1))), F.slice(p, 1, F.greatest(n - 1, F.lit(1))), lambda b, a: b - a - read_length)
    gaps = F.concat(F.array(F.lit(0).cast("long")), F.filter(between, lambda g: g > 0))
    total = F.aggregate("gaps", F.lit(0).cast("long"), lambda s, g: s + g)
    return fragments.withColumn("gaps", gaps).select(
        "barcode", "chrom", "frag",
        F.array_max("gaps").alias("max_gap"),
        total.alias("gap_total"),
        F.size("gaps").cast("long").alias("n_gaps"),
        F.round((F.col("length") - total) / F.col("length") * 100, 4).alias("covered_percent"),
        F.round(F.col("n_reads") * read_length / F.col("length"), 6).alias("mean_depth"),
    )


def fragment_summary(fragments: DataFrame, genome: int = 2_934_876_545) -> DataFrame:
    """One row of totals; the median is exact. Barcodes are counted through a partial aggregation of their own.

    ``merged_length`` is what the fragments cover of the chromosomes, overlapping ones once; ``genome_percent`` is its
    share of the genome. ``reads_per_kbp`` divides the mean reads by the median length.
    """
    per_bc = fragments.groupBy("barcode").agg(F.count(F.lit(1)).alias("f"), F.sum("n_reads").alias("r"))
    bc = per_bc.agg(F.count(F.lit(1)).alias("n_barcodes"), F.round(F.avg("f"), 4).alias("frags_per_bc"), F.round(F.avg("r"), 4).alias("reads_per_bc"))
    total = fragments.agg(
        F.count(F.lit(1)).alias("n_fragments"),
        F.coalesce(F.sum("n_reads"), F.lit(0)).alias("n_reads"),
        F.round(F.avg("length"), 2).alias("mean_length"),
        F.round(F.median("length"), 4).alias("median_length"),
        F.round(F.avg("n_reads"), 4).alias("reads_per_frag"),
        F.round(F.coalesce(F.try_divide(1000 * F.avg("n_reads"), F.median("length")), F.lit(0.0)), 9).alias("reads_per_kbp"),
    )
    spans = merge_intervals(fragments.select("chrom", F.col("min_pos").alias("start"), (F.col("min_pos") + F.col("length")).alias("end")))
    covered = spans.agg(F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0)).alias("merged_length"))
    covered = covered.withColumn("genome_percent", F.round(F.col("merged_length") / genome * 100, 4))
    return bc.crossJoin(total).crossJoin(covered)  # one row each


FINE_BINS = [(1, 1), (2, 2), (3, 3), (4, 4), (5, 9), (10, 24), (25, 49), (50, 99), (100, None)]
COARSE_BINS = [(1, 1), (2, 4), (5, 9), (10, 24), (25, 99), (100, None)]


def bin_label(value: Column, bins: list[tuple[int, int | None]]) -> Column:
    label = F.lit(None).cast("string")
    for low, high in reversed(bins):
        name = f">={low}" if high is None else str(low) if low == high else f"[{low},{high + 1})"
        label = F.when((value >= low) & (F.lit(True) if high is None else value <= high), F.lit(name)).otherwise(label)
    return label


def reads_per_barcode_bins(counts: DataFrame, bins: list[tuple[int, int | None]]) -> DataFrame:
    """``counts``: (barcode, n_reads). Barcodes and reads by bin of reads per barcode."""
    return counts.groupBy(bin_label(F.col("n_reads"), bins).alias("bin")).agg(F.count(F.lit(1)).alias("n_barcodes"), F.sum("n_reads").alias("n_reads"))


def reads_per_barcode_distribution(counts: DataFrame) -> DataFrame:
    """How many barcodes have how many reads, with their share of all reads."""
    groups = counts.groupBy("n_reads").agg(F.count(F.lit(1)).alias("n_barcodes")).withColumn("reads", F.col("n_reads") * F.col("n_barcodes"))
    whole = groups.agg(F.sum("reads").alias("_all"))
    return groups.crossJoin(F.broadcast(whole)).select("n_reads", "n_barcodes", "reads", F.round(F.col("reads") / F.col("_all") * 100, 6).alias("percent"))


def deep_barcode_tally(fragments: DataFrame, depth: int, min_reads: int) -> DataFrame:
    """Barcodes of ``depth`` or more reads by whether any of their fragments passes."""
    per = fragments.groupBy("barcode").agg(
        F.sum("n_reads").alias("r"), F.count(F.lit(1)).alias("n"), F.sum((F.col("n_reads") >= min_reads).cast("long")).alias("good")
    )
    return per.filter(F.col("r") >= depth).groupBy((F.col("good") > 0).cast("long").alias("any_passed")).agg(
        F.count(F.lit(1)).alias("n_barcodes"), F.sum("n").alias("n_fragments"), F.sum("good").alias("n_passed")
    )


def same_barcode_gaps(fragments: DataFrame, far: int) -> DataFrame:
    """Positive gaps between consecutive fragments of a barcode on a chromosome, and how many are ``far``."""
    order = Window.partitionBy("barcode", "chrom").orderBy("min_pos", "max_pos")
    gaps = fragments.withColumn("gap", F.col("min_pos") - F.lag("max_pos").over(order)).filter("gap > 0")
    return gaps.groupBy("chrom").agg(F.count(F.lit(1)).alias("n_gaps"), F.sum((F.col("gap") >= far).cast("long")).alias("n_far"), F.max("gap").alias("max_gap"))


def secondary_fragments(fragments: DataFrame, min_reads: int) -> DataFrame:
    """Failing fragments of barcodes that have several fragments and at least one that passes."""
    per = fragments.groupBy("barcode").agg(F.count(F.lit(1)).alias("_n"), F.max("n_reads").alias("_top"))
    kept = per.filter((F.col("_n") > 1) & (F.col("_top") >= min_reads)).select("barcode")
    return fragments.filter(F.col("n_reads") < min_reads).join(kept, "barcode", "left_semi").select("barcode", "chrom", "frag", "n_reads", "length")


def top_barcodes(fragments: DataFrame, n: int = 20) -> DataFrame:
    return fragments.groupBy("barcode").agg(F.count(F.lit(1)).alias("n_fragments")).orderBy(F.desc("n_fragments"), "barcode").limit(n)


def duplicate_rate(fragments: DataFrame) -> DataFrame:
    """Share of duplicate reads per chromosome."""
    return fragments.groupBy("chrom").agg(
        F.sum("n_dup").alias("n_dup"), F.sum("n_reads").alias("n_reads"), F.round(F.sum("n_dup") / F.sum("n_reads"), 6).alias("dup_rate")
    )


def fragments_from_bed(rows: DataFrame, gap: int, read_length: int = 100, most_n: int = 2) -> DataFrame:
    """Fragments of split BED rows (``barcode, chrom, start, read_id, mate, strand``).

    Barcodes with over ``most_n`` N are left out, a read counts once however many rows it has (its first start), and the strand of
    second mates is turned.
    """
    turned = F.when(F.col("mate") == 2, F.when(F.col("strand") == "+", "-").otherwise("+")).otherwise(F.col("strand"))
    good = rows.filter(F.length("barcode") - F.length(F.replace("barcode", F.lit("N"))) <= most_n)
    reads = good.withColumn("strand", turned).groupBy("barcode", "chrom", "read_id").agg(F.min(F.struct("start", "strand")).alias("f"))
    return call_fragments(reads.select("barcode", "chrom", "read_id", F.col("f.start").alias("pos"), F.when(F.col("f.strand") == "-", 16).otherwise(0).alias("flag")), gap, read_length)


def length_bins(fragments: DataFrame, step: int, most: int) -> DataFrame:
    """Fragments and reads by length bin; a length on the edge of two bins counts in both."""
    low = F.floor(F.col("length") / step)
    bins = F.when((F.col("length") % step == 0) & (low > 0), F.array(low - 1, low)).otherwise(F.array(low))
    cut = fragments.filter(F.col("length") <= most).select("length", "n_reads", F.explode(bins).alias("bin")).filter(F.col("bin") * step < most)
    return cut.groupBy((F.col("bin") * step).alias("from"), ((F.col("bin") + 1) * step).alias("to")).agg(
        F.count(F.lit(1)).alias("n_fragments"), F.sum("n_reads").alias("n_reads"), F.round(F.median("n_reads"), 4).alias("median_reads")
    )


def reads_and_barcodes(reads: DataFrame, min_mapq: int) -> DataFrame:
    """Primary mapped reads of at least ``min_mapq``, and their barcodes, per reference."""
    good = reads.filter((F.col("flag").bitwiseAND(F.lit(0x900 | 4)) == 0) & (F.col("mapq") >= min_mapq))
    per = good.groupBy("chrom", "barcode").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("chrom").agg(F.sum("n").alias("n_reads"), F.count("barcode").alias("n_barcodes"))


def gc_ratio(fragments: DataFrame, references: DataFrame) -> DataFrame:
    """GC share of each fragment's reference slice (``start``, ``end`` 1-based, both ends inside), over its length plus one."""
    piece = F.expr("substring(seq, cast(start as int), cast(end - start + 1 as int))")
    joined = fragments.join(references, "chrom").withColumn("_s", piece)
    return joined.withColumn("gc_ratio", F.round(gc_count(F.col("_s")) / (F.length("_s") + 1), 6)).drop("_s", "seq")


def end_bias(gaps: DataFrame) -> DataFrame:
    """Poorly covered stretches of fragments by the half that holds their middle (``gap_start, gap_end, start, end, strand``); 5' is turned on ``-``."""
    left = (F.col("gap_start") + F.col("gap_end")) < (F.col("start") + F.col("end"))
    five = F.when(F.col("strand") == "-", ~left).otherwise(left)
    return gaps.groupBy(F.when(five, "five_prime").otherwise("three_prime").alias("half")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("gap_end") - F.col("gap_start")).alias("bases"))
