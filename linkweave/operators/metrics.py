"""Alignment, GC, duplicate, adapter and length metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import seq as S


def _count(condition: Column) -> Column:
    return F.sum(F.coalesce(condition.cast("long"), F.lit(0)))


def align_metrics(reads: DataFrame) -> DataFrame:
    """Clean, mapped, unique and duplicate primary reads, bases and mismatches, in one pass."""
    flag = F.col("flag")
    clean = ~S.has_flag(flag, 0x900)
    mapped = clean & ~S.has_flag(flag, 4)
    return reads.agg(
        _count(clean).alias("clean"),
        _count(mapped).alias("mapped"),
        _count(mapped & (F.col("mapq") >= 1)).alias("uniq"),
        _count(mapped & S.has_flag(flag, 0x400)).alias("dup"),
        F.sum(F.when(mapped, F.col("bases")).otherwise(0)).alias("bases"),
        F.sum(F.when(mapped, F.col("mismatches")).otherwise(0)).alias("mismatches"),
        F.round(_count(mapped) / _count(clean), 6).alias("map_rate"),
        F.round(F.sum(F.when(mapped, F.col("mismatches"))) / F.sum(F.when(mapped, F.col("bases"))), 6).alias("mismatch_rate"),
    )


def flagstat(reads: DataFrame) -> DataFrame:
    flag = F.col("flag")
    names = {"secondary": 0x100, "supplementary": 0x800, "duplicates": 0x400, "unmapped": 4, "reverse": 16}
    return reads.agg(F.count(F.lit(1)).alias("total"), *[_count(S.has_flag(flag, bit)).alias(n) for n, bit in names.items()])


def idxstats(reads: DataFrame) -> DataFrame:
    unmapped = S.has_flag(F.col("flag"), 4)
    return reads.groupBy("chrom").agg(_count(~unmapped).alias("mapped"), _count(unmapped).alias("unmapped"))


def gc_histogram(reads: DataFrame, length: int, reference: DataFrame | None = None) -> DataFrame:
    """Reads by GC count 0..``length`` per mate with their share, and coverage over the reference share:
    capped at 3, 1 where both are zero, 3 where only the reference is. Every GC value has a row."""
    counts = reads.groupBy("mate", S.gc_count(F.col("seq")).cast("long").alias("gc")).agg(F.count(F.lit(1)).alias("n"))
    mates = reads.select("mate").distinct()
    grid = mates.withColumn("gc", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(length).cast("long"))))
    whole = Window.partitionBy("mate")
    full = grid.join(counts, ["mate", "gc"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    full = full.withColumn("percent", F.col("n") / F.sum("n").over(whole) * 100)
    if reference is None:
        return full.select("mate", "gc", "n", F.round("percent", 6).alias("percent"))
    joined = full.join(F.broadcast(reference), "gc", "left").withColumn("ref", F.coalesce("ref_percent", F.lit(0.0)))
    ratio = F.when((F.col("ref") == 0) & (F.col("n") == 0), 1.0).when(F.col("ref") == 0, 3.0).otherwise(F.least(F.lit(3.0), F.col("percent") / F.col("ref")))
    return joined.select("mate", "gc", "n", F.round("percent", 6).alias("percent"), F.round(ratio, 2).alias("coverage"))


def duplicates_by_locus(reads: DataFrame) -> DataFrame:
    """Per locus: barcodes, reads, barcodes with a single read, reads beyond the first of each sequence."""
    per_bc = reads.groupBy("chrom", "pos", "barcode").agg(F.countDistinct("read_id").alias("r"), F.count(F.lit(1)).alias("rows"), F.countDistinct("seq").alias("s"))
    loci = per_bc.groupBy("chrom", "pos").agg(
        F.count(F.lit(1)).alias("n_barcodes"),
        F.sum("r").alias("n_reads"),
        F.sum((F.col("r") == 1).cast("long")).alias("false_dup"),
        F.sum(F.col("rows") - F.col("s")).alias("same_seq"),
    )
    return loci.withColumn("false_dup_rate", F.round(F.col("false_dup") / F.col("n_reads"), 6))


def duplicate_rates(reads: DataFrame) -> DataFrame:
    """Per locus: barcodes over reads, the share of reads whose barcode has others there, and the share of these with the
    sequence of another one of their barcode (the plain number where there are none). A read id counts once a barcode."""
    single = reads.groupBy("chrom", "pos", "barcode", "read_id").agg(F.max("seq").alias("seq"))
    same = single.groupBy("chrom", "pos", "barcode", "seq").agg(F.count(F.lit(1)).alias("n"))
    per_bc = same.groupBy("chrom", "pos", "barcode").agg(F.sum("n").alias("r"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("same"))
    several = F.col("r") > 1
    loci = per_bc.groupBy("chrom", "pos").agg(
        F.count(F.lit(1)).alias("n_barcodes"), F.sum("r").alias("n_reads"), F.sum(F.when(several, F.col("r")).otherwise(0)).alias("shared"), F.sum(F.when(several, F.col("same")).otherwise(0)).alias("same_seq")
    )
    return loci.select(
        "chrom", "pos", "n_barcodes", "n_reads", "same_seq", F.round(F.col("n_barcodes") / F.col("n_reads"), 6).alias("barcode_rate"),
        F.round(F.col("shared") / F.col("n_reads"), 6).alias("shared_rate"), F.round(F.coalesce(F.try_divide("same_seq", "shared"), F.col("same_seq").cast("double")), 6).alias("same_seq_rate"),
    )


def duplicate_totals(rates: DataFrame) -> DataFrame:
    """One row over all loci of ``duplicate_rates``: reads, barcodes, and barcodes over reads."""
    n, bc = F.coalesce(F.sum("n_reads"), F.lit(0)), F.coalesce(F.sum("n_barcodes"), F.lit(0))
    return rates.agg(n.alias("n_reads"), bc.alias("n_barcodes"), F.round(F.coalesce(F.try_divide(bc, n), F.lit(0.0)), 6).alias("barcode_rate"))


def without_duplicates(reads: DataFrame, marked: DataFrame, remove: bool = True) -> DataFrame:
    """``reads`` that ``mark_duplicates`` did not mark; all of them where the barcode mode passes duplicates on."""
    return reads.join(marked.filter("is_dup = 1").select("read_id"), "read_id", "left_anti") if remove else reads


def mark_duplicates(reads: DataFrame) -> DataFrame:
    """Barcode-aware duplicates: all but the best read of equal (chrom, pos, strand, barcode) are marked.

    The best has the highest quality, then the least id. It is found by aggregation and joined back; the reads
    of one locus, strand and barcode meet in that join. Stands in for an external tool's closed form.
    """
    strand = F.col("flag").bitwiseAND(F.lit(16)).alias("strand")
    keyed = reads.withColumn("strand", strand)
    best = keyed.groupBy("chrom", "pos", "strand", "barcode").agg(F.min(F.struct((-F.col("mapq")).alias("q"), F.col("read_id").alias("i"))).alias("b"))
    best = best.select(F.col("chrom").alias("_c"), F.col("pos").alias("_p"), F.col("strand").alias("_s"), F.col("barcode").alias("_bc"), F.col("b.i").alias("_best"))
    same = F.col("barcode").eqNullSafe(F.col("_bc")) & (F.col("chrom") == F.col("_c")) & (F.col("pos") == F.col("_p")) & (F.col("strand") == F.col("_s"))
    return keyed.join(best, same).select("read_id", "chrom", "pos", (F.col("read_id") != F.col("_best")).cast("long").alias("is_dup"))


def merge_lanes(counts: DataFrame, cutoff: int) -> DataFrame:
    """Barcode counts summed over the lanes where they exceed ``cutoff``."""
    return counts.filter(F.col("n") > cutoff).groupBy("barcode").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_lanes"))


def adapter_frequency(reads: DataFrame, adapter: Column, start: int, length: int) -> DataFrame:
    hit = F.substring(F.col("seq"), start, length) == adapter
    return reads.agg(F.count(F.lit(1)).alias("n_reads"), _count(hit).alias("n_hits"), F.round(F.avg(hit.cast("double")), 6).alias("frequency"))


def adapter_trim(reads: DataFrame, adapters: DataFrame, k: int = 23, mismatches: int = 1, most_rows: int = 1_000_000) -> DataFrame:
    """Trims each read from its first place that holds an adapter k-mer with up to ``mismatches`` (0 or 1).

    Reads are cut into k-mers and joined to the adapters' k-mer neighbourhood on equality; the least hit
    place per read is all that is gathered. The adapter side, a row per base and
    neighbour, is broadcast only up to ``most_rows`` rows.
    """
    few = (adapters.agg(F.sum(F.length("adapter"))).first()[0] or 0) * (1 + 3 * k * mismatches) <= most_rows
    probes = adapters.select(F.explode(S.kmers(F.col("adapter"), k)).alias("w"))
    if mismatches:
        probes = probes.select(F.explode(S.neighbours(F.col("w"), k)).alias("w"))
    # long sequences go in overlapping chunks: a substring costs its distance from the string's start
    chunk = 256
    starts = F.sequence(F.lit(0), F.greatest(F.length("seq") - k, F.lit(0)), F.lit(chunk))
    chunks = reads.select("read_id", "seq", F.explode(starts).alias("off"))
    chunks = chunks.select("read_id", "off", F.substring(F.col("seq"), F.col("off") + 1, F.lit(chunk + k - 1)).alias("part"))
    cut = chunks.select("read_id", "off", F.posexplode(S.kmers(F.col("part"), k)).alias("i", "w")).select("read_id", (F.col("off") + F.col("i")).alias("at"), "w")
    first = cut.join(F.broadcast(probes.distinct()) if few else probes.distinct(), "w", "left_semi").groupBy("read_id").agg(F.min("at").alias("at"))
    trimmed = reads.join(first, "read_id", "left")
    seq = F.when(F.col("at").isNull(), F.col("seq")).otherwise(F.substring(F.col("seq"), F.lit(1), F.col("at")))
    return trimmed.select("read_id", seq.alias("seq"), F.length(seq).cast("long").alias("kept"), F.col("at").isNotNull().cast("long").alias("trimmed"))


def length_stats(df: DataFrame, length: Column, by: str) -> DataFrame:
    """Count, mean, deviation, range and exact quantiles of a length per group."""
    rows = df.select(by, length.cast("long").alias("l"))
    quantile = lambda q: F.round(F.percentile("l", q), 4)
    return rows.groupBy(by).agg(
        F.count("l").alias("n"), F.round(F.avg("l"), 4).alias("mean"), F.round(F.stddev("l"), 4).alias("std"), F.min("l").alias("min"),
        quantile(0.1).alias("p10"), F.round(F.median("l"), 4).alias("median"), quantile(0.9).alias("p90"), F.max("l").alias("max"),
    )


def length_percentiles(df: DataFrame, length: Column, by: str, at: tuple[int, ...] = (10, 20, 25, 30, 40, 50, 60, 70, 75, 80, 90, 95, 99)) -> DataFrame:
    """(group, percent, length): exact percentiles of a length, one row each."""
    listed = df.select(by, length.cast("long").alias("l")).groupBy(by).agg(F.percentile("l", F.array(*[F.lit(p / 100) for p in at])).alias("v"))
    rows = listed.select(by, F.posexplode("v").alias("i", "value"))
    return rows.select(by, F.element_at(F.array(*[F.lit(p) for p in at]), F.col("i") + 1).alias("percent"), F.round("value", 4).alias("length"))


def gc_both(reads: DataFrame, length: int) -> DataFrame:
    """The GC histogram of both mates together, with a row per GC value; mate is ``both``."""
    counts = reads.groupBy(S.gc_count(F.col("seq")).cast("long").alias("gc")).agg(F.count(F.lit(1)).alias("n"))
    grid = reads.sparkSession.range(length + 1).select(F.col("id").alias("gc"))
    whole = reads.agg(F.count(F.lit(1)).alias("_all"))
    full = grid.join(counts, "gc", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long"))).crossJoin(F.broadcast(whole))  # one row
    return full.select(F.lit("both").alias("mate"), "gc", "n", F.round(F.col("n") / F.col("_all") * 100, 6).alias("percent"))
