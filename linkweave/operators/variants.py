"""Variants: difference strings, genotype filters, reads over variants, phased blocks, ordered merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import seq as S


def cs_variants(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per variant of a ``cs`` difference string: type, 1-based reference place, reference and own bases.

    Each token moves the reference place by its own advance; the places are the running sums within a string, folded over the string's
    tokens, so nothing is shuffled.
    """
    op, body = lambda t: F.substring(t, 1, 1), lambda t: F.substring(t, 2, 1 << 20)

    def advance(t: Column) -> Column:
        number = F.regexp_extract(t, r"(\d+)", 1).cast("long")
        return F.when(op(t).isin(":", "~"), number).when(op(t).isin("=", "-"), F.length(t) - 1).when(op(t) == "*", 1).otherwise(0).cast("long")

    empty = F.struct(F.col("target_start").cast("long").alias("at"), F.array().cast("array<struct<at:bigint,t:string>>").alias("seen"))

    def step(s: Column, t: Column) -> Column:
        return F.struct((s["at"] + advance(t)).alias("at"), F.concat(s["seen"], F.array(F.struct((s["at"] + 1).alias("at"), t.alias("t")))).alias("seen"))

    walked = rows.select(*keys, F.explode(F.aggregate(S.cs_tokens(F.col("cs")), empty, step)["seen"]).alias("v")).select(*keys, "v.at", "v.t")
    t = F.col("t")
    kind = F.when(op(t) == "*", "snp").when(op(t) == "+", "insertion").when(op(t) == "-", "deletion")
    ref = F.when(op(t) == "*", F.substring(t, 2, 1)).when(op(t) == "-", body(t)).otherwise("-")
    own = F.when(op(t) == "*", F.substring(t, 3, 1)).when(op(t) == "+", body(t)).otherwise("-")
    return walked.filter(kind.isNotNull()).select(*keys, kind.alias("variant_type"), F.col("at").alias("ref_pos"), F.upper(ref).alias("ref_base"), F.upper(own).alias("own_base"))


def variant_kind(ref: Column, alt: Column) -> Column:
    return F.when((F.length(ref) == 1) & (F.length(alt) == 1), "snp").otherwise("indel")


def genotype_counts(vcf: DataFrame) -> DataFrame:
    """Per chromosome and kind: variants, heterozygous and phased heterozygous ones."""
    gt = F.substring("gt", 1, 3)
    count = lambda c: F.sum(c.cast("long"))
    return vcf.groupBy("chrom", variant_kind(F.col("ref"), F.col("alt")).alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), count(gt.isin("0|1", "1|0", "0/1", "1/0")).alias("n_het"), count(gt.isin("0|1", "1|0")).alias("n_phased")
    )


def reads_with_variants(reads: DataFrame, variants: DataFrame, bin_size: int = 1000) -> DataFrame:
    """(read_id, chrom, pos, base) where a read (``start`` 0-based) shows one of a variant's bases (``pos`` 1-based, ``alts`` array), by an equi-join on bins."""
    last = F.col("start") + F.greatest(F.length("seq"), F.lit(1)) - 1
    cut = reads.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("start") / bin_size), F.floor(last / bin_size))))
    joined = cut.join(variants.withColumn("_bin", F.floor((F.col("pos") - 1) / bin_size)), ["chrom", "_bin"])
    offset = F.col("pos") - F.col("start")
    rows = joined.filter((offset >= 1) & (offset <= F.length("seq"))).withColumn("base", F.expr("substring(seq, cast(pos - start as int), 1)"))
    return rows.filter(F.array_contains("alts", F.col("base"))).select("read_id", "chrom", "pos", "base")


def truth_alleles(snps: DataFrame, truth: DataFrame) -> DataFrame:
    """Assembled SNPs with the truth alleles at their place, ``-`` where there are none."""
    return snps.join(truth, ["chrom", "pos"], "left").na.fill("-", [c for c in truth.columns if c not in ("chrom", "pos")])


def block_summary(blocks: DataFrame) -> DataFrame:
    """Phased SNPs and spans of all blocks, and the range of span per phased SNP."""
    each = blocks.withColumn("r", F.col("span") / F.col("phased"))
    return each.agg(
        F.count(F.lit(1)).alias("n_blocks"), F.sum("phased").alias("phased"), F.sum("span").alias("span"),
        F.round(F.avg("r"), 4).alias("mean"), F.round(F.min("r"), 4).alias("min"), F.round(F.max("r"), 4).alias("max"), F.round(F.stddev("r"), 4).alias("std"),
    )


def largest_blocks(sizes: DataFrame) -> DataFrame:
    """The block of most SNPs of each chromosome; the least block on ties."""
    best = sizes.groupBy("chrom").agg(F.max(F.struct("n_snps", (-F.col("block")).alias("b"))).alias("m"))
    return best.select("chrom", (-F.col("m.b")).alias("block"), F.col("m.n_snps").alias("n_snps"))


def merge_ordered(files: list[DataFrame], contigs: DataFrame) -> DataFrame:
    """Union of per-contig variant tables in header order (``contigs``: chrom, ord) and position; contigs missing from the header are left out."""
    whole = files[0]
    for part in files[1:]:
        whole = whole.unionByName(part)
    return whole.join(contigs, "chrom").orderBy("ord", "pos")

