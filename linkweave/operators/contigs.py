"""Contigs of barcodes: comparisons, containment, direction, votes, and what the library's identities say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions import seq as S
from ..kernels import pools as K
from . import placement, pools


def contigs_per_barcode(contigs: DataFrame) -> DataFrame:
    """Contigs, and barcodes, of barcodes with one contig and with several."""
    per = contigs.groupBy("barcode").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(F.when(F.col("n") == 1, "one").otherwise("several").alias("kind")).agg(F.count(F.lit(1)).alias("n_barcodes"), F.sum("n").alias("n_contigs"))


def lengthened(before: DataFrame, after: DataFrame) -> DataFrame:
    """Barcodes in both assemblies whose longest contig grew."""
    longest = lambda df, name: df.groupBy("barcode").agg(F.max("len").alias(name))
    joined = longest(before, "old_len").join(longest(after, "new_len"), "barcode")
    return joined.filter("new_len > old_len").withColumn("gain", F.col("new_len") - F.col("old_len"))


def shortfall(reference: DataFrame, own: DataFrame, limit: int) -> DataFrame:
    """Barcodes with ``limit`` bases or more in the reference assembly but fewer in ours."""
    longest = lambda df, name: df.groupBy("barcode").agg(F.max("len").alias(name))
    ours = longest(own, "own_len").filter(F.col("own_len") < limit)
    return longest(reference, "ref_len").filter(F.col("ref_len") >= limit).join(ours, "barcode").withColumn("gap", F.col("ref_len") - F.col("own_len"))


def shortfall_classes(reads: DataFrame, own: DataFrame, reference: DataFrame, edge: int = 20, least: int = 2) -> DataFrame:
    """Why our contig ends inside the reference contig of its barcode: (barcode, left, right, class).

    Our contig (``barcode, seq``) and all distinct reads are placed on the reference contig (``barcode, seq``). A read bridges an end of
    ours if it reaches ``edge`` bases over it on both sides; an end counts as bridged by ``least`` reads.
    """
    target = reference.select("barcode", F.lit(0).alias("target_id"), "seq")
    sizes = reference.select("barcode", F.length("seq").alias("ref_len"))
    pool = reads.select("barcode", "seq").distinct().withColumn("read_id", F.xxhash64("seq"))
    # short rows of many barcodes are estimated too small for Spark to choose these joins
    at = placement.placements(own.select("barcode", F.lit(0).alias("read_id"), "seq"), target).join(own.select("barcode", F.length("seq").alias("n")).hint("merge"), "barcode")
    ours = at.select("barcode", F.col("start").alias("s"), (F.col("start") + F.col("n")).alias("e"))
    placed = placement.placements(pool, target).join(pool.select("barcode", "read_id", F.length("seq").alias("n")).hint("merge"), ["barcode", "read_id"])
    reach = lambda point: ((F.col("start") <= F.col(point) - edge) & (F.col("start") + F.col("n") >= F.col(point) + edge)).cast("long")
    bridges = placed.join(ours.hint("merge"), "barcode").groupBy("barcode").agg(F.sum(reach("s")).alias("left"), F.sum(reach("e")).alias("right"))
    joined = sizes.join(ours.hint("merge"), "barcode", "left").join(bridges.hint("merge"), "barcode", "left").na.fill(0, ["left", "right"])
    left, right = (F.col("s") > 0) & (F.col("left") >= least), (F.col("e") < F.col("ref_len")) & (F.col("right") >= least)
    kind = (
        F.when(F.col("s").isNull(), "unplaced").when((F.col("s") <= 0) & (F.col("e") >= F.col("ref_len")), "covers")
        .when(left & right, "bridged_both").when(left | right, "bridged_one").otherwise("no_bridge")
    )
    return joined.select("barcode", "left", "right", kind.alias("class"))


def drop_contained(contigs: DataFrame, k: int = 17) -> DataFrame:
    """Distinct sequences per barcode that are no part of a longer one.

    A contained sequence's first k-mer lies in the longer one, so candidates come from an index of first k-mers;
    sequences shorter than ``k`` are compared within their barcode. Rows without a barcode are compared with none.
    """
    rows = contigs.select("barcode", "seq")
    apart = rows.filter("barcode is null or seq is null").distinct()
    kept = pools.by_barcode(rows.filter("seq is not null"), lambda own: ((s,) for s in K.uncontained((s for (s,) in own), k)), rows.schema)
    return kept.union(apart)


def kmer_identity(reads: DataFrame, k: int) -> DataFrame:
    """Pairs of a barcode's reads with a common k-mer: the k-th root of the share of the smaller k-mer set that both have."""
    rows = reads.select("barcode", "read_id", "seq").filter("read_id is not null and seq is not null")
    kind = rows.schema["read_id"].dataType
    schema = StructType([rows.schema["barcode"], StructField("a", kind), StructField("b", kind), StructField("shared", LongType()), StructField("_n", LongType())])
    both = pools.by_barcode(rows, lambda own: K.shared_words(own, k), schema)
    return both.select("barcode", "a", "b", "shared", F.round(F.pow(F.col("shared") / F.col("_n"), F.lit(1.0 / k)), 6).alias("identity"))


def base_votes(aligned: DataFrame, contigs: DataFrame, min_votes: int = 3, share: float = 0.6) -> DataFrame:
    """Places (from 0) where placed reads outvote a contig base: one vote is the contig's own, ties give the least base."""
    part = lambda df, n, start: df.select("barcode", F.lit(n).alias("_part"), start.cast("long").alias("start"), "seq")
    rows = part(contigs, 0, F.lit(0)).unionByName(part(aligned, 1, F.col("start"))).filter("start is not null and seq is not null")
    schema = StructType([rows.schema["barcode"], *[StructField(*x) for x in (("at", LongType()), ("old", StringType()), ("new", StringType()), ("votes", LongType()), ("total", LongType()))]])
    return pools.by_barcode(rows, lambda own: K.outvoted(own, min_votes, share), schema, "_part")


def direction_by_adapter(contigs: DataFrame, adapter: str, flank: int = 30) -> DataFrame:
    """Contigs turned where the adapter's reverse complement lies in their last ``flank`` bases."""
    turned = F.right("seq", F.lit(flank)).contains(S.reverse_complement(F.lit(adapter)))
    return contigs.withColumn("turned", turned.cast("long")).withColumn("seq", F.when(turned, S.reverse_complement(F.col("seq"))).otherwise(F.col("seq")))


def direction_by_mapping(contigs: DataFrame, mapped: DataFrame, prefix: int = 21) -> DataFrame:
    """Contigs turned where the last mapping line (by ``ord``) of their name's first ``prefix`` characters is on ``-``; route ``unmapped`` without one."""
    last = mapped.groupBy(F.substring("query", 1, prefix).alias("_q")).agg(F.max_by("strand", "ord").alias("strand"))
    joined = contigs.join(last, F.substring("name", 1, prefix) == F.col("_q"), "left").drop("_q")
    seq = F.when(F.col("strand") == "-", S.reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    return joined.withColumn("seq", seq).withColumn("route", F.when(F.col("strand").isNull(), "unmapped").otherwise("mapped")).drop("strand")


def reference_fraction(coords: DataFrame, references: DataFrame) -> DataFrame:
    """Share of its reference that the first line of each contig covers."""
    first = coords.groupBy("contig").agg(F.min(F.struct("ord", "ref", "start", "end")).alias("f")).select("contig", "f.*")
    return first.join(references, "ref").select("contig", "ref", F.round((F.col("end") - F.col("start") + 1) / F.col("ref_len"), 6).alias("fraction"))


def join_exons(exons: DataFrame) -> DataFrame:
    """One sequence per barcode: its exons in file order, named ``barcode exon1+exon2 reads``."""
    listed = exons.groupBy("barcode").agg(F.sort_array(F.collect_list(F.struct("ord", "exon", "seq"))).alias("l"), F.max("n_reads").alias("n"))
    names = F.array_join(F.transform("l", lambda x: x["exon"]), "+")
    return listed.select(F.concat_ws(" ", "barcode", names, F.col("n").cast("string")).alias("name"), F.array_join(F.transform("l", lambda x: x["seq"]), "").alias("seq"))


def deeper_than(records: DataFrame, cutoff: int) -> DataFrame:
    """Records whose header ends in a number above ``cutoff``."""
    return records.filter(F.try_element_at(F.split("name", " "), F.lit(-1)).try_cast("long") > cutoff)


def identity_summary(pairs: DataFrame, cut: float = 0.97) -> DataFrame:
    """(metric, value) of pair identities within and across barcodes (``within`` 1 or 0).

    The enrichment divides the same-molecule share within barcodes by that across, which counts as half a pair at least.
    """
    side = lambda flag, c: F.when(F.col("within") == flag, c)
    hit = (F.col("identity") >= cut).cast("double")
    one = pairs.agg(F.count(side(1, F.lit(1))).alias("wn"), F.count(side(0, F.lit(1))).alias("cn"), F.avg(side(1, hit)).alias("w"), F.avg(side(0, hit)).alias("c"))
    rich = F.col("w") / F.greatest(F.col("c"), 0.5 / F.greatest(F.col("cn"), F.lit(1)))
    values = {"within_barcode_pairs": F.col("wn").cast("double"), "cross_barcode_pairs": F.col("cn").cast("double"), "within_frac_same_molecule": F.round("w", 4), "cross_frac_same_molecule": F.round("c", 4), "same_molecule_enrichment": F.round(rich, 2)}
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in values.items()])))


def probe_decision(kept: DataFrame, cross: DataFrame, skip_below: float = 0.02, few: int = 20) -> DataFrame:
    """One row: drop rate of the read filter on a probe (``barcode, kept``), whether to run it on all, and the preset that the upper median of
    identities across barcodes suggests. Under ``few`` barcodes the filter is run and ``balanced`` taken."""
    drops = kept.agg(F.countDistinct("barcode").alias("barcodes"), F.coalesce(F.avg(1.0 - F.col("kept")), F.lit(0.0)).alias("rate"))
    # the upper median: the higher of the two middle values
    middle = cross.agg(F.max("identity").alias("top"), F.expr("-percentile_disc(0.5) within group (order by -identity)").alias("median"))
    enough = F.col("barcodes") >= few
    preset = F.when(enough & (F.col("median") <= 0.60), "high_div").otherwise("balanced")
    return drops.crossJoin(middle).select(  # one row each
        F.when(enough, "ok").otherwise("insufficient_data").alias("status"), F.round("rate", 4).alias("probe_drop_rate"),
        F.round("median", 4).alias("cross_median_identity"), (~enough | (F.col("rate") >= skip_below)).cast("long").alias("run_read_filter"), preset.alias("suggested_qc_preset"),
    )


def coverage_classes(exons: DataFrame, edges: tuple[int, ...] = (1000, 2000, 3000, 6000), cap: int = 500) -> DataFrame:
    """Barcodes by the total of their merged exon spans: the class is the largest edge reached (0: none); ``cap`` barcodes of each class are
    listed (the feature is a plot of so many), least digest first."""
    from .intervals import merge_intervals

    totals = merge_intervals(exons, ("barcode", "chrom")).groupBy("barcode").agg(F.sum("span").alias("total"))
    reached = F.coalesce(*[F.when(F.col("total") >= e, F.lit(e)) for e in sorted(edges, reverse=True)], F.lit(0))
    order = Window.partitionBy("class").orderBy(F.md5("barcode"), "barcode")
    return totals.withColumn("class", reached.cast("long")).withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= cap).drop("_r")


def first_contigs(contigs: DataFrame, most: int) -> DataFrame:
    """The first ``most`` contigs of each barcode, with the record name ``barcode>k41_i`` of each."""
    order = Window.partitionBy("barcode").orderBy("contig_ix")
    ranked = contigs.withColumn("i", F.row_number().over(order) - 1).filter(F.col("i") < most)
    return ranked.withColumn("name", F.concat(F.col("barcode"), F.lit(">k41_"), F.col("i").cast("string"))).drop("i")


def qc_counts(flags: DataFrame, *columns: str) -> DataFrame:
    """(metric, n, percent) for 0/1 ``columns`` of a quality table: the rows that have each, of all rows."""
    one = flags.agg(F.count(F.lit(1)).alias("all"), *[F.count_if(F.col(c) == 1).alias(c) for c in columns])
    percent = lambda c: F.round(F.coalesce(F.try_divide(100.0 * F.col(c), F.col("all")), F.lit(0.0)), 2)
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("n"), percent(c).alias("percent")) for c in ["all", *columns]])))


def low_complexity(barcode: Column, share: float = 0.8) -> Column:
    """One base makes up ``share`` of the barcode or more; an empty one is as well."""
    most = F.greatest(*[F.length(barcode) - F.length(F.replace(barcode, F.lit(c))) for c in "ACGT"])
    return barcode.isNull() | (F.length(barcode) == 0) | (most >= share * F.length(barcode))


def sampled_barcodes(reads: DataFrame, n: int, min_reads: int, seed: str = "probe") -> DataFrame:
    """``n`` barcodes of ``min_reads`` reads or more that aren't of low complexity, by least digest (the sample is the feature)."""
    counts = reads.groupBy("barcode").agg(F.count(F.lit(1)).alias("n_reads")).filter((F.col("n_reads") >= min_reads) & ~low_complexity(F.col("barcode")))
    return counts.orderBy(F.md5(F.concat(F.lit(seed + ":"), "barcode")), "barcode").limit(n)


def sampled_pairs(reads: DataFrame, seed: str = "pairs", most_reads: int = 40) -> DataFrame:
    """Read pairs to compare, chosen by digests where the reference draws them: each barcode's reads in digest order (at most
    ``most_reads`` of them, the feature) are paired with the next one (``within`` 1) and with the first of the barcode next in digest order (``within`` 0)."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.col("barcode"), F.lit(":"), F.col("seq")))
    own = Window.partitionBy("barcode").orderBy("d", "seq")
    distinct = reads.select("barcode", "seq").distinct().withColumn("d", digest)
    ranked = distinct.withColumn("r", F.row_number().over(own)).filter(F.col("r") <= most_reads)
    within = ranked.withColumn("other", F.lead("seq").over(own)).filter(F.col("other").isNotNull()).select(F.lit(1).alias("within"), F.col("barcode").alias("a"), F.col("barcode").alias("b"), F.col("seq").alias("x"), F.col("other").alias("y"))
    first = ranked.filter("r = 1")
    # neighbours inside one of many buckets of the digest, so no task sorts all barcodes
    near = Window.partitionBy(F.substring("d", 1, 2)).orderBy("d", "barcode")
    across = first.withColumn("ob", F.lead("barcode").over(near)).withColumn("os", F.lead("seq").over(near)).filter(F.col("ob").isNotNull())
    return within.union(across.select(F.lit(0), "barcode", "ob", "seq", "os"))


def umi_gate(results: DataFrame, min_reads: int, shortest: int = 400, longest: int = 20_000) -> DataFrame:
    """Consensus rows (n_reads, seq) from enough reads and of a length in the limits, both included."""
    return results.filter((F.col("n_reads") >= min_reads) & F.length("seq").between(shortest, longest))


def in_regions(rows: DataFrame, chroms: list[str] | None = None, regions: DataFrame | None = None) -> DataFrame:
    """Rows (chrom, pos) on the listed chromosomes, and inside any half-open region (chrom, start, end) where those are given."""
    out = rows.filter(F.col("chrom").isin(chroms)) if chroms is not None else rows
    if regions is None:
        return out
    from .intervals import merge_intervals

    apart = merge_intervals(regions.select("chrom", "start", "end")).select(F.col("chrom").alias("_c"), F.col("start").alias("_s"), F.col("end").alias("_e"))
    return out.join(apart, (F.col("chrom") == F.col("_c")) & (F.col("pos") >= F.col("_s")) & (F.col("pos") < F.col("_e")), "left_semi")
