"""Interval operators: merge, bounds, overlap joins, depth by sweep line, coverage profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.seq import reverse_complement


def _pieces(df: DataFrame, at: str) -> DataFrame:
    """``df`` with ``_piece``: ranges of ``at`` of equal width, some for every shuffle partition, so that a group as long as
    a chromosome is swept by many tasks."""
    n = 8 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    low, high = df.agg(F.min(at), F.max(at)).first()
    width = max(1, -(-(int(high) - int(low) + 1) // n)) if low is not None else 1
    return df.withColumn("_piece", F.floor((F.col(at) - F.lit(int(low or 0))) / F.lit(width)).cast("long"))


def _carried(totals: DataFrame, by: Sequence[str], value: Column, name: str) -> DataFrame:
    """Per (group, piece) the aggregate ``value`` of ``totals`` over the pieces before it; one row per piece is swept."""
    before = Window.partitionBy(*by).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn(name, value.over(before))


def _islands(intervals: DataFrame, by: Sequence[str]) -> DataFrame:
    """``intervals`` with ``_island``, the number of the chain of overlapping or touching intervals in its group.

    Two levels: the greatest end and the number of fresh starts of each piece are carried over the pieces, the rest
    is a window inside a piece.
    """
    cut = _pieces(intervals, "start")
    key = [*by, "_piece"]
    tops = _carried(cut.groupBy(*key).agg(F.max("end").alias("_top")), by, F.max("_top"), "_before").select(*key, "_before")
    order = Window.partitionBy(*key).orderBy("start", "end")
    inside = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    before = F.greatest(inside, "_before")  # nulls are skipped
    marked = cut.join(tops.hint("merge"), key).withColumn("_new", F.when(before.isNull() | (F.col("start") > before), 1).otherwise(0)).drop("_before")
    starts = _carried(marked.groupBy(*key).agg(F.sum("_new").alias("_n")), by, F.sum("_n"), "_base").select(*key, F.coalesce("_base", F.lit(0)).alias("_base"))
    number = F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return marked.withColumn("_local", number).join(starts.hint("merge"), key).withColumn("_island", F.col("_base") + F.col("_local")).drop("_new", "_local", "_base", "_piece")


def merge_intervals(intervals: DataFrame, by: Sequence[str] = ("chrom",), names: str | None = None) -> DataFrame:
    """Islands of overlapping or touching intervals per group (with the strand in ``by``: per strand); ``span`` counts both ends.

    ``names``: a column whose distinct values are listed, sorted and comma-joined, for each island.
    """
    listed = [F.array_join(F.array_sort(F.collect_set(F.col(names).cast("string"))), ",").alias("names")] if names else []
    merged = _islands(intervals, by).groupBy(*by, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n_merged"), *listed)
    return merged.withColumn("span", F.col("end") - F.col("start") + 1).drop("_island")


def bounds(intervals: DataFrame, by: Sequence[str]) -> DataFrame:
    return intervals.groupBy(*by).agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n_rows"))


def overlap_join(left: DataFrame, right: DataFrame, by: str, bin_size: int) -> DataFrame:
    """Pairs of half-open intervals that share a place, as an equi-join on (group, bin).

    Each interval is copied to the bins it touches; a pair counts only in the bin where the later of
    the two starts, so none comes twice and no range join is left to a nested loop.
    """

    def binned(df: DataFrame, tag: str) -> DataFrame:
        named = df.select(*[F.col(c).alias(c if c == by else f"{tag}_{c}") for c in df.columns])
        first, last = F.floor(F.col(f"{tag}_start") / bin_size), F.floor((F.greatest(F.col(f"{tag}_end") - 1, F.col(f"{tag}_start"))) / bin_size)
        return named.withColumn("_bin", F.explode(F.sequence(first, last)))

    pairs = binned(left, "l").join(binned(right, "r"), [by, "_bin"])
    at = F.greatest("l_start", "r_start")
    hit = (F.col("l_start") < F.col("r_end")) & (F.col("r_start") < F.col("l_end")) & (F.floor(at / bin_size) == F.col("_bin"))
    return pairs.filter(hit).drop("_bin")


def overlap_outer(left: DataFrame, right: DataFrame, by: str, bin_size: int, key: str) -> DataFrame:
    """``overlap_join`` with the number of shared places, and with every left row (known by ``key``) that meets none: right columns null, overlap 0."""
    pairs = overlap_join(left, right, by, bin_size)
    pairs = pairs.withColumn("overlap", F.least("l_end", "r_end") - F.greatest("l_start", "r_start"))
    named = left.select(*[F.col(c).alias(c if c == by else f"l_{c}") for c in left.columns])
    alone = named.join(pairs.select(f"l_{key}").distinct(), f"l_{key}", "left_anti").withColumn("overlap", F.lit(0).cast("long"))
    return pairs.unionByName(alone, allowMissingColumns=True)


def sequences(intervals: DataFrame, references: DataFrame) -> DataFrame:
    """Half-open ``intervals`` (chrom, start, end, and a strand or none) with the reference's bases, turned on strand ``-``."""
    piece = F.expr("substring(_ref, cast(start + 1 as int), cast(end - start as int))")
    seq = F.when(F.col("strand") == "-", reverse_complement(piece)).otherwise(piece) if "strand" in intervals.columns else piece
    return intervals.join(references.select("chrom", F.col("seq").alias("_ref")), "chrom").withColumn("seq", seq).drop("_ref")


def depth_runs(intervals: DataFrame, by: str = "chrom") -> DataFrame:
    """Runs of constant depth above zero: (group, start, end, depth), by a sweep over +1 and -1 events.

    Two levels: the sum of each piece and the first place of the next are carried over the pieces.
    """
    events = intervals.select(by, F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("d")), F.struct(F.col("end").alias("at"), F.lit(-1).alias("d")))).alias("e"))
    steps = _pieces(events.groupBy(by, F.col("e.at").alias("at")).agg(F.sum("e.d").alias("d")), "at")
    order = Window.partitionBy(by, "_piece").orderBy("at")
    sums = steps.groupBy(by, "_piece").agg(F.sum("d").alias("_s"), F.min("at").alias("_a"))
    sums = _carried(sums, [by], F.sum("_s"), "_base").withColumn("_next", F.lead("_a").over(Window.partitionBy(by).orderBy("_piece")))
    inside = steps.withColumn("_end", F.lead("at").over(order)).withColumn("_run", F.sum("d").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    joined = inside.join(sums.select(by, "_piece", "_base", "_next").hint("merge"), [by, "_piece"])
    runs = joined.select(by, F.col("at").alias("start"), F.coalesce("_end", "_next").alias("end"), (F.coalesce("_base", F.lit(0)) + F.col("_run")).alias("depth"))
    return runs.filter("depth > 0 and end > start")


def depth_histogram(runs: DataFrame) -> DataFrame:
    return runs.groupBy("depth").agg(F.sum(F.col("end") - F.col("start")).alias("n_bases"))


def depth_cumulative(histogram: DataFrame) -> DataFrame:
    """Bases at each depth or more, and their share of all covered bases. The histogram is small (one row per depth)."""
    down = Window.orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = histogram.agg(F.sum("n_bases").alias("_all"))
    counted = histogram.withColumn("at_least", F.sum("n_bases").over(down)).crossJoin(F.broadcast(whole))
    return counted.select("depth", "n_bases", "at_least", F.round(F.col("at_least") / F.col("_all"), 6).alias("share"))


def coverage_thresholds(runs: DataFrame, limits: Sequence[int] = (4, 10, 20)) -> DataFrame:
    size = F.col("end") - F.col("start")
    return runs.groupBy("chrom").agg(
        F.sum(size).alias("covered"),
        F.round(F.sum(size * F.col("depth")) / F.sum(size), 6).alias("mean_depth"),
        *[F.sum(F.when(F.col("depth") >= d, size).otherwise(0)).alias(f"ge_{d}x") for d in limits],
    )


def low_coverage(runs: DataFrame, limit: int) -> DataFrame:
    """Merged stretches of depth below ``limit`` (but above zero)."""
    return merge_intervals(runs.filter(F.col("depth") < limit).select("chrom", "start", "end"))


def reference_coverage(runs: DataFrame, references: DataFrame, limits: Sequence[int] = (4, 10, 20)) -> DataFrame:
    """Per chromosome and in total (``total``): mean depth, coverage and shares at each limit, over the reference bases other than N.

    ``references`` has (chrom, bases): see ``non_n_bases``. References without any covered base count as well.
    """
    size = F.col("end") - F.col("start")
    found = runs.groupBy("chrom").agg(
        F.sum(size).alias("covered"), F.sum(size * F.col("depth")).alias("depth_sum"), *[F.sum(F.when(F.col("depth") >= d, size).otherwise(0)).alias(f"n{d}") for d in limits]
    )
    either = F.explode(F.array("chrom", F.lit("total")))
    names = ["covered", "depth_sum", *[f"n{d}" for d in limits]]
    whole = references.join(found, "chrom", "left").withColumn("chrom", either).groupBy("chrom").agg(F.sum("bases").alias("bases"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    share = lambda n: F.round(F.coalesce(F.try_divide(F.col(n), F.col("bases")), F.lit(0.0)), 6)
    return whole.select("chrom", F.col("bases").cast("long").alias("bases"), share("depth_sum").alias("mean_depth"), share("covered").alias("coverage"), *[share(f"n{d}").alias(f"coverage_{d}x") for d in limits])


def non_n_bases(references: DataFrame) -> DataFrame:
    """(chrom, bases) of reference sequences: bases other than N."""
    return references.groupBy("chrom").agg(F.sum(F.length(F.regexp_replace("seq", "[Nn]", ""))).cast("long").alias("bases"))


def coverage_profile(fragments: DataFrame, bins: int = 10) -> DataFrame:
    """Reads per tenth of a fragment, turned round on strand 0: (barcode, chrom, frag, bin, n)."""
    placed = fragments.select("barcode", "chrom", "frag", "strand", "min_pos", "length", F.explode("positions").alias("pos"))
    at = F.least(F.floor((F.col("pos") - F.col("min_pos")) * bins / F.col("length")), F.lit(bins - 1))
    turned = F.when(F.col("strand") == 0, bins - 1 - at).otherwise(at)
    return placed.groupBy("barcode", "chrom", "frag", turned.cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def covered_profile(fragments: DataFrame, read_length: int, bins: int | None = 10, bin_size: int | None = None) -> DataFrame:
    """Mean depth per bin of each fragment, from the bases its reads cover: (barcode, chrom, frag, bin, depth).

    A fragment reaches from its first read to the end of its last. It has ``bins`` equal bins, or those of ``bin_size`` bases that
    fit in it. A read counts in every bin it touches, with the bases it has there. Bins are numbered from the other end on strand 0.
    """
    span = F.col("max_pos") - F.col("min_pos") + read_length
    width = F.lit(float(bin_size)) if bin_size else span / bins
    n = F.floor(span / bin_size) if bin_size else F.lit(bins)
    whole = fragments.select("barcode", "chrom", "frag", "strand", "min_pos", "positions", width.alias("w"), n.cast("int").alias("n")).filter("n > 0")
    reads = whole.select("barcode", "chrom", "frag", "w", "n", F.explode(F.transform("positions", lambda x: x - F.col("min_pos"))).alias("a"))
    first, last = F.floor(F.col("a") / F.col("w")), F.floor((F.col("a") + read_length) / F.col("w"))
    parts = reads.withColumn("bin", F.explode(F.sequence(first, F.greatest(first, last)))).filter("bin < n")
    bases = F.least(F.col("a") + read_length, (F.col("bin") + 1) * F.col("w")) - F.greatest(F.col("a"), F.col("bin") * F.col("w"))
    sums = parts.groupBy("barcode", "chrom", "frag", "bin").agg(F.sum(bases).alias("b"))
    grid = whole.select("barcode", "chrom", "frag", "strand", "w", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1)).alias("bin"))
    joined = grid.join(sums, ["barcode", "chrom", "frag", "bin"], "left")
    turned = F.when(F.col("strand") == 0, F.col("n") - 1 - F.col("bin")).otherwise(F.col("bin"))
    return joined.select("barcode", "chrom", "frag", turned.cast("long").alias("bin"), F.round(F.coalesce("b", F.lit(0.0)) / F.col("w"), 6).alias("depth"))


def profile_slopes(profile: DataFrame) -> DataFrame:
    """Slope of each fragment's depth over its bins, numbered from 1."""
    return profile.groupBy("barcode", "chrom", "frag").agg(F.round(F.regr_slope("depth", F.col("bin") + 1), 6).alias("slope"))


def longest_of_island(intervals: DataFrame, by: str = "chrom", weight: str = "weight", tie: str = "name") -> DataFrame:
    """Of each chain of overlapping intervals the one of the greatest weight."""
    best = _islands(intervals, [by]).groupBy(by, F.col("_island").alias("island")).agg(F.max(F.struct(F.col(weight), (-F.col(tie)).alias("t"))).alias("b"))
    return best.select(by, (-F.col("b.t")).alias(tie), F.col(f"b.{weight}").alias(weight))
