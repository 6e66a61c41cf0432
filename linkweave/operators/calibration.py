"""Dose-response correlation, abundance, and verdict joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def log2p1(value: Column) -> Column:
    return F.log2(F.coalesce(value.cast("double"), F.lit(0.0)) + 1)


def spike_counts(truth: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """All truth rows with their counts; missing counts are 0."""
    return truth.join(counts, key, "left").na.fill(0, [c for c in counts.columns if c != key])


def dose_response(pairs: DataFrame) -> DataFrame:
    """Pearson, R squared, slope, intercept and Spearman of (x, y).

    Average ranks come from counts per distinct value. Values are cut into ranges whose counts are carried over the
    ranges, so the running sum of a range is one task's and no task has all values.
    """
    n = 8 * int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def ranked(df: DataFrame, c: str) -> DataFrame:
        groups = df.groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        low, high = df.agg(F.min(c), F.max(c)).first()
        width = (float(high) - float(low)) / n if high is not None and high > low else 1.0
        groups = groups.withColumn("_piece", F.floor((F.col(c) - F.lit(float(low or 0))) / F.lit(width)))
        ahead = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)  # n + 1 rows at most
        bases = groups.groupBy("_piece").agg(F.sum("_n").alias("_s")).select("_piece", F.coalesce(F.sum("_s").over(ahead), F.lit(0)).alias("_base"))
        upto = F.sum("_n").over(Window.partitionBy("_piece").orderBy(c).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        ranks = groups.withColumn("_upto", upto).join(F.broadcast(bases), "_piece")
        ranks = ranks.select(F.col(c).alias("_v"), (F.col("_base") + F.col("_upto") - (F.col("_n") - 1) / 2).alias(f"r{c}"))
        return df.join(ranks, df[c] == ranks["_v"]).drop("_v")

    r = ranked(ranked(pairs, "x"), "y")
    return r.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.corr("x", "y"), 6).alias("pearson"),
        F.round(F.regr_r2("y", "x"), 6).alias("r2"),
        F.round(F.regr_slope("y", "x"), 6).alias("slope"),
        F.round(F.regr_intercept("y", "x"), 6).alias("intercept"),
        F.round(F.corr("rx", "ry"), 6).alias("spearman"),
    )


def abundance(observed: DataFrame, theory: DataFrame) -> DataFrame:
    """Observed share per species against the expected percent: difference and fold."""
    counts = observed.groupBy("species").agg(F.sum("n").alias("n"))
    whole = counts.agg(F.sum("n").alias("_all"))
    shares = counts.crossJoin(F.broadcast(whole)).withColumn("observed", F.col("n") / F.col("_all") * 100)
    joined = theory.join(shares, "species", "left").withColumn("observed", F.coalesce("observed", F.lit(0.0)))
    return joined.select(
        "species", F.round("observed", 6).alias("observed"), "expected",
        F.round(F.col("observed") - F.col("expected"), 6).alias("difference"), F.round(F.col("observed") / F.col("expected"), 6).alias("fold"),
    )


def verdict(contigs: DataFrame, readback: DataFrame, chimera: DataFrame, junction: DataFrame, breadth: float = 0.95) -> DataFrame:
    """Contigs with their flags; low confidence if unsupported, too narrow, chimeric or suspect."""
    joined = contigs.join(readback, "barcode", "left").join(chimera, "barcode", "left").join(junction, "barcode", "left")
    suspect = F.coalesce("junction_suspect", F.lit(0))
    low = F.col("breadth_1x").isNull() | (F.col("breadth_1x") < breadth) | (F.coalesce("chimera", F.lit("N")) == "Y") | (suspect == 1)
    return joined.select("barcode", "breadth_1x", F.coalesce("chimera", F.lit("N")).alias("chimera"), suspect.alias("junction_suspect"), low.cast("long").alias("low_confidence"))


def best_by(df: DataFrame, key: str, order: list[Column], keep: list[str]) -> DataFrame:
    """One row per key, the first in ``order``."""
    ranked = df.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.filter("_r = 1").select(key, *keep)
