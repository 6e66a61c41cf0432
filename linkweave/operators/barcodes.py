"""Order, selection and sampling of barcodes, and what pooled samples are expected to share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import seq as S


def ordinals(keys: DataFrame, key: str, prefix: int = 4) -> DataFrame:
    """Distinct keys with their place (from 1) in byte order.

    Keys are numbered within their prefix, and the prefixes' running counts (at most 5^``prefix`` rows for
    bases and N) are added by join, so no task sorts all keys.
    """
    distinct = keys.select(key).distinct().withColumn("_p", F.substring(key, 1, prefix))
    heads = distinct.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    numbered = distinct.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(key)))
    return numbered.join(heads.select("_p", F.coalesce(before, F.lit(0)).alias("_b")), "_p").select(key, (F.col("_b") + F.col("_r")).alias("place"))


def equal_ranges(keys: DataFrame, key: str, n: int, prefix: int = 4) -> DataFrame:
    """Keys in byte order cut into ``n`` ranges (0..n-1) whose sizes differ by one at most, larger ones first."""
    placed = ordinals(keys, key, prefix)
    total = placed.agg(F.count(F.lit(1)).alias("_all"))
    small, large = F.floor(F.col("_all") / n), F.col("_all") % n
    at = F.col("place") - 1
    cut = large * (small + 1)
    part = F.when(at < cut, F.floor(at / (small + 1))).otherwise(large + F.floor((at - cut) / F.greatest(small, F.lit(1))))
    return placed.crossJoin(F.broadcast(total)).select(key, "place", part.cast("long").alias("part"))  # one row


def middle(keys: DataFrame, key: str, n: int, prefix: int = 4) -> DataFrame:
    """The ``n`` keys in the middle of the byte order."""
    placed = ordinals(keys, key, prefix)
    first = F.greatest(F.floor((F.col("_all") - n) / 2), F.lit(0))
    total = placed.agg(F.count(F.lit(1)).alias("_all"))
    return placed.crossJoin(F.broadcast(total)).filter((F.col("place") > first) & (F.col("place") <= first + n)).select(key)  # one row


def first_groups(reads: DataFrame, n: int, order: str = "barcode") -> DataFrame:
    """Reads of the first ``n`` barcodes, by byte order or by the first place where they were seen (``order='ord'``)."""
    groups = reads.groupBy("barcode").agg(F.min(order).alias("_o")) if order != "barcode" else reads.select("barcode", F.col("barcode").alias("_o")).distinct()
    return reads.join(groups.orderBy("_o", "barcode").limit(n).select("barcode"), "barcode", "left_semi")


def depth_window(counts: DataFrame, low: int, high: int, n: int) -> DataFrame:
    """The first ``n`` barcodes, in log order (then by barcode), of ``low`` to ``high`` reads."""
    return counts.filter(F.col("cnt").between(low, high)).orderBy("idx", "barcode").limit(n)


def downsample(reads: DataFrame, share: float, key: str = "barcode", tie: str = "read_id") -> DataFrame:
    """Of each group the whole part of ``share`` of its reads, but one at least, by digest of (group, read)."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.col(tie).cast("string")))
    order = Window.partitionBy(key).orderBy(digest, tie)
    numbered = reads.withColumn("_r", F.row_number().over(order)).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key)))
    return numbered.filter(F.col("_r") <= F.greatest(F.floor(F.col("_n") * share), F.lit(1))).drop("_r", "_n")


def lane_ratios(fragments: DataFrame) -> DataFrame:
    """Fragments and distinct barcodes per lane, and of all lanes (lane ``all``: sums of the lanes), with fragments per barcode."""
    bc = fragments.groupBy("lane", "barcode").agg(F.count(F.lit(1)).alias("n"))
    lanes = bc.groupBy("lane").agg(F.sum("n").alias("n_fragments"), F.count(F.lit(1)).alias("n_barcodes"))
    whole = lanes.agg(F.sum("n_fragments").alias("n_fragments"), F.sum("n_barcodes").alias("n_barcodes")).select(F.lit("all").alias("lane"), "*")
    return lanes.unionByName(whole).withColumn("frags_per_bc", F.round(F.try_divide("n_fragments", "n_barcodes"), 6))


def tag_log(headers: DataFrame, header: str = "header") -> DataFrame:
    """Read pairs per barcode, from a ``BX:Z:`` field or else the name after ``#``; headers without one don't count."""
    tag = F.nullif(F.regexp_extract(F.col(header), r"BX:Z:(\S+)", 1), F.lit(""))
    return headers.select(S.barcode_of(F.col(header), tag).alias("barcode")).filter("barcode is not null").groupBy("barcode").agg(F.count(F.lit(1)).alias("cnt"))


def random_barcode_reads(pairs: DataFrame, start: int, length: int, full_length: int, umi_start: int | None = None, umi_length: int = 0, turned: bool = False) -> DataFrame:
    """Random-barcode demultiplexing: barcode and long barcode cut from ``seq2``, optional UMI (from ``seq2``, else from ``seq1``).

    Every read is kept. ``header`` becomes ``id#barcode[#umi]``. With ``turned`` both barcodes are reverse complements.
    """
    cut = lambda n: F.substring("seq2", start, n)
    side = S.reverse_complement if turned else lambda c: c
    out = pairs.withColumn("barcode", side(cut(length))).withColumn("long_barcode", side(cut(full_length)))
    umi = F.coalesce(F.nullif(F.substring("seq2", umi_start, umi_length), F.lit("")), F.substring("seq1", umi_start, umi_length)) if umi_start else F.lit(None).cast("string")
    return out.withColumn("umi", umi).withColumn("header", F.concat_ws("#", S.read_id_of(F.col("header")), "barcode", "umi"))


def expected_beads(beads: Column, samples: Column, most: int = 10) -> Column:
    """Beads that a sample is expected to see if each bead carries 1 to ``most`` fragments, each as likely, over ``samples`` pooled samples."""
    miss = F.aggregate(F.sequence(F.lit(1), F.lit(most)), F.lit(0.0), lambda s, k: s + F.pow(1 - 1 / samples, k))
    return beads * (1 - miss / most)


def distinct_odds(fragments: Column, samples: Column) -> Column:
    """Odds that all ``fragments`` of a bead come from different ones of ``samples`` samples."""
    return F.aggregate(F.sequence(F.lit(0), fragments - 1), F.lit(1.0), lambda s, i: s * F.greatest(samples - i, F.lit(0)) / samples)
