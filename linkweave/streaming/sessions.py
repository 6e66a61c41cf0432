"""Streaming form of the gap session: fragments from a stream of reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_sessions(reads: DataFrame, gap_seconds: int, watermark: str = "10 minutes", time: str = "ts") -> DataFrame:
    """Sessions of (barcode, chrom) that end where two reads are ``gap_seconds`` or more apart.

    Spark's session window merges reads exactly the gap apart, while a fragment splits there, so the
    window is a microsecond shorter. Works on batch and streaming input alike; late reads beyond the
    watermark are left out in streams.
    """
    marked = reads.withWatermark(time, watermark) if reads.isStreaming else reads
    window = F.session_window(time, f"{gap_seconds - 1} seconds 999999 microseconds")
    return marked.groupBy(window, "barcode", "chrom").agg(F.count(F.lit(1)).alias("n_reads"), F.min(time).alias("first"), F.max(time).alias("last")).drop("session_window")


def append_counts(batch: DataFrame, path: str) -> None:
    """``foreachBatch`` sink of partial barcode counts; totals come from ``merged_counts``."""
    batch.groupBy("barcode").agg(F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)


def merged_counts(partial: DataFrame) -> DataFrame:
    return partial.groupBy("barcode").agg(F.sum("n").alias("n"))
