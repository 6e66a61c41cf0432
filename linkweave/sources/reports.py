"""Readers and writers of the tables and reports around a run: counts, truth, quality tables, summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import _lines


def _require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def read_spike_truth(spark: SparkSession, path: str) -> DataFrame:
    """Spike-in truth table; the id and both mixes' concentrations must be there."""
    mixes = [f"concentration in Mix {i} (attomoles/ul)" for i in (1, 2)]
    return _require(spark.read.csv(path, sep="\t", header=True, inferSchema=True), ["ERCC ID", *mixes])


def read_feature_counts(spark: SparkSession, path: str) -> DataFrame:
    """(id, length, count): the count is the last column; what is no number counts 0."""
    df = _require(spark.read.csv(path, sep="\t", header=True, comment="#"), ["Geneid", "Length"])
    count = F.coalesce(F.col(f"`{df.columns[-1]}`").try_cast("double"), F.lit(0.0))
    return df.select(F.col("Geneid").alias("id"), F.col("Length").try_cast("double").alias("length"), count.alias("count"))


def read_gc_reference(spark: SparkSession, path: str, read_length: int, first_length: int = 20) -> DataFrame:
    """(gc, ref_percent) of one read length: line ``read_length - first_length`` (from 0) of comma-separated percentages."""
    line = _lines(spark, path).filter(F.col("ord") == read_length - first_length)
    cut = line.select(F.posexplode(F.split("line", ",")).alias("gc", "v"))
    return cut.select(F.col("gc").cast("long").alias("gc"), F.trim("v").try_cast("double").alias("ref_percent")).filter("ref_percent is not null")


def read_chimera_flags(spark: SparkSession, path: str) -> DataFrame:
    """(barcode, chimera) of chimera tables of 18 columns or more: the second up to ``>``, the eighteenth; the last line of a barcode holds."""
    f = F.split("line", "\t")
    rows = _lines(spark, path).filter(F.size(f) >= 18).select("ord", F.substring_index(f[1], ">", 1).alias("barcode"), f[17].alias("chimera"))
    return rows.groupBy("barcode").agg(F.max_by("chimera", "ord").alias("chimera"))


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab-separated table with a header, by column name; its columns must be those of ``schema``."""
    df = spark.read.csv(path, sep="\t", header=True)
    wanted = [c.split() for c in schema.split(",")]
    return _require(df, [n for n, _ in wanted]).select(*[F.col(n).try_cast(t).alias(n) for n, t in wanted])


def read_key_values(spark: SparkSession, path: str, keys: Mapping[str, str], sep: str = r"[:\t]\s*") -> DataFrame:
    """(name, value) of the report lines that begin with one of ``keys``' values; the last such line holds."""
    rows = _lines(spark, path).select("ord", F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.lit(p).alias("p")) for k, p in keys.items()])).alias("k"), "line")
    hit = rows.filter(F.startswith("line", F.col("k.p")))
    value = F.trim(F.regexp_replace(F.expr("substring(line, length(k.p) + 1)"), f"^{sep}", ""))
    return hit.groupBy(F.col("k.name").alias("name")).agg(F.max_by(value, "ord").alias("value"))


def read_contig_names(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, length, ord) of a FASTA index."""
    f = F.split("line", "\t")
    return _lines(spark, path).select(f[0].alias("chrom"), f[1].cast("long").alias("length"), "ord")


def unknown_contigs(wanted: Sequence[str], alignments: DataFrame) -> list[str]:
    """Wanted reference names that no alignment has."""
    found = {r[0] for r in alignments.filter(F.col("rname").isin(list(wanted))).select("rname").distinct().collect()}
    return [c for c in wanted if c not in found]


def covered_snps(spark: SparkSession, path: str) -> DataFrame:
    """(snp_ix) covered by the blocks of a haplotype fragment file, from 0, in either of its layouts.

    A line has its number of blocks first and then pairs of 1-based place and alleles, from the third field on (old layout,
    one field after the pairs) or from the sixth (new layout).
    """
    f = F.split(F.trim("line"), r"\s+")
    n = f[0].try_cast("int")
    first = F.when(F.floor((F.size(f) - 3) / 2) == n, 2).when(F.floor((F.size(f) - 6) / 2) == n, 5)
    rows = _lines(spark, path).select(f.alias("f"), n.alias("n"), first.alias("at")).filter("at is not null and n > 0")
    pairs = rows.select("f", F.explode(F.sequence(F.col("at"), F.col("at") + 2 * (F.col("n") - 1), F.lit(2))).alias("i"))
    cut = pairs.select((F.try_element_at("f", F.col("i") + 1).cast("long") - 1).alias("pos"), F.length(F.try_element_at("f", F.col("i") + 2)).alias("n")).filter("n > 0")
    return cut.select(F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("n") - 1)).alias("snp_ix")).distinct()


def long_report(parts: Mapping[str, DataFrame]) -> DataFrame:
    """(section, ord, metric, value) of one-row tables, in the given order."""
    out = None
    for section, df in parts.items():
        cells = [F.struct(F.lit(i).alias("ord"), F.lit(c).alias("metric"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(df.columns)]
        rows = df.select(F.lit(section).alias("section"), F.inline(F.array(*cells)))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no parts")
    return out


def write_split_log(counts: DataFrame, summary: DataFrame, path: str, diversity: DataFrame | None = None) -> None:
    """Barcodes in first-seen order as tab-separated text, and the demultiplexing counters (and those of diversity) beside them."""
    counts.orderBy("first_ord").select("cnt", "barcode", "first_ord").write.mode("overwrite").csv(f"{path}/barcodes", sep="\t", header=True)
    parts = {"demultiplexing": summary} | ({} if diversity is None else {"diversity": diversity})
    long_report(parts).coalesce(1).write.mode("overwrite").csv(f"{path}/summary", sep="\t", header=True)


def write_by_barcode(reads: DataFrame, barcodes: DataFrame, path: str) -> DataFrame:
    """Reads of the listed barcodes, one folder for each; returns (barcode, n), 0 where a barcode has no read."""
    kept = reads.join(barcodes.select("barcode").distinct(), "barcode", "left_semi")
    kept.select("barcode", F.concat_ws("\n", "header", "seq", F.lit("+"), "qual").alias("value")).write.mode("overwrite").partitionBy("barcode").text(path)
    counts = kept.groupBy("barcode").agg(F.count(F.lit(1)).alias("n"))
    return barcodes.select("barcode").distinct().join(counts, "barcode", "left").na.fill(0, ["n"])


def write_bed(intervals: DataFrame, path: str) -> None:
    """Intervals in (chrom, start) order, range-partitioned: the parts in file order are one sorted BED."""
    intervals.orderBy("chrom", "start", "end").write.mode("overwrite").csv(path, sep="\t")
