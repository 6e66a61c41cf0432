"""Jobs over alignments: the module switches of a run decide which tables are built and written."""

from __future__ import annotations

import argparse
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import seq as S
from .kernels.assembly import AssembleOptions
from .operators import assemble, calibration, contigs, fragments, metrics, placement
from .sources import text


@dataclass(frozen=True)
class JobOptions:
    """``split_distances``: each gives its own fragment tables; the other limits are those of the gates."""

    split_distances: tuple[int, ...] = (50_000,)
    read_length: int = 100
    min_reads: int = 4
    min_fragment: int = 750
    min_mapq: int = 30
    min_contig: int = 400


def tagged_reads(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of SAM text with barcode, bases and mismatches, as the metrics and fragments take them."""
    tag = lambda name: F.col("tags")[name]
    # a SAM tag value is what follows its type, e.g. the 7 of NM:i:7
    return text.read_sam(spark, path).select(
        F.col("qname").alias("read_id"), F.col("rname").alias("chrom"), "pos", "flag", "mapq", "cigar", "seq",
        S.barcode_of(F.col("qname"), F.regexp_replace(tag("BX"), "^:", "")).alias("barcode"),
        F.length("seq").cast("long").alias("bases"),
        F.coalesce(F.regexp_extract(tag("NM"), r"(\d+)$", 1).try_cast("long"), F.lit(0)).alias("mismatches"),
    )


def _fragment_tables(reads: DataFrame, options: JobOptions) -> dict[str, DataFrame]:
    good = fragments.passed_reads(reads, min_mapq=options.min_mapq)
    out = {}
    for gap in options.split_distances:
        called = fragments.call_fragments(good, gap, options.read_length)
        kept = called.filter((F.col("n_reads") >= options.min_reads) & (F.col("length") >= options.min_fragment))
        out |= {
            f"fragments_{gap}": called,
            f"fragment_gate_{gap}": fragments.fragment_gate(called, options.min_reads, options.min_fragment),
            f"fragment_summary_{gap}": fragments.fragment_summary(kept),
        }
    return out


def _metric_tables(reads: DataFrame, options: JobOptions) -> dict[str, DataFrame]:
    return {
        "align_metrics": metrics.align_metrics(reads),
        "flagstat": metrics.flagstat(reads),
        "idxstats": metrics.idxstats(reads),
        "read_gate": fragments.gate_counts(reads, min_mapq=options.min_mapq),
    }


def _contig_tables(reads: DataFrame, options: JobOptions) -> dict[str, DataFrame]:
    pool = reads.filter("barcode is not null").select("barcode", "seq")
    return {"contigs": assemble.assemble_barcodes(pool, AssembleOptions(min_contig=options.min_contig))}


def _denovo_tables(reads: DataFrame, options: JobOptions) -> dict[str, DataFrame]:
    """Reads that don't conflict, read pools, contigs, and the verdicts on each barcode's longest contig."""
    order = Window.partitionBy("barcode").orderBy("seq")
    pool = reads.filter("barcode is not null").select("barcode", "seq").distinct().withColumn("read_id", F.row_number().over(order).cast("long"))
    judged = assemble.conflict_filter(pool)
    kept = pool.join(judged.filter("kept = 1").select("barcode", "read_id"), ["barcode", "read_id"])
    found = assemble.assemble_barcodes(kept.select("barcode", "seq"), AssembleOptions(min_contig=options.min_contig))
    longest = found.filter("contig_ix = 0").select("barcode", F.col("contig_ix").alias("target_id"), "seq")
    back = placement.read_back(placement.placements(kept, longest), kept, longest)
    junctions = assemble.junction_qc(found, kept)
    none = reads.sparkSession.createDataFrame([], "barcode string, chimera string")
    verdict = calibration.verdict(longest.select("barcode", "seq"), back.select("barcode", "breadth_1x"), none, junctions.select("barcode", "junction_suspect"))
    flags = {"junction": (junctions, "junction_suspect"), "pools": (assemble.pool_components(pool), "suspect"), "verdict": (verdict, "low_confidence")}
    return {
        "read_filter": judged, "contigs": found, "readback": back, **{name: df for name, (df, _) in flags.items()},
        **{f"{name}_counts": contigs.qc_counts(df, flag) for name, (df, flag) in flags.items()},
    }


def _duplicate_tables(reads: DataFrame, options: JobOptions) -> dict[str, DataFrame]:
    mapped = reads.filter(~S.has_flag(F.col("flag"), 4))
    rates = metrics.duplicate_rates(mapped)
    return {"duplicate_rates": rates, "duplicate_totals": metrics.duplicate_totals(rates)}


def _gc_tables(reads: DataFrame, options: JobOptions) -> dict[str, DataFrame]:
    mate = F.when(S.has_flag(F.col("flag"), 128), 2).otherwise(1)
    rows = reads.select(mate.alias("mate"), "seq")
    return {"gc": metrics.gc_histogram(rows, options.read_length), "gc_both": metrics.gc_both(rows, options.read_length)}


MODULES: dict[str, Callable[[DataFrame, JobOptions], dict[str, DataFrame]]] = {
    "eval_metrics": _metric_tables,
    "LFR": _fragment_tables,
    "frag_de_novo": _contig_tables,
    "denovo_qc": _denovo_tables,
    "duplicates": _duplicate_tables,
    "gc_bias": _gc_tables,
}


def targets(reads: DataFrame, modules: Mapping[str, bool], options: JobOptions = JobOptions()) -> dict[str, DataFrame]:
    """Table name to (lazy) table of every module that is switched on; an unknown module is an error."""
    unknown = sorted(set(modules) - set(MODULES))
    if unknown:
        raise ValueError(f"unknown modules: {', '.join(unknown)}")
    return {name: df for module, make in MODULES.items() if modules.get(module) for name, df in make(reads, options).items()}


def write_targets(tables: Mapping[str, DataFrame], folder: str, settings: Mapping[str, str]) -> None:
    """Every table as Parquet under ``folder``, and the run's settings and engine version as ``provenance``."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
    for df in list(tables.values())[:1]:
        spark = df.sparkSession
        rows = [("spark", spark.version), ("tables", ",".join(tables)), *sorted((k, str(v)) for k, v in settings.items())]
        spark.createDataFrame(rows, "key string, value string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/provenance")


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="python -m linkweave", description="Build the tables of the chosen modules from SAM text.")
    parser.add_argument("--reads", required=True, help="SAM text, one or many files")
    parser.add_argument("--out", required=True, help="folder of the tables")
    parser.add_argument("--module", action="append", required=True, choices=sorted(MODULES))
    parser.add_argument("--split-distance", type=int, action="append")
    parser.add_argument("--min-reads", type=int, default=JobOptions.min_reads)
    parser.add_argument("--min-mapq", type=int, default=JobOptions.min_mapq)
    parser.add_argument("--min-contig", type=int, default=JobOptions.min_contig)
    parser.add_argument("--read-length", type=int, default=JobOptions.read_length)
    parser.add_argument("--chrom", action="append", help="keep alignments to these references; each must be in the header")
    chosen = parser.parse_args(arguments)
    distances = tuple(chosen.split_distance or JobOptions.split_distances)
    options = JobOptions(split_distances=distances, min_reads=chosen.min_reads, min_mapq=chosen.min_mapq, min_contig=chosen.min_contig, read_length=chosen.read_length)
    spark = SparkSession.builder.getOrCreate()
    known = [r["chrom"] for r in text.sam_references(spark, chosen.reads).collect()] if chosen.chrom else []
    if missing := sorted(set(chosen.chrom or ()) - set(known)):
        parser.error(f"not in the header: {', '.join(missing)}")
    # the SAM text is parsed once; all tables read the result
    contigs.in_regions(tagged_reads(spark, chosen.reads), chosen.chrom).write.mode("overwrite").parquet(f"{chosen.out}/reads")
    reads = spark.read.parquet(f"{chosen.out}/reads")
    write_targets(targets(reads, dict.fromkeys(chosen.module, True), options), chosen.out, vars(chosen))
