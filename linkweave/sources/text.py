"""Readers and writers of the sequence text formats, as DataFrames."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_COMMENT = "#"


def _stretches(batches: Iterator) -> Iterator:
    """(file, block, lines) for every stretch of lines of one input split, in order; a split may come in several stretches."""
    import numpy as np

    for batch in batches:
        lines, files, blocks = batch.columns
        if not len(lines):
            continue
        file, block = files.dictionary_encode().indices.to_numpy(), blocks.to_numpy()
        cuts = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(lines)], strict=True):
            yield files[i].as_py(), int(block[i]), lines.slice(i, j - i)


def _split_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, block): text lines with the input split they begin in; plain files are split, gzipped ones are read as a stream."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _places(lines: DataFrame, mark: str | None, ahead: int) -> dict[tuple[str, int], tuple[int, int, list[str]]]:
    """Per input split: lines before it in its file, marked lines before it, and the first ``ahead`` lines behind it.

    One row per split comes to the driver, which holds a task per split anyway.
    """

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        found: dict[tuple[str, int], list] = {}
        for file, block, some in _stretches(batches):
            row = found.setdefault((file, block), [0, 0, []])
            row[0] += len(some)
            if mark:
                row[1] += sum(mark in x for x in some.to_pylist())
            if len(row[2]) < ahead:
                row[2] += some.slice(0, ahead - len(row[2])).to_pylist()
        columns = [[k[0] for k in found], [k[1] for k in found], *([r[i] for r in found.values()] for i in range(3))]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "block", "n", "marks", "head"])

    rows = lines.mapInArrow(count, "file string, block long, n long, marks long, head array<string>").collect()
    out: dict[tuple[str, int], tuple[int, int, list[str]]] = {}
    by_file: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["file"], r["block"])):
        by_file.setdefault(r["file"], []).append(r)
    for file, splits in by_file.items():
        n = marks = 0
        for i, r in enumerate(splits):
            behind: list[str] = []
            for later in splits[i + 1 :]:
                if len(behind) >= ahead:
                    break
                behind += later["head"]
            out[file, r["block"]] = (n, marks, behind[:ahead])
            n, marks = n + r["n"], marks + r["marks"]
    return out


def _lines(spark: SparkSession, path: str, mark: str | None = None) -> DataFrame:
    """(file, ord, section, line): lines with their place in the file, and how many lines that hold ``mark`` there are up to them.

    A first pass counts the lines of each input split, so the second numbers them in place: nothing is shuffled and no task
    holds a file.
    """
    lines = _split_lines(spark, path)
    places = spark.sparkContext.broadcast(_places(lines, mark, 0))

    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        seen: dict[tuple[str, int], tuple[int, int]] = {}
        for file, block, some in _stretches(batches):
            at, section = seen.get((file, block), places.value[file, block][:2])
            flags = np.array([mark in x for x in some.to_pylist()], np.int64) if mark else np.zeros(len(some), np.int64)
            sections = section + np.cumsum(flags)
            seen = {(file, block): (at + len(some), int(sections[-1]))}
            yield pa.RecordBatch.from_arrays(
                [pa.array([file] * len(some), pa.string()), pa.array(np.arange(at, at + len(some))), pa.array(sections), some], names=["file", "ord", "section", "line"]
            )

    return lines.mapInArrow(cut, "file string, ord long, section long, line string")


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """(file, ord, header, seq, plus, qual); a truncated last record is an error. Files may be gzipped and of any size.

    A record belongs to the input split that its header begins in. A first pass counts the lines of the splits and
    notes the first three of each; the second cuts records in place, so no line is shuffled.
    """
    lines = _split_lines(spark, path)
    places = spark.sparkContext.broadcast(_places(lines, None, 3))
    names = ["header", "seq", "plus", "qual"]

    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def records(file: str, first: int, some: pa.Array) -> pa.RecordBatch:
            n = len(some) // 4
            columns = [some.take(pa.array(np.arange(i, 4 * n, 4))) for i in range(4)]
            return pa.RecordBatch.from_arrays([pa.array([file] * n, pa.string()), pa.array(np.arange(first, first + n)), *columns], names=["file", "ord", *names])

        def last() -> Iterator:
            if key and len(held):
                text = held.to_pylist() + places.value[key][2]
                if len(text) < 4:
                    raise ValueError(f"truncated FASTQ record in {key[0]}")
                yield records(key[0], number, pa.array(text[:4], pa.string()))

        key, number, skip, held = None, 0, 0, pa.array([], pa.string())
        for file, block, some in _stretches(batches):
            if key != (file, block):
                yield from last()
                key = (file, block)
                start = places.value[key][0]
                skip, number, held = -start % 4, -(-start // 4), some.slice(0, 0)
            drop = min(skip, len(some))
            skip, some = skip - drop, pa.concat_arrays([held, some.slice(drop)])
            whole = len(some) // 4
            if whole:
                yield records(file, number, some.slice(0, 4 * whole))
            number, held = number + whole, some.slice(4 * whole)
        yield from last()

    return lines.mapInArrow(cut, "file string, ord long, header string, seq string, plus string, qual string")


def read_pairs(spark: SparkSession, first: str, second: str) -> DataFrame:
    """Read pairs by place in their lanes (files sorted by name)."""

    def laned(path: str) -> DataFrame:
        df = read_fastq(spark, path)
        names = df.select("file").distinct().withColumn("lane", F.regexp_replace(F.col("file"), r"_read_?[12]", ""))
        return df.join(names, "file").select("lane", "ord", F.struct("header", "seq", "qual").alias("r"))

    return laned(first).withColumnRenamed("r", "r1").join(laned(second).withColumnRenamed("r", "r2"), ["lane", "ord"])


def lane_files(spark: SparkSession, folder: str, lanes: Sequence[str], mate: int | None = None) -> list[str]:
    """Paths of the lanes' reads under ``folder``, sorted: of one mate, or (None) of single reads.

    Files that the splitter set aside (``discard`` in the path) are left out. Only names are listed.
    """
    pattern = f"*_read_{mate}.fq.gz" if mate else "*_read*.fq.gz"
    jvm = spark.sparkContext._jvm
    found = []
    for lane in lanes:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{lane}/{pattern}")
        hits = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
        found += [hit.getPath().toString() for hit in hits]
    return sorted(name for name in found if "discard" not in name)


def bases_of_fastq(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(mate, seq) of read files for base counts: upper case, the mate from the file name (null if none)."""
    parts = [read_fastq(spark, p) for p in paths]
    rows = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "file string, seq string")
    mate = F.regexp_extract("file", r"_read_?([12])", 1)
    return rows.select(F.when(mate != "", mate.cast("int")).alias("mate"), F.upper("seq").alias("seq"))


def bases_of_sam(spark: SparkSession, path: str, only_mapped: bool = False) -> DataFrame:
    """(mate, seq) of alignments for base counts: upper case, the mate from the flags (null if neither)."""
    rows = read_sam(spark, path)
    flag = F.col("flag")
    if only_mapped:
        rows = rows.filter(flag.bitwiseAND(F.lit(4)) == 0)
    mate = F.when(flag.bitwiseAND(F.lit(64)) != 0, 1).when(flag.bitwiseAND(F.lit(128)) != 0, 2)
    return rows.select(mate.alias("mate"), F.upper("seq").alias("seq"))


def read_fasta(spark: SparkSession, path: str, keep: str = "all") -> DataFrame:
    """(name, header, seq) of multi-line FASTA; ``keep``: all, longest or last record of a name."""
    lines = _lines(spark, path, ">").filter(F.length("line") > 0)
    grouped = lines.groupBy("file", F.col("section").alias("rec")).agg(F.sort_array(F.collect_list(F.struct("ord", "line"))).alias("l"))
    rows = grouped.select(
        "file", "rec", F.expr("substring(l[0].line, 2)").alias("header"),
        F.array_join(F.transform(F.slice("l", 2, F.greatest(F.size("l") - 1, F.lit(1))), lambda x: F.trim(x["line"])), "").alias("seq"),
    ).withColumn("name", F.element_at(F.split("header", r"\s+"), 1))
    if keep == "longest":
        rows = rows.groupBy("name").agg(F.max_by(F.struct("header", "seq"), F.struct(F.length("seq"), -F.col("rec"))).alias("b")).select("name", "b.*")
    elif keep == "last":
        rows = rows.groupBy("name").agg(F.max_by(F.struct("header", "seq"), "rec").alias("b")).select("name", "b.*")
    return rows.select("name", "header", "seq")


def _tags(fields: Column, first: int) -> Column:
    """Optional fields ``TAG:T:value`` from the ``first``-th on, as a map."""
    some = F.slice(fields, first, F.greatest(F.size(fields) - first + 1, F.lit(0)))
    return F.map_from_entries(F.transform(some, lambda t: F.struct(F.substring(t, 1, 2), F.substring(t, F.lit(6), F.length(t)))))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignment rows of SAM text: positions 0-based, optional fields as a map."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).filter(~F.col("value").startswith("@"))
    tag = _tags(f, 12)
    return rows.select(
        f[0].alias("qname"), f[1].cast("int").alias("flag"), f[2].alias("rname"), (f[3].cast("long") - 1).alias("pos"),
        f[4].cast("int").alias("mapq"), f[5].alias("cigar"), f[9].alias("seq"), f[10].alias("qual"), tag.alias("tags"),
    )


def sam_references(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, length) of the header's sequence lines; no alignment is parsed."""
    rows = spark.read.text(path).filter(F.col("value").startswith("@SQ\t"))
    return rows.select(F.regexp_extract("value", r"\tSN:([^\t]+)", 1).alias("chrom"), F.regexp_extract("value", r"\tLN:(\d+)", 1).try_cast("long").alias("length")).distinct()


def first_by_membership(reads: DataFrame, names: DataFrame, most: int = 200) -> tuple[DataFrame, DataFrame]:
    """The first ``most`` reads (by ``ord``; so many are the feature) whose name is listed, and of those whose name isn't."""
    listed = names.select("name").distinct()
    return tuple(reads.join(listed, "name", how).orderBy("ord").limit(most) for how in ("left_semi", "left_anti"))


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """BED rows; see ``named_reads`` for split BED, whose fourth column holds read, barcode and mate."""
    return spark.read.csv(path, sep="\t", comment=_COMMENT, schema="chrom string, start long, end long, name string, score string, strand string", mode="PERMISSIVE")


def named_reads(bed: DataFrame, mark: str = "#") -> DataFrame:
    """Split-BED rows with the read id, barcode and mate that ``name`` holds as ``read#barcode/mate`` (mate 1 if missing)."""
    last = F.element_at(F.split("name", mark), -1)
    mate = F.regexp_extract("name", r"/([12])$", 1)
    return bed.withColumn("read_id", F.element_at(F.split("name", mark), 1)).withColumn("barcode", F.regexp_replace(last, r"/[12]$", "")).withColumn(
        "mate", F.when(mate == "", 1).otherwise(mate.cast("int"))
    )


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """Records of ten columns or more: chrom, pos (1-based), ref, alt, genotype of the first sample."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).filter(~F.col("value").startswith("#")).filter(F.size(f) >= 10)
    return rows.select(f[0].alias("chrom"), f[1].cast("long").alias("pos"), f[2].alias("id"), f[3].alias("ref"), f[4].alias("alt"), F.substring(f[9], 1, 3).alias("gt"))


def heterozygous(vcf: DataFrame, phased: bool = False) -> DataFrame:
    return vcf.filter(F.col("gt").isin("0|1", "1|0") if phased else F.col("gt").isin("0|1", "1|0", "0/1", "1/0"))


def read_paf(spark: SparkSession, path: str) -> DataFrame:
    f = F.split("value", "\t")
    names = ["query", "qlen", "qstart", "qend", "strand", "target", "tlen", "tstart", "tend", "matches", "block", "mapq"]
    text = {"query", "strand", "target"}
    fixed = [f[i].alias(n) if n in text else f[i].cast("long").alias(n) for i, n in enumerate(names)]
    tags = _tags(f, 13)
    return _lines(spark, path).withColumnRenamed("line", "value").select("ord", *fixed, tags.alias("tags"))


def read_split_log(spark: SparkSession, path: str) -> DataFrame:
    """(idx, cnt, barcode) after the four header lines."""
    f = F.split("line", r"\s+")
    return _lines(spark, path).filter("ord > 3").select(f[0].cast("int").alias("idx"), f[1].cast("long").alias("cnt"), f[2].alias("barcode"))


def read_idxstats(spark: SparkSession, path: str, fields: int | None = None) -> DataFrame:
    """Rows of exactly four fields, or of ``fields`` and more (missing counts are null)."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).filter(F.size(f) == 4 if fields is None else F.size(f) >= fields)
    return rows.select(f[0].alias("ref"), f[1].cast("long").alias("length"), f[2].cast("long").alias("mapped"), F.get(f, F.lit(3)).cast("long").alias("unmapped"))


def read_hapblocks(spark: SparkSession, path: str) -> DataFrame:
    """(block, ord, snp_ix, a1, a2, chrom, pos): lines between block headers."""
    lines = _lines(spark, path, "BLOCK").withColumnRenamed("section", "block")
    f = F.split("line", r"\s+")
    rows = lines.filter(~F.col("line").contains("BLOCK") & ~F.col("line").startswith("*") & (F.size(f) >= 5))
    return rows.select("block", "ord", f[0].cast("long").alias("snp_ix"), f[1].alias("a1"), f[2].alias("a2"), f[3].alias("chrom"), f[4].cast("long").alias("pos"))


def write_fastq(reads: DataFrame, path: str, route: str | None = None) -> None:
    """Gzipped FASTQ text, in order within each part; one folder per value of ``route``."""
    lines = F.concat_ws("\n", "header", "seq", F.lit("+"), "qual").alias("value")
    rows = reads.sortWithinPartitions("ord").select(*([route] if route else []), lines)
    writer = rows.write.mode("overwrite").option("compression", "gzip")
    (writer.partitionBy(route) if route else writer).text(path)


def write_fasta(contigs: DataFrame, path: str) -> None:
    contigs.select(F.concat(F.lit(">"), F.col("barcode"), F.lit(">k41_"), F.col("contig_ix").cast("string"), F.lit("\n"), F.col("seq")).alias("value")).write.mode("overwrite").text(path)


def write_by_confidence(contigs: DataFrame, path: str) -> None:
    """FASTA of the contigs (barcode, seq, low_confidence) in two folders: ``highconf`` and ``flagged``."""
    side = F.when(F.col("low_confidence") == 1, "flagged").otherwise("highconf").alias("side")
    contigs.select(side, F.concat(F.lit(">"), "barcode", F.lit("\n"), "seq").alias("value")).write.mode("overwrite").partitionBy("side").text(path)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, sep="\t", header=True)
