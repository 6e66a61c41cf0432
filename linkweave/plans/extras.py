"""Registered queries on coverage, diversity, duplicates, samples and text input, with their DuckDB statements."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import contigs, demux, intervals, metrics
from ..sources import text
from .catalogue import _DEPTH_SQL, _DNA, _FRAGS_SQL, _LIST_SQL, _MOLECULE, _PLACE_SQL, _READS_SQL, DAY, _demuxed, _depth, _fragments, _molecule_reads, _molecules, _orders, _orders_sql, _query, _reads, _table

# --- coverage ---------------------------------------------------------------------------------------------

_PROFILE_SQL = f"""{_FRAGS_SQL}, w AS (SELECT barcode, chrom, frag, strand, min_pos, (max_pos - min_pos + {DAY}) / 10.0::DOUBLE AS w FROM frags),
x AS (SELECT w.*, n.pos - min_pos AS a, k FROM w JOIN numbered n USING (barcode, chrom, frag) CROSS JOIN (SELECT unnest(range(0, 10)) AS k)),
pf AS (SELECT barcode, chrom, frag, CASE WHEN strand = 0 THEN 9 - k ELSE k END AS bin, round(sum(greatest(0, least(a + {DAY}, (k + 1) * w) - greatest(a, k * w))) / any_value(w), 6) AS depth
  FROM x GROUP BY barcode, chrom, frag, strand, k)"""


@_query(f"WITH {_PROFILE_SQL} SELECT * FROM pf")
def covered_profile(spark: SparkSession, d: str) -> DataFrame:
    return intervals.covered_profile(_fragments(spark, d), DAY)


@_query(f"WITH {_PROFILE_SQL} SELECT barcode, chrom, frag, round(regr_slope(depth, bin + 1), 6) AS slope FROM pf GROUP BY 1, 2, 3")
def profile_slopes(spark: SparkSession, d: str) -> DataFrame:
    return intervals.profile_slopes(intervals.covered_profile(_fragments(spark, d), DAY))


@_query(
    f"""WITH {_FRAGS_SQL}, w AS (SELECT * FROM frags WHERE max_pos - min_pos >= {DAY}),
x AS (SELECT w.barcode, w.chrom, w.frag, strand, n.pos - min_pos AS a, (max_pos - min_pos + {DAY}) // {2 * DAY} AS n, unnest(range(0, (max_pos - min_pos + {DAY}) // {2 * DAY})) AS k FROM w JOIN numbered n USING (barcode, chrom, frag))
SELECT barcode, chrom, frag, CAST(CASE WHEN strand = 0 THEN n - 1 - k ELSE k END AS BIGINT) AS bin, round(sum(greatest(0, least(a + {DAY}, (k + 1) * {2 * DAY}) - greatest(a, k * {2 * DAY}))) / {2 * DAY}.0::DOUBLE, 6) AS depth
FROM x GROUP BY barcode, chrom, frag, strand, n, k"""
)
def covered_bins(spark: SparkSession, d: str) -> DataFrame:
    return intervals.covered_profile(_fragments(spark, d), DAY, bins=None, bin_size=2 * DAY)


_SIZES = "select distinct concat(o_orderpriority, '/', cast(o_custkey % 40 as {s})) as chrom, 2999 + 10 * (o_custkey % 40) as bases from {t} union all select 'none', 501"


@_query(
    f"""WITH {_DEPTH_SQL}, rf AS ({_SIZES.format(s='VARCHAR', t='orders')}), c AS (SELECT chrom, sum(e - s) AS n, sum((e - s) * depth) AS ds, {', '.join(f'sum(CASE WHEN depth >= {k} THEN e - s ELSE 0 END) AS n{k}' for k in (4, 10, 20))} FROM runs GROUP BY 1),
j AS (SELECT rf.chrom, bases, coalesce(n, 0) AS n, coalesce(ds, 0) AS ds, {', '.join(f'coalesce(n{k}, 0) AS n{k}' for k in (4, 10, 20))} FROM rf LEFT JOIN c USING (chrom)), a AS (SELECT * FROM j UNION ALL SELECT 'total', * EXCLUDE (chrom) FROM j)
SELECT chrom, CAST(sum(bases) AS BIGINT) AS bases, round(sum(ds) / sum(bases), 6) AS mean_depth, round(sum(n) / sum(bases), 6) AS coverage, {', '.join(f'round(sum(n{k}) / sum(bases), 6) AS coverage_{k}x' for k in (4, 10, 20))} FROM a GROUP BY 1"""
)
def reference_coverage(spark: SparkSession, d: str) -> DataFrame:
    _table(spark, d, "orders").createOrReplaceTempView("_extras_orders")
    return intervals.reference_coverage(_depth(spark, d), spark.sql(_SIZES.format(s="string", t="_extras_orders")))


@_query(f"SELECT source AS chrom, CAST(sum(length(replace(replace({_DNA.format('text')}, 'A', 'N'), 'N', ''))) AS BIGINT) AS bases FROM documents GROUP BY 1")
def non_n_bases(spark: SparkSession, d: str) -> DataFrame:
    seq = F.replace(F.expr(_DNA.format("text")), F.lit("A"), F.lit("N"))
    return intervals.non_n_bases(_table(spark, d, "documents").select(F.col("source").alias("chrom"), seq.alias("seq")))


# --- intervals ------------------------------------------------------------------------------------------------


@_query(
    f"""WITH {_orders_sql()}, l AS (SELECT * FROM iv WHERE e > s), r AS (SELECT chrom, s + 40 AS s, e + 30 AS e, name FROM iv WHERE e + 30 > s + 40)
SELECT l.chrom, l.s AS l_start, l.e AS l_end, l.name AS l_name, r.s AS r_start, r.e AS r_end, r.name AS r_name, CASE WHEN r.name IS NULL THEN 0 ELSE least(l.e, r.e) - greatest(l.s, r.s) END AS overlap
FROM l LEFT JOIN r ON l.chrom = r.chrom AND l.s < r.e AND r.s < l.e"""
)
def overlap_outer(spark: SparkSession, d: str) -> DataFrame:
    left = _orders(spark, d).filter("end > start").drop("weight")
    right = left.selectExpr("chrom", "start + 40 as start", "end + 30 as end", "name").filter("end > start")
    return intervals.overlap_outer(left, right, "chrom", 16, "name")


@_query(
    f"""WITH {_orders_sql()}, st AS (SELECT chrom, CASE WHEN name % 2 = 0 THEN '+' ELSE '-' END AS strand, s, e, name % 7 AS g FROM iv),
m AS (SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY chrom, strand ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS b FROM st),
n AS (SELECT *, sum(b) OVER (PARTITION BY chrom, strand ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS i FROM m)
SELECT chrom, strand, min(s) AS "start", max(e) AS "end", count(*) AS n_merged, string_agg(DISTINCT CAST(g AS VARCHAR), ',' ORDER BY CAST(g AS VARCHAR)) AS names, max(e) - min(s) + 1 AS span FROM n GROUP BY chrom, strand, i"""
)
def merged_strands(spark: SparkSession, d: str) -> DataFrame:
    rows = _orders(spark, d).withColumn("strand", F.when(F.col("name") % 2 == 0, "+").otherwise("-")).withColumn("g", F.col("name") % 7)
    return intervals.merge_intervals(rows, ("chrom", "strand"), names="g")


@_query(
    """WITH iv AS (SELECT 'one' AS chrom, epoch_us(o_orderdate) // 86400000000 * 400 + o_orderkey % 397 AS s, epoch_us(o_orderdate) // 86400000000 * 400 + o_orderkey % 397 + o_custkey % 11 AS e FROM orders),
m AS (SELECT *, CASE WHEN s > max(e) OVER (ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS b FROM iv), n AS (SELECT *, sum(b) OVER (ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS i FROM m)
SELECT chrom, min(s) AS "start", max(e) AS "end", count(*) AS n_merged, max(e) - min(s) + 1 AS span FROM n GROUP BY chrom, i"""
)
def one_chromosome_merge(spark: SparkSession, d: str) -> DataFrame:
    """All intervals on one chromosome: the sweep is cut by ranges."""
    at = "cast(unix_micros(cast(o_orderdate as timestamp)) div 86400000000 as bigint) * 400 + o_orderkey % 397"
    return intervals.merge_intervals(_table(spark, d, "orders").selectExpr("'one' as chrom", f"{at} as start", f"{at} + o_custkey % 11 as end"))


@_query(
    f"""WITH {_orders_sql("'one'")}, ev AS (SELECT pt, sum(d) AS d FROM (SELECT s AS pt, 1 AS d FROM iv WHERE e > s UNION ALL SELECT e, -1 FROM iv WHERE e > s) GROUP BY pt),
rn AS (SELECT pt AS s, lead(pt) OVER (ORDER BY pt) AS e, CAST(sum(d) OVER (ORDER BY pt ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth FROM ev) SELECT 'one' AS chrom, s AS "start", e AS "end", depth FROM rn WHERE depth > 0 AND e > s"""
)
def one_chromosome_depth(spark: SparkSession, d: str) -> DataFrame:
    return intervals.depth_runs(_orders(spark, d, "'one'").filter("end > start"))


@_query(
    f"""WITH m AS (SELECT CAST(p_partkey AS VARCHAR) AS chrom, p_partkey AS k, {_MOLECULE.format(s='VARCHAR')} AS seq FROM part), p AS (SELECT chrom, k % 40 AS a, k % 40 + 5 + k % 30 AS b, CASE WHEN k % 2 = 0 THEN '+' ELSE '-' END AS strand, seq FROM m)
SELECT chrom, a AS "start", b AS "end", strand, CASE WHEN strand = '-' THEN reverse(translate(substr(seq, a + 1, b - a), 'ACGT', 'TGCA')) ELSE substr(seq, a + 1, b - a) END AS seq FROM p"""
)
def interval_sequences(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "part").selectExpr("cast(p_partkey as string) as chrom", "p_partkey % 40 as start", "p_partkey % 40 + 5 + p_partkey % 30 as end", "case when p_partkey % 2 = 0 then '+' else '-' end as strand")
    return intervals.sequences(rows, _molecules(spark, d).select(F.col("barcode").alias("chrom"), "seq"))


@_query(
    """SELECT o_orderkey AS id, o_orderpriority AS chrom, epoch_us(o_orderdate) // 86400000000 AS pos FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
AND EXISTS (SELECT 1 FROM nation WHERE epoch_us(o_orderdate) // 86400000000 >= 8000 + 100 * n_nationkey AND epoch_us(o_orderdate) // 86400000000 < 8000 + 100 * n_nationkey + 20 + 9 * n_regionkey)"""
)
def in_regions(spark: SparkSession, d: str) -> DataFrame:
    rows = _orders(spark, d, "o_orderpriority").select(F.col("name").alias("id"), "chrom", F.col("start").alias("pos"))
    regions = _table(spark, d, "nation").selectExpr("explode(array('1-URGENT', '2-HIGH')) as chrom", "8000L + 100 * n_nationkey as start", "8000L + 100 * n_nationkey + 20 + 9 * n_regionkey as end")
    return contigs.in_regions(rows, ["1-URGENT", "2-HIGH"], regions)


# --- demultiplexing, duplicates, lengths -----------------------------------------------------------------------


@_query(
    f"""WITH {_LIST_SQL}, c AS (SELECT count(*) AS n, count(CASE WHEN barcode <> '0_0_0' THEN 1 END) AS s, count(DISTINCT CASE WHEN barcode <> '0_0_0' THEN barcode END) AS b FROM dm), t AS (SELECT CAST(count(*) AS BIGINT) AS p FROM part)
SELECT p * p * p AS types, b AS seen, round(100 * b / (p * p * p), 6) AS type_percent, n AS n_reads, s AS n_split, round(100 * s / n, 6) AS split_percent, round(b / s, 6) AS diversity FROM c, t"""
)
def barcode_diversity(spark: SparkSession, d: str) -> DataFrame:
    return demux.diversity(_demuxed(spark, d), _table(spark, d, "part").count() ** 3)


_LOCI_SQL = f"""{_READS_SQL}, l AS (SELECT chrom, pos // {DAY} AS pos, barcode, read_id, read_id % 3 AS seq FROM reads), sm AS (SELECT chrom, pos, barcode, seq, count(*) AS n FROM l GROUP BY ALL),
b AS (SELECT chrom, pos, barcode, sum(n) AS r, sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS same FROM sm GROUP BY 1, 2, 3),
lo AS (SELECT chrom, pos, count(*) AS n_barcodes, CAST(sum(r) AS BIGINT) AS n_reads, CAST(sum(CASE WHEN r > 1 THEN r ELSE 0 END) AS BIGINT) AS shared, CAST(sum(CASE WHEN r > 1 THEN same ELSE 0 END) AS BIGINT) AS same_seq FROM b GROUP BY 1, 2)"""


def _loci(spark: SparkSession, d: str) -> DataFrame:
    return metrics.duplicate_rates(_reads(spark, d).selectExpr("chrom", f"pos div {DAY} as pos", "barcode", "read_id", "read_id % 3 as seq"))


@_query(
    f"""WITH {_LOCI_SQL} SELECT chrom, pos, n_barcodes, n_reads, same_seq, round(n_barcodes / n_reads, 6) AS barcode_rate, round(shared / n_reads, 6) AS shared_rate,
  round(CASE WHEN shared > 0 THEN same_seq / shared ELSE same_seq END, 6) AS same_seq_rate FROM lo"""
)
def duplicate_rates(spark: SparkSession, d: str) -> DataFrame:
    return _loci(spark, d)


@_query(f"WITH {_LOCI_SQL} SELECT CAST(sum(n_reads) AS BIGINT) AS n_reads, CAST(sum(n_barcodes) AS BIGINT) AS n_barcodes, round(sum(n_barcodes) / sum(n_reads), 6) AS barcode_rate FROM lo")
def duplicate_totals(spark: SparkSession, d: str) -> DataFrame:
    return metrics.duplicate_totals(_loci(spark, d))


@_query(
    f"""WITH {_READS_SQL}, r AS (SELECT read_id, chrom, pos, row_number() OVER (PARTITION BY chrom, pos // {DAY}, flag & 16, barcode ORDER BY mapq DESC, read_id) AS k FROM reads) SELECT read_id, chrom, pos FROM r WHERE k = 1"""
)
def removed_duplicates(spark: SparkSession, d: str) -> DataFrame:
    reads = _reads(spark, d)
    marked = metrics.mark_duplicates(reads.withColumn("pos", F.expr(f"pos div {DAY}")))
    return metrics.without_duplicates(reads, marked).select("read_id", "chrom", "pos")


@_query(
    f"""WITH c AS (SELECT CAST(32 - length(replace(replace({_DNA.format('CAST(event_id AS VARCHAR)')}, 'G', ''), 'C', '')) AS BIGINT) AS gc, count(*) AS n FROM events GROUP BY 1)
SELECT 'both' AS mate, gc, coalesce(n, 0) AS n, round(coalesce(n, 0) / (SELECT count(*) FROM events) * 100, 6) AS percent FROM (SELECT unnest(range(0, 33)) AS gc) LEFT JOIN c USING (gc)"""
)
def gc_both(spark: SparkSession, d: str) -> DataFrame:
    return metrics.gc_both(_table(spark, d, "events").selectExpr(_DNA.format("cast(event_id as string)") + " as seq"), 32)


_PERCENTS = (10, 20, 25, 30, 40, 50, 60, 70, 75, 80, 90, 95, 99)


@_query(" UNION ALL ".join(f"SELECT lang, {p} AS percent, round(quantile_cont(length(text), {p / 100}), 4) AS length FROM documents GROUP BY 1" for p in _PERCENTS))
def length_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return metrics.length_percentiles(_table(spark, d, "documents"), F.length("text"), "lang", _PERCENTS)


# --- quality control of contigs ----------------------------------------------------------------------------------


@_query(
    """WITH f AS (SELECT count(*) AS a, count(CASE WHEN toxic = 1 THEN 1 END) AS t, count(CASE WHEN quality = 1 THEN 1 END) AS q FROM labels)
SELECT 'all' AS metric, a AS n, 100.0 AS percent FROM f UNION ALL SELECT 'toxic', t, round(100 * t / a, 2) FROM f UNION ALL SELECT 'quality', q, round(100 * q / a, 2) FROM f"""
)
def qc_counts(spark: SparkSession, d: str) -> DataFrame:
    return contigs.qc_counts(_table(spark, d, "labels"), "toxic", "quality")


@_query(
    f"""WITH b AS (SELECT substr({_DNA.format('CAST(o_custkey AS VARCHAR)')}, 1, 4) AS barcode, count(*) AS n_reads FROM orders GROUP BY 1)
SELECT barcode, n_reads FROM b WHERE n_reads >= 3 AND greatest({', '.join(f"4 - length(replace(barcode, '{c}', ''))" for c in 'ACGT')}) < 0.7 * 4 ORDER BY md5('probe:' || barcode), barcode LIMIT 60"""
)
def sampled_barcodes(spark: SparkSession, d: str) -> DataFrame:
    reads = _table(spark, d, "orders").selectExpr(f"substr({_DNA.format('cast(o_custkey as string)')}, 1, 4) as barcode")
    counts = reads.filter(~contigs.low_complexity(F.col("barcode"), 0.7))
    return contigs.sampled_barcodes(counts, 60, 3)


@_query(
    f"""WITH {_PLACE_SQL}, dd AS (SELECT DISTINCT barcode, seq, md5('pairs:' || barcode || ':' || seq) AS g FROM rd), rk AS (SELECT *, row_number() OVER w AS r, lead(seq) OVER w AS o FROM dd WINDOW w AS (PARTITION BY barcode ORDER BY g, seq)),
ac AS (SELECT *, lead(barcode) OVER w AS ob, lead(seq) OVER w AS os FROM rk WHERE r = 1 WINDOW w AS (PARTITION BY substr(g, 1, 2) ORDER BY g, barcode))
SELECT 1 AS "within", barcode AS a, barcode AS b, seq AS x, o AS y FROM rk WHERE o IS NOT NULL UNION ALL SELECT 0, barcode, ob, seq, os FROM ac WHERE ob IS NOT NULL"""
)
def sampled_pairs(spark: SparkSession, d: str) -> DataFrame:
    return contigs.sampled_pairs(_molecule_reads(spark, d))


@_query("SELECT doc_id, doc_id % 9 AS n_reads FROM documents WHERE doc_id % 9 >= 3 AND length(text) BETWEEN 400 AND 20000")
def umi_gate(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "documents").select("doc_id", (F.col("doc_id") % 9).alias("n_reads"), F.col("text").alias("seq"))
    return contigs.umi_gate(rows, 3).select("doc_id", "n_reads")


# --- text input ----------------------------------------------------------------------------------------------------


def _scratch(spark: SparkSession) -> str:
    """A fresh folder that all executors share; a temporary one in a single-process session."""
    named = spark.conf.get("spark.checkpoint.dir", None) or (tempfile.mkdtemp(prefix="linkweave-") if spark.sparkContext.master.startswith("local[") else spark.conf.get("spark.sql.warehouse.dir"))
    return f"{named}/text-{uuid.uuid4().hex}"


@_query(f"SELECT o_orderkey AS id, {_DNA.format('CAST(o_orderkey AS VARCHAR)')} AS seq, substr({_DNA.format('CAST(o_custkey AS VARCHAR)')}, 1, 20 + o_orderkey % 10) AS qual FROM orders")
def fastq_records(spark: SparkSession, d: str) -> DataFrame:
    """Orders written as FASTQ text and read again: records are cut inside input splits."""
    rows = _table(spark, d, "orders").selectExpr(
        "o_orderkey as ord", "concat('@', cast(o_orderkey as string)) as header", f"{_DNA.format('cast(o_orderkey as string)')} as seq",
        f"substr({_DNA.format('cast(o_custkey as string)')}, 1, cast(20 + o_orderkey % 10 as int)) as qual",
    )
    path = _scratch(spark)
    text.write_fastq(rows, path)
    return text.read_fastq(spark, path).select(F.expr("cast(substring(header, 2) as bigint)").alias("id"), "seq", "qual")


@_query(f"SELECT o_orderkey AS id, {_DNA.format('CAST(o_orderkey AS VARCHAR)')} || substr({_DNA.format('CAST(o_custkey AS VARCHAR)')}, 1, 1 + o_orderkey % 32) AS seq FROM orders")
def fasta_records(spark: SparkSession, d: str) -> DataFrame:
    """Orders written as FASTA of several lines a record and read again."""
    more = f"substr({_DNA.format('cast(o_custkey as string)')}, 1, cast(1 + o_orderkey % 32 as int))"
    lines = _table(spark, d, "orders").selectExpr(f"concat('>', cast(o_orderkey as string), ' any words\\n', {_DNA.format('cast(o_orderkey as string)')}, '\\n', {more}) as value")
    path = _scratch(spark)
    lines.write.text(path)
    return text.read_fasta(spark, path).select(F.col("name").cast("long").alias("id"), "seq")
