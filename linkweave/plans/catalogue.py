"""Registered queries: each operator over a projection of the driver tables, with its DuckDB statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import seq as S
from ..kernels.assembly import AssembleOptions, JunctionOptions
from ..operators import assemble, calibration, demux, fragments, intervals, metrics, phasing, placement
from ..streaming import sessions

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}

DAY = 86_400_000_000
GAP = 5 * DAY
READ = 100
_DNA = "translate(md5({}), '0123456789abcdef', 'ACGTACGTACGTACGT')"


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _ORACLES[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- projections, each once per engine -------------------------------------------------------------

_FLAG = (
    "cast((case when event_id % 7 = 0 then 1024 else 0 end) + (case when event_id % 11 = 0 then 4 else 0 end) + "
    "(case when event_id % 2 = 0 then 16 else 0 end) + (case when event_id % 13 = 0 then 256 else 0 end) as int) as flag"
)
_READ_COLUMNS = f"event_id as read_id, event_type as chrom, cast(event_id % 61 as int) as mapq, {_FLAG}"


def _reads(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "events").selectExpr(
        *[c.strip() for c in ("event_id as read_id", "event_type as chrom", "cast(event_id % 61 as int) as mapq", _FLAG)],
        "case when user_id % 25 = 0 then null else cast(user_id as string) end as barcode",
        "unix_micros(cast(ts as timestamp)) as pos",
        "cast(event_id % 150 as bigint) as bases",
        "cast(event_id % 5 as bigint) as mismatches",
    )


_READS_SQL = f"""reads AS (SELECT {_READ_COLUMNS}, CASE WHEN user_id % 25 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS barcode,
  epoch_us(ts) AS pos, CAST(event_id % 150 AS BIGINT) AS bases, CAST(event_id % 5 AS BIGINT) AS mismatches FROM events)"""


def _fragments(spark: SparkSession, d: str) -> DataFrame:
    return fragments.call_fragments(fragments.passed_reads(_reads(spark, d)), GAP, READ)


_FRAGS_SQL = f"""{_READS_SQL}, good AS (
  SELECT * FROM reads WHERE barcode IS NOT NULL AND barcode <> '0_0_0' AND (flag & 2304) = 0 AND (flag & 4) = 0 AND mapq >= 30
), marked AS (
  SELECT *, CASE WHEN pos - lag(pos) OVER w >= {GAP} THEN 1 ELSE 0 END AS s FROM good WINDOW w AS (PARTITION BY barcode, chrom ORDER BY pos, read_id)
), numbered AS (
  SELECT *, CAST(sum(s) OVER (PARTITION BY barcode, chrom ORDER BY pos, read_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS frag FROM marked
), frags AS (
  SELECT barcode, chrom, frag, count(*) AS n_reads, min(pos) AS min_pos, max(pos) AS max_pos, max(pos) - min(pos) + {READ} AS length,
    CAST(CASE WHEN 2 * sum(CASE WHEN (flag & 16) <> 0 THEN 1 ELSE 0 END) > count(*) THEN 0 ELSE 1 END AS BIGINT) AS strand,
    CAST(sum(CASE WHEN (flag & 1024) <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_dup
  FROM numbered GROUP BY barcode, chrom, frag)"""


def _orders(spark: SparkSession, d: str, chrom: str = "cast(o_custkey as string)") -> DataFrame:
    return _table(spark, d, "orders").selectExpr(
        f"{chrom} as chrom", "cast(unix_micros(cast(o_orderdate as timestamp)) div 86400000000 as bigint) as start",
        "cast(unix_micros(cast(o_orderdate as timestamp)) div 86400000000 + floor(o_totalprice / 10000) as bigint) as end",
        "o_orderkey as name", "cast(floor(o_totalprice) as bigint) as weight",
    )


def _orders_sql(chrom: str = "CAST(o_custkey AS VARCHAR)") -> str:
    return f"""iv AS (SELECT {chrom} AS chrom, epoch_us(o_orderdate) // 86400000000 AS s,
  CAST(epoch_us(o_orderdate) // 86400000000 + floor(o_totalprice / 10000) AS BIGINT) AS e, o_orderkey AS name, CAST(floor(o_totalprice) AS BIGINT) AS weight FROM orders)"""


_ISLANDS_SQL = """, im AS (SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS b FROM iv),
ii AS (SELECT *, sum(b) OVER (PARTITION BY chrom ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS i FROM im)"""


def _depth(spark: SparkSession, d: str) -> DataFrame:
    return intervals.depth_runs(_orders(spark, d, "concat(o_orderpriority, '/', cast(o_custkey % 40 as string))").filter("end > start"))


_DEPTH_SQL = _orders_sql("concat(o_orderpriority, '/', CAST(o_custkey % 40 AS VARCHAR))") + """,
ev AS (SELECT chrom, pt, sum(d) AS d FROM (SELECT chrom, s AS pt, 1 AS d FROM iv WHERE e > s UNION ALL SELECT chrom, e, -1 FROM iv WHERE e > s) GROUP BY chrom, pt),
rn AS (SELECT chrom, pt AS s, lead(pt) OVER (PARTITION BY chrom ORDER BY pt) AS e, CAST(sum(d) OVER (PARTITION BY chrom ORDER BY pt ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth FROM ev),
runs AS (SELECT * FROM rn WHERE depth > 0 AND e > s)"""

_BC = "case when l_orderkey % 10 < 5 then cast(l_orderkey as bigint) else -cast(floor(sqrt(l_orderkey)) as bigint) end"


def _bc_counts(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "lineitem").groupBy(F.expr(_BC).alias("barcode")).agg(F.count(F.lit(1)).alias("n_reads"))


_BC_SQL = f"bc AS (SELECT {_BC} AS barcode, count(*) AS n_reads FROM lineitem GROUP BY 1)"


def _bins_sql(bins: list[tuple[int, int | None]]) -> str:
    arms = " ".join(
        f"WHEN n_reads >= {a} {'' if b is None else f'AND n_reads <= {b}'} THEN '{f'>={a}' if b is None else a if a == b else f'[{a},{b + 1})'}'" for a, b in bins
    )
    return f"WITH {_BC_SQL} SELECT CASE {arms} END AS bin, count(*) AS n_barcodes, CAST(sum(n_reads) AS BIGINT) AS n_reads FROM bc GROUP BY 1"


# --- reads and fragments -----------------------------------------------------------------------------


@_query(
    f"""WITH {_READS_SQL} SELECT CASE WHEN barcode IS NULL OR barcode = '0_0_0' THEN 'bc_flag_failed' WHEN (flag & 2304) <> 0 THEN 'read_flag_failed'
  WHEN (flag & 4) <> 0 THEN 'mapped_flag_failed' WHEN mapq < 30 THEN 'poor_quality' ELSE 'passed' END AS reason, count(*) AS n_reads FROM reads GROUP BY 1"""
)
def read_gate_counts(spark: SparkSession, d: str) -> DataFrame:
    return fragments.gate_counts(_reads(spark, d))


@_query(f"WITH {_FRAGS_SQL} SELECT * FROM frags")
def fragment_calls(spark: SparkSession, d: str) -> DataFrame:
    return _fragments(spark, d).drop("positions")


@_query(
    f"""WITH {_FRAGS_SQL}, gp AS (SELECT barcode, chrom, frag, pos - lag(pos) OVER (PARTITION BY barcode, chrom, frag ORDER BY pos, read_id) - {READ} AS g FROM numbered),
gs AS (SELECT barcode, chrom, frag, greatest(0, max(g)) AS max_gap, coalesce(sum(CASE WHEN g > 0 THEN g END), 0) AS gap_total, 1 + count(CASE WHEN g > 0 THEN 1 END) AS n_gaps FROM gp GROUP BY ALL)
SELECT f.barcode, f.chrom, f.frag, CAST(coalesce(max_gap, 0) AS BIGINT) AS max_gap, CAST(gap_total AS BIGINT) AS gap_total, CAST(n_gaps AS BIGINT) AS n_gaps,
  round((length - gap_total) / length * 100, 4) AS covered_percent, round(n_reads * {READ} / length, 6) AS mean_depth
FROM frags f JOIN gs USING (barcode, chrom, frag)"""
)
def fragment_gaps(spark: SparkSession, d: str) -> DataFrame:
    return fragments.fragment_gaps(_fragments(spark, d), READ)


@_query(
    f"""WITH {_FRAGS_SQL} SELECT CASE WHEN n_reads < 4 THEN 'few_reads' WHEN length < {DAY} THEN 'short' ELSE 'passed' END AS gate, count(*) AS n_fragments,
  CAST(sum(n_reads) AS BIGINT) AS n_reads FROM frags GROUP BY 1"""
)
def fragment_gate(spark: SparkSession, d: str) -> DataFrame:
    return fragments.fragment_gate(_fragments(spark, d), 4, DAY)


@_query(
    f"""WITH {_FRAGS_SQL}, b AS (SELECT barcode, count(*) AS f, sum(n_reads) AS r FROM frags GROUP BY 1), iv AS (SELECT chrom, min_pos AS s, min_pos + length AS e FROM frags) {_ISLANDS_SQL}, mg AS (SELECT min(s) AS s, max(e) AS e FROM ii GROUP BY chrom, i)
SELECT (SELECT count(*) FROM b) AS n_barcodes, (SELECT round(avg(f), 4) FROM b) AS frags_per_bc, (SELECT round(avg(r), 4) FROM b) AS reads_per_bc,
  count(*) AS n_fragments, CAST(sum(n_reads) AS BIGINT) AS n_reads, round(avg(length), 2) AS mean_length, round(median(length), 4) AS median_length, round(avg(n_reads), 4) AS reads_per_frag,
  round(1000 * avg(n_reads) / median(length), 9) AS reads_per_kbp, (SELECT CAST(sum(e - s) AS BIGINT) FROM mg) AS merged_length, (SELECT round(sum(e - s) / 2934876545000000 * 100, 4) FROM mg) AS genome_percent FROM frags"""
)
def fragment_summary(spark: SparkSession, d: str) -> DataFrame:
    return fragments.fragment_summary(_fragments(spark, d), genome=2_934_876_545_000_000)


@_query(_bins_sql(fragments.FINE_BINS))
def reads_per_bc_bins(spark: SparkSession, d: str) -> DataFrame:
    return fragments.reads_per_barcode_bins(_bc_counts(spark, d), fragments.FINE_BINS)


@_query(_bins_sql(fragments.COARSE_BINS))
def reads_per_bc_bins_coarse(spark: SparkSession, d: str) -> DataFrame:
    return fragments.reads_per_barcode_bins(_bc_counts(spark, d), fragments.COARSE_BINS)


@_query(
    f"""WITH {_BC_SQL} SELECT n_reads, count(*) AS n_barcodes, n_reads * count(*) AS reads,
  round(n_reads * count(*) / (SELECT sum(n_reads) FROM bc) * 100, 6) AS percent FROM bc GROUP BY n_reads"""
)
def reads_per_bc_dist(spark: SparkSession, d: str) -> DataFrame:
    return fragments.reads_per_barcode_distribution(_bc_counts(spark, d))


@_query(
    f"""WITH {_FRAGS_SQL}, p AS (SELECT barcode, sum(n_reads) AS r, count(*) AS n, sum(CASE WHEN n_reads >= 3 THEN 1 ELSE 0 END) AS good FROM frags GROUP BY 1)
SELECT CAST(good > 0 AS BIGINT) AS any_passed, count(*) AS n_barcodes, CAST(sum(n) AS BIGINT) AS n_fragments, CAST(sum(good) AS BIGINT) AS n_passed FROM p WHERE r >= 10 GROUP BY 1"""
)
def bc100_tally(spark: SparkSession, d: str) -> DataFrame:
    return fragments.deep_barcode_tally(_fragments(spark, d), depth=10, min_reads=3)


@_query(
    f"""WITH {_FRAGS_SQL}, g AS (SELECT chrom, min_pos - lag(max_pos) OVER (PARTITION BY barcode, chrom ORDER BY min_pos, max_pos) AS gap FROM frags)
SELECT chrom, count(*) AS n_gaps, CAST(sum(CASE WHEN gap >= {10 * DAY} THEN 1 ELSE 0 END) AS BIGINT) AS n_far, max(gap) AS max_gap FROM g WHERE gap > 0 GROUP BY chrom"""
)
def same_bc_far(spark: SparkSession, d: str) -> DataFrame:
    return fragments.same_barcode_gaps(_fragments(spark, d), far=10 * DAY)


@_query(
    f"""WITH {_FRAGS_SQL}, p AS (SELECT barcode FROM frags GROUP BY 1 HAVING count(*) > 1 AND max(n_reads) >= 4)
SELECT barcode, chrom, frag, n_reads, length FROM frags WHERE n_reads < 4 AND barcode IN (SELECT barcode FROM p)"""
)
def secondary_frags(spark: SparkSession, d: str) -> DataFrame:
    return fragments.secondary_fragments(_fragments(spark, d), 4)


@_query(f"WITH {_FRAGS_SQL} SELECT barcode, count(*) AS n_fragments FROM frags GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def top20_barcodes(spark: SparkSession, d: str) -> DataFrame:
    return fragments.top_barcodes(_fragments(spark, d))


@_query(
    f"""WITH {_FRAGS_SQL} SELECT chrom, CAST(sum(n_dup) AS BIGINT) AS n_dup, CAST(sum(n_reads) AS BIGINT) AS n_reads, round(sum(n_dup) / sum(n_reads), 6) AS dup_rate FROM frags GROUP BY 1"""
)
def frag_dup_rate(spark: SparkSession, d: str) -> DataFrame:
    return fragments.duplicate_rate(_fragments(spark, d))


@_query(
    f"""WITH {_FRAGS_SQL} SELECT n.barcode, n.chrom, n.frag,
  CAST(CASE WHEN f.strand = 0 THEN 9 - least(CAST(floor((pos - min_pos) * 10 / length) AS BIGINT), 9) ELSE least(CAST(floor((pos - min_pos) * 10 / length) AS BIGINT), 9) END AS BIGINT) AS bin, count(*) AS n
FROM numbered n JOIN frags f USING (barcode, chrom, frag) GROUP BY ALL"""
)
def coverage_profile(spark: SparkSession, d: str) -> DataFrame:
    return intervals.coverage_profile(_fragments(spark, d))


@_query(
    f"""WITH rs AS (SELECT event_id AS read_id, event_type AS chrom, CAST(user_id AS VARCHAR) AS barcode, epoch_us(ts) AS pos FROM events),
m AS (SELECT *, CASE WHEN pos - lag(pos) OVER w >= {GAP} THEN 1 ELSE 0 END AS s FROM rs WINDOW w AS (PARTITION BY barcode, chrom ORDER BY pos, read_id)),
n AS (SELECT *, sum(s) OVER (PARTITION BY barcode, chrom ORDER BY pos, read_id ROWS UNBOUNDED PRECEDING) AS f FROM m)
SELECT barcode, chrom, count(*) AS n_reads, min(pos) AS first_us, max(pos) AS last_us FROM n GROUP BY barcode, chrom, f"""
)
def session_fragments(spark: SparkSession, d: str) -> DataFrame:
    """The streaming operator over the batch table."""
    rows = _table(spark, d, "events").selectExpr("cast(user_id as string) as barcode", "user_id", "event_type as chrom", "cast(ts as timestamp) as ts")
    found = sessions.stream_sessions(rows, GAP // 1_000_000)
    return found.select("barcode", "chrom", "n_reads", F.unix_micros("first").alias("first_us"), F.unix_micros("last").alias("last_us"))


# --- intervals and depth -------------------------------------------------------------------------------


@_query(
    f"""WITH {_orders_sql()} {_ISLANDS_SQL} SELECT chrom, min(s) AS "start", max(e) AS "end", count(*) AS n_merged, max(e) - min(s) + 1 AS span FROM ii GROUP BY chrom, i"""
)
def interval_merge(spark: SparkSession, d: str) -> DataFrame:
    return intervals.merge_intervals(_orders(spark, d))


@_query(f"""WITH {_orders_sql()} SELECT chrom, min(s) AS "start", max(e) AS "end", count(*) AS n_rows FROM iv GROUP BY chrom""")
def interval_bounds(spark: SparkSession, d: str) -> DataFrame:
    return intervals.bounds(_orders(spark, d), ["chrom"])


@_query(
    f"""WITH {_orders_sql()} SELECT a.chrom, a.name AS l_name, b.name AS r_name, least(a.e, b.e) - greatest(a.s, b.s) AS shared
FROM iv a JOIN iv b ON a.chrom = b.chrom AND a.name < b.name AND a.s < b.e AND b.s < a.e"""
)
def interval_overlap(spark: SparkSession, d: str) -> DataFrame:
    iv = _orders(spark, d).select("chrom", "start", "end", "name")
    pairs = intervals.overlap_join(iv, iv, "chrom", bin_size=16).filter("l_name < r_name")
    return pairs.select("chrom", "l_name", "r_name", (F.least("l_end", "r_end") - F.greatest("l_start", "r_start")).alias("shared"))


@_query(
    f"""WITH {_orders_sql()} {_ISLANDS_SQL}, r AS (SELECT chrom, name, weight, row_number() OVER (PARTITION BY chrom, i ORDER BY weight DESC, name) AS k FROM ii)
SELECT chrom, name, weight FROM r WHERE k = 1"""
)
def longest_of_island(spark: SparkSession, d: str) -> DataFrame:
    return intervals.longest_of_island(_orders(spark, d))


@_query(f"WITH {_DEPTH_SQL} SELECT depth, CAST(sum(e - s) AS BIGINT) AS n_bases FROM runs GROUP BY depth")
def depth_hist(spark: SparkSession, d: str) -> DataFrame:
    return intervals.depth_histogram(_depth(spark, d))


@_query(
    f"""WITH {_DEPTH_SQL}, h AS (SELECT depth, CAST(sum(e - s) AS BIGINT) AS n_bases FROM runs GROUP BY depth), c AS (SELECT *, sum(n_bases) OVER (ORDER BY depth DESC) AS a FROM h)
SELECT depth, n_bases, CAST(a AS BIGINT) AS at_least, round(a / (SELECT sum(n_bases) FROM h), 6) AS share FROM c"""
)
def depth_cumulative(spark: SparkSession, d: str) -> DataFrame:
    return intervals.depth_cumulative(intervals.depth_histogram(_depth(spark, d)))


@_query(
    f"""WITH {_DEPTH_SQL} SELECT chrom, CAST(sum(e - s) AS BIGINT) AS covered, round(sum((e - s) * depth) / sum(e - s), 6) AS mean_depth,
  {', '.join(f'CAST(sum(CASE WHEN depth >= {k} THEN e - s ELSE 0 END) AS BIGINT) AS ge_{k}x' for k in (4, 10, 20))} FROM runs GROUP BY chrom"""
)
def coverage_thresholds(spark: SparkSession, d: str) -> DataFrame:
    return intervals.coverage_thresholds(_depth(spark, d))


@_query(
    f"""WITH {_DEPTH_SQL.replace('iv AS', 'iv0 AS').replace('FROM iv ', 'FROM iv0 ')}, iv AS (SELECT chrom, s, e FROM runs WHERE depth < 2) {_ISLANDS_SQL}
SELECT chrom, min(s) AS "start", max(e) AS "end", count(*) AS n_merged, max(e) - min(s) + 1 AS span FROM ii GROUP BY chrom, i"""
)
def low_cov_gaps(spark: SparkSession, d: str) -> DataFrame:
    return intervals.low_coverage(_depth(spark, d), 2)


# --- alignment metrics -----------------------------------------------------------------------------------


@_query(
    f"""WITH {_READS_SQL}, r AS (SELECT *, (flag & 2304) = 0 AS c, (flag & 2304) = 0 AND (flag & 4) = 0 AS m FROM reads)
SELECT CAST(sum(CAST(c AS INT)) AS BIGINT) AS clean, CAST(sum(CAST(m AS INT)) AS BIGINT) AS mapped, CAST(sum(CAST(m AND mapq >= 1 AS INT)) AS BIGINT) AS uniq,
  CAST(sum(CAST(m AND (flag & 1024) <> 0 AS INT)) AS BIGINT) AS dup, CAST(sum(CASE WHEN m THEN bases ELSE 0 END) AS BIGINT) AS bases,
  CAST(sum(CASE WHEN m THEN mismatches ELSE 0 END) AS BIGINT) AS mismatches, round(sum(CAST(m AS INT)) / sum(CAST(c AS INT)), 6) AS map_rate,
  round(sum(CASE WHEN m THEN mismatches END) / sum(CASE WHEN m THEN bases END), 6) AS mismatch_rate FROM r"""
)
def align_metrics(spark: SparkSession, d: str) -> DataFrame:
    return metrics.align_metrics(_reads(spark, d))


@_query(
    f"""WITH {_READS_SQL} SELECT count(*) AS total, {', '.join(f'CAST(sum(CASE WHEN (flag & {b}) <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS {n}' for n, b in (('secondary', 256), ('supplementary', 2048), ('duplicates', 1024), ('unmapped', 4), ('reverse', 16)))} FROM reads"""
)
def flagstat(spark: SparkSession, d: str) -> DataFrame:
    return metrics.flagstat(_reads(spark, d))


@_query(
    f"""WITH {_READS_SQL} SELECT chrom, CAST(sum(CASE WHEN (flag & 4) = 0 THEN 1 ELSE 0 END) AS BIGINT) AS mapped, CAST(sum(CASE WHEN (flag & 4) <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS unmapped FROM reads GROUP BY 1"""
)
def idxstats(spark: SparkSession, d: str) -> DataFrame:
    return metrics.idxstats(_reads(spark, d))


_GC_SQL = f"""r AS (SELECT event_id % 2 AS mate, {_DNA.format('CAST(event_id AS VARCHAR)')} AS seq FROM events),
c AS (SELECT mate, CAST(32 - length(replace(replace(seq, 'G', ''), 'C', '')) AS BIGINT) AS gc, count(*) AS n FROM r GROUP BY 1, 2),
g AS (SELECT mate, gc, coalesce(n, 0) AS n FROM (SELECT DISTINCT mate FROM r) CROSS JOIN (SELECT unnest(range(0, 33)) AS gc) LEFT JOIN c USING (mate, gc)),
p AS (SELECT mate, gc, n, n / sum(n) OVER (PARTITION BY mate) * 100 AS pc, CASE WHEN gc % 9 = 0 THEN 0.0 ELSE 100.0 / 29 END AS ref FROM g)"""


@_query(
    f"""WITH {_GC_SQL} SELECT mate, gc, n, round(pc, 6) AS percent, round(CASE WHEN ref = 0 AND n = 0 THEN 1.0 WHEN ref = 0 THEN 3.0 ELSE least(3.0, pc / ref) END, 2) AS coverage FROM p"""
)
def gc_hist(spark: SparkSession, d: str) -> DataFrame:
    reads = _table(spark, d, "events").selectExpr("event_id % 2 as mate", _DNA.format("cast(event_id as string)") + " as seq")
    reference = spark.range(33).selectExpr("id as gc", "case when id % 9 = 0 then 0.0D else 100.0D / 29 end as ref_percent")
    return metrics.gc_histogram(reads, 32, reference)


@_query(
    f"""WITH {_READS_SQL}, l AS (SELECT chrom, pos // {DAY} AS pos, barcode, read_id, read_id % 3 AS seq FROM reads),
b AS (SELECT chrom, pos, barcode, count(DISTINCT read_id) AS r, count(*) AS k, count(DISTINCT seq) AS s FROM l GROUP BY 1, 2, 3)
SELECT chrom, pos, count(*) AS n_barcodes, CAST(sum(r) AS BIGINT) AS n_reads, CAST(sum(CAST(r = 1 AS INT)) AS BIGINT) AS false_dup, CAST(sum(k - s) AS BIGINT) AS same_seq,
  round(sum(CAST(r = 1 AS INT)) / sum(r), 6) AS false_dup_rate FROM b GROUP BY 1, 2"""
)
def dup_by_locus(spark: SparkSession, d: str) -> DataFrame:
    reads = _reads(spark, d).selectExpr("chrom", f"pos div {DAY} as pos", "barcode", "read_id", "read_id % 3 as seq")
    return metrics.duplicates_by_locus(reads)


@_query(
    f"""WITH {_READS_SQL}, l AS (SELECT read_id, chrom, pos // {DAY} AS pos, row_number() OVER (PARTITION BY chrom, pos // {DAY}, flag & 16, barcode ORDER BY mapq DESC, read_id) AS k FROM reads)
SELECT read_id, chrom, pos, CAST(k > 1 AS BIGINT) AS is_dup FROM l"""
)
def mark_dups(spark: SparkSession, d: str) -> DataFrame:
    return metrics.mark_duplicates(_reads(spark, d).withColumn("pos", F.expr(f"pos div {DAY}")))


@_query(
    """WITH l AS (SELECT event_type AS lane, CAST(user_id AS VARCHAR) AS barcode, count(*) AS n FROM events GROUP BY 1, 2)
SELECT barcode, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_lanes FROM l WHERE n > 5 GROUP BY 1"""
)
def lane_merge(spark: SparkSession, d: str) -> DataFrame:
    lanes = _table(spark, d, "events").groupBy("event_type", F.col("user_id").cast("string").alias("barcode")).agg(F.count(F.lit(1)).alias("n"))
    return metrics.merge_lanes(lanes, 5)


@_query(
    f"""WITH r AS (SELECT {_DNA.format('CAST(event_id AS VARCHAR)')} AS seq FROM events)
SELECT count(*) AS n_reads, CAST(sum(CASE WHEN substr(seq, 6, 3) = 'ACG' THEN 1 ELSE 0 END) AS BIGINT) AS n_hits, round(avg(CASE WHEN substr(seq, 6, 3) = 'ACG' THEN 1.0 ELSE 0.0 END), 6) AS frequency FROM r"""
)
def adapter_freq(spark: SparkSession, d: str) -> DataFrame:
    reads = _table(spark, d, "events").selectExpr(_DNA.format("cast(event_id as string)") + " as seq")
    return metrics.adapter_frequency(reads, F.lit("ACG"), 6, 3)


@_query(
    """WITH p AS (SELECT DISTINCT substr(a, i, 23) AS w FROM (SELECT text AS a, unnest(range(1, length(text) - 21)) AS i FROM benchmark WHERE length(text) >= 23)),
r AS (SELECT doc_id AS read_id, text AS seq, unnest(range(1, length(text) - 21)) AS i FROM documents WHERE length(text) >= 23),
h AS (SELECT read_id, min(i) AS pt FROM r WHERE substr(seq, i, 23) IN (SELECT w FROM p) GROUP BY 1)
SELECT d.doc_id AS read_id, CASE WHEN pt IS NULL THEN text ELSE substr(text, 1, pt - 1) END AS seq, CAST(CASE WHEN pt IS NULL THEN length(text) ELSE pt - 1 END AS BIGINT) AS kept,
  CAST(pt IS NOT NULL AS BIGINT) AS trimmed FROM documents d LEFT JOIN h ON h.read_id = d.doc_id"""
)
def adapter_trim(spark: SparkSession, d: str) -> DataFrame:
    reads = _table(spark, d, "documents").selectExpr("doc_id as read_id", "text as seq")
    return metrics.adapter_trim(reads, _table(spark, d, "benchmark").selectExpr("text as adapter"), 23, mismatches=0)


@_query(
    """SELECT lang, count(*) AS n, round(avg(length(text)), 4) AS mean, round(stddev_samp(length(text)), 4) AS std, min(length(text)) AS min, round(quantile_cont(length(text), 0.1), 4) AS p10,
  round(median(length(text)), 4) AS median, round(quantile_cont(length(text), 0.9), 4) AS p90, max(length(text)) AS max FROM documents GROUP BY lang"""
)
def length_stats(spark: SparkSession, d: str) -> DataFrame:
    return metrics.length_stats(_table(spark, d, "documents"), F.length("text"), "lang")


# --- demultiplexing and sequences --------------------------------------------------------------------------

_LIST_SQL = f"""w AS (SELECT CAST(p_partkey AS VARCHAR) AS barcode_id, p_partkey AS line_no, substr({_DNA.format('CAST(p_partkey AS VARCHAR)')}, 1, 10) AS barcode FROM part),
nb AS (SELECT barcode_id, line_no, CASE WHEN i = 0 THEN barcode ELSE substr(barcode, 1, i - 1) || b || substr(barcode, i + 1) END AS segment FROM w, (SELECT unnest(range(0, 11)) AS i), (SELECT unnest(['A', 'G', 'C', 'T']) AS b)),
near AS (SELECT segment, arg_max(barcode_id, line_no) AS barcode_id FROM nb GROUP BY 1),
r AS (SELECT o_orderkey AS ord, substr({_DNA.format('CAST(1 + o_orderkey % 97 AS VARCHAR)')}, 1, 10) || 'GGGGGG' || substr({_DNA.format('CAST(1 + o_custkey % 89 AS VARCHAR)')}, 1, 9)
  || 'A' || 'GGGGGG' || substr({_DNA.format('CAST(o_orderkey AS VARCHAR)')}, 1, 10) AS seq FROM orders),
dm AS (SELECT ord, x.barcode_id AS b1, y.barcode_id AS b2, z.barcode_id AS b3, CASE WHEN x.segment IS NULL OR y.segment IS NULL OR z.segment IS NULL THEN '0_0_0'
  ELSE x.barcode_id || '_' || y.barcode_id || '_' || z.barcode_id END AS barcode FROM r LEFT JOIN near x ON x.segment = substr(seq, 1, 10) LEFT JOIN near y ON y.segment = substr(seq, 17, 10) LEFT JOIN near z ON z.segment = substr(seq, 33, 10))"""


def _demuxed(spark: SparkSession, d: str) -> DataFrame:
    whitelist = _table(spark, d, "part").selectExpr("cast(p_partkey as string) as barcode_id", "p_partkey as line_no", f"substr({_DNA.format('cast(p_partkey as string)')}, 1, 10) as barcode")
    reads = _table(spark, d, "orders").selectExpr(
        "o_orderkey as ord",
        f"concat(substr({_DNA.format('cast(1 + o_orderkey % 97 as string)')}, 1, 10), 'GGGGGG', substr({_DNA.format('cast(1 + o_custkey % 89 as string)')}, 1, 9), 'A', 'GGGGGG', substr({_DNA.format('cast(o_orderkey as string)')}, 1, 10)) as seq",
    )
    return demux.demux(reads, whitelist)


@_query(f"WITH {_LIST_SQL} SELECT ord, b1, b2, b3, barcode FROM dm")
def demux_segments(spark: SparkSession, d: str) -> DataFrame:
    return _demuxed(spark, d).select("ord", "b1", "b2", "b3", "barcode")


@_query(
    f"""WITH {_LIST_SQL} SELECT count(*) AS n_reads, CAST(sum(CASE WHEN barcode <> '0_0_0' THEN 1 ELSE 0 END) AS BIGINT) AS n_split, count(b1) AS hits_1, count(b2) AS hits_2, count(b3) AS hits_3,
  count(DISTINCT CASE WHEN barcode <> '0_0_0' THEN barcode END) AS n_barcodes FROM dm"""
)
def demux_summary(spark: SparkSession, d: str) -> DataFrame:
    return demux.demux_summary(_demuxed(spark, d))


@_query(
    f"""WITH {_LIST_SQL} SELECT CASE WHEN barcode <> '0_0_0' THEN 'main' ELSE 'noBC_' || CASE WHEN b1 IS NULL THEN '0' ELSE '1' END || CASE WHEN b2 IS NULL THEN '0' ELSE '1' END || CASE WHEN b3 IS NULL THEN '0' ELSE '1' END END AS route,
  count(*) AS n FROM dm GROUP BY 1"""
)
def demux_routes(spark: SparkSession, d: str) -> DataFrame:
    return demux.demux_route(_demuxed(spark, d)).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@_query(f"WITH {_LIST_SQL} SELECT barcode, count(*) AS cnt, min(ord) AS first_ord FROM dm WHERE barcode <> '0_0_0' GROUP BY 1")
def split_log(spark: SparkSession, d: str) -> DataFrame:
    return demux.barcode_counts(_demuxed(spark, d))


_DOC_DNA_SQL = _DNA.format("text")


@_query(f"SELECT doc_id, reverse(translate({_DOC_DNA_SQL}, 'ACGT', 'TGCA')) AS rc, CAST(32 - length(replace(replace({_DOC_DNA_SQL}, 'G', ''), 'C', '')) AS BIGINT) AS gc FROM documents")
def revcomp(spark: SparkSession, d: str) -> DataFrame:
    seq = F.expr(_DNA.format("text"))
    return _table(spark, d, "documents").select("doc_id", S.reverse_complement(seq).alias("rc"), S.gc_count(seq).cast("long").alias("gc"))


@_query(f"WITH r AS (SELECT {_DOC_DNA_SQL} AS s, unnest(range(1, 29)) AS i FROM documents) SELECT substr(s, i, 5) AS kmer, count(*) AS n FROM r GROUP BY 1")
def kmer_counts(spark: SparkSession, d: str) -> DataFrame:
    return placement.kmer_counts(_table(spark, d, "documents").selectExpr(_DNA.format("text") + " as seq"), "seq", 5)


@_query("SELECT DISTINCT text FROM documents")
def exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "documents").select("text").distinct()


@_query(
    f"""WITH r AS (SELECT DISTINCT source AS barcode, {_DOC_DNA_SQL} AS seq FROM documents), x AS (SELECT barcode, seq, reverse(translate(seq, 'ACGT', 'TGCA')) AS t, unnest(range(1, 26)) AS i FROM r),
m AS (SELECT barcode, seq, min(least(substr(seq, i, 8), substr(t, i, 8))) AS minimizer FROM x GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY barcode, minimizer ORDER BY length(seq) DESC, seq) AS r FROM m)
SELECT barcode, seq, minimizer FROM k WHERE r <= 1"""
)
def minimizer_dedup(spark: SparkSession, d: str) -> DataFrame:
    reads = _table(spark, d, "documents").selectExpr("source as barcode", _DNA.format("text") + " as seq")
    return placement.minimizer_dedup(reads, k=8, keep=1)


@_query(
    f"""WITH b AS (SELECT DISTINCT substr({_DNA.format('CAST(c_custkey AS VARCHAR)')}, 1, 6) AS x FROM customer)
SELECT p.x AS a, q.x AS b FROM b p JOIN b q ON p.x < q.x WHERE {' + '.join(f'CAST(substr(p.x, {i}, 1) <> substr(q.x, {i}, 1) AS INT)' for i in range(1, 7))} = 1"""
)
def hamming_neighbours(spark: SparkSession, d: str) -> DataFrame:
    codes = _table(spark, d, "customer").selectExpr(f"substr({_DNA.format('cast(c_custkey as string)')}, 1, 6) as barcode").distinct()
    return demux.hamming_neighbours(codes, 6)


_CIGAR = "{c}(cast(1 + l_orderkey % 90 as {s}), 'M', cast(l_linenumber as {s}), case when l_partkey % 3 = 0 then 'D' else 'I' end, cast(l_suppkey % 50 as {s}), 'M', cast(l_partkey % 9 as {s}), 'S')"


@_query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 1 + l_orderkey % 90 + l_suppkey % 50 AS matched FROM lineitem")
def cigar_match(spark: SparkSession, d: str) -> DataFrame:
    cigar = F.expr(_CIGAR.format(c="concat", s="string"))
    return _table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", S.cigar_matched(cigar).alias("matched"))


# --- placement and read-back ----------------------------------------------------------------------------------

_MOLECULE = "concat({0}, {1}, {2})".format(*[_DNA.format(f"concat(cast(p_partkey as {{s}}), '_{i}')") for i in range(3)])


def _molecules(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "part").selectExpr("cast(p_partkey as string) as barcode", "0 as target_id", _MOLECULE.format(s="string") + " as seq")


def _molecule_reads(spark: SparkSession, d: str) -> DataFrame:
    cut = "array(substr(seq, 1, 56), substr(seq, 21, 56), reverse(translate(substr(seq, 41, 56), 'ACGT', 'TGCA')), substr(seq, 9, 60))"
    return _molecules(spark, d).selectExpr("barcode", f"posexplode({cut}) as (read_id, seq)")


_PLACE_SQL = f"""m AS (SELECT CAST(p_partkey AS VARCHAR) AS barcode, {_MOLECULE.format(s='VARCHAR')} AS seq FROM part),
rd AS (SELECT barcode, i AS read_id, CASE i WHEN 0 THEN substr(seq, 1, 56) WHEN 1 THEN substr(seq, 21, 56) WHEN 2 THEN reverse(translate(substr(seq, 41, 56), 'ACGT', 'TGCA')) ELSE substr(seq, 9, 60) END AS seq
  FROM m, (SELECT unnest(range(0, 4)) AS i)),
st AS (SELECT barcode, read_id, '+' AS strand, seq FROM rd UNION ALL SELECT barcode, read_id, '-', reverse(translate(seq, 'ACGT', 'TGCA')) FROM rd),
q AS (SELECT barcode, read_id, strand, i - 1 AS qpos, substr(seq, i, 17) AS w FROM (SELECT *, unnest(range(1, length(seq) - 15)) AS i FROM st)),
t AS (SELECT barcode, i - 1 AS tpos, substr(seq, i, 17) AS w, count(*) OVER (PARTITION BY barcode, substr(seq, i, 17)) AS c FROM (SELECT *, unnest(range(1, length(seq) - 15)) AS i FROM m)),
dg AS (SELECT q.barcode, read_id, strand, tpos - qpos AS pt, count(DISTINCT qpos) AS n, max(qpos) - min(qpos) + 17 AS span FROM q JOIN t ON q.barcode = t.barcode AND q.w = t.w AND t.c <= 12 GROUP BY 1, 2, 3, 4),
bs AS (SELECT *, rank() OVER (PARTITION BY barcode, read_id, strand ORDER BY n DESC) AS k FROM dg WHERE n >= 3 AND span >= 40),
u AS (SELECT barcode, read_id, strand, min(pt) AS pt FROM bs WHERE k = 1 GROUP BY 1, 2, 3 HAVING count(*) = 1),
pl AS (SELECT barcode, read_id, min(pt) AS pt, min(strand) AS strand FROM u GROUP BY 1, 2 HAVING count(*) = 1)"""


@_query(f'WITH {_PLACE_SQL} SELECT barcode, CAST(read_id AS INT) AS read_id, 0 AS target_id, CAST(pt AS BIGINT) AS "start", strand FROM pl')
def kmer_placement(spark: SparkSession, d: str) -> DataFrame:
    return placement.placements(_molecule_reads(spark, d), _molecules(spark, d))


@_query(
    f"""WITH {_PLACE_SQL}, sp AS (SELECT pl.barcode, greatest(pt, 0) AS a, least(pt + length(rd.seq), 96) AS b FROM pl JOIN rd USING (barcode, read_id)),
cv AS (SELECT barcode, p, count(*) AS dp FROM (SELECT barcode, unnest(range(a, b)) AS p FROM sp) GROUP BY 1, 2),
br AS (SELECT barcode, count(*) AS c1, count(CASE WHEN dp >= 2 THEN 1 END) AS c2 FROM cv GROUP BY 1)
SELECT sp.barcode, 0 AS target_id, count(*) AS placed_reads, round(any_value(c1) / 96, 6) AS breadth_1x, round(any_value(c2) / 96, 6) AS breadth_2x, CAST(sum(CAST(a <= 20 AS INT)) AS BIGINT) AS left_end_reads,
  CAST(sum(CAST(b >= 76 AS INT)) AS BIGINT) AS right_end_reads, CAST(sum(CAST(a <= 20 AS INT)) >= 2 AND sum(CAST(b >= 76 AS INT)) >= 2 AS BIGINT) AS two_end_supported FROM sp JOIN br USING (barcode) GROUP BY 1"""
)
def readback_support(spark: SparkSession, d: str) -> DataFrame:
    reads, targets = _molecule_reads(spark, d), _molecules(spark, d)
    return placement.read_back(placement.placements(reads, targets), reads, targets)


# --- calibration, verdicts, selections ----------------------------------------------------------------------------


@_query(
    """WITH p AS (SELECT log2(p_retailprice + 1) AS x, log2(CAST(coalesce(n, 0) AS DOUBLE) + 1) AS y FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_partkey = p_partkey),
r AS (SELECT x, y, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2 AS rx, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2 AS ry FROM p)
SELECT count(*) AS n, round(corr(x, y), 6) AS pearson, round(regr_r2(y, x), 6) AS r2, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept, round(corr(rx, ry), 6) AS spearman FROM r"""
)
def spike_in_corr(spark: SparkSession, d: str) -> DataFrame:
    truth = _table(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_retailprice")
    counts = _table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    pairs = calibration.spike_counts(truth, counts, "id")
    return calibration.dose_response(pairs.select(calibration.log2p1(F.col("p_retailprice")).alias("x"), calibration.log2p1(F.col("n")).alias("y")))


@_query(
    """WITH o AS (SELECT r_name AS species, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1), w AS (SELECT sum(n) AS a FROM o)
SELECT r_name AS species, round(coalesce(n, 0) / a * 100, 6) AS observed, 20.0::DOUBLE AS expected, round(coalesce(n, 0) / a * 100 - 20, 6) AS difference, round(coalesce(n, 0) / a * 100 / 20, 6) AS fold FROM region LEFT JOIN o ON r_name = species, w"""
)
def abundance(spark: SparkSession, d: str) -> DataFrame:
    nation, region = _table(spark, d, "nation"), _table(spark, d, "region")
    names = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("species"))
    seen = _table(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n")).join(names, F.col("c_nationkey") == F.col("n_nationkey"))
    return calibration.abundance(seen, region.select(F.col("r_name").alias("species"), F.lit(20.0).alias("expected")))


@_query(
    """WITH l AS (SELECT doc_id, min(quality) AS q, max(toxic) AS t FROM labels GROUP BY 1)
SELECT d.doc_id AS barcode, CASE WHEN l.doc_id IS NULL THEN NULL WHEN q = 1 THEN 0.97::DOUBLE ELSE 0.5::DOUBLE END AS breadth_1x, CASE WHEN t = 1 THEN 'Y' ELSE 'N' END AS chimera, CASE WHEN n_chars < 100 THEN 1 ELSE 0 END AS junction_suspect,
  CAST(l.doc_id IS NULL OR q <> 1 OR t = 1 OR n_chars < 100 AS BIGINT) AS low_confidence FROM documents d LEFT JOIN l USING (doc_id)"""
)
def qc_verdict(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents").select(F.col("doc_id").alias("barcode"), "n_chars")
    flags = _table(spark, d, "labels").groupBy(F.col("doc_id").alias("barcode")).agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    back = flags.select("barcode", F.when(F.col("q") == 1, 0.97).otherwise(0.5).alias("breadth_1x"))
    chimera = flags.select("barcode", F.when(F.col("t") == 1, "Y").otherwise("N").alias("chimera"))
    suspect = docs.select("barcode", (F.col("n_chars") < 100).cast("int").alias("junction_suspect"))
    return calibration.verdict(docs.select("barcode"), back, chimera, suspect)


@_query(
    """SELECT query, matches, block, mapq FROM (SELECT l_orderkey AS query, CAST(l_quantity AS BIGINT) AS matches, l_partkey AS block, l_suppkey % 61 AS mapq,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY CAST(l_quantity AS BIGINT) DESC, l_partkey DESC, l_suppkey % 61 DESC, l_linenumber) AS k FROM lineitem) WHERE k = 1"""
)
def best_paf(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "lineitem").selectExpr("l_orderkey as query", "cast(l_quantity as bigint) as matches", "l_partkey as block", "l_suppkey % 61 as mapq", "l_linenumber as line")
    order = [F.desc("matches"), F.desc("block"), F.desc("mapq"), F.col("line")]
    return calibration.best_by(rows, "query", order, ["matches", "block", "mapq"])


@_query("SELECT barcode, contig_ix, len FROM (SELECT source AS barcode, doc_id AS contig_ix, n_chars AS len, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS k FROM documents) WHERE k = 1")
def longest_contig(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents").select(F.col("source").alias("barcode"), F.struct(F.col("n_chars").alias("len"), (-F.col("doc_id")).alias("i")).alias("s"))
    return docs.groupBy("barcode").agg(F.max("s").alias("s")).select("barcode", (-F.col("s.i")).alias("contig_ix"), F.col("s.len").alias("len"))


@_query(f"WITH {_BC_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE {_BC} IN (SELECT barcode FROM bc WHERE n_reads >= 10)")
def semi_filter(spark: SparkSession, d: str) -> DataFrame:
    kept = _bc_counts(spark, d).filter("n_reads >= 10").select("barcode")
    return _table(spark, d, "lineitem").withColumn("barcode", F.expr(_BC)).join(kept, "barcode", "left_semi").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@_query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_split(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "documents").select("doc_id", "source").join(_table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")


# --- phasing ------------------------------------------------------------------------------------------------------


def _alleles(spark: SparkSession, d: str) -> DataFrame:
    ord_ = F.row_number().over
    from pyspark.sql import Window

    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    return _table(spark, d, "lineitem").select(
        F.lit("chr1").alias("chrom"), F.col("l_orderkey").alias("block"), ord_(order).cast("long").alias("ord"), F.col("l_partkey").alias("pos"),
        (F.col("l_partkey") % 2).alias("a1"), (F.col("l_suppkey") % 2).alias("t1"),
    )


_ALLELES_SQL = """al AS (SELECT 'chr1' AS chrom, l_orderkey AS block, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS ord, l_partkey AS pos, l_partkey % 2 AS a1, l_suppkey % 2 AS t1 FROM lineitem)"""


@_query(f"WITH {_ALLELES_SQL} SELECT chrom, block, arg_min(pos, ord) AS first_pos, arg_max(pos, ord) AS last_pos, count(*) AS n_snps FROM al GROUP BY 1, 2")
def hapblock_bounds(spark: SparkSession, d: str) -> DataFrame:
    return phasing.block_bounds(_alleles(spark, d))


@_query(f"WITH {_ALLELES_SQL} SELECT chrom, block, CAST(least(sum(CAST(a1 <> t1 AS INT)), count(*) - sum(CAST(a1 <> t1 AS INT))) AS BIGINT) AS flat, count(*) AS n_snps FROM al GROUP BY 1, 2")
def flat_error(spark: SparkSession, d: str) -> DataFrame:
    return phasing.flat_error(_alleles(spark, d))


@_query(f"WITH {_ALLELES_SQL} SELECT chrom, block, CAST(CASE WHEN count(*) >= 4 THEN count(*) - 3 ELSE 0 END AS BIGINT) AS poss_sw, CAST(CASE WHEN count(*) >= 2 THEN count(*) ELSE 0 END AS BIGINT) AS poss_mm FROM al GROUP BY 1, 2")
def switch_opportunity(spark: SparkSession, d: str) -> DataFrame:
    return phasing.opportunities(_alleles(spark, d))


@_query(
    """WITH s AS (SELECT lang AS grp, n_chars AS span, doc_id AS tie FROM documents), c AS (SELECT *, sum(span) OVER (PARTITION BY grp ORDER BY span DESC, tie DESC ROWS UNBOUNDED PRECEDING) AS r, sum(span) OVER (PARTITION BY grp) AS a FROM s)
SELECT grp, max(span) AS n50 FROM c WHERE 2 * r > a GROUP BY 1"""
)
def n50(spark: SparkSession, d: str) -> DataFrame:
    return phasing.n50(_table(spark, d, "documents").select(F.col("lang").alias("grp"), F.col("n_chars").alias("span"), F.col("doc_id").alias("tie")), by="grp")


def _marked_alleles(spark: SparkSession, d: str) -> DataFrame:
    """Alleles over three chromosomes; some of both haplotypes are missing."""
    part = lambda n: F.col("l_quantity").cast("long") % n == 0
    rows = _alleles(spark, d).drop("chrom")
    marks = _table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("block"), "l_linenumber", F.col("l_partkey").alias("pos"), "l_suppkey", part(11).alias("no_a"), part(13).alias("no_t")
    )
    from pyspark.sql import Window

    order = Window.partitionBy("block").orderBy("l_linenumber", "pos", "l_suppkey")
    marks = marks.select("block", F.row_number().over(order).cast("long").alias("ord"), "no_a", "no_t")
    return rows.join(marks, ["block", "ord"]).select(
        F.concat(F.lit("chr"), (F.col("block") % 3 + 1).cast("string")).alias("chrom"), "block", "ord", "pos",
        F.when(F.col("no_a"), "-").otherwise(F.col("a1").cast("string")).alias("a1"), F.when(F.col("no_t"), "-").otherwise(F.col("t1").cast("string")).alias("t1"),
    )


_MARKED_SQL = """al AS (SELECT 'chr' || (l_orderkey % 3 + 1) AS chrom, l_orderkey AS block, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS ord, l_partkey AS pos,
  CASE WHEN CAST(floor(l_quantity) AS BIGINT) % 11 = 0 THEN '-' ELSE CAST(l_partkey % 2 AS VARCHAR) END AS a1, CASE WHEN CAST(floor(l_quantity) AS BIGINT) % 13 = 0 THEN '-' ELSE CAST(l_suppkey % 2 AS VARCHAR) END AS t1 FROM lineitem)"""
_SWITCH_SQL = f"""{_MARKED_SQL}, kn AS (SELECT chrom, block, ord, a1 <> t1 AS bit, row_number() OVER (PARTITION BY block ORDER BY ord) AS n, count(*) OVER (PARTITION BY block) AS total FROM al WHERE a1 <> '-' AND t1 <> '-'),
ch AS (SELECT *, CASE WHEN n > 1 AND bit <> lag(bit) OVER (PARTITION BY block ORDER BY ord) THEN 1 ELSE 0 END AS c, ord - lag(ord) OVER (PARTITION BY block ORDER BY ord) > 1 AS gap FROM kn),
nr AS (SELECT *, sum(1 - c) OVER (PARTITION BY block ORDER BY ord) AS run FROM ch),
ru AS (SELECT block, run, count(*) + CASE WHEN min(n) = 2 THEN (coalesce(min(CASE WHEN gap THEN n END), max(n) + 1) - 2) % 2 ELSE 0 END AS len, max(n) = max(total) AS ends FROM nr WHERE c = 1 GROUP BY 1, 2),
er AS (SELECT block, sum(CASE WHEN ends THEN 0 ELSE len % 2 END) AS sw, sum(len // 2 + CASE WHEN ends THEN len % 2 ELSE 0 END) AS mm FROM ru GROUP BY 1),
se AS (SELECT b.chrom, b.block, CAST(coalesce(sw, 0) AS BIGINT) AS switches, CAST(coalesce(mm, 0) AS BIGINT) AS mismatches FROM (SELECT DISTINCT chrom, block FROM al) b LEFT JOIN er USING (block))"""


@_query(f"WITH {_SWITCH_SQL} SELECT * FROM se")
def switch_error(spark: SparkSession, d: str) -> DataFrame:
    return phasing.switch_errors(_marked_alleles(spark, d))


@_query(
    f"""WITH {_SWITCH_SQL}, pl AS (SELECT chrom, block, count(*) AS n, sum(CAST(a1 <> t1 AS INT)) AS w FROM al WHERE a1 <> '-' AND t1 <> '-' GROUP BY 1, 2),
j AS (SELECT se.*, coalesce(n, 0) AS n, coalesce(w, 0) AS w FROM se LEFT JOIN pl USING (chrom, block)), t AS (SELECT * FROM j UNION ALL SELECT 'total', block, switches, mismatches, n, w FROM j)
SELECT chrom, round(sum(switches) / sum(greatest(n - 3, 0)), 6) AS switch_rate, round(sum(mismatches) / sum(CASE WHEN n >= 2 THEN n ELSE 0 END), 6) AS mismatch_rate,
  round(sum(switches + mismatches) / sum(CASE WHEN n >= 2 THEN n ELSE 0 END), 6) AS combined_rate, round(sum(least(w, n - w)) / sum(CASE WHEN n >= 2 THEN n ELSE 0 END), 6) AS flat_rate FROM t GROUP BY 1"""
)
def phasing_rates(spark: SparkSession, d: str) -> DataFrame:
    alleles = _marked_alleles(spark, d)
    return phasing.phasing_rates(phasing.switch_errors(alleles), phasing.opportunities(alleles), phasing.flat_error(alleles))


@_query(
    f"""WITH {_MARKED_SQL}, sz AS (SELECT chrom, count(*) AS n_snps, count(*) AS n_covered, CAST(sum(pos) AS BIGINT) AS length FROM al GROUP BY 1),
sp AS (SELECT chrom, block, count(*) AS phased, arg_max(pos, ord) - arg_min(pos, ord) AS span, round((arg_max(pos, ord) - arg_min(pos, ord)) * count(*) / (max(ord) - min(ord) + 1), 6) AS adjusted FROM al WHERE a1 <> '-' GROUP BY 1, 2),
pt AS (SELECT chrom, n_snps, n_covered, length, (SELECT sum(phased) FROM sp WHERE sp.chrom = sz.chrom) AS phased, (SELECT max(phased) FROM sp WHERE sp.chrom = sz.chrom) AS top FROM sz),
tt AS (SELECT chrom, sum(n_snps) AS n_snps, sum(n_covered) AS n_covered, sum(length) AS length, sum(phased) AS phased, sum(top) AS top FROM (SELECT * FROM pt UNION ALL SELECT 'total', n_snps, n_covered, length, phased, top FROM pt) GROUP BY 1),
sb AS (SELECT * FROM sp UNION ALL SELECT 'total', block, phased, span, adjusted FROM sp),
an AS (SELECT chrom, adjusted, sum(phased) OVER (PARTITION BY chrom ORDER BY adjusted DESC, phased DESC, block ROWS UNBOUNDED PRECEDING) AS r FROM sb),
n5 AS (SELECT chrom, span, sum(span) OVER (PARTITION BY chrom ORDER BY span DESC, block ROWS UNBOUNDED PRECEDING) AS r FROM sb)
SELECT chrom, CAST(phased AS BIGINT) AS phased, round(1 - phased / n_covered, 6) AS missing_rate, coalesce((SELECT max(adjusted) FROM an WHERE an.chrom = tt.chrom AND 2 * r > n_snps), 0) AS an50,
  CAST(coalesce((SELECT max(span) FROM n5 WHERE n5.chrom = tt.chrom AND 2 * r > length), 0) AS BIGINT) AS n50, round(top / n_snps, 6) AS max_block_share FROM tt"""
)
def phasing_completeness(spark: SparkSession, d: str) -> DataFrame:
    alleles = _marked_alleles(spark, d)
    n = F.count(F.lit(1))
    sizes = alleles.groupBy("chrom").agg(n.alias("n_snps"), n.alias("n_covered"), F.sum("pos").alias("length"))
    return phasing.completeness(alleles, sizes)


@_query(
    f"""WITH {_ALLELES_SQL}, vc AS (SELECT ord, min(pos) AS p FROM al GROUP BY 1)
SELECT 'chr1' AS chrom, block, al.ord, a1, p AS pos, CAST(block % 2 = 0 AND al.pos <> p AS INT) AS conflict FROM al JOIN vc USING (ord)"""
)
def block_positions(spark: SparkSession, d: str) -> DataFrame:
    alleles = _alleles(spark, d)
    variants = alleles.groupBy("chrom", "ord").agg(F.min("pos").alias("pos"))
    own = F.when(F.col("block") % 2 == 0, F.col("pos"))
    return phasing.numbered_snps(alleles.select("chrom", "block", "ord", "a1", own.alias("pos")), variants)


# --- kernels ------------------------------------------------------------------------------------------------------


_BOTH_WAYS = "least(seq, reverse(translate(seq, 'ACGT', 'TGCA')))"


@_query(f"WITH m AS (SELECT CAST(p_partkey AS VARCHAR) AS barcode, {_MOLECULE.format(s='VARCHAR')} AS seq FROM part) SELECT barcode, CAST(0 AS INT) AS contig_ix, {_BOTH_WAYS} AS seq FROM m")
def assemble_contigs(spark: SparkSession, d: str) -> DataFrame:
    """The reads tile their molecule, so each barcode has one contig, the molecule (the lesser of its strands is given)."""
    found = assemble.assemble_barcodes(_molecule_reads(spark, d), AssembleOptions(min_overlap=25, min_contig=60))
    return found.withColumn("seq", F.expr(_BOTH_WAYS))


@_query()
def conflict_filter(spark: SparkSession, d: str) -> DataFrame:
    return assemble.conflict_filter(_molecule_reads(spark, d).withColumn("read_id", F.col("read_id").cast("long")), min_overlap=20)


def _pools(spark: SparkSession, d: str) -> DataFrame:
    """Reads of two neighbouring molecules under one barcode; in some, copies of the first read stand for those that join theirs."""
    reads = _molecules(spark, d).withColumnRenamed("seq", "whole").join(_molecule_reads(spark, d), "barcode").withColumn("p", F.col("barcode").cast("bigint"))
    kept = reads.withColumn("seq", F.expr("case when p % 5 = 0 and read_id in (1, 3) then substr(whole, 1, 56) else seq end"))
    return kept.select(F.floor(F.col("p") / 2).cast("string").alias("barcode"), (F.col("p") % 2 * 4 + F.col("read_id")).alias("read_id"), "seq")


@_query(
    f"""WITH {_PLACE_SQL}, po AS (SELECT CAST(CAST(barcode AS BIGINT) // 2 AS VARCHAR) AS barcode, CAST(barcode AS BIGINT) % 2 * 4 + read_id AS r, CASE WHEN CAST(barcode AS BIGINT) % 5 = 0 AND read_id IN (1, 3) THEN substr(m.seq, 1, 56) ELSE rd.seq END AS seq FROM rd JOIN m USING (barcode)),
ps AS (SELECT barcode, min(r) AS r, seq FROM po GROUP BY barcode, seq), tg AS (SELECT barcode, r, 0 AS s, seq FROM ps UNION ALL SELECT barcode, r, 1, reverse(translate(seq, 'ACGT', 'TGCA')) FROM ps),
qk AS (SELECT barcode, r, i, substr(seq, i, 17) AS w FROM (SELECT *, unnest(range(1, length(seq) - 15)) AS i FROM ps)), tk AS (SELECT barcode, r, s, i, substr(seq, i, 17) AS w FROM (SELECT *, unnest(range(1, length(seq) - 15)) AS i FROM tg)),
dl AS (SELECT q.barcode, q.r AS a, t.r AS b FROM qk q JOIN tk t ON q.barcode = t.barcode AND q.w = t.w AND q.r < t.r GROUP BY q.barcode, q.r, t.r, t.s, t.i - q.i HAVING count(DISTINCT q.i) >= 3 AND max(q.i) - min(q.i) >= 20),
ed AS (SELECT barcode, a, b FROM dl UNION SELECT barcode, b, a FROM dl UNION SELECT barcode, r, r FROM ps),
l1 AS (SELECT e.barcode, e.a, min(f.b) AS b FROM ed e JOIN ed f ON e.barcode = f.barcode AND e.b = f.a GROUP BY 1, 2), l2 AS (SELECT e.barcode, e.a, min(l.b) AS b FROM ed e JOIN l1 l ON e.barcode = l.barcode AND e.b = l.a GROUP BY 1, 2),
l3 AS (SELECT e.barcode, e.a, min(l.b) AS b FROM ed e JOIN l2 l ON e.barcode = l.barcode AND e.b = l.a GROUP BY 1, 2), l4 AS (SELECT e.barcode, e.a, min(l.b) AS b FROM ed e JOIN l3 l ON e.barcode = l.barcode AND e.b = l.a GROUP BY 1, 2),
gs AS (SELECT barcode, b, count(*) AS n FROM l4 GROUP BY 1, 2)
SELECT barcode, CAST(count(*) AS INT) AS n_groups, round(max(n) / sum(n), 4) AS largest, CAST(count(*) > 1 AND max(n) / sum(n) < 0.9 AS INT) AS suspect FROM gs GROUP BY 1"""
)
def pool_components(spark: SparkSession, d: str) -> DataFrame:
    return assemble.pool_components(_pools(spark, d), min_anchors=3, min_span=20)


@_query()
def junction_profile(spark: SparkSession, d: str) -> DataFrame:
    options = JunctionOptions(margin=10, edge=15, window=20, smooth=11)
    return assemble.junction_qc(_molecules(spark, d).withColumnRenamed("target_id", "contig_ix"), _molecule_reads(spark, d), options)


@_query(
    f"""WITH m AS (SELECT CAST(p_partkey AS VARCHAR) AS barcode, {_MOLECULE.format(s='VARCHAR')} AS seq FROM part) SELECT barcode, seq FROM m"""
)
def consensus(spark: SparkSession, d: str) -> DataFrame:
    cut = "array(struct(0 as start, substr(seq, 1, 56) as s), struct(20 as start, substr(seq, 21, 56) as s), struct(40 as start, substr(seq, 41, 56) as s))"
    rows = _molecules(spark, d).selectExpr("barcode", f"inline({cut})").withColumnRenamed("s", "seq")
    return assemble.consensus(rows)
