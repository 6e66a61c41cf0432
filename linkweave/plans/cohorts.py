"""Registered queries on barcode order, contig comparison, variants and library verdicts, with their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import seq as S
from ..operators import barcodes, calibration, contigs, demux, fragments, variants
from .catalogue import _ALLELES_SQL, _DNA, _FRAGS_SQL, _LIST_SQL, _MOLECULE, _READS_SQL, DAY, _alleles, _fragments, _molecule_reads, _molecules, _query, _reads, _table

# --- order and selection of barcodes --------------------------------------------------------------------

_CODES_SQL = f"codes AS (SELECT DISTINCT substr({_DNA.format('CAST(o_orderkey AS VARCHAR)')}, 1, 12) AS barcode FROM orders), pl AS (SELECT barcode, row_number() OVER (ORDER BY barcode) AS place, count(*) OVER () AS a FROM codes)"


def _codes(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "orders").selectExpr(f"substr({_DNA.format('cast(o_orderkey as string)')}, 1, 12) as barcode")


@_query(
    f"""WITH {_CODES_SQL} SELECT barcode, place, CAST(CASE WHEN place - 1 < (a % 7) * (a // 7 + 1) THEN (place - 1) // (a // 7 + 1) ELSE a % 7 + (place - 1 - (a % 7) * (a // 7 + 1)) // (a // 7) END AS BIGINT) AS part FROM pl"""
)
def barcode_ranges(spark: SparkSession, d: str) -> DataFrame:
    return barcodes.equal_ranges(_codes(spark, d), "barcode", 7)


@_query(f"WITH {_CODES_SQL} SELECT barcode FROM pl WHERE place > greatest((a - 500) // 2, 0) AND place <= greatest((a - 500) // 2, 0) + 500")
def middle_barcodes(spark: SparkSession, d: str) -> DataFrame:
    return barcodes.middle(_codes(spark, d), "barcode", 500)


@_query(
    """WITH g AS (SELECT l_partkey AS barcode, min(l_orderkey * 100 + l_linenumber) AS o FROM lineitem GROUP BY 1), f AS (SELECT barcode FROM g ORDER BY o, barcode LIMIT 20)
SELECT l_partkey AS barcode, l_orderkey * 100 + l_linenumber AS ord FROM lineitem WHERE l_partkey IN (SELECT barcode FROM f)"""
)
def first_barcodes(spark: SparkSession, d: str) -> DataFrame:
    reads = _table(spark, d, "lineitem").selectExpr("l_partkey as barcode", "l_orderkey * 100 + l_linenumber as ord")
    return barcodes.first_groups(reads, 20, "ord")


@_query("SELECT idx, cnt, barcode FROM (SELECT min(l_orderkey) AS idx, count(*) AS cnt, l_partkey AS barcode FROM lineitem GROUP BY 3) WHERE cnt BETWEEN 20 AND 30 ORDER BY idx, barcode LIMIT 25")
def depth_window(spark: SparkSession, d: str) -> DataFrame:
    log = _table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("barcode")).agg(F.min("l_orderkey").alias("idx"), F.count(F.lit(1)).alias("cnt"))
    return barcodes.depth_window(log, 20, 30, 25).select("idx", "cnt", "barcode")


@_query(
    """WITH r AS (SELECT user_id AS barcode, event_id AS read_id, row_number() OVER (PARTITION BY user_id ORDER BY md5(CAST(user_id AS VARCHAR) || ':' || CAST(event_id AS VARCHAR)), event_id) AS k, count(*) OVER (PARTITION BY user_id) AS n FROM events)
SELECT barcode, read_id FROM r WHERE k <= greatest(CAST(floor(n * 0.3) AS BIGINT), 1)"""
)
def umi_downsample(spark: SparkSession, d: str) -> DataFrame:
    return barcodes.downsample(_table(spark, d, "events").select(F.col("user_id").alias("barcode"), F.col("event_id").alias("read_id")), 0.3)


@_query(
    f"""WITH {_FRAGS_SQL}, l AS (SELECT chrom AS lane, count(*) AS n_fragments, count(DISTINCT barcode) AS n_barcodes FROM frags GROUP BY 1),
u AS (SELECT * FROM l UNION ALL SELECT 'all', CAST(sum(n_fragments) AS BIGINT), CAST(sum(n_barcodes) AS BIGINT) FROM l) SELECT *, round(n_fragments / n_barcodes, 6) AS frags_per_bc FROM u"""
)
def lane_ratios(spark: SparkSession, d: str) -> DataFrame:
    return barcodes.lane_ratios(_fragments(spark, d).withColumnRenamed("chrom", "lane"))


_HEADER = "concat('r', cast(event_id as {s}), case when event_id % 9 = 0 then '' else concat('#', case when event_id % 5 = 0 then '' else cast(user_id as {s}) end) end, '/1', case when event_id % 4 = 0 then concat(' BX:Z:', cast(user_id % 20 as {s})) else '' end)"


@_query(
    f"""WITH h AS (SELECT {_HEADER.format(s='varchar')} AS h FROM events), b AS (SELECT coalesce(nullif(regexp_extract(h, 'BX:Z:(\\S+)', 1), ''), nullif(regexp_extract(h, '^[^#]*#([^#/]*)', 1), '')) AS barcode FROM h)
SELECT barcode, count(*) AS cnt FROM b WHERE barcode IS NOT NULL GROUP BY 1"""
)
def tag_log(spark: SparkSession, d: str) -> DataFrame:
    return barcodes.tag_log(_table(spark, d, "events").selectExpr(_HEADER.format(s="string") + " as header"))


_PAIR = "concat('r', cast(event_id as {s}), '/2 x') as header, substr({0}, 1, 20) as seq1, substr({0}, 9, 24) as seq2"


@_query(
    f"""WITH p AS (SELECT {_PAIR.format(_DNA.format('cast(event_id as varchar)'), s='varchar')} FROM events)
SELECT reverse(translate(substr(seq2, 1, 15), 'ACGT', 'TGCA')) AS barcode, reverse(translate(substr(seq2, 1, 18), 'ACGT', 'TGCA')) AS long_barcode, substr(seq2, 19, 6) AS umi,
  split_part(split_part(header, ' ', 1), '/', 1) || '#' || reverse(translate(substr(seq2, 1, 15), 'ACGT', 'TGCA')) || '#' || substr(seq2, 19, 6) AS header FROM p"""
)
def random_barcode_demux(spark: SparkSession, d: str) -> DataFrame:
    pairs = _table(spark, d, "events").selectExpr(*_columns(_PAIR.format(_DNA.format("cast(event_id as string)"), s="string")))
    return barcodes.random_barcode_reads(pairs, 1, 15, 18, 19, 6, turned=True).select("barcode", "long_barcode", "umi", "header")


def _columns(text: str) -> list[str]:
    """Cuts a select list at the commas outside parentheses."""
    out, depth = [""], 0
    for c in text:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


@_query(
    f"""WITH {_LIST_SQL}, rv AS (SELECT CASE WHEN i = 0 THEN t ELSE substr(t, 1, i - 1) || b || substr(t, i + 1) END AS segment FROM (SELECT reverse(translate(barcode, 'ACGT', 'TGCA')) AS t FROM w), (SELECT unnest(range(0, 11)) AS i), (SELECT unnest(['A', 'G', 'C', 'T']) AS b))
SELECT CAST(count(CASE WHEN substr(seq, 33, 10) IN (SELECT segment FROM near) THEN 1 END) AS BIGINT) AS forward, CAST(count(CASE WHEN substr(seq, 33, 10) IN (SELECT segment FROM rv) THEN 1 END) AS BIGINT) AS reverse FROM r"""
)
def orientation_vote(spark: SparkSession, d: str) -> DataFrame:
    whitelist = _table(spark, d, "part").selectExpr("cast(p_partkey as string) as barcode_id", "p_partkey as line_no", f"substr({_DNA.format('cast(p_partkey as string)')}, 1, 10) as barcode")
    reads = _table(spark, d, "orders").selectExpr(f"concat(repeat('G', 32), substr({_DNA.format('cast(o_orderkey as string)')}, 1, 10)) as seq")
    return demux.orientation_vote(reads, whitelist, 33)


@_query(
    """WITH s AS (SELECT n_nationkey + 1 AS samples FROM nation), k AS (SELECT unnest(range(1, 11)) AS k)
SELECT samples, round(3e7 * avg(1 - pow(1 - 1.0::DOUBLE / samples, k)), 2) AS beads, (SELECT round(product(greatest(samples - i, 0) / samples), 8) FROM (SELECT unnest(range(0, 5)) AS i)) AS odds FROM s, k GROUP BY samples"""
)
def bead_odds(spark: SparkSession, d: str) -> DataFrame:
    samples = _table(spark, d, "nation").select((F.col("n_nationkey") + 1).alias("samples"))
    return samples.select("samples", F.round(barcodes.expected_beads(F.lit(3e7), F.col("samples")), 2).alias("beads"), F.round(barcodes.distinct_odds(F.lit(5), F.col("samples")), 8).alias("odds"))


# --- contigs ----------------------------------------------------------------------------------------------


@_query("SELECT CASE WHEN n = 1 THEN 'one' ELSE 'several' END AS kind, count(*) AS n_barcodes, CAST(sum(n) AS BIGINT) AS n_contigs FROM (SELECT l_partkey * 10 + l_linenumber AS b, count(*) AS n FROM lineitem GROUP BY 1) GROUP BY 1")
def contigs_per_barcode(spark: SparkSession, d: str) -> DataFrame:
    return contigs.contigs_per_barcode(_table(spark, d, "lineitem").select((F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("barcode")))


_ARMS = "cast(floor(l_quantity * {k}) as bigint) as len"


def _arm(spark: SparkSession, d: str, k: int) -> DataFrame:
    return _table(spark, d, "lineitem").selectExpr("l_orderkey as barcode", _ARMS.format(k=k))


_ARMS_SQL = "a AS (SELECT l_orderkey AS barcode, max({0}) AS x FROM lineitem GROUP BY 1), b AS (SELECT l_orderkey AS barcode, max({1}) AS y FROM lineitem GROUP BY 1)".format(
    *[_ARMS.format(k=k).removesuffix(" as len") for k in (40, 30)]
)


@_query(f"WITH {_ARMS_SQL} SELECT barcode, x AS old_len, y AS new_len, y - x AS gain FROM a JOIN b USING (barcode) WHERE y > x")
def lengthened_contigs(spark: SparkSession, d: str) -> DataFrame:
    return contigs.lengthened(_arm(spark, d, 40), _arm(spark, d, 30))


@_query(f"WITH {_ARMS_SQL} SELECT barcode, x AS ref_len, y AS own_len, x - y AS gap FROM a JOIN b USING (barcode) WHERE x >= 1000 AND y < 1000")
def shortfall_cohort(spark: SparkSession, d: str) -> DataFrame:
    return contigs.shortfall(_arm(spark, d, 40), _arm(spark, d, 30), 1000)


@_query()
def shortfall_classes(spark: SparkSession, d: str) -> DataFrame:
    whole = _molecules(spark, d)
    own = whole.selectExpr("barcode", "case when cast(barcode as bigint) % 3 = 0 then seq else substr(seq, 25, 50) end as seq")
    return contigs.shortfall_classes(_molecule_reads(spark, d), own, whole.select("barcode", "seq"), edge=10)


_PIECES = "array(substr(seq, 1, 60), substr(seq, 11, 40), substr(seq, 30, 50), substr(seq, 61, 30), substr(seq, 5, 12), substr(seq, 1, 60))"
_PIECES_SQL = f"m AS (SELECT CAST(p_partkey AS VARCHAR) AS barcode, {_MOLECULE.format(s='VARCHAR')} AS seq FROM part), pc AS (SELECT DISTINCT barcode, unnest([{_PIECES[6:-1]}]) AS seq FROM m)"


@_query(f"WITH {_PIECES_SQL} SELECT barcode, seq FROM pc WHERE NOT EXISTS (SELECT 1 FROM pc q WHERE q.barcode = pc.barcode AND length(q.seq) > length(pc.seq) AND contains(q.seq, pc.seq))")
def drop_contained(spark: SparkSession, d: str) -> DataFrame:
    return contigs.drop_contained(_molecules(spark, d).selectExpr("barcode", f"explode({_PIECES}) as seq"))


@_query(
    f"""WITH m AS (SELECT CAST(p_partkey AS VARCHAR) AS barcode, {_MOLECULE.format(s='VARCHAR')} AS seq FROM part), pc AS (SELECT barcode, i AS read_id, substr(seq, 1 + 12 * i, 50) AS seq FROM m, (SELECT unnest(range(0, 4)) AS i)),
w AS (SELECT DISTINCT barcode, read_id, substr(seq, j, 9) AS w FROM (SELECT *, unnest(range(1, length(seq) - 7)) AS j FROM pc)), z AS (SELECT barcode, read_id, count(*) AS n FROM w GROUP BY 1, 2),
s AS (SELECT p.barcode, p.read_id AS a, q.read_id AS b, count(*) AS shared FROM w p JOIN w q ON p.barcode = q.barcode AND p.w = q.w AND p.read_id < q.read_id GROUP BY 1, 2, 3)
SELECT s.barcode, CAST(a AS INT) AS a, CAST(b AS INT) AS b, shared, round(pow(shared / least(x.n, y.n), 1.0::DOUBLE / 9), 6) AS identity FROM s JOIN z x ON x.barcode = s.barcode AND x.read_id = a JOIN z y ON y.barcode = s.barcode AND y.read_id = b"""
)
def kmer_identity(spark: SparkSession, d: str) -> DataFrame:
    cut = "array(" + ", ".join(f"substr(seq, {1 + 12 * i}, 50)" for i in range(4)) + ")"
    return contigs.kmer_identity(_molecules(spark, d).selectExpr("barcode", f"posexplode({cut}) as (read_id, seq)"), 9)


@_query(
    f"""WITH m AS (SELECT CAST(p_partkey AS VARCHAR) AS barcode, {_MOLECULE.format(s='VARCHAR')} AS seq FROM part), own AS (SELECT barcode, substr(seq, 1, 29) || 'A' || substr(seq, 31) AS seq FROM m),
al AS (SELECT barcode, s, substr(seq, s + 1, 50) AS seq FROM m, (SELECT unnest([0, 10, 20]) AS s)),
v AS (SELECT barcode, s + j - 1 AS pt, substr(seq, j, 1) AS base FROM (SELECT *, unnest(range(1, length(seq) + 1)) AS j FROM al) UNION ALL SELECT barcode, j - 1, substr(seq, j, 1) FROM (SELECT *, unnest(range(1, length(seq) + 1)) AS j FROM own)),
c AS (SELECT barcode, pt, base, count(*) AS n FROM v GROUP BY 1, 2, 3), t AS (SELECT *, sum(n) OVER (PARTITION BY barcode, pt) AS total, row_number() OVER (PARTITION BY barcode, pt ORDER BY n DESC, base) AS k FROM c)
SELECT barcode, CAST(pt AS BIGINT) AS "at", substr(own.seq, CAST(pt + 1 AS BIGINT), 1) AS old, base AS new, n AS votes, CAST(total AS BIGINT) AS total FROM t JOIN own USING (barcode) WHERE k = 1 AND total >= 3 AND n >= 0.6 * total AND base <> substr(own.seq, CAST(pt + 1 AS BIGINT), 1)"""
)
def base_votes(spark: SparkSession, d: str) -> DataFrame:
    whole = _molecules(spark, d)
    aligned = whole.selectExpr("barcode", "inline(array(" + ", ".join(f"struct({s} as start, substr(seq, {s + 1}, 50) as s)" for s in (0, 10, 20)) + "))").withColumnRenamed("s", "seq")
    return contigs.base_votes(aligned, whole.selectExpr("barcode", "concat(substr(seq, 1, 29), 'A', substr(seq, 31)) as seq"))


@_query(
    f"""WITH m AS (SELECT CAST(p_partkey AS VARCHAR) AS barcode, {_MOLECULE.format(s='VARCHAR')} AS seq FROM part)
SELECT barcode, CASE WHEN contains(right(seq, 30), 'ACGT') THEN reverse(translate(seq, 'ACGT', 'TGCA')) ELSE seq END AS seq, CAST(contains(right(seq, 30), 'ACGT') AS BIGINT) AS turned FROM m"""
)
def adapter_direction(spark: SparkSession, d: str) -> DataFrame:
    return contigs.direction_by_adapter(_molecules(spark, d).select("barcode", "seq"), "ACGT")


@_query(
    f"""WITH m AS (SELECT CAST(p_partkey AS VARCHAR) AS name, {_MOLECULE.format(s='VARCHAR')} AS seq FROM part), l AS (SELECT CAST(l_partkey AS VARCHAR) AS q, arg_max(CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END, l_orderkey * 10 + l_linenumber) AS st FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_orderkey * 10 + l_linenumber ORDER BY l_suppkey) AS k FROM lineitem) WHERE l_shipdate > TIMESTAMP '1997-01-01' AND k = 1 GROUP BY 1)
SELECT name, CASE WHEN st = '-' THEN reverse(translate(seq, 'ACGT', 'TGCA')) ELSE seq END AS seq, CASE WHEN st IS NULL THEN 'unmapped' ELSE 'mapped' END AS route FROM m LEFT JOIN l ON q = name"""
)
def mapping_direction(spark: SparkSession, d: str) -> DataFrame:
    lines = _table(spark, d, "lineitem").selectExpr(
        "cast(l_partkey as string) as query", "case when l_returnflag = 'R' then '-' else '+' end as strand", "l_orderkey * 10 + l_linenumber as ord",
        "row_number() over (partition by l_partkey, l_orderkey * 10 + l_linenumber order by l_suppkey) as k", "l_shipdate",
    )
    mapped = lines.filter("l_shipdate > timestamp_ntz'1997-01-01' and k = 1")
    return contigs.direction_by_mapping(_molecules(spark, d).select(F.col("barcode").alias("name"), "seq"), mapped)


@_query(
    """WITH f AS (SELECT o_custkey AS contig, arg_min(o_orderpriority, o_orderkey) AS ref, arg_min(floor(o_totalprice), o_orderkey) AS n FROM orders GROUP BY 1) SELECT contig, ref, round(n / (500000 + length(ref)), 6) AS fraction FROM f"""
)
def reference_fraction(spark: SparkSession, d: str) -> DataFrame:
    orders = _table(spark, d, "orders")
    coords = orders.selectExpr("o_custkey as contig", "o_orderkey as ord", "o_orderpriority as ref", "1L as start", "cast(floor(o_totalprice) as bigint) as end")
    return contigs.reference_fraction(coords, orders.selectExpr("o_orderpriority as ref", "500000L + length(o_orderpriority) as ref_len").distinct())


@_query(
    """WITH x AS (SELECT l_orderkey, l_linenumber * 1000000 + l_partkey AS o, substr(md5(CAST(l_partkey AS VARCHAR)), 1, 8) AS seq, l_suppkey FROM lineitem),
j AS (SELECT CAST(l_orderkey AS VARCHAR) || ' ' || string_agg('e' || CAST(o AS VARCHAR), '+' ORDER BY o, seq) || ' ' || CAST(count(DISTINCT l_suppkey) AS VARCHAR) AS name, string_agg(seq, '' ORDER BY o, seq) AS seq, count(DISTINCT l_suppkey) AS n FROM x GROUP BY l_orderkey)
SELECT name, seq FROM j WHERE n > 2"""
)
def joined_exons(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "lineitem").selectExpr("cast(l_orderkey as string) as barcode", "l_linenumber * 1000000 + l_partkey as ord", "l_suppkey", "substr(md5(cast(l_partkey as string)), 1, 8) as seq")
    counts = rows.groupBy("barcode").agg(F.countDistinct("l_suppkey").alias("n_reads"))
    exons = rows.withColumn("exon", F.concat(F.lit("e"), F.col("ord").cast("string"))).join(counts, "barcode")
    return contigs.deeper_than(contigs.join_exons(exons), 2)


@_query(
    """WITH p AS (SELECT l_returnflag = 'A' AS w, 0.9::DOUBLE + (l_partkey % 100) / 1000 + CASE WHEN l_returnflag = 'A' THEN 0.0025 ELSE 0.0005 END AS x FROM lineitem),
s AS (SELECT count(*) FILTER (w) AS wn, count(*) FILTER (NOT w) AS cn, avg(CAST(x >= 0.97 AS INT)) FILTER (w) AS a, avg(CAST(x >= 0.97 AS INT)) FILTER (NOT w) AS c FROM p)
SELECT 'within_barcode_pairs' AS metric, CAST(wn AS DOUBLE) AS value FROM s UNION ALL SELECT 'cross_barcode_pairs', cn FROM s UNION ALL SELECT 'within_frac_same_molecule', round(a, 4) FROM s
UNION ALL SELECT 'cross_frac_same_molecule', round(c, 4) FROM s UNION ALL SELECT 'same_molecule_enrichment', round(a / greatest(c, 0.5 / cn), 2) FROM s"""
)
def library_identity(spark: SparkSession, d: str) -> DataFrame:
    return contigs.identity_summary(_table(spark, d, "lineitem").selectExpr(
        "cast(l_returnflag = 'A' as int) as within", "0.9D + (l_partkey % 100) / 1000D + case when l_returnflag = 'A' then 0.0025D else 0.0005D end as identity"
    ))


@_query(
    """WITH k AS (SELECT count(DISTINCT user_id) AS b, avg(CAST(event_id % 40 = 0 AS INT)) AS r FROM events), x AS (SELECT 0.55 + (l_partkey % 37) / 100.0::DOUBLE AS i FROM lineitem),
m AS (SELECT i AS median FROM (SELECT i, row_number() OVER (ORDER BY i) AS k, count(*) OVER () AS n FROM x) WHERE k = n // 2 + 1)
SELECT CASE WHEN b >= 20 THEN 'ok' ELSE 'insufficient_data' END AS status, round(r, 4) AS probe_drop_rate, round(median, 4) AS cross_median_identity, CAST(b < 20 OR r >= 0.02 AS BIGINT) AS run_read_filter,
  CASE WHEN b >= 20 AND median <= 0.6 THEN 'high_div' ELSE 'balanced' END AS suggested_qc_preset FROM k, m"""
)
def probe_decision(spark: SparkSession, d: str) -> DataFrame:
    kept = _table(spark, d, "events").selectExpr("user_id as barcode", "cast(event_id % 40 <> 0 as int) as kept")
    return contigs.probe_decision(kept, _table(spark, d, "lineitem").selectExpr("0.55D + (l_partkey % 37) / 100.0D as identity"))


_EXONS = "cast(o_custkey as {s}) as barcode, o_orderpriority as chrom, o_orderkey % 5000 as {a}, o_orderkey % 5000 + cast(floor(o_totalprice / 100) as bigint) as {b}"


@_query(
    f"""WITH iv AS (SELECT {_EXONS.format(s='varchar', a='s', b='e')} FROM orders),
im AS (SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY barcode, chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS n FROM iv),
ii AS (SELECT *, sum(n) OVER (PARTITION BY barcode, chrom ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS i FROM im), il AS (SELECT barcode, max(e) - min(s) + 1 AS span FROM ii GROUP BY barcode, chrom, i),
t AS (SELECT barcode, CAST(sum(span) AS BIGINT) AS total FROM il GROUP BY 1), c AS (SELECT *, CAST(CASE WHEN total >= 6000 THEN 6000 WHEN total >= 3000 THEN 3000 WHEN total >= 2000 THEN 2000 WHEN total >= 1000 THEN 1000 ELSE 0 END AS BIGINT) AS class FROM t)
SELECT barcode, total, class FROM (SELECT *, row_number() OVER (PARTITION BY class ORDER BY md5(barcode), barcode) AS k FROM c) WHERE k <= 50"""
)
def coverage_classes(spark: SparkSession, d: str) -> DataFrame:
    return contigs.coverage_classes(_table(spark, d, "orders").selectExpr(*_columns(_EXONS.format(s="string", a="start", b="end"))), cap=50)


# --- variants and blocks ------------------------------------------------------------------------------------

_CS = "concat(':', cast(1 + p_partkey % 30 as {s}), '*ag', '=ACGT', '+', lower(substr({0}, 1, cast(1 + p_size % 4 as int))), ':7-', lower(substr({0}, 5, cast(1 + p_size % 3 as int))), '~gt', cast(p_size as {s}), 'ag', '*', lower(substr('ACGT', cast(1 + p_partkey % 4 as int), 1)), 'n')"


@_query(
    rf"""WITH t AS (SELECT p_partkey AS contig, p_size AS st, regexp_extract_all({_CS.format(_DNA.format('CAST(p_partkey AS VARCHAR)'), s='VARCHAR')}, '(:[0-9]+|\*[a-z][a-z]|[=+\-][A-Za-z]+|~[a-z]{{2}}[0-9]+[a-z]{{2}})') AS l FROM part),
u AS (SELECT contig, st, unnest(l) AS t, generate_subscripts(l, 1) AS i FROM t),
v AS (SELECT *, CAST(CASE WHEN t[1] IN (':', '~') THEN CAST(regexp_extract(t, '(\d+)', 1) AS BIGINT) WHEN t[1] IN ('=', '-') THEN length(t) - 1 WHEN t[1] = '*' THEN 1 ELSE 0 END AS BIGINT) AS adv FROM u),
w AS (SELECT *, st + 1 + coalesce(sum(adv) OVER (PARTITION BY contig ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pt FROM v)
SELECT contig, CASE t[1] WHEN '*' THEN 'snp' WHEN '+' THEN 'insertion' ELSE 'deletion' END AS variant_type, CAST(pt AS BIGINT) AS ref_pos, upper(CASE t[1] WHEN '*' THEN t[2] WHEN '-' THEN substr(t, 2) ELSE '-' END) AS ref_base,
  upper(CASE t[1] WHEN '*' THEN t[3] WHEN '+' THEN substr(t, 2) ELSE '-' END) AS own_base FROM w WHERE t[1] IN ('*', '+', '-')"""
)
def cs_variants(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "part").selectExpr("p_partkey as contig", "p_size as target_start", _CS.format(_DNA.format("cast(p_partkey as string)"), s="string") + " as cs")
    return variants.cs_variants(rows, ["contig"])


_VCF = "o_orderpriority as chrom, o_orderkey as pos, substr({0}, 1, cast(1 + o_orderkey % 2 as int)) as {r}, substr({0}, 5, cast(1 + o_custkey % 2 as int)) as alt, case o_orderkey % 5 when 0 then '0|1' when 1 then '1|0' when 2 then '0/1:12' when 3 then '1/1' else '1|1' end as gt"


@_query(
    f"""WITH v AS (SELECT {_VCF.format(_DNA.format('cast(o_orderkey as varchar)'), r='rf')} FROM orders)
SELECT chrom, CASE WHEN length(rf) = 1 AND length(alt) = 1 THEN 'snp' ELSE 'indel' END AS kind, count(*) AS n, CAST(count(*) FILTER (substr(gt, 1, 3) IN ('0|1', '1|0', '0/1', '1/0')) AS BIGINT) AS n_het, CAST(count(*) FILTER (substr(gt, 1, 3) IN ('0|1', '1|0')) AS BIGINT) AS n_phased FROM v GROUP BY 1, 2"""
)
def genotype_counts(spark: SparkSession, d: str) -> DataFrame:
    return variants.genotype_counts(_table(spark, d, "orders").selectExpr(*_columns(_VCF.format(_DNA.format("cast(o_orderkey as string)"), r="ref"))))


@_query(
    f"""WITH r AS (SELECT event_id AS read_id, user_id AS chrom, (event_id * 37) % 5000 AS st, {_DNA.format('CAST(event_id AS VARCHAR)')} AS seq FROM events), v AS (SELECT DISTINCT 1 + o_custkey % 150 AS chrom, 1 + o_orderkey % 5000 AS pos FROM orders)
SELECT read_id, r.chrom, pos, substr(seq, CAST(pos - st AS BIGINT), 1) AS base FROM r JOIN v ON r.chrom = v.chrom AND pos > st AND pos <= st + 32 WHERE substr(seq, CAST(pos - st AS BIGINT), 1) IN ('A', 'C')"""
)
def reads_with_variants(spark: SparkSession, d: str) -> DataFrame:
    reads = _table(spark, d, "events").selectExpr("event_id as read_id", "user_id as chrom", "(event_id * 37) % 5000 as start", _DNA.format("cast(event_id as string)") + " as seq")
    sites = _table(spark, d, "orders").selectExpr("1 + o_custkey % 150 as chrom", "1 + o_orderkey % 5000 as pos").distinct().withColumn("alts", F.array(F.lit("A"), F.lit("C")))
    return variants.reads_with_variants(reads, sites, 100)


@_query(f"WITH {_ALLELES_SQL}, t AS (SELECT DISTINCT 'chr1' AS chrom, p_partkey AS pos, CAST(p_size % 2 AS VARCHAR) AS t1 FROM part WHERE p_size % 3 > 0) SELECT al.chrom, block, ord, al.pos, coalesce(t.t1, '-') AS t1 FROM al LEFT JOIN t ON al.pos = t.pos")
def truth_alleles(spark: SparkSession, d: str) -> DataFrame:
    truth = _table(spark, d, "part").filter("p_size % 3 > 0").selectExpr("'chr1' as chrom", "p_partkey as pos", "cast(p_size % 2 as string) as t1")
    return variants.truth_alleles(_alleles(spark, d).select("chrom", "block", "ord", "pos"), truth)


_BLOCKS_SQL = "b AS (SELECT l_orderkey, count(*) AS phased, max(l_partkey) - min(l_partkey) + 1 AS span FROM lineitem GROUP BY 1)"


@_query(f"WITH {_BLOCKS_SQL}, r AS (SELECT *, span / phased AS r FROM b) SELECT count(*) AS n_blocks, CAST(sum(phased) AS BIGINT) AS phased, CAST(sum(span) AS BIGINT) AS span, round(avg(r), 4) AS mean, round(min(r), 4) AS min, round(max(r), 4) AS max, round(stddev_samp(r), 4) AS std FROM r")
def block_summary(spark: SparkSession, d: str) -> DataFrame:
    return variants.block_summary(_table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("phased"), (F.max("l_partkey") - F.min("l_partkey") + 1).alias("span")))


@_query("WITH b AS (SELECT l_returnflag AS chrom, l_orderkey AS block, count(*) AS n_snps FROM lineitem GROUP BY 1, 2) SELECT chrom, block, n_snps FROM (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY n_snps DESC, block) AS k FROM b) WHERE k = 1")
def largest_blocks(spark: SparkSession, d: str) -> DataFrame:
    return variants.largest_blocks(_table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("chrom"), F.col("l_orderkey").alias("block")).agg(F.count(F.lit(1)).alias("n_snps")))


@_query("SELECT o_orderpriority AS chrom, o_orderkey AS pos, CAST(substr(o_orderpriority, 1, 1) AS INT) * 3 % 5 AS ord FROM orders")
def merge_ordered(spark: SparkSession, d: str) -> DataFrame:
    orders = _table(spark, d, "orders").selectExpr("o_orderpriority as chrom", "o_orderkey as pos")
    header = orders.select("chrom").distinct().withColumn("ord", F.substring("chrom", 1, 1).cast("int") * 3 % 5)
    files = [orders.filter(F.substring("chrom", 1, 1) == str(i)) for i in range(1, 6)]
    return variants.merge_ordered(files, header).select("chrom", "pos", "ord")


# --- fragments ----------------------------------------------------------------------------------------------

_BED = "case when user_id % 10 = 0 then concat('NNN', cast(user_id as {s})) else concat('N', cast(user_id as {s})) end as barcode, event_type as chrom, event_id - event_id % 3 as read_id, cast(1 + event_id % 2 as int) as mate, case when event_id % 7 < 3 then '-' else '+' end as strand"


@_query(
    f"""WITH r AS (SELECT {_BED.format(s='varchar')}, epoch_us(ts) AS st FROM events), g AS (SELECT barcode, chrom, read_id, min({{'s': st, 't': CASE WHEN mate = 2 THEN CASE WHEN strand = '+' THEN '-' ELSE '+' END ELSE strand END}}) AS f FROM r WHERE barcode NOT LIKE 'NNN%' GROUP BY 1, 2, 3),
p AS (SELECT barcode, chrom, read_id, f.s AS pos, f.t AS t FROM g), k AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY barcode, chrom ORDER BY pos, read_id) >= {5 * DAY} THEN 1 ELSE 0 END AS b FROM p),
n AS (SELECT *, CAST(sum(b) OVER (PARTITION BY barcode, chrom ORDER BY pos, read_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS frag FROM k)
SELECT barcode, chrom, frag, count(*) AS n_reads, min(pos) AS min_pos, max(pos) - min(pos) + 100 AS length, CAST(CASE WHEN 2 * count(*) FILTER (t = '-') > count(*) THEN 0 ELSE 1 END AS BIGINT) AS strand FROM n GROUP BY 1, 2, 3"""
)
def bed_fragments(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "events").selectExpr(*_columns(_BED.format(s="string")), "unix_micros(cast(ts as timestamp)) as start")
    return fragments.fragments_from_bed(rows, 5 * DAY).select("barcode", "chrom", "frag", "n_reads", "min_pos", "length", "strand")


@_query(
    f"""WITH {_FRAGS_SQL}, h AS (SELECT length // 3600000000 * 1 AS length, n_reads FROM frags), b AS (SELECT length, n_reads, length // 24 AS bin FROM h WHERE length <= 240 UNION ALL SELECT length, n_reads, length // 24 - 1 FROM h WHERE length <= 240 AND length % 24 = 0 AND length >= 24)
SELECT bin * 24 AS "from", (bin + 1) * 24 AS "to", count(*) AS n_fragments, CAST(sum(n_reads) AS BIGINT) AS n_reads, round(median(n_reads), 4) AS median_reads FROM b WHERE bin * 24 < 240 GROUP BY bin"""
)
def length_bins(spark: SparkSession, d: str) -> DataFrame:
    return fragments.length_bins(_fragments(spark, d).selectExpr("length div 3600000000 as length", "n_reads"), 24, 240)


@_query(f"WITH {_READS_SQL} SELECT chrom, count(*) AS n_reads, count(DISTINCT barcode) AS n_barcodes FROM reads WHERE (flag & 2308) = 0 AND mapq >= 20 GROUP BY 1")
def spike_in_counts(spark: SparkSession, d: str) -> DataFrame:
    return fragments.reads_and_barcodes(_reads(spark, d), 20)


@_query(
    f"""WITH m AS (SELECT CAST(p_partkey AS VARCHAR) AS chrom, {_MOLECULE.format(s='VARCHAR')} AS seq FROM part), f AS (SELECT CAST(l_partkey AS VARCHAR) AS chrom, l_orderkey AS frag, 1 + l_linenumber AS a, 20 + l_linenumber + l_suppkey % 60 AS b, l_suppkey FROM lineitem),
x AS (SELECT f.*, substr(seq, a, CAST(b - a + 1 AS BIGINT)) AS s FROM f JOIN m USING (chrom)) SELECT chrom, frag, l_suppkey, a AS "start", b AS "end", round((length(s) - length(replace(replace(s, 'G', ''), 'C', ''))) / (length(s) + 1), 6) AS gc_ratio FROM x"""
)
def fragment_gc(spark: SparkSession, d: str) -> DataFrame:
    frags = _table(spark, d, "lineitem").selectExpr("cast(l_partkey as string) as chrom", "l_orderkey as frag", "l_suppkey", "1 + l_linenumber as start", "20 + l_linenumber + l_suppkey % 60 as end")
    return fragments.gc_ratio(frags, _molecules(spark, d).select(F.col("barcode").alias("chrom"), "seq"))


@_query(
    """WITH g AS (SELECT l_partkey % 1000 AS a, l_partkey % 1000 + l_linenumber AS b, CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS st FROM lineitem)
SELECT CASE WHEN (a + b < 1000) = (st = '+') THEN 'five_prime' ELSE 'three_prime' END AS half, count(*) AS n, CAST(sum(b - a) AS BIGINT) AS bases FROM g GROUP BY 1"""
)
def end_bias(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "lineitem").selectExpr("l_partkey % 1000 as gap_start", "l_partkey % 1000 + l_linenumber as gap_end", "0L as start", "1000L as end", "case when l_returnflag = 'R' then '-' else '+' end as strand")
    return fragments.end_bias(rows)


@_query(
    f"""WITH {_FRAGS_SQL}, l AS (SELECT barcode, max(length // {DAY}) AS x FROM frags GROUP BY 1), c AS (SELECT CAST(user_id AS VARCHAR) AS barcode, count(*) AS y FROM events GROUP BY 1), p AS (SELECT x, y FROM l JOIN c USING (barcode)),
r AS (SELECT x, y, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2 AS rx, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2 AS ry FROM p)
SELECT count(*) AS n, round(corr(x, y), 6) AS pearson, round(regr_r2(y, x), 6) AS r2, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept, round(corr(rx, ry), 6) AS spearman FROM r"""
)
def length_depth_corr(spark: SparkSession, d: str) -> DataFrame:
    longest = _fragments(spark, d).groupBy("barcode").agg(F.max(F.expr(f"length div {DAY}")).alias("x"))
    depth = _table(spark, d, "events").groupBy(F.col("user_id").cast("string").alias("barcode")).agg(F.count(F.lit(1)).alias("y"))
    return calibration.dose_response(longest.join(depth, "barcode").select("x", "y"))


# --- names and motifs ---------------------------------------------------------------------------------------


@_query(
    f"""WITH s AS (SELECT event_id, {_DNA.format('CAST(event_id AS VARCHAR)')} AS seq FROM events) SELECT event_id, CAST(CASE WHEN instr(seq, 'ACG') = 0 THEN -1 ELSE instr(seq, 'ACG') END AS INT) AS m1, CAST(CASE WHEN instr(seq, 'TTT') = 0 THEN -1 ELSE instr(seq, 'TTT') END AS INT) AS m2 FROM s"""
)
def motif_places(spark: SparkSession, d: str) -> DataFrame:
    seq = F.expr(_DNA.format("cast(event_id as string)"))
    return _table(spark, d, "events").select("event_id", *[S.motif_place(seq, m).alias(n) for n, m in (("m1", "ACG"), ("m2", "TTT"))])


@_query("""SELECT p_partkey, 'ERCC-' || lpad(CAST(p_partkey AS VARCHAR), 5, '0') AS ercc, 'Genus_species' || CASE WHEN p_size % 2 = 0 THEN 'x' ELSE '' END AS raw, replace('Genus_species' || CASE WHEN p_size % 2 = 0 THEN 'x' ELSE '' END, '_', ' ') AS species FROM part""")
def reference_names(spark: SparkSession, d: str) -> DataFrame:
    header = F.expr("concat('Genus_species', case when p_size % 2 = 0 then 'x' else '' end, '_16S_', cast(p_partkey as string))")
    name = F.expr("concat('bc', cast(p_size as string), '_ERCC-', lpad(cast(p_partkey as string), 5, '0'), '_k')")
    return _table(spark, d, "part").select("p_partkey", S.spike_id(name).alias("ercc"), F.regexp_extract(header, r"^([A-Za-z]+_[a-z]+)", 1).alias("raw"), S.species_of(header).alias("species"))


@_query("SELECT event_id, CAST(CASE WHEN event_id % 3 = 0 THEN event_id % 2 = 0 ELSE (event_id % 64) & 16 <> 0 END AS BIGINT) AS reverse FROM events")
def legacy_flags(spark: SparkSession, d: str) -> DataFrame:
    flag = F.expr("case when event_id % 3 = 0 then case when event_id % 2 = 0 then 'pr' else 'p1' end else cast(event_id % 64 as string) end")
    return _table(spark, d, "events").select("event_id", S.has_text_flag(flag, 16, "r").cast("long").alias("reverse"))
