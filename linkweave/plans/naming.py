"""Registered queries on names, barcode artefacts, clips and sequence pieces, with their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import contigs
from .catalogue import _DNA, _query, _table

_SEQ = _DNA.format("cast(event_id as {s})")
_NAME = "concat('r', cast(event_id as {s}), case when event_id % 9 = 0 then '' else concat('#', cast(user_id as {s}), '_', cast(event_id % 7 as {s})) end, '/1')"


@_query(
    f"""WITH s AS (SELECT event_id, {_SEQ.format(s='varchar')} AS seq FROM events)
SELECT event_id, seq[3:7] AS inner_piece, seq[30:34] AS short_piece, '' AS past_piece, seq[28:30] AS end_piece, seq[32:32] AS last_piece FROM s"""
)
def sequence_pieces(spark: SparkSession, d: str) -> DataFrame:
    seq = F.expr(_SEQ.format(s="string"))
    places = {"inner_piece": (3, 5), "short_piece": (30, 5), "past_piece": (40, 5), "end_piece": (-4, 3)}
    cut = [N.piece(seq, *at).alias(name) for name, at in places.items()]
    last = N.piece(seq, 32, 9).alias("last_piece")
    return _table(spark, d, "events").select("event_id", *cut, last)


@_query(
    f"""WITH n AS (SELECT event_id, user_id, {_NAME.format(s='varchar')} AS name FROM events), p AS (SELECT *, regexp_extract(name, '([^#]*)$', 1) AS last FROM n)
SELECT event_id, CASE WHEN instr(name, '#') > 0 THEN last END AS umi, substr(last, 1, 3) || '#' || CAST(user_id AS VARCHAR) || '#' || substr(name, 1, length(name) - 2) AS pe_name,
substr(last, 1, 3) || '#' || CAST(user_id AS VARCHAR) || '#' || name AS se_name, name || CASE WHEN event_id % 4 = 0 THEN '_' || CAST(event_id % 100 AS VARCHAR) ELSE '' END AS tagged,
substr(name, 1, 6) || right(name, 2) AS short FROM p"""
)
def read_names(spark: SparkSession, d: str) -> DataFrame:
    name, pos = F.expr(_NAME.format(s="string")), F.col("user_id")
    tag = F.expr("case when event_id % 4 = 0 then cast(event_id % 100 as string) end")
    return _table(spark, d, "events").select(
        "event_id", N.umi_of(name).alias("umi"), N.placed_name(name, pos, 3, True).alias("pe_name"), N.placed_name(name, pos, 3, False).alias("se_name"),
        N.tagged_name(name, tag).alias("tagged"), N.short_record(F.concat(name, F.lit(" rest of it")), 6).alias("short"),
    )


_CONTIG = "concat(case when p_partkey % 2 = 0 then 'chr' else '' end, case when p_size = 23 then 'X' when p_size = 24 then 'M' else cast(p_size as {s}) end)"
_LISTED = ["chr1", "2", "chr3", "X", "chr12", "7"]


@_query(
    f"""WITH c AS (SELECT p_partkey, {_CONTIG.format(s='varchar')} AS name FROM part), o AS (SELECT *, CASE WHEN name LIKE 'chr%' THEN substr(name, 4) ELSE 'chr' || name END AS other FROM c)
SELECT p_partkey, CASE WHEN name IN ({', '.join(repr(x) for x in _LISTED)}) THEN name WHEN other IN ({', '.join(repr(x) for x in _LISTED)}) THEN other ELSE name END AS contig,
CAST(name LIKE 'chr%' AND (substr(name, 4) IN ('X', 'Y') OR coalesce(TRY_CAST(substr(name, 4) AS INT) BETWEEN 1 AND 22, false)) AS INT) AS main FROM o"""
)
def contig_names(spark: SparkSession, d: str) -> DataFrame:
    name = F.expr(_CONTIG.format(s="string"))
    known = F.array(*[F.lit(x) for x in _LISTED])
    return _table(spark, d, "part").select("p_partkey", N.known_contig(name, known).alias("contig"), N.is_main_chromosome(name).cast("int").alias("main"))


_ODD = "case when user_id % 10 = 0 then concat(repeat('A', 14), 'C') when user_id % 10 = 1 then concat('N', substr({0}, 1, 14)) when user_id % 10 = 2 then concat(repeat('A', 13), 'CC') else substr({0}, 1, 15) end".format(
    _DNA.format("cast(user_id as {s})")
)


@_query(
    f"""WITH b AS (SELECT {_ODD.format(s='varchar')} AS barcode FROM events) SELECT barcode, replace(replace(barcode, 'N', ''), 'n', '') AS bases,
CAST(strpos(barcode, 'N') > 0 OR strpos(barcode, repeat('A', 14)) > 0 AS INT) AS artefact, count(*) AS n_reads FROM b GROUP BY barcode"""
)
def barcode_artefacts(spark: SparkSession, d: str) -> DataFrame:
    counts = _table(spark, d, "events").select(F.expr(_ODD.format(s="string")).alias("barcode")).groupBy("barcode").agg(F.count(F.lit(1)).alias("n_reads"))
    return counts.select("barcode", N.without_unread(F.col("barcode")).alias("bases"), N.is_artefact(F.col("barcode")).cast("int").alias("artefact"), "n_reads")


_CIGAR = "case event_id % 4 when 0 then concat(cast(event_id % 60 as {s}), 'S', cast(100 - event_id % 60 as {s}), 'M') when 1 then concat(cast(100 - event_id % 60 as {s}), 'M', cast(event_id % 60 as {s}), 'S') when 2 then '100M' else '5S40M2I30M23S' end"


@_query(
    """WITH c AS (SELECT event_id, event_id % 4 AS kind, event_id % 60 AS clip FROM events)
SELECT event_id, CAST(kind = 1 AND 100 - clip >= 50 AND clip >= 20 AS INT) AS left_match, CAST(kind = 0 AND 100 - clip >= 50 AND clip >= 20 AS INT) AS right_match,
CAST(CASE kind WHEN 0 THEN 100 - clip >= 40 AND clip >= 20 WHEN 3 THEN true ELSE false END AS INT) AS right_short FROM c"""
)
def soft_clips(spark: SparkSession, d: str) -> DataFrame:
    cigar = F.expr(_CIGAR.format(s="string"))
    kinds = {"left_match": ("left", 50, 20), "right_match": ("right", 50, 20), "right_short": ("right", 40, 20)}
    return _table(spark, d, "events").select("event_id", *[N.clipped(cigar, *k).cast("int").alias(name) for name, k in kinds.items()])


@_query(
    """WITH r AS (SELECT CAST(l_orderkey AS VARCHAR) AS barcode, l_linenumber AS contig_ix, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS i FROM lineitem)
SELECT barcode, contig_ix, barcode || '>k41_' || CAST(i AS VARCHAR) AS name FROM r WHERE i < 3"""
)
def capped_contigs(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "lineitem").selectExpr("cast(l_orderkey as string) as barcode", "l_linenumber as contig_ix")
    return contigs.first_contigs(rows, 3)
