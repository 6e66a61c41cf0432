"""Temperature mixing of sources, realised as budgeted block permutations. DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import buckets, forget, numbered, skewed_join, written


@dataclass(frozen=True)
class MixOptions:
    """``target_entropy``: share of the log of the number of sources that the weights' entropy shall not
    exceed; ``max_repeats``: how often a source's tokens may be used; ``budget``: tokens of the mix (None:
    as many as the corpus has); ``block_tokens``: budget of a block; ``seed`` keys all permutations;
    ``few_sources``: table rows up to which the weights of the sources are broadcast."""

    target_entropy: float = 0.97
    max_repeats: float = 4.0
    budget: int | None = None
    block_tokens: int = 1_000_000
    seed: str = "mix-1"
    steps: int = 40
    top: float = 16.0
    few_sources: int = 20_000


def tokens(text: Column) -> Column:
    """Words between ASCII white space; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


@dataclass(frozen=True)
class Shares:
    """What the search for the exponent needs to know of all sources with tokens: their number, their tokens,
    the least and the greatest token share, and for exponents e the sums of share**e and of share**e * log(share)."""

    sources: int
    whole: int
    least: float
    most: float
    sums: Callable[[list[float]], list[tuple[float, float]]]


def find_exponent(shares: Shares, options: MixOptions) -> tuple[float, bool]:
    """The least exponent (flattest mix) within both limits, by bisection; and whether one is within both.

    Up to 1, a smaller exponent means more entropy and more repetition, so being within the limits is
    monotone. If the natural shares exceed the entropy already, the exponent is bisected above 1; there a
    larger one means less entropy and more repetition, and the repetition limit goes first. Where no
    exponent brings the entropy down (sources of equal size) the natural shares stay.
    """
    if shares.sources < 2:
        return 1.0, shares.sources == 0 or (options.budget or 0) <= options.max_repeats * shares.whole
    budget = options.budget or shares.whole
    limit = options.target_entropy * math.log(shares.sources)

    def state(exponents: list[float]) -> list[tuple[bool, bool]]:
        """Per exponent: entropy within its limit, repetition within its limit."""
        out = []
        for e, (scale, tilted) in zip(exponents, shares.sums(exponents), strict=True):
            entropy = math.log(scale) - e * tilted / scale
            rare = shares.least if e < 1 else shares.most
            repeats = rare ** (e - 1) / scale * budget / shares.whole
            out.append((entropy <= limit + 1e-12, repeats <= options.max_repeats * (1 + 1e-12)))
        return out

    def bisect(low: float, high: float, good: Callable[[tuple[bool, bool]], bool]) -> tuple[float, float]:
        """(last bad, first good) exponent; four bisection steps are answered by one pass over the sources."""
        for _ in range(options.steps // 4):
            inner = [low + (high - low) * i / 16 for i in range(1, 16)]
            known = dict(zip(inner, state(inner), strict=True))
            at, to = 0, 16
            while to - at > 1:
                middle = (at + to) // 2
                at, to = (at, middle) if good(known[inner[middle - 1]]) else (middle, to)
            low, high = ([low, *inner][at], [*inner, high][to - 1])
        return low, high

    flat, natural, steep = state([0.0, 1.0, options.top])
    if all(flat):
        return 0.0, True
    if all(natural):
        return bisect(0.0, 1.0, all)[1], True
    if not natural[1] or not steep[0]:
        return 1.0, False
    exponent = bisect(1.0, options.top, lambda s: s[0])[1]
    if state([exponent])[0][1]:
        return exponent, True
    return bisect(1.0, exponent, lambda s: not s[1])[0], False


def shares_of(totals: DataFrame) -> Shares:
    """``Shares`` of a table (total) with one row a source, by aggregates: the driver never holds the sources."""
    used = totals.filter("total > 0")
    n, whole, least, most = used.agg(F.count(F.lit(1)), F.sum("total"), F.min("total"), F.max("total")).first()
    if not n:
        return Shares(0, 0, 0.0, 0.0, lambda _: [])
    share = F.col("total") / F.lit(float(whole))

    def sums(exponents: list[float]) -> list[tuple[float, float]]:
        raised = [F.pow(share, F.lit(e)) for e in exponents]
        row = used.agg(*[F.sum(x) for x in raised], *[F.sum(x * F.log(share)) for x in raised]).first()
        return list(zip(row[: len(exponents)], row[len(exponents) :], strict=True))

    return Shares(n, whole, least / whole, most / whole, sums)


def _order(seed: str, copy: Column, key: Column) -> Column:
    """Keyed permutation value of a document within one pass over its source: 52 bits, as a long."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(seed), copy.cast("string"), key), 256), 1, 13), 16, 10).cast("long")


def _rows(docs: DataFrame, payload: Column) -> DataFrame:
    """(payload, s, key, n_tokens): the source (null is one of its own), and what a document is permuted by:
    its id, else (null id) its text."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("t"), F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    source = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    return docs.select(payload.alias("payload"), source.alias("s"), key.alias("key"), tokens(F.col("text")).alias("n_tokens"))


def _with_source(rows: DataFrame, table: DataFrame, options: MixOptions) -> DataFrame:
    """``rows`` with the columns that ``table`` has for their source. A table of few sources (a fixed list of
    origins) is broadcast; one that grows with the data, as hosts do, is joined by sort-merge, where large sources are split."""
    if table.count() <= options.few_sources:
        return rows.join(F.broadcast(table), "s")
    return skewed_join(rows, table, "s")


def plan_mix(docs: DataFrame, options: MixOptions) -> tuple[DataFrame, DataFrame]:
    """(narrow rows, one row a source: s, total, weight, quota, passes, rest, exponent, reached, cut).

    ``quota`` is the source's share of the budget in tokens, never above ``max_repeats`` of its own;
    ``weight`` is the quota's share of all quotas. ``cut`` is the largest permutation value up to which the
    last, partial pass keeps within the quota. It is found in two steps: token sums by value range, then an
    exact running sum in the one range per source where the quota ends, so no task ever holds a whole source.
    """
    n = buckets(docs.sparkSession)
    rows = written(_rows(docs, F.col("doc_id").cast("long")))
    totals = written(rows.groupBy("s").agg(F.sum("n_tokens").alias("total")))
    shares = shares_of(totals)
    exponent, reached = find_exponent(shares, options)
    budget = options.budget or shares.whole
    scale = shares.sums([exponent])[0][0] if shares.sources else 1.0
    wanted = F.pow(F.col("total") / F.lit(float(max(1, shares.whole))), F.lit(exponent)) / F.lit(scale) * F.lit(float(budget))
    quota = F.least(F.floor(wanted + 1e-6), F.floor(F.col("total") * F.lit(float(options.max_repeats))))
    table = written(totals.filter("total > 0").withColumn("quota", quota.cast("long")))
    granted = table.agg(F.sum("quota")).first()[0] or 0
    table = table.select(
        "s", "total", (F.col("quota") / F.lit(float(max(1, granted)))).alias("weight"), "quota", F.floor(F.col("quota") / F.col("total")).cast("int").alias("passes"),
        (F.col("quota") % F.col("total")).alias("rest"), F.lit(exponent).alias("exponent"), F.lit(reached).alias("reached"),
    )
    table = written(table)
    known = _with_source(rows, table.select("s", "passes", "rest"), options).filter("rest > 0")
    span = (1 << 52) // (8 * n)
    ranged = known.withColumn("last", _order(options.seed, F.col("passes"), F.col("key"))).withColumn("range", (F.col("last") / F.lit(span)).cast("long"))
    sums = ranged.groupBy("s", "rest", "range").agg(F.sum("n_tokens").alias("t"))
    upto = Window.partitionBy("s").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ends = written(
        sums.withColumn("before", F.coalesce(F.sum("t").over(upto), F.lit(0)))
        .filter("before <= rest and before + t > rest")
        .groupBy("s")
        .agg(F.min_by("before", "range").alias("before"), F.min("range").alias("end_range"))
    )
    inside = _with_source(ranged, ends, options).filter(F.col("range") == F.col("end_range"))
    running = Window.partitionBy("s").orderBy("last").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = (
        inside.withColumn("upto", F.col("before") + F.sum("n_tokens").over(running))
        .groupBy("s", "end_range")
        .agg(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("last"))).alias("within"))
        .select("s", F.coalesce("within", F.col("end_range") * span - 1).alias("cut"))
    )
    # a source without a partial pass places nothing in it
    return rows, written(table.join(cuts, "s", "left").withColumn("cut", F.coalesce("cut", F.lit(-1))))


def placed(docs: DataFrame, payload: Column, options: MixOptions) -> tuple[DataFrame, int]:
    """(one row per placed copy: payload, s, weight, n_tokens, pass, block, o; number of blocks).

    A source's passes are laid end to end, each in a keyed permutation of its own. The stream is cut into
    the blocks by its running tokens, so every block has every source's equal part to within one document.
    ``o`` orders the copies inside a block, by a further permutation. Running sums take two levels: token
    sums by (source, pass, value range), then a window inside a range.
    """
    n = buckets(docs.sparkSession)
    rows, table = plan_mix(docs, options)
    span = (1 << 52) // (8 * n)

    def copies(some: DataFrame) -> DataFrame:
        known = _with_source(some, table.select("s", "weight", "passes", "cut"), options)
        times = F.col("passes") + (_order(options.seed, F.col("passes"), F.col("key")) <= F.col("cut")).cast("int")
        known = known.withColumn("times", times).filter("times > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
        known = known.withColumn("value", _order(options.seed, F.col("pass"), F.col("key")))
        return known.drop("passes", "cut", "times").withColumn("range", (F.col("value") / F.lit(span)).cast("long"))

    sums = copies(rows).groupBy("s", "pass", "range").agg(F.sum("n_tokens").alias("t"))
    upto = Window.partitionBy("s").orderBy("pass", "range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("before", F.coalesce(F.sum("t").over(upto), F.lit(0))).withColumn("stream", F.sum("t").over(Window.partitionBy("s")))
    starts = written(starts.select(F.col("s").alias("_s"), F.col("pass").alias("_p"), F.col("range").alias("_r"), "before", "stream", "t"))
    forget(rows)
    whole = starts.agg(F.sum("t")).first()[0] or 0
    blocks = max(1, -(-whole // options.block_tokens))
    made = copies(_rows(docs, payload))
    same = (F.col("s") == F.col("_s")) & (F.col("pass") == F.col("_p")) & (F.col("range") == F.col("_r"))
    made = made.join(starts.drop("t").hint("merge"), same)
    inside = Window.partitionBy("s", "pass", "range").orderBy("value", "key", "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("before") + F.sum("n_tokens").over(inside) - F.col("n_tokens") / 2
    block = F.least(F.floor(middle * F.lit(blocks) / F.greatest(F.col("stream"), F.lit(1))), F.lit(blocks - 1)).cast("long")
    o = _order(options.seed + "/block", F.col("pass"), F.col("key"))
    return made.select("payload", "s", F.round("weight", 6).alias("weight"), "n_tokens", "pass", block.alias("block"), o.alias("o"), "key"), blocks


def mix_rows(docs: DataFrame, options: MixOptions = MixOptions()) -> DataFrame:
    """The mix as documents: each row of ``docs`` as often as the mix has it, in mix order, same columns whatever their names.

    The order is physical: partitions hold consecutive blocks, sorted by block and place in it, so
    files written from it follow the mix. Nulls, ties and empty tables as in ``mix``.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    made, blocks = placed(docs, whole, options)
    parts = min(blocks, buckets(docs.sparkSession))
    dealt = made.repartitionById(parts, F.floor(F.col("block") * parts / blocks).cast("int"))
    return dealt.sortWithinPartitions("block", "o", "key", "n_tokens").select("payload.*")


def mix(docs: DataFrame, options: MixOptions = MixOptions()) -> DataFrame:
    """One row per placed document copy: doc_id, source, weight, n_tokens, pass, block and slot in the block.

    Null source is a source of its own; null text has no tokens. Sources without any token get weight
    zero and place nothing. Repeated rows are placed each, ties of a permutation go by key and tokens; an
    empty table gives no rows; further columns are ignored. ``weight`` is the realised one (see ``plan_mix``).
    """
    n = buckets(docs.sparkSession)
    made, _ = placed(docs, F.col("doc_id").cast("long"), options)
    source = F.when(F.col("s") != "n", F.expr("substring(s, 2)"))
    rows = made.select(F.col("payload").alias("doc_id"), source.alias("source"), "weight", "n_tokens", "pass", "block", "o")
    return numbered(rows, ["block"], ["o", "doc_id"], "slot", F.col("o"), n).drop("o")
