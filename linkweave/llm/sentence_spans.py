"""Removal of sentences inside repeated runs of consecutive sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, pairwise

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import utf8

SCHEMA = "doc_id long, text string, n_sentences int, n_removed int, removed array<int>"

_SENTENCE = re.compile(r"[^.!?。！？\n]*(?:[.!?。！？]+\s*|\n\s*|$)")
_WORD = re.compile(r"\S+\s*")


@dataclass(frozen=True)
class SpanOptions:
    """``sentences`` in a run at least, and as many more as it takes to reach ``min_words`` words, since
    fewer are no evidence of copying; a sentence of more than ``long`` words counts as several, cut where every ``window`` words in a row
    have their least hash."""

    sentences: int = 2
    min_words: int = 10
    long: int = 25
    window: int = 10
    most_keys: int = 400_000


def _cuts(words: list[str], window: int) -> list[int]:
    """Numbers of words before each cut: after the least hash of every window, the last of equal ones.

    They are at most ``window`` words apart and depend on the words around alone, so a passage is cut the
    same wherever it stands, but for its first and last ``window`` - 1 words. Any 48 words of one sentence
    hold a run of 10 words in equal pieces.
    """
    import xxhash

    h = [xxhash.xxh3_64_intdigest(w) for w in words]
    out, best = [], -1
    for i in range(len(h) - window + 1):
        last = i + window - 1
        if best < i:
            best = min(range(last, i - 1, -1), key=h.__getitem__)
        elif h[last] <= h[best]:
            best = last
        if not out or out[-1] != best + 1:
            out.append(best + 1)
    return [n for n in out if n < len(h)]


def sentences(text: str, options: SpanOptions) -> list[str]:
    """The text cut into sentences, white space kept with the sentence before; joined they are the text."""
    out: list[str] = []
    for piece in _SENTENCE.findall(text):
        if not piece:
            continue
        if len(piece) > 2 * options.long and len(piece.split()) > options.long:
            words = _WORD.findall(piece)
            lead = piece[: len(piece) - sum(map(len, words))]
            ends = [0, *_cuts(piece.lower().split(), options.window), len(words)]
            some = ["".join(words[i:j]) for i, j in pairwise(ends)]
            some[0] = lead + some[0]
            out += some
        elif out and not piece.strip():
            out[-1] += piece
        else:
            out.append(piece)
    return out


def runs(parts: list[str], options: SpanOptions) -> list[tuple[int, int, str]]:
    """(first sentence, sentences, normalised run) of the shortest run with enough words from every start and to every end.

    With both, each stretch of enough sentences and words is covered by runs inside it.
    """
    words = [p.lower().split() for p in parts]
    normal, k, least = [" ".join(w) for w in words], options.sentences, options.min_words
    sums = [0, *accumulate(map(len, words))]
    spans, stop, start = set(), 0, len(parts)
    for i in range(len(parts)):
        stop = max(stop, i + k)
        while stop <= len(parts) and sums[stop] - sums[i] < least:
            stop += 1
        if stop > len(parts):
            break
        spans.add((i, stop))
    for j in range(len(parts), 0, -1):
        start = min(start, j - k)
        while start >= 0 and sums[j] - sums[start] < least:
            start -= 1
        if start < 0:
            break
        spans.add((start, j))
    return [(i, j - i, "\n".join(normal[i:j])) for i, j in sorted(spans)]


def remove_repeated_sentences(docs: DataFrame, options: SpanOptions = SpanOptions()) -> DataFrame:
    """Every row of ``docs`` without the sentences covered by a non-first repeated run.

    The first place of a run is the least (doc_id, hash of the text, number of the run); null ids come last. Rows equal in
    doc_id and text are one document: they keep and lose the same sentences. Null text stays null and
    empty text empty; a text of fewer sentences than a run keeps all. Further columns are ignored.

    Each task hashes its runs (128 bits) and keeps only the first of each: the later ones are known to
    repeat already. So a run shared by any number of documents goes out at most once per task, and the
    window over a hash holds as many rows as there are tasks, not documents.
    """
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("t64"),
        F.xxhash64(F.lit(11), F.coalesce("text", F.lit(""))).alias("s64"),
    )

    def hashed(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        digest = xxhash.xxh3_128_intdigest
        half = (1 << 64) - 1
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        names = ["h1", "h2", "doc_id", "t64", "s64", "at", "again"]
        kinds = [pa.int64()] * 5 + [pa.int32(), pa.bool_()]

        def out(first: dict, again: set) -> pa.RecordBatch:
            rows = [(signed(h >> 64), signed(h & half), p[1], p[2], p[3], p[4], False) for h, p in first.items()]
            rows += [(None, None, p[1], p[2], p[3], p[4], True) for p in again]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        first: dict[int, tuple] = {}
        again: set[tuple] = set()
        for batch in batches:
            ids, t64, s64 = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "t64", "s64"))
            for text, doc, t, s in zip(utf8(batch, "text"), ids, t64, s64, strict=True):
                for i, (_, _, run) in enumerate(runs(sentences(text.decode("utf-8", "replace"), options), options)):
                    h, place = digest(run), (doc is None, doc, t, s, i)
                    old = first.setdefault(h, place)
                    if old != place:
                        if _before(place, old):
                            first[h], place = place, old
                        again.add(place)
                if len(first) + len(again) > options.most_keys:
                    yield out(first, again)
                    first, again = {}, set()
        yield out(first, again)

    found = keyed.mapInArrow(hashed, "h1 long, h2 long, doc_id long, t64 long, s64 long, at int, again boolean")
    # both kinds of rows go through one exchange: repeats known already are dealt by place
    order = Window.partitionBy("h1", "h2", F.when(F.col("again"), F.struct("doc_id", "t64", "at"))).orderBy(
        F.col("doc_id").asc_nulls_last(), "t64", "s64", "at"
    )
    late = found.withColumn("rank", F.rank().over(order)).filter("again or rank > 1")
    cover = late.groupBy("doc_id", "t64", "s64").agg(F.collect_set("at").alias("starts"))
    cover = cover.select(F.col("doc_id").alias("_id"), F.col("t64").alias("_t"), F.col("s64").alias("_s"), "starts")
    same = (F.col("t64") == F.col("_t")) & (F.col("s64") == F.col("_s")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    rows = keyed.join(cover, same, "left").select("doc_id", "text", "starts")

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts, totals, counts, lists = [], [], [], []
            column = batch.column(batch.schema.get_field_index("text"))
            starts = batch.column(batch.schema.get_field_index("starts")).to_pylist()
            for text, some in zip(column.to_pylist(), starts, strict=True):
                parts = sentences(text or "", options)
                known = runs(parts, options) if some else []
                lost = {i for at in some or () for i in range(known[at][0], known[at][0] + known[at][1])}
                gone = sorted(lost)
                texts.append("".join(p for i, p in enumerate(parts) if i not in lost) if gone else text)
                totals.append(len(parts))
                counts.append(len(gone))
                lists.append(gone)
            arrays = [batch.column(batch.schema.get_field_index("doc_id")), pa.array(texts, column.type)]
            arrays += [pa.array(totals, pa.int32()), pa.array(counts, pa.int32()), pa.array(lists, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text", "n_sentences", "n_removed", "removed"])

    return rows.mapInArrow(cut, SCHEMA)


def _before(a: tuple, b: tuple) -> bool:
    """Order of places: null ids last."""
    return (a[0], a[1] or 0, *a[2:]) < (b[0], b[1] or 0, *b[2:])
