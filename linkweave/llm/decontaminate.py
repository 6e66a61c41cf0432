"""Benchmark decontamination: broadcast table of test n-grams, verified hits, spans or documents removed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame

from .common import utf8, written

SCHEMA = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
    "item_ids array<string>, hit_spans array<struct<start:int,stop:int>>"
)

#: Letters to lower case, every other ASCII non-word byte to a space; bytes from 0x80 are word bytes.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def fold_words(text: bytes) -> list[bytes]:
    """Normalised words of a text."""
    return text.translate(_FOLD).split()


class BenchmarkWindows:
    """The windows of a set of items: word numbers, and for each window length a map to its items."""

    def __init__(self, items: Iterable[tuple[str | None, bytes]], n: int):
        self.codes: dict[bytes, int] = {}
        self.by_length: dict[int, dict[tuple[int, ...], frozenset[str | None]]] = {}
        found: dict[int, dict[tuple[int, ...], set[str | None]]] = {}
        for item, text in items:
            words = [self.codes.setdefault(w, len(self.codes)) for w in fold_words(text)]
            size = min(n, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                found.setdefault(size, {}).setdefault(tuple(words[i : i + size]), set()).add(item)
        for size, windows in found.items():
            self.by_length[size] = {w: frozenset(i) for w, i in windows.items()}

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Merged hit spans of word positions, and the items whose windows occur."""
        codes = self.codes
        ids = [codes.get(w, -1) for w in words]
        items: set[str | None] = set()
        spans: list[tuple[int, int]] = []
        # runs of words that the benchmark knows; only a run as long as a window can hold one
        least = min(self.by_length, default=0)
        if not least:
            return [], items
        at, total = 0, len(ids)
        runs = []
        while at < total:
            if ids[at] < 0:
                at += 1
                continue
            stop = at
            while stop < total and ids[stop] >= 0:
                stop += 1
            if stop - at >= least:
                runs.append((at, stop))
            at = stop
        for size, windows in self.by_length.items():
            for start, stop in runs:
                for i in range(start, stop - size + 1):
                    hit = windows.get(tuple(ids[i : i + size]))
                    if hit:
                        items |= hit
                        spans.append((i, i + size))
        return _merge(spans), items


def benchmark_blocks(benchmark: DataFrame, n: int, max_bytes: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """The items in blocks of at most ``max_bytes`` of text, one block at a time; there is always a first block.

    An item of more text comes in pieces that share ``n`` - 1 words, so they have the same windows together.
    """
    rows = benchmark.selectExpr("cast(item_id as string) as item_id", "text")
    block: list[tuple[str | None, bytes]] = []
    size, sent = 0, False
    for item, text in rows.toLocalIterator():
        raw = (text or "").encode()
        for piece in _item_pieces(raw, n, max_bytes) if len(raw) > max_bytes else [raw]:
            if size and size + len(piece) > max_bytes:
                yield block
                block, size, sent = [], 0, True
            block.append((item, piece))
            size += len(piece)
    if block or not sent:
        yield block


def _item_pieces(raw: bytes, n: int, max_bytes: int) -> Iterator[bytes]:
    """Normalised pieces of about ``max_bytes``; each but the first begins with the last ``n`` - 1 words before it."""
    some: list[bytes] = []
    size = 0
    for word in fold_words(raw):
        if size + len(word) + 1 > max_bytes and len(some) >= 2 * n:
            yield b" ".join(some)
            some = some[len(some) - n + 1 :]
            size = sum(len(w) + 1 for w in some)
        some.append(word)
        size += len(word) + 1
    yield b" ".join(some)


def _passes(docs: DataFrame, columns: list[str], benchmark: DataFrame, n: int, max_bytes: int, finish, schema: str) -> DataFrame:
    """One pass over ``docs`` per benchmark block; rows carry what the passes before found.

    A task holds one block's windows at a time: between passes the rows are written to the shared folder.
    The benchmark is a fixed set beside the corpus, mostly one block. ``finish`` makes the final batch from
    a batch, its texts, their numbers of words, spans and items.
    """
    spark = docs.sparkSession
    extra = ["spans", "items"]
    while {c.lower() for c in columns} & set(extra):
        extra = [f"_{x}" for x in extra]
    blocks = benchmark_blocks(benchmark, n, max_bytes)
    now, after, first = docs, next(blocks), True
    while after is not None:
        block, after = spark.sparkContext.broadcast(after), next(blocks, None)

        def scan(batches: Iterator, block=block, first=first, last=after is None) -> Iterator:
            import pyarrow as pa

            table = BenchmarkWindows(block.value, n)
            for batch in batches:
                texts = utf8(batch, "text")
                known = [([], set())] * len(texts) if first else _carried(batch)
                counts, spans, items = [], [], []
                for text, (old, named) in zip(texts, known, strict=True):
                    words = fold_words(text)
                    new, more = table.scan(words)
                    counts.append(len(words))
                    spans.append(_merge(old + new) if old and new else old or new)
                    items.append(named | more if named and more else named or more)
                own = pa.RecordBatch.from_arrays(batch.columns[: len(columns)], schema=pa.schema(list(batch.schema)[: len(columns)]))
                if last:
                    yield finish(own, texts, counts, spans, items)
                else:
                    flat = pa.array([[x for s in some for x in s] for some in spans], pa.list_(pa.int32()))
                    lists = pa.array([list(some) for some in items], pa.list_(pa.string()))
                    yield pa.RecordBatch.from_arrays([*own.columns, flat, lists], names=[*columns, *extra])

        if after is None:
            return now.mapInArrow(scan, schema)
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
        now, first = written(now.mapInArrow(scan, f"{fields}, {extra[0]} array<int>, {extra[1]} array<string>")), False
    raise AssertionError("there is always a block")


def _carried(batch) -> list[tuple[list[tuple[int, int]], set]]:
    """Spans, as (start, stop) in word positions, and items (null: one without id) that the passes before left in the last two columns."""
    flat, items = batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
    return [(list(zip(s[::2], s[1::2], strict=True)), set(i)) for s, i in zip(flat, items, strict=True)]


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, max_bytes: int = 32 << 20) -> DataFrame:
    """Per row of ``docs``: words, hit words, the items found and the hit spans (in word positions).

    Null or empty texts have no words and no hits; items without words have no window. The windows of items with a
    null item_id count as those of one more item, which no list names. Repeated rows are rows of their own;
    an empty benchmark hits nothing. Further columns of either table are ignored. Narrow: the benchmark
    windows are broadcast in blocks of ``max_bytes``, the corpus isn't shuffled.
    """

    def finish(batch, texts: list[bytes], counts: list[int], spans: list, items: list):
        import pyarrow as pa

        columns: list[list] = [[] for _ in range(7)]
        for count, some, found in zip(counts, spans, items, strict=True):
            named = sorted(i for i in found if i is not None)
            digest = hashlib.sha256(",".join(named).encode()).hexdigest()
            hit = sum(b - a for a, b in some)
            row = (count, hit, len(found), digest, hit > 0, named, [{"start": a, "stop": b} for a, b in some])
            for column, value in zip(columns, row, strict=True):
                column.append(value)
        span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        kinds = [pa.int64()] * 3 + [pa.string(), pa.bool_(), pa.list_(pa.string()), span]
        arrays = [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
        names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "item_ids", "hit_spans"]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    narrow = docs.selectExpr("cast(doc_id as long) as doc_id", "text")
    return _passes(narrow, ["doc_id", "text"], benchmark, n, max_bytes, finish, SCHEMA)


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the bytes from the first to the last word of each span of word positions."""
    if not spans:
        return text
    import re

    places = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(_FOLD))]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : places[a][0]])
        at = places[b - 1][1]
    out.append(text[at:])
    return b"".join(out)


def remove_contamination(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, max_hit_share: float = 0.2, max_bytes: int = 32 << 20
) -> DataFrame:
    """``docs`` with the same columns, whatever their names: hit spans are cut out of the text; a document is
    dropped where more than ``max_hit_share`` of its words are hit. Texts without a hit are returned unchanged,
    null ones too; repeated rows fare alike; an empty table gives no rows."""
    schema, place = docs.schema, docs.columns.index("text")

    def finish(batch, texts: list[bytes], counts: list[int], spans: list, items: list):
        import pyarrow as pa

        keep, changed = [], False
        for i, (text, some) in enumerate(zip(texts, spans, strict=True)):
            hit = sum(b - a for a, b in some)
            keep.append(not hit or hit <= max_hit_share * counts[i])
            if hit and keep[-1]:
                texts[i], changed = cut_spans(text, some), True
        if changed:
            nulls = batch.column(place).is_null().to_pylist()
            made = [None if null else t.decode("utf-8") for t, null in zip(texts, nulls, strict=True)]
            arrays = [pa.array(made, batch.schema.field(place).type) if i == place else c for i, c in enumerate(batch.columns)]
            batch = pa.RecordBatch.from_arrays(arrays, schema=batch.schema)
        return batch if all(keep) else batch.filter(pa.array(keep, pa.bool_()))

    return _passes(docs, docs.columns, benchmark, n, max_bytes, finish, schema)


#: DuckDB form of the query's digest columns.
ORACLE = r"""
WITH words AS (
  SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', CAST(item_id AS VARCHAR),
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), item_windows AS (
  SELECT DISTINCT id AS item, least(10, len(w)) AS size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM words WHERE kind = 'b' AND len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT id, i, size, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM (SELECT id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, sizes WHERE kind = 'd' AND len(w) >= size)
), hits AS (
  SELECT d.id, d.i, d.size, b.item FROM doc_windows d JOIN item_windows b ON d.win = b.win AND d.size = b.size
), hit_words AS (
  SELECT id, count(DISTINCT p) AS n FROM (SELECT id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY id
), hit_items AS (
  SELECT id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT id, item FROM hits) GROUP BY id
)
SELECT d.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(t.n, 0) AS BIGINT) AS n_items, sha256(coalesce(t.items, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM documents d JOIN words w ON w.kind = 'd' AND w.id = CAST(d.doc_id AS VARCHAR)
LEFT JOIN hit_words h ON h.id = w.id LEFT JOIN hit_items t ON t.id = w.id
"""
