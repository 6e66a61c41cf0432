"""Quality rules by compression bands, on top of word and line counts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame

from .common import utf8

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, whole_ratio double, least_chunk double, most_chunk double, reason string"
)


@dataclass(frozen=True)
class Band:
    """Limits of compressed/raw size for texts of ``up_to`` bytes at most."""

    up_to: float
    low: float
    high: float


@dataclass(frozen=True)
class QualityOptions:
    """``bands`` hold for whole texts by their length; ``chunk_low``/``chunk_high`` for every chunk of
    ``chunk`` bytes; the last chunk ends with the text, so it may overlap the one before and no byte is left out.

    Short texts carry frame overhead and little history, hence the wide bands there. A text is
    rejected as soon as the whole or any chunk leaves its band.
    """

    level: int = 3
    chunk: int = 2048
    bands: tuple[Band, ...] = (
        Band(256, 0.30, 4.00),
        Band(1024, 0.30, 1.00),
        Band(4096, 0.25, 0.90),
        Band(16384, 0.20, 0.85),
        Band(float("inf"), 0.15, 0.80),
    )
    chunk_low: float = 0.10
    chunk_high: float = 0.90
    min_words: int = 50
    max_repeat_percent: int = 50


_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"


def repeat_words(words: list[bytes]) -> int:
    """Words covered by 3-word windows that occur at least twice in ``words``."""
    import numpy as np

    n = len(words)
    if n < 4:
        return 0
    codes: dict[bytes, int] = {}
    number = codes.setdefault
    ids = np.fromiter([number(w, len(codes)) for w in words], np.int64, n)
    if len(codes) == n:
        return 0
    pairs = ids[:-1] * len(codes) + ids[1:]
    if len(codes) > 2_000_000:  # pair numbers are ranked so that a triple still fits 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    triples = pairs[:-1] * len(codes) + ids[2:]
    order = np.argsort(triples, kind="stable")
    ranked = triples[order]
    same = np.concatenate(([False], ranked[1:] == ranked[:-1], [False]))
    twice = np.zeros(n - 2, bool)
    twice[order] = same[1:] | same[:-1]
    covered = np.zeros(n, bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def dup_lines(text: bytes) -> int:
    """Lines with at least one word that equal an earlier line."""
    seen: set[bytes] = set()
    n = 0
    for line in text.split(b"\n"):
        if line in seen:
            n += 1
        elif line.strip(_SPACE):
            seen.add(line)
    return n


def verdict(text: bytes, options: QualityOptions, pack) -> tuple[float, float | None, float | None, str]:
    """Whole ratio, least and most chunk ratio, and the reason for a rejection (or empty).

    A text shorter than a chunk has no chunk; its whole ratio has the band of its length.
    """
    whole = len(pack(text)) / max(1, len(text))
    least = most = None
    last = len(text) - options.chunk
    for at in [*range(0, last, options.chunk), last] if last >= 0 else []:
        ratio = len(pack(text[at : at + options.chunk])) / options.chunk
        least, most = min(ratio, least or ratio), max(ratio, most or ratio)
    band = next(b for b in options.bands if len(text) <= b.up_to)
    if whole < band.low or least is not None and least < options.chunk_low:
        return whole, least, most, "repetitive"
    if whole > band.high or most is not None and most > options.chunk_high:
        return whole, least, most, "incompressible"
    return whole, least, most, ""


def quality_rules(docs: DataFrame, options: QualityOptions = QualityOptions()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; further columns are ignored) with counts and verdict.

    Null text counts as empty: no words, so it fails the base rule. Repeated rows and null doc_id are
    kept as rows of their own. Narrow: no shuffle, one Arrow pass over whole texts.
    """

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        pack = zstandard.ZstdCompressor(level=options.level, write_checksum=False).compress
        for batch in batches:
            columns: list[list] = [[] for _ in range(11)]
            for text in utf8(batch, "text"):
                words = text.split()
                n = len(words)
                repeated = repeat_words(words)
                chars = b"".join(words).decode("utf-8", "replace")
                failed = n < options.min_words or 100 * repeated > options.max_repeat_percent * n
                whole, least, most, reason = verdict(text, options, pack)
                symbols = len(text) - len(text.translate(None, _SYMBOLS))
                row = (n, len(chars), symbols, dup_lines(text), repeated, failed, not failed and not reason)
                for column, value in zip(columns, (*row, whole, least, most, "base" if failed else reason), strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 3 + [pa.string()]
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            arrays = [ids, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
            names = [f.split()[0] for f in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    narrow = docs.selectExpr("cast(doc_id as long) as doc_id", "text")
    return narrow.mapInArrow(scan, SCHEMA)


def keep_good(docs: DataFrame, options: QualityOptions = QualityOptions()) -> DataFrame:
    """The rows of ``docs`` that pass all rules, with the same columns, whatever their names.

    Null and empty texts fail the base rule; repeated rows are judged alike; an empty table gives no rows.
    """

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        pack = zstandard.ZstdCompressor(level=options.level, write_checksum=False).compress
        for batch in batches:
            keep = []
            for text in utf8(batch, "text"):
                words = text.split()
                bad = len(words) < options.min_words or 100 * repeat_words(words) > options.max_repeat_percent * len(words)
                keep.append(not bad and not verdict(text, options, pack)[3])
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(scan, docs.schema)
