"""Names of reads, contigs and barcodes, and pieces of sequences, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def piece(seq: Column, start: int, length: int) -> Column:
    """``length`` bases from the 1-based ``start`` on, as far as there are any.

    Both ends follow slices: an end before the sequence counts back from its last base (``start`` 0 is the
    last base), and a piece whose end does not lie behind its start is empty.
    """
    first, size = start - 1, F.length(seq)

    def place(at: int) -> Column:
        return F.least(size, F.lit(at)) if at >= 0 else F.greatest(size + at, F.lit(0))

    low, high = place(first), place(first + length)
    return F.substring(seq, low + 1, F.greatest(high - low, F.lit(0)))


def umi_of(name: Column, length: int | None = None) -> Column:
    """What follows the last ``#`` of a read name, cut to ``length``; null without a ``#``."""
    last = F.substring_index(name, "#", -1)
    last = last if length is None else F.substring(last, 1, length)
    return F.when(F.contains(name, F.lit("#")), last)


def placed_name(name: Column, pos: Column, length: int, paired: bool) -> Column:
    """``umi#pos#name``; the name of a paired read loses its mate suffix of two characters.

    A name without ``#`` serves as its own UMI.
    """
    umi = F.substring(F.substring_index(name, "#", -1), 1, length)
    kept = F.substring(name, F.lit(1), F.greatest(F.length(name) - 2, F.lit(0))) if paired else name
    return F.concat_ws("#", umi, pos.cast("string"), kept)


def tagged_name(name: Column, tag: Column) -> Column:
    """``name_tag`` where there is a tag, else the name."""
    return F.concat_ws("_", name, tag)


def short_record(header: Column, head: int = 28, tail: int = 2) -> Column:
    """First ``head`` and last ``tail`` characters of a record's name (up to the first blank)."""
    name = F.substring_index(header, " ", 1)
    return F.concat(F.substring(name, 1, head), F.right(name, F.lit(tail)))


def known_contig(name: Column, known: Column) -> Column:
    """The contig as the reference list ``known`` spells it, with or without ``chr``; else as given."""
    other = F.when(name.startswith("chr"), F.substring(name, 4, 1 << 20)).otherwise(F.concat(F.lit("chr"), name))
    return F.when(F.array_contains(known, name), name).when(F.array_contains(known, other), other).otherwise(name)


def is_main_chromosome(name: Column) -> Column:
    """chr1 to chr22, chrX, chrY."""
    return name.rlike(r"^chr([1-9]|1[0-9]|2[0-2]|X|Y)$")


def is_artefact(barcode: Column, run: int = 14) -> Column:
    """A barcode with an unread base or a run of ``run`` times A."""
    return F.contains(barcode, F.lit("N")) | F.contains(barcode, F.lit("A" * run))


def without_unread(seq: Column) -> Column:
    """The sequence without its unread bases."""
    return F.translate(seq, "Nn", "")


def clipped(cigar: Column, match_side: str, least_match: int, least_clip: int) -> Column:
    """A soft-clipped read whose first match lies on ``match_side`` (left, right) of its first clip, with a
    match and a clip of the least lengths. Reads without a clip or without a match are none."""
    if match_side not in ("left", "right"):
        raise ValueError("match_side is left or right")
    match, clip = F.instr(cigar, "M"), F.instr(cigar, "S")
    sided = match < clip if match_side == "left" else match > clip

    def longest(op: str) -> Column:
        return F.array_max(F.transform(F.regexp_extract_all(cigar, F.lit(rf"(\d+){op}"), F.lit(1)), lambda x: x.cast("long")))

    reached = (longest("M") >= least_match) & (longest("S") >= least_clip)
    return F.coalesce((match > 0) & (clip > 0) & sided & reached, F.lit(False))
