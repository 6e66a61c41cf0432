"""Sequence functions as pure column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reverse_complement(seq: Column, keep_case: bool = False) -> Column:
    """Reverse complement; other letters (N) stay. With ``keep_case`` lower-case bases are mapped too."""
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca") if keep_case else F.translate(seq, "ACGT", "TGCA"))


def swap_bases(seq: Column, pair: str) -> Column:
    """Exchanges the two bases of ``pair`` (for instance ``"GC"``)."""
    return F.translate(seq, pair, pair[::-1])


def kmers(seq: Column, k: int) -> Column:
    """Array of all k-mers in order; empty where the sequence is shorter than ``k``."""
    places = F.sequence(F.lit(1), F.greatest(F.length(seq) - k + 1, F.lit(1)))
    return F.when(F.length(seq) >= k, F.transform(places, lambda i: F.substring(seq, i, F.lit(k)))).otherwise(F.array().cast("array<string>"))


def minimizer(seq: Column, k: int = 21) -> Column:
    """Least k-mer over both strands; null where the sequence is shorter than ``k``."""
    return F.array_min(F.concat(kmers(seq, k), kmers(reverse_complement(seq), k)))


def neighbours(seq: Column, n: int) -> Column:
    """All sequences within one substitution of the ``n`` bases of ``seq``, itself included."""
    swapped = [F.overlay(seq, F.lit(b), F.lit(i), F.lit(1)) for i in range(1, n + 1) for b in "AGCT"]
    return F.array_distinct(F.array(seq, *swapped))


def hamming(a: Column, b: Column) -> Column:
    """Differing places of two strings of equal length; null otherwise."""
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int"))
    return F.when(F.length(a) == F.length(b), F.aggregate(pairs, F.lit(0), lambda s, x: s + x))


def gc_count(seq: Column) -> Column:
    return F.length(seq) - F.length(F.translate(F.upper(seq), "GC", ""))


def low_complexity(seq: Column, share: float = 0.8) -> Column:
    """One base makes up ``share`` of the sequence, or it is empty."""
    counts = [F.length(seq) - F.length(F.replace(seq, F.lit(b))) for b in "ACGT"]
    return (F.length(seq) == 0) | (F.greatest(*counts) >= share * F.length(seq))


def cigar_matched(cigar: Column) -> Column:
    """Sum of the M lengths of a CIGAR string."""
    lengths = F.regexp_extract_all(cigar, F.lit(r"(\d+)M"), F.lit(1))
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))


def has_flag(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(F.lit(bit)) != 0


def barcode_of(name: Column, tag: Column | None = None, length: int | None = None) -> Column:
    """Barcode from the tag, else from the read name between ``#`` and ``/``; empty gives null."""
    found = F.regexp_extract(name, r"^[^#]*#([^#/]*)", 1)
    found = F.substring(found, 1, length) if length else found
    found = F.when(found != "", found)
    return found if tag is None else F.coalesce(tag, found)


def read_id_of(header: Column) -> Column:
    """Header up to white space, then up to ``/``."""
    return F.substring_index(F.element_at(F.split(header, r"\s+"), 1), "/", 1)


def optional_int(text: Column, tag: str) -> Column:
    """Value of an optional ``TAG:i:<digits>`` field; null where it is missing or negative."""
    return F.expr("cast(null as int)") if not tag else F.nullif(F.regexp_extract(text, rf"\b{tag}:i:(\d+)", 1), F.lit("")).cast("int")


def cs_tokens(cs: Column) -> Column:
    """Tokens of a ``cs`` tag, in order."""
    return F.regexp_extract_all(cs, F.lit(r"(:[0-9]+|\*[a-z][a-z]|[=+\-][A-Za-z]+|~[a-z]{2}[0-9]+[a-z]{2})"), F.lit(1))


def has_text_flag(flag: Column, bit: int, letter: str) -> Column:
    """Bit of a flag given as digits, else whether the old text form has ``letter``."""
    return F.when(flag.rlike(r"^\d+$"), has_flag(flag.try_cast("int"), bit)).otherwise(flag.contains(letter))


def motif_place(seq: Column, motif: str) -> Column:
    """First place (from 1) of a motif, -1 where it is missing."""
    at = F.instr(seq, F.lit(motif))
    return F.when(at == 0, -1).otherwise(at)


def spike_id(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"(ERCC-\d+)", 1), F.lit(""))


def species_of(header: Column) -> Column:
    """``Genus species`` of a FASTA header that begins with ``Genus_species``."""
    return F.replace(F.regexp_extract(header, r"^([A-Za-z]+_[a-z]+)", 1), F.lit("_"), F.lit(" "))


def read_identity(name: Column) -> Column:
    """(read_id, barcode) around the first ``#``; barcode ``NA`` without one."""
    at = F.instr(name, F.lit("#"))
    return F.struct(F.substring_index(name, "#", 1).alias("read_id"), F.when(at == 0, "NA").otherwise(F.substring(name, at + 1, F.length(name))).alias("barcode"))
