"""Run options: defaults, quality presets, and gate limits by barcode mode."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields, replace
from typing import Any


@dataclass(frozen=True)
class QcSettings:
    read_filter: bool
    max_span_ratio: float
    min_local_span_ratio: float


# fixed values
PRESETS = {
    "none": QcSettings(False, 0.0, 0.0),
    "high_div": QcSettings(True, 0.15, 0.0),
    "sensitive": QcSettings(True, 0.15, 0.0),
    "balanced": QcSettings(True, 0.25, 0.0),
    "strict": QcSettings(True, 0.25, 0.20),
}
ALIASES = {"off": "none", "raw": "none", "soil": "high_div", "environmental": "high_div"}


def preset_name(value: Any) -> str:
    """Name of a preset or ``auto``. A YAML ``off`` arrives as False and means ``none``; True is an error."""
    if value is False:
        return "none"
    name = value.strip().lower() if isinstance(value, str) else ""
    name = ALIASES.get(name, name)
    if name != "auto" and name not in PRESETS:
        raise ValueError(f"unknown quality preset {value!r}: take auto or one of {sorted(PRESETS)}")
    return name


def resolve_qc(config: Mapping[str, Any], probe: Mapping[str, str] | None = None) -> tuple[str, QcSettings]:
    """Preset and settings: ``auto`` takes the probe's suggestion (balanced without a known one); keys in ``config`` override the preset's."""
    name = preset_name(config.get("qc_preset", "auto"))
    if name == "auto":
        suggested = (probe or {}).get("suggested_qc_preset", "balanced")
        name = suggested if suggested in PRESETS else "balanced"
    own = {f.name: config[f.name] for f in fields(QcSettings) if f.name in config}
    return name, replace(PRESETS[name], **own)


def gate_limits(mode: str, paired: bool, linked_random: bool, min_reads: int | str = "default", min_mapq: int | str = "default") -> tuple[int, int]:
    """(reads per fragment, mapping quality); each ``default`` is resolved by itself.

    Random barcodes of the linked-contig protocol take 100 and 0, other libraries 4 and 30, single-end ones half the reads.
    """
    reads, quality = (100, 0) if linked_random and "random_bc" in mode else (4 if paired else 2, 30)
    return reads if min_reads == "default" else int(min_reads), quality if min_mapq == "default" else int(min_mapq)


def filled(params: Mapping[str, Any], defaults: Mapping[str, Any], placeholder: str = "/path/to") -> dict[str, Any]:
    """``params`` with defaults where a value is missing, empty or a placeholder path."""
    unset = lambda v: v is None or v == "" or str(v).startswith(placeholder)
    return dict(params) | {k: v for k, v in defaults.items() if unset(params.get(k))}
