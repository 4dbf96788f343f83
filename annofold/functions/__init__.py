"""Scalar column functions."""

from annofold.functions.scalars import (
    as_fraction,
    clip_unit,
    length_bin,
    number,
    stable_hash,
    strict_unit,
    thresholds,
)

__all__ = ["as_fraction", "clip_unit", "length_bin", "number", "stable_hash", "strict_unit", "thresholds"]
