"""Threshold ladders and bands built as one CASE expression each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _chain(branches: Sequence[tuple[Column, Any]]) -> Column:
    (cond, value), *rest = branches
    out = F.when(cond, value)
    for cond, value in rest:
        out = out.when(cond, value)
    return out


def first_match(branches: Sequence[tuple[Column, Any]], default: Any = None) -> Column:
    """Value of the first condition that holds, else ``default``."""
    out = _chain(branches)
    return out if default is None else out.otherwise(default)


def at_least(value: Column, steps: Sequence[tuple[float, Any]], default: Any) -> Column:
    """Label of the first (highest) step that ``value`` reaches."""
    return first_match([(value >= edge, label) for edge, label in steps], default)


def above(value: Column, steps: Sequence[tuple[float, Any]], default: Any) -> Column:
    """As ``at_least`` with a strict comparison."""
    return first_match([(value > edge, label) for edge, label in steps], default)


def at_most(value: Column, steps: Sequence[tuple[float, Any]], default: Any) -> Column:
    """Label of the first (lowest) step that still holds ``value``."""
    return first_match([(value <= edge, label) for edge, label in steps], default)


def bin_right_closed(
    value: Column, edges: Sequence[float], labels: Sequence[str], include_lowest: bool = True
) -> Column:
    """Bands ``(a, b]``; null outside the edges. The lowest edge is inside on request."""
    low, high = edges[0], edges[-1]
    inside = (value >= low) if include_lowest else (value > low)
    band = first_match([(value <= edge, label) for edge, label in zip(edges[1:], labels)])
    return F.when(inside & (value <= high), band)


def bin_left_closed(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Bands ``[a, b)`` that are open at both ends of the scale."""
    return first_match([(value < edge, label) for edge, label in zip(edges, labels)], labels[-1])


def map_values(value: Column, mapping: Mapping[str, Any], default: Any = None) -> Column:
    """Dictionary lookup; a missing key gives ``default`` (null when not given)."""
    return first_match([(value == key, v) for key, v in mapping.items()], default)
