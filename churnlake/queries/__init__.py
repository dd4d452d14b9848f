"""Operators bound to the given tables, each with its SQL counterpart where one exists."""

from __future__ import annotations

from importlib import import_module

MODULES = ["relational", "joins", "aggregates", "windows", "scalars", "scores", "quality", "warehouse", "lake", "documents", "runs"]


def load() -> None:
    for name in MODULES:
        import_module(f"churnlake.queries.{name}")
