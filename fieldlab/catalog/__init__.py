"""Registered queries: every operator applied to the given tables."""

from __future__ import annotations

from importlib import import_module

PARTS = ("scans", "shaping", "filtering", "joining", "aggregating", "windowing", "scalars", "upkeep", "reports")


def load():
    """Import all parts once and return the register."""
    for part in PARTS:
        import_module(f"fieldlab.catalog.{part}")
    return import_module("fieldlab.catalog.registry")
