"""A memory that lives as long as a Python worker, so that one task's lookups serve the next."""

from __future__ import annotations


def worker_memory(name: str) -> dict:
    """The worker's dictionary of this name; empty at first. It only saves work: any task can do without it."""
    import sys
    import types

    kept = sys.modules.setdefault("scenewright_worker_memory", types.ModuleType("scenewright_worker_memory"))
    return kept.__dict__.setdefault("memories", {}).setdefault(name, {})
