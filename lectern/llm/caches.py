"""Memory that a worker keeps between tasks of one operator, given back when another one begins."""

from __future__ import annotations

import gc
from collections.abc import Callable

import pyarrow as pa

_CLEAR: dict[str, Callable[[], object]] = {}
_FILLED: set[str] = set()


def keeps(name: str, clear: Callable[[], object]) -> None:
    """Registers a cache; clear empties it."""
    _CLEAR[name] = clear


def only(name: str | None = None) -> None:
    """Empties all caches but the named one, which may be filled from now on. Called where an operator's work on a batch or partition begins."""
    others = _FILLED - {name}
    for other in others:
        _CLEAR[other]()
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
    _FILLED.clear()
    if name:
        _FILLED.add(name)
