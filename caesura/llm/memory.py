"""Memory that a Python worker is done with, given back to the system."""

from __future__ import annotations

import ctypes

import pyarrow as pa

_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only


def give_back() -> None:
    """Frees what the allocators of Arrow and of C keep for later. Workers live on through all stages of a session, two or more beside an executor's JVM."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)
