"""What Python workers hold between tasks.

Spark hands a worker on from stage to stage, so what one kind of work leaves behind lies beside the heap during all
others, in each of an executor's workers.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps

import pyarrow as pa

_KEEPING: list = []


def kept(size: int):
    """A function whose results a worker keeps from task to task, until it is given a task of another kind."""

    def keeping(make: Callable):
        _KEEPING.append(lru_cache(maxsize=size)(make))
        return _KEEPING[-1]

    return keeping


def drop_but(own=None) -> None:
    """Drop what is kept for others than ``own``."""
    others = [x for x in _KEEPING if x is not own and x.cache_info().currsize]
    for x in others:
        x.cache_clear()
    if others:
        gc.collect()


def give_back() -> None:
    """Give what is freed back to the system; with WORKER_MEMORY that is also what Python and numpy have freed."""
    pa.default_memory_pool().release_unused()


def task(run: Callable[[Iterator], Iterator], own=None) -> Callable[[Iterator], Iterator]:
    """``run`` for ``mapInArrow`` or an Arrow function of iterators: it begins without what others have kept, and at
    its end the worker gives back what it has freed. ``own`` is the function marked ``kept`` that ``run`` calls."""

    @wraps(run)
    def tidy(parts):
        drop_but(own)
        try:
            yield from run(parts)
        finally:
            give_back()

    return tidy
