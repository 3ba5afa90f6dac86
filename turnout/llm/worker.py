"""What a Python worker keeps from one task to the next.

Spark gives a worker tasks of one operator after another.  It keeps what the operator at hand has learnt and
nothing of those before, so that a pipeline takes the memory of its largest stage, not that of all together.
"""

import gc
from collections.abc import Callable, Hashable

import pyarrow as pa

_KEPT: dict = {}


def release() -> None:
    """Give back what tasks of other operators left here."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()  # memos and what fills them refer to each other
        pa.default_memory_pool().release_unused()


def kept(key: Hashable, make: Callable):
    """What ``make`` returned for ``key``, until the worker turns to something else."""
    if key not in _KEPT:
        release()
        _KEPT[key] = make()
    return _KEPT[key]
