"""What Python workers keep between batches: the objects of one operator at a time.

Spark reuses its Python workers from stage to stage, so caches kept by module
would add up over a pipeline.  ``held`` drops the others' when an operator begins.
"""

from __future__ import annotations

import gc

import pyarrow as pa

from sylvan.session import BATCH_ROWS, small_batches  # noqa: F401 - used by the operators

_HELD: dict = {}


def held(operator: str, key, make):
    if any(k[0] != operator for k in _HELD):
        _HELD.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
    if (operator, key) not in _HELD:
        _HELD[operator, key] = make()
    return _HELD[operator, key]
