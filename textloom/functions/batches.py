"""Arrow batches in Python workers: cut into runs of bounded size, memory given back."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def runs(batch: pa.Array, size: int) -> Iterator[pa.Array]:
    """Slices of ``batch`` with about ``size`` bytes of text or list elements each, one row at
    least: what is made of a run does not grow with the rows or the length of a batch."""
    lists = pa.types.is_list(batch.type) or pa.types.is_large_list(batch.type)
    lengths = pc.list_value_length(batch) if lists else pc.binary_length(batch)
    before = np.cumsum(pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False), dtype="int64")
    at = 0
    while at < len(batch):
        held = before[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(before, held + size, "right")))
        yield batch.slice(at, to - at)
        at = to


def lists_of(flat: pa.Array, sizes, nulls: pa.Array | None = None) -> pa.ListArray:
    """``flat`` as lists of ``sizes`` (0 where ``nulls`` is true)."""
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype="int64")]).astype("int32")
    return pa.ListArray.from_arrays(pa.array(offsets), flat, mask=nulls)


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on for other tasks and
    stages and otherwise keeps the most it ever held."""
    import ctypes

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):      # not this C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)
