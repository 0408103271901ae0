"""Arrow batches in parts of bounded size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_VALUES = 1 << 18


def list_offsets(lists: pa.Array) -> np.ndarray:
    """Where each list starts and ends among the values that `flatten` gives; a null list has none."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


def list_slices(batches: Iterable[pa.Array], limit: int = SLICE_VALUES) -> Iterator[pa.Array]:
    """The list arrays cut into slices of about `limit` values; a longer list is alone. What a task
    holds besides Spark's batch then does not grow with the rows of a batch."""
    for batch in batches:
        block = list_offsets(batch)[1:] // limit
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(batch)]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                yield batch.slice(start, end - start)
        pa.default_memory_pool().release_unused()
