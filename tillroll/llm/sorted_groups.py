"""Arrow batches of sorted rows, cut where a group of rows ends."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def key_rows(table: pa.RecordBatch | pa.Table, names: list[str]) -> np.ndarray:
    columns = [table.column(k) for k in names]
    columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
    return np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in columns], axis=1)


def group_bounds(keys: np.ndarray) -> np.ndarray:
    """Starts of the groups of equal consecutive rows, and the end."""
    new = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
    return np.concatenate([[0], new, [len(keys)]])


def whole_groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Tables in which every group of equal (not null) keys is complete."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        own = key_rows(batch, names)
        differs = np.flatnonzero((own != own[-1]).any(axis=1))
        cut = int(differs[-1]) + 1 if len(differs) else 0
        if cut or (held and (last != own[-1]).any()):
            ready = [*held, batch.slice(0, cut)]
            if sum(b.num_rows for b in ready):
                yield pa.Table.from_batches(ready)
            held = []
        held.append(batch.slice(cut))
        last = own[-1]
    if held:
        yield pa.Table.from_batches(held)
