"""Whole sessions out of Arrow batches of rows that come sorted by session."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def _changes(batch: pa.RecordBatch, keys: int) -> np.ndarray:
    """Rows, from the second on, that differ from the one before in one of the first ``keys`` columns."""
    n, differ = batch.num_rows, np.zeros(max(batch.num_rows - 1, 0), bool)
    for k in range(keys):
        column = batch.column(k)
        differ |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(differ) + 1


def whole_sessions(batches: Iterator[pa.RecordBatch], keys: int = 1) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of whole sessions, and the row at which each begins.

    The rows come sorted by their first ``keys`` columns, which hold no NULL and tell the sessions apart.  The session that a
    batch ends in waits for the next batch, so a task holds a batch and one session.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        # the last held row in front: its session goes on if the first row is no change
        seam = pa.concat_batches([held[-1].slice(held[-1].num_rows - 1), batch]) if held else batch
        at = _changes(seam, keys) - bool(held)
        if not len(at):
            held.append(batch)
            continue
        done = pa.concat_batches([*held, batch.slice(0, at[-1])])
        before = sum(b.num_rows for b in held)
        starts = np.concatenate(([0], at[:-1] + before))
        held = [batch.slice(at[-1])]
        yield done, starts
    if held:
        yield pa.concat_batches(held), np.zeros(1, np.int64)
