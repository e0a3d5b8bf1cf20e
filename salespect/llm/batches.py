"""Small helpers for tasks over Arrow batches that keep the memory of a Python worker low."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa

ROWS = 512  # texts taken from a batch at once
STAGED_ROWS = 1000  # of an Arrow batch in writes of texts and sets


def texts(column: pa.Array, rows: int = ROWS) -> Iterator[list[str | None]]:
    """The texts of a column, some rows at a time, so that few are held as Python strings."""
    for at in range(0, len(column), rows):
        yield column.slice(at, rows).to_pylist()


def tidy(task: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """task, a generator over batches, that gives Arrow's free memory back after each result and at its end.

    A worker outlives its task, and Arrow's pool keeps what batches took. Without
    this every worker of an executor holds the largest batches that it has seen.
    """

    @wraps(task)
    def run(*args, **kwargs):
        pool = pa.default_memory_pool()
        for out in task(*args, **kwargs):
            yield out
            del out
            pool.release_unused()
        pool.release_unused()

    return run
