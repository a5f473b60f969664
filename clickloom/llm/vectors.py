"""What the two vector operators share: checked components and runs of rows that belong together."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str = "embedding") -> Column:
    """Not null, and without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Whole runs of rows with equal `keys` (numbers) of a sorted partition, many at a time, and the runs' first rows."""
    rest: pa.RecordBatch | None = None
    for batch in _with_end(batches):
        if batch is None:
            whole = rest
        else:
            whole = batch if rest is None else pa.concat_batches([rest, batch])
        if whole is None:
            return
        cols = np.stack([whole.column(c).to_numpy() for c in keys], 1)
        first = np.flatnonzero(np.concatenate(([True], (cols[1:] != cols[:-1]).any(1))))
        if batch is not None:
            cut = int(first[-1])
            rest, whole, first = whole.slice(cut), whole.slice(0, cut), first[:-1]
        if whole.num_rows:
            yield whole, np.append(first, whole.num_rows)


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    for batch in batches:
        if batch.num_rows:
            yield batch
    yield None
