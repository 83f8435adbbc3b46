"""What the two vector operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for vectors that are not null and hold neither nulls nor non-finite components."""
    fine = F.forall(vector, lambda x: F.coalesce(x, F.lit(float("nan")).cast("double")).between(-1.7976931348623157e308, 1.7976931348623157e308))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """A list column as a double matrix; shorter vectors are filled up with zeros."""
    lengths = np.asarray(column.value_lengths(), dtype=np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    widest = int(lengths.max(initial=0)) if width is None else max(width, int(lengths.max(initial=0)))
    if len(lengths) and (lengths == widest).all():
        return flat.reshape(len(lengths), widest)
    out = np.zeros((len(lengths), widest))
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def widened(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The slices of sorted `batches` over which `keys` stay the same, with their values; one key may take several."""
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, dtype=bool)
        for k in keys:
            values = batch.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:], strict=False):
            yield tuple(batch.column(k)[a].as_py() for k in keys), batch.slice(a, b - a)
