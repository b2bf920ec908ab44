"""Vector columns as numpy matrices inside Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def usable(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, float64 matrix) for each length of the vectors that are there and
    hold no null and no non-finite entry."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    there = np.flatnonzero(lengths >= 0)
    flat = column.flatten()  # of the lists that are there
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    ends = np.cumsum(lengths[there])
    begins = ends - lengths[there]
    bad = np.append(0, np.cumsum(~np.isfinite(values)))  # an entry that is null comes as NaN
    fine = bad[ends] == bad[begins]
    for d in np.unique(lengths[there][fine]).tolist():
        own = fine & (lengths[there] == d)
        places = begins[own][:, None] + np.arange(d)
        yield there[own], values[places]
