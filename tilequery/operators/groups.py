"""Grouped work in Arrow that takes many small groups at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  used as pa.compute
from pyspark.sql import DataFrame

#: Rows that a call gets at least, while there are more.
ROWS = 1 << 16


def starts(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """Where a group begins in rows sorted by ``keys``."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for k in keys:
        code = rows.column(k).combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy()
        new[1:] |= np.diff(code) != 0
    return new


def in_groups(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], pa.Table], schema: str, most: int | None = None) -> DataFrame:
    """``fn`` over whole groups, which it gets sorted by ``keys``: as many as fill ``ROWS`` rows (or ``most``, if that is less), or one larger. A call costs milliseconds, which a group of a few rows is not worth."""

    least = min(ROWS, most or ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, enough = [], 0, least
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < enough:
                continue
            rows = pa.Table.from_batches(held)
            cut = int(np.flatnonzero(starts(rows, keys))[-1])
            if cut:
                yield from fn(rows.slice(0, cut).combine_chunks()).to_batches(least)
            held = rows.slice(cut).to_batches()
            n -= cut
            enough = max(least, 2 * n)  # a large group is looked at again only when it has doubled
        if n:
            yield from fn(pa.Table.from_batches(held).combine_chunks()).to_batches(least)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
