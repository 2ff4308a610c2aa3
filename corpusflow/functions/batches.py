"""Python work on texts, a bounded slice of an Arrow batch at a time.

Spark fills an Arrow batch by a number of rows, however much Python makes of each. What a
function makes of a slice goes back to Spark before the next slice is worked, so a worker
holds the batch as Arrow and the Python objects of one slice.
"""

from __future__ import annotations

from typing import Iterator, Tuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

#: Rows and bytes of text in a slice; a longer text is a slice by itself.
SLICE_ROWS, SLICE_BYTES = 256, 1 << 20


def slices(columns: list[pa.Array], rows: int = SLICE_ROWS, size: int = SLICE_BYTES) -> Iterator[Tuple[int, int]]:
    """(first row, number of rows) of the slices of a batch, which cover it in order."""
    n = len(columns[0])
    texts = [c for c in columns if pa.types.is_string(c.type) or pa.types.is_large_string(c.type)]
    ends = np.cumsum(sum((pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in texts),
                         np.zeros(n, np.int64)))
    at, before = 0, 0
    while at < n:
        upto = max(min(int(np.searchsorted(ends, before + size, side="right")), at + rows), at + 1)
        yield at, upto - at
        at, before = upto, int(ends[upto - 1])


def sliced(udf, returns: pa.DataType):
    """The pandas UDF ``udf`` (series of the same length in and out) worked by ``slices``. Spark may
    not copy it into a filter, as it does with the size of an exploded array: it runs once a row."""
    work, kind = udf.func, udf.returnType

    @F.arrow_udf(kind)
    def run(batches: Iterator[Tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            columns = list(batch) if isinstance(batch, tuple) else [batch]  # of one argument, the column itself
            for at, n in slices(columns):
                given = [pd.Series(c.slice(at, n).to_pylist(), dtype=object) for c in columns]
                yield pa.array(work(*given).tolist(), returns)

    return run.asNondeterministic()
