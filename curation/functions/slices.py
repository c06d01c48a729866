"""Texts of an Arrow batch worked through a few MB at a time.

A batch holds up to 10 000 rows or 64 MB, and as Python texts with what is
made of them several times that.  So a scan turns one slice of a batch into
Python texts, and sends its results on, before it takes the next; one text is
never cut, so a very long text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

#: Text bytes of a slice.
SLICE_BYTES = 2 << 20


def slice_bounds(texts: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """``(begin, end)`` of runs of rows that hold about ``max_bytes``."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < len(texts):
        done = ends[begin - 1] if begin else 0
        end = max(int(np.searchsorted(ends, done + max_bytes, side="right")), begin + 1)
        yield begin, end
        begin = end


def text_udf(make: Callable[[str | None], object], kind: DataType) -> Callable[[Column], Column]:
    """A column function from a function of one text (or null)."""
    arrow = to_arrow_type(kind)

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for begin, end in slice_bounds(texts):
                yield pa.array([make(x) for x in texts[begin:end].to_pylist()], arrow)
    return arrow_udf(scan, kind)
