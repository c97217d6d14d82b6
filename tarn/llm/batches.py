"""Texts of Arrow batches in portions of bounded size."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PORTION_BYTES = 1 << 20


def portions(batch: pa.RecordBatch, text: str, most: int = PORTION_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ``most`` bytes in column ``text``; a row above that is a portion of its own."""
    first, total = 0, 0
    for k, one in enumerate(batch.column(text)):
        size = len(one.as_buffer()) if one.is_valid else 0
        if k > first and total + size > most:
            yield batch.slice(first, k - first)
            first, total = k, 0
        total += size
    if batch.num_rows > first:
        yield batch.slice(first)
