"""Blocks of documents: bounded batches that a map task handles and names as one.

A block's number is the task's partition and a running number, so a table that is
read twice yields the same blocks twice.  Users of blocks carry a check value with
each block and compare it where results of two passes meet.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

_ARROW = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}


def release() -> None:
    """Give freed memory back to the system: a reused worker must not hold the peak of its last task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):                        # another C library
        pass


def released(kernel: Callable) -> Callable:
    """A grouped kernel that gives its memory back after each group."""
    def run(*args):
        out = kernel(*args)
        release()
        return out

    # Spark reads the number of arguments
    return (lambda a, b: run(a, b)) if kernel.__code__.co_argcount == 2 else (lambda a: run(a))


def blocks(batches: Iterator[pa.RecordBatch], chars: int, rows: int = 65_000) -> Iterator[tuple[int, list, list[str]]]:
    """(block, identifiers, texts) of consecutive documents; null text is empty."""
    block = TaskContext.get().partitionId() << 32
    ids: list = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):             # few texts at a time leave the batch as Python strings
            part = batch.slice(lo, 256)
            for i, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                t = t or ""
                if texts and (size + len(t) > chars or len(texts) >= rows):
                    yield block, ids, texts
                    block, ids, texts, size = block + 1, [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t)
    if texts:
        yield block, ids, texts


def map_blocks(docs: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """``run`` over the Arrow batches of (doc_id, text); it yields pandas frames of the given columns."""
    fields = [f.split() for f in schema.split(", ")]
    out = pa.schema([(name, _ARROW[kind]) for name, kind in fields])

    def arrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in run(batches):
            yield pa.RecordBatch.from_pandas(frame, schema=out, preserve_index=False)
        release()

    return docs.mapInArrow(arrow, schema)
