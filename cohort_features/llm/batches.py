"""Streaming rows through Python a slice at a time, as Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

Rows = Iterator[tuple]


def rows_of(batches: Iterable[pa.RecordBatch], slice_rows: int = 256) -> Rows:
    """The rows as tuples; only ``slice_rows`` rows are Python objects at once."""
    for batch in batches:
        for i in range(0, batch.num_rows, slice_rows):
            part = batch.slice(i, slice_rows)
            yield from zip(*(c.to_pylist() for c in part.columns), strict=True)


def batched(rows: Rows, schema: pa.Schema, most_rows: int = 2048, most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches, closed at a row count or a rough byte count."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, (str, bytes, list, np.ndarray)))
        if len(held) >= most_rows or size >= most_bytes:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(held: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(col, type=f.type) for col, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema
    )


#: rows that Spark hands to Python at once; its default of 10,000 texts may
#: take hundreds of megabytes outside the heap of an executor
BATCH_ROWS = 1000
BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batch size lowered to ``BATCH_ROWS`` if
    it is larger."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(BATCH_KEY, "10000")) <= BATCH_ROWS:
        conf.set(BATCH_KEY, str(BATCH_ROWS))
    return df


def map_rows(df: DataFrame, fn: Callable[[Rows], Rows], schema: str) -> DataFrame:
    """``df`` through ``fn`` (an iterator of tuples to an iterator of tuples),
    partition by partition, in order, in ``small_batches``."""
    out: StructType = _parse_datatype_string(schema)
    arrow = to_arrow_schema(out)

    def run(batches):
        return batched(fn(rows_of(batches)), arrow)

    return small_batches(df).mapInArrow(run, out)
