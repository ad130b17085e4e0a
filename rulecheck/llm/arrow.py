"""Batches for operators that run numpy inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

import rulecheck.llm
from rulecheck.llm.common import without

# tasks carry this subpackage's code with them, so executors need no copy of the library
cloudpickle.register_pickle_by_value(rulecheck.llm)

SLICE_BYTES = 4_000_000


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about SLICE_BYTES of text each (one row at least), so memory follows the longest text."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).cumsum()
    start = 0
    while start < batch.num_rows:
        done = sizes[start - 1] if start else 0
        end = max(start + 1, int(sizes.searchsorted(done + SLICE_BYTES, side="right")))
        yield batch.slice(start, end - start)
        start = end


def with_columns(df: DataFrame, text: str, fields: list[T.StructField], make: Callable[[], Callable[[list[str]], list[pa.Array]]]) -> DataFrame:
    """df with new columns made from the texts (null: empty) of each slice. make() runs once in a task. New
    columns replace those of the same name."""
    df = without(df, [f.name for f in fields])
    schema = T.StructType([*df.schema.fields, *fields])
    kinds = [to_arrow_type(f.dataType) for f in fields]
    at = [c.lower() for c in df.columns].index(text.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, batch.schema.names[at]):
                texts = ["" if t is None else t for t in part.column(at).to_pylist()]
                made = [a.cast(k) for a, k in zip(work(texts), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=schema.names)

    return df.mapInArrow(run, schema)
