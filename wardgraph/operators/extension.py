"""A user's own function over batches of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wardgraph.sources.tables import written

FAILURES = "batch string, rows long, error string"


def try_batches(rows: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str | StructType, size: int = 1000) -> tuple[DataFrame, DataFrame]:
    """function over batches of at most `size` rows -> what it gives, and a row for each batch that failed: its task and number there,
    its rows, and the error. A batch fails if the function raises or if its result does not fit the schema (columns by name;
    values that an Arrow cast does not take); the others go on. The function runs once: both tables are read from what it wrote."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    out = StructType([*kind.fields, *StructType.fromDDL(", ".join(f"__{c}" for c in FAILURES.split(", "))).fields])
    arrow, n = to_arrow_schema(out), len(kind.fields)
    own = pa.schema(list(arrow)[:n])

    def tried(part: pa.RecordBatch, name: str) -> pa.RecordBatch:
        try:
            found = function(part.to_pandas())
            good = pa.RecordBatch.from_pandas(found[own.names], own, preserve_index=False)
            columns, mark = good.columns, [None] * 3
            size = good.num_rows
        except Exception as e:  # the batch's failure is its own, as asked
            columns, mark, size = [pa.nulls(1, t) for t in own.types], [name, part.num_rows, f"{type(e).__name__}: {e}"], 1
        return pa.RecordBatch.from_arrays([*columns, *(pa.array([m] * size, t) for m, t in zip(mark, arrow.types[n:], strict=True))], schema=arrow)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done = TaskContext.get().partitionId(), 0
        for part in parts:
            for at in range(0, part.num_rows, size):
                some = part.slice(at, size)
                yield tried(some, f"{task}-{done}")
                done += 1

    found = written(rows.mapInArrow(run, out), "batches")
    failed = found.where("__batch is not null").select(*(F.col(f"__{c.split()[0]}").alias(c.split()[0]) for c in FAILURES.split(", ")))
    return found.where("__batch is null").select(*(f"`{c}`" for c in kind.names)), failed


def map_batches(rows: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str | StructType, size: int = 1000) -> DataFrame:
    """function over batches of at most `size` rows; a batch that fails is skipped. try_batches says which."""
    return try_batches(rows, function, schema, size)[0]
