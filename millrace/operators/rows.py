"""One pass of plain Python over the rows of each partition, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

BATCH_ROWS = 10_000


def map_rows(df: DataFrame, fn: Callable[[Iterator[tuple]], Iterable[tuple]], schema: str) -> DataFrame:
    """``fn`` gets the row tuples of a partition in order and gives row tuples of ``schema``.

    Nulls are None and integers stay integers, also in key columns. Only one batch in
    and one batch out are held.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*[column.to_pylist() for column in batch.columns]))
        held: list[tuple] = []
        for row in fn(rows):
            held.append(row)
            if len(held) >= BATCH_ROWS:
                yield batch_of(held)
                held = []
        if held:
            yield batch_of(held)

    return df.mapInArrow(run, schema)
