"""Keyed buffers that release by count or by time, replayed over bounded data.

The streaming forms are in :mod:`millrace.streaming.processors`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import SECOND
from millrace.operators.rows import map_rows
from millrace.operators.scale import position_in_key
from millrace.operators.windows import _merge


def batches_by_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], limit: Column | int = 100) -> DataFrame:
    """Adds ``batch``, the number of the release a row goes out with, and ``_limit``.

    A buffer is released when it holds ``limit`` rows; the last batch of a key with
    fewer rows is still in the buffer at the end.
    """
    bound = limit if isinstance(limit, Column) else F.lit(limit)
    numbered = position_in_key(df, keys, order, "_position").withColumn("_limit", bound.cast("long"))
    batch = F.floor((F.col("_position") - 1) / F.col("_limit")).cast("long")
    return numbered.withColumn("batch", batch).drop("_position")


def batches_by_time(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    delay_seconds: Column | int,
    aggregates: Sequence[Column],
    merge: dict[str, str],
    tick_seconds: int = 1,
) -> DataFrame:
    """Aggregates per key and buffer; the first row of a buffer sets the timer that releases it.

    The clock has ticks. Rows of one tick go together, so they are aggregated per
    (key, tick) first; the replay then passes once over the ticks of a key in order
    and holds only the start of the open buffer.
    """
    keys = list(keys)
    delay = delay_seconds if isinstance(delay_seconds, Column) else F.lit(delay_seconds)
    second = F.floor(F.unix_micros(ts) / F.lit(tick_seconds * SECOND)).cast("long") * tick_seconds
    ticks = df.groupBy(*keys, second.alias("_s"), delay.cast("long").alias("_delay")).agg(*aggregates)
    names = list(merge)
    width = len(keys)

    def replay(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, group in groupby(rows, key=lambda row: row[:width]):
            start, number = None, -1
            for row in group:
                tick, wait = row[width], row[width + 1]
                if start is None or tick > start + wait:
                    start, number = tick, number + 1
                yield (*key, number, start, *row[width + 2 :])

    types = {f.name: f.dataType.simpleString() for f in ticks.schema}
    schema = ", ".join(
        [*(f"`{k}` {types[k]}" for k in keys), "batch long", "start_s long", *(f"`{n}` {types[n]}" for n in names)]
    )
    columns = ticks.select(*keys, "_s", "_delay", *names)
    ordered = columns.repartition(*keys).sortWithinPartitions(*keys, "_s")
    return map_rows(ordered, replay, schema).groupBy(*keys, "batch", "start_s").agg(*_merge(merge))
