"""Event-time windows whose late elements are rows too, on Spark's own watermark.

Spark drops what is behind the watermark before it reaches a stateful operator, and only counts it. Here the time
column that carries the watermark ends before the state, so late elements arrive there, and the processor decides by
window and allowed lateness: on-time pane, late pane, or a dropped element, given out as such.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegralType

from millrace.functions.times import SECOND, micros, window_start
from millrace.streaming.processors import use_state_store

ON_TIME, LATE, DROPPED = "ON_TIME", "LATE", "DROPPED"


class WindowPanes(StatefulProcessor):
    """Panes of one key and window; the key ends with the window's begin.

    The on-time pane has all that came before the watermark reached the window's end. After it every micro-batch with
    elements of the window gives a late pane, as long as the watermark is not past end plus lateness; exactly there
    an element still counts. State is a few numbers, and is cleared when the lateness is over.
    """

    def __init__(self, size_us: int, lateness_us: int, total: str) -> None:
        self.size, self.lateness, self.total = size_us, lateness_us, total

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("pane", f"n long, total {self.total}, panes int")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        n, total = 0, None
        for row in rows:
            n += row["_n"]
            total = row["_total"] if total is None else total + (row["_total"] or 0)
        end, watermark = key[-1] + self.size, timerValues.getCurrentWatermarkInMs() * 1000
        if watermark > end + self.lateness:
            yield self._pane(key, None, DROPPED, n, total)
            return
        fresh = not self.state.exists()
        held, held_total, panes = (0, None, 0) if fresh else self.state.get()
        if watermark < end:
            held, held_total = held + n, total if held_total is None else held_total + (total or 0)
        else:
            if held:  # the timer of the window's end goes off behind the rows of the same micro-batch
                yield self._pane(key, panes, ON_TIME, held, held_total)
                held, held_total, panes = 0, None, panes + 1
            yield self._pane(key, panes, LATE, n, total)
            panes += 1
        self.state.update((held, held_total, panes))
        if fresh:
            for due in (end, end + self.lateness + 1000):
                self.handle.registerTimer(due // 1000)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.state.exists():
            return
        held, total, panes = self.state.get()
        if held:
            yield self._pane(key, panes, ON_TIME, held, total)
            panes += 1
        if timerValues.getCurrentWatermarkInMs() * 1000 > key[-1] + self.size + self.lateness:
            self.state.clear()
        else:
            self.state.update((0, None, panes))

    def close(self) -> None: ...

    def _pane(self, key: tuple, index: int | None, timing: str, n: int, total) -> Row:
        named = {f"key{i}": part for i, part in enumerate(key[:-1])}
        return Row(**named, window_start=key[-1], window_end=key[-1] + self.size, pane_index=index, pane_timing=timing, n=n, total=total)


def panes_with_late_rows(
    stream: DataFrame, keys: Sequence[str], ts: str, value: str, size_seconds: int = 600, lateness_seconds: int = 300, delay_seconds: int = 0
) -> DataFrame:
    """Count and sum per key, window and pane: ``pane_index`` (from 0), ``pane_timing`` ON_TIME, LATE or DROPPED.

    The watermark is the largest event time of the micro-batches before, less ``delay_seconds``. A dropped element has
    no pane index; it is a row for each key, window and micro-batch, with the number of such elements. Every element is
    in exactly one row once its window is over. Null times are left out, null keys are keys, null values count but
    add nothing.

    A task folds its elements to one row per key and window in Arrow before the shuffle, so a hot key costs the
    stateful task one row for each task and window.
    """
    use_state_store(stream.sparkSession)
    total = "long" if isinstance(stream.select(value).schema[0].dataType, IntegralType) else "double"
    rows = stream.withWatermark(ts, f"{delay_seconds} seconds").where(F.col(ts).isNotNull()).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        window_start(micros(F.col(ts)), size_seconds * SECOND).alias("window_start"),
        F.col(value).cast(total).alias("_total"),
        F.lit(1).cast("long").alias("_n"),
    )
    named = [*[f"_k{i}" for i in range(len(keys))], "window_start"]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                folded = pa.Table.from_batches([batch]).group_by(named, use_threads=False).aggregate([("_total", "sum"), ("_n", "sum")])
                yield from folded.rename_columns([*named, "_total", "_n"]).combine_chunks().to_batches()

    folded = rows.mapInArrow(fold, rows.schema)
    kinds = "".join(f"key{i} {rows.schema[f'_k{i}'].dataType.simpleString()}, " for i in range(len(keys)))
    schema = f"{kinds}window_start long, window_end long, pane_index int, pane_timing string, n long, total {total}"
    processor = WindowPanes(size_seconds * SECOND, lateness_seconds * SECOND, total)
    panes = folded.groupBy(*named).transformWithState(processor, schema, "Append", "EventTime")
    return panes.withColumnsRenamed({f"key{i}": k for i, k in enumerate(keys)})


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows that Spark's own operators have dropped as too late, over the progress reports the query still holds."""
    return sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
