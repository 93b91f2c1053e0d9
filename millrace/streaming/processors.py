"""Keyed state and timers: pane triggers and buffers as streaming operators.

State is held per key (and window) in the RocksDB store and cleared when a window is
over or a buffer is released.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import islice

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.times import SECOND, micros, window_start
from millrace.operators.rows import map_rows
from millrace.operators.triggers import NO_WATERMARK, Trigger, WindowFold, WindowState
from millrace.session import STATE_STORE

PANE_STATE = (
    "n long, total {total}, first long, timely boolean, step int, passed boolean, on_time_seen boolean, "
    "pane_index int, closed boolean"
)


ITEMS_PER_ROW = 10_000
HELD_KEYS = 50_000


def use_state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


class PaneProcessor(StatefulProcessor):
    """Panes of one key and fixed window; key columns end with ``window_start``."""

    def __init__(self, trigger: Trigger, size_us: int, lateness_us: int, held_back_us: int, total: str):
        self.trigger, self.size, self.lateness, self.held_back = trigger, size_us, lateness_us, held_back_us
        self.total = total

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("pane", PANE_STATE.format(total=self.total))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        fold, fresh = self._load(key, timerValues)
        n, total = 0, 0
        for row in rows:
            n, total = n + row["_n"], total + row["_total"]
        panes = self._advance(fold, timerValues) + fold.add((n, total), n)
        yield from self._rows(key, panes)
        if self._keep(fold) and fresh:
            # The stream's watermark runs `held_back` behind the largest event time.
            for due in (fold.end, fold.end + self.lateness + 1000):
                self.handle.registerTimer((due - self.held_back) // 1000)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        fold, _ = self._load(key, timerValues)
        yield from self._rows(key, self._advance(fold, timerValues))
        self._keep(fold)

    def close(self) -> None: ...

    def _load(self, key: tuple, times) -> tuple[WindowFold, bool]:
        fold = WindowFold(self.trigger, key[-1] + self.size, self.lateness)
        if not self.state.exists():
            return fold, True
        n, total, first, timely, step, passed, seen, index, closed = self.state.get()
        items = [(n, total)] if n else []
        fold.state = WindowState(items, n, first, timely, step, passed, seen, index, closed)
        return fold, False

    def _advance(self, fold: WindowFold, times) -> list:
        reached = times.getCurrentWatermarkInMs()
        watermark = reached * 1000 + self.held_back if reached > 0 else NO_WATERMARK
        panes = fold.advance_clock(times.getCurrentProcessingTimeInMs() * 1000)
        return panes + fold.advance_watermark(watermark)

    def _keep(self, fold: WindowFold) -> bool:
        """Saves the state of a window that is not over; of one that is, nothing stays."""
        if fold.watermark > fold.end + fold.lateness:
            self.state.clear()
            return False
        s = fold.state
        n, total = sum(i[0] for i in s.items), sum(i[1] for i in s.items)
        self.state.update((n, total, s.first, s.timely, s.step, s.passed, s.on_time_seen, s.index, s.closed))
        return True

    def _rows(self, key: tuple, panes: list) -> Iterator[Row]:
        for pane in panes:
            n, total = sum(i[0] for i in pane.items), sum(i[1] for i in pane.items)
            yield Row(
                **{f"key{i}": part for i, part in enumerate(key[:-1])},
                window_start=key[-1],
                window_end=key[-1] + self.size,
                pane_index=pane.index,
                pane_timing=pane.timing,
                n=n,
                total=total,
            )


def stream_panes(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    trigger: Trigger,
    size_seconds: int = 600,
    lateness_seconds: int = 300,
) -> DataFrame:
    """Discarding panes of any trigger over a stream.

    Spark would drop rows behind its watermark before they reach the processor, so the
    watermark is held back by window size and lateness, which no allowed element
    exceeds; the processor adds that back and applies the exact rule itself.
    """
    use_state_store(stream.sparkSession)
    held_back = size_seconds + lateness_seconds
    start = window_start(micros(F.col(ts)), size_seconds * SECOND).alias("window_start")
    # Sums keep the kind of their values, as in the batch form.
    total = "long" if isinstance(stream.select(value).schema[0].dataType, IntegralType) else "double"
    rows = stream.select(*keys, start, micros(F.col(ts)).alias("_us"), F.col(value).cast(total).alias("_total"))
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    width = len(keys) + 1

    def fold(elements: Iterator[tuple]) -> Iterator[tuple]:
        """Elements of a task to one row per key and window, with their latest time, count and sum."""
        held: dict = {}
        for element in elements:
            key, (us, v) = element[:width], element[width:]
            last, n, total = held.get(key, (us, 0, 0))
            held[key] = (max(last, us), n + 1, total + (v or 0))
            if len(held) >= HELD_KEYS:
                yield from (k + folded for k, folded in held.items())
                held = {}
        yield from (k + folded for k, folded in held.items())

    # A micro-batch is atomic for the trigger, so a hot key is folded before the shuffle.
    named = "".join(f"`{k}` {types[k]}, " for k in keys)
    folded = map_rows(rows, fold, f"{named}window_start long, _us long, _n long, _total {total}")
    rows = folded.withColumn("_ts", F.timestamp_micros("_us")).withWatermark("_ts", f"{held_back} seconds")
    key_types = "".join(f"key{i} {types[k]}, " for i, k in enumerate(keys))
    schema = key_types + "window_start long, window_end long, pane_index int, pane_timing string, n long, " + f"total {total}"
    processor = PaneProcessor(trigger, size_seconds * SECOND, lateness_seconds * SECOND, held_back * SECOND, total)
    panes = rows.groupBy(*keys, "window_start").transformWithState(processor, schema, "Append", "EventTime")
    return panes.select(*[F.col(f"key{i}").alias(k) for i, k in enumerate(keys)], *panes.columns[len(keys) :])


class CountBuffer(StatefulProcessor):
    """Holds the values of a key and releases them ``limit`` at a time; a null value releases the rest."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.values = handle.getListState("values", "value string")
        self.meta = handle.getValueState("meta", "held int, batch long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # The store is read and written once per micro-batch, not once per row.
        held, batch = self.meta.get() if self.meta.exists() else (0, 0)
        items = [v[0] for v in self.values.get()] if held else []
        for row in rows:
            last = row["_value"] is None
            if not last:
                items.append(row["_value"])
            if items and (last or len(items) >= row["_limit"]):
                yield Row(**_named(key), batch=batch, items=items)
                items, batch = [], batch + 1
        if items:
            self.values.put([(item,) for item in items])
        elif held:
            self.values.clear()
        self.meta.update((len(items), batch))

    def close(self) -> None: ...


class TimeBuffer(StatefulProcessor):
    """Holds the values of a key; the first sets a processing-time timer that releases them, as a null value does.

    A release is as many rows of at most ``ITEMS_PER_ROW`` values as it needs.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.values = handle.getListState("values", "value string")
        self.due = handle.getValueState("due", "at long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        delay, last = 0, False
        while piece := list(islice(rows, ITEMS_PER_ROW)):
            delay = piece[0]["_limit"]
            last |= any(row["_value"] is None for row in piece)
            if values := [(row["_value"],) for row in piece if row["_value"] is not None]:
                self.values.appendList(values)
        if last:
            yield from self._release(key, timerValues.getCurrentProcessingTimeInMs())
        elif not self.due.exists():
            at = timerValues.getCurrentProcessingTimeInMs() + delay * 1000
            self.handle.registerTimer(at)
            self.due.update((at,))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.due.exists():
            yield from self._release(key, self.due.get()[0])

    def _release(self, key: tuple, at: int) -> Iterator[Row]:
        if self.values.exists():
            held = self.values.get()
            while piece := list(islice(held, ITEMS_PER_ROW)):
                yield Row(**_named(key), batch=at, items=[v[0] for v in piece])
            self.values.clear()
        self.due.clear()

    def close(self) -> None: ...


def _named(key: tuple) -> dict:
    return {f"key{i}": part for i, part in enumerate(key)}


def _buffered(
    stream: DataFrame, keys: Sequence[str], value: Column, bound: Column, processor: StatefulProcessor, mode: str
) -> DataFrame:
    use_state_store(stream.sparkSession)
    rows = stream.select(*keys, value.cast("string").alias("_value"), bound.cast("int").alias("_limit"))
    kinds = "".join(f"key{i} {rows.schema[k].dataType.simpleString()}, " for i, k in enumerate(keys))
    buffered = rows.groupBy(*keys).transformWithState(processor, f"{kinds}batch long, items array<string>", "Append", mode)
    return buffered.withColumnsRenamed({f"key{i}": k for i, k in enumerate(keys)})


def stream_batches_by_count(stream: DataFrame, keys: Sequence[str], value: Column, limit: Column) -> DataFrame:
    """Batches of ``limit`` values per key, as soon as each is full; a null value gives out the rest.

    A hot key is one state and one task at a time: put a shard column (a hash of the row)
    beside it in ``keys`` to spread it.
    """
    return _buffered(stream, keys, value, limit, CountBuffer(), "None")


def stream_batches_by_time(stream: DataFrame, keys: Sequence[str], value: Column, delay_seconds: Column) -> DataFrame:
    """Batches per key, given out ``delay_seconds`` after their first value came, or with a null value."""
    return _buffered(stream, keys, value, delay_seconds, TimeBuffer(), "ProcessingTime")
