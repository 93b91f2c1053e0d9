"""Panes of event-time windows over an arrival log: lateness, triggers, accumulation.

The log has an element's event time ``ts``, and ``batch_id``, the tick of the processing
clock it came with. All elements of a batch arrive together, so everything here works on
one summary row per (key, window, batch): a hot key or batch is folded before it is
shuffled, and the groups that are replayed hold ticks, not elements.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.times import SECOND, micros, window_start
from millrace.operators.rows import map_rows
from millrace.operators.triggers import END_OF_TIME, Trigger, WindowFold
from millrace.session import materialize

TICK_SECONDS = 600
CLOCK_BLOCK = 4096


def summaries(
    arrivals: DataFrame, keys: Sequence[str], size_seconds: int, value: str, ts: str = "ts", batch: str = "batch_id"
) -> DataFrame:
    """One row per (keys, window, batch) with count, sum, first and last event time.

    The log is read once, here: the watermark and the panes both come from these rows,
    which are therefore written to the checkpoint folder.
    """
    time = micros(F.col(ts))
    start = window_start(time, size_seconds * SECOND).alias("window_start")
    folded = arrivals.groupBy(*keys, start, F.col(batch).alias("batch_id")).agg(
        F.count("*").alias("n"), F.sum(value).alias("total"), F.min(time).alias("first_us"), F.max(time).alias("last_us")
    )
    return materialize(folded)


def watermark_clock(rows: DataFrame) -> DataFrame:
    """Per batch the watermark it sees and the one it leaves: (batch_id, wm_before, wm_after).

    The watermark is the largest event time so far; the first batch sees none. The
    running maximum goes over blocks of batches and then within each block.
    """
    tops = rows.groupBy("batch_id").agg(F.max("last_us").alias("_top"))
    tops = tops.withColumn("_block", F.floor(F.col("batch_id") / CLOCK_BLOCK).cast("long"))
    earlier_blocks = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = tops.groupBy("_block").agg(F.max("_top").alias("_block_top"))
    blocks = blocks.select("_block", F.max("_block_top").over(earlier_blocks).alias("_base"))
    within = Window.partitionBy("_block").orderBy("batch_id")
    up_to = F.max("_top").over(within.rowsBetween(Window.unboundedPreceding, 0))
    before = F.max("_top").over(within.rowsBetween(Window.unboundedPreceding, -1))
    clock = tops.join(blocks, "_block").select(
        "batch_id", F.greatest("_base", before).alias("wm_before"), F.greatest("_base", up_to).alias("wm_after")
    )
    return materialize(clock)


def _window_end(size_seconds: int) -> Column:
    return F.col("window_start") + F.lit(size_seconds * SECOND)


def with_lateness(arrived: DataFrame, clock: DataFrame, size_seconds: int, lateness_seconds: int) -> DataFrame:
    """Adds ``window_end``, ``late`` (after the window's end) and ``dropped`` (after the allowed lateness too).

    A watermark of exactly end + lateness still lets an element in.
    """
    seen = arrived.join(clock.select("batch_id", "wm_before"), "batch_id")
    end = _window_end(size_seconds)
    late = F.coalesce(F.col("wm_before") >= end, F.lit(False))
    dropped = F.coalesce(F.col("wm_before") > end + lateness_seconds * SECOND, F.lit(False))
    return seen.withColumn("window_end", end).withColumn("late", late).withColumn("dropped", dropped)


def late_data(
    arrivals: DataFrame, keys: Sequence[str], value: str, size_seconds: int = 600, lateness_seconds: int = 300
) -> DataFrame:
    """Per key and window how many elements are on time, late but allowed, and dropped."""
    rows = summaries(arrivals, keys, size_seconds, value)
    judged = with_lateness(rows, watermark_clock(rows), size_seconds, lateness_seconds)
    return judged.groupBy(*keys, "window_start").agg(
        F.sum(F.when(~F.col("late"), F.col("n")).otherwise(0)).alias("on_time"),
        F.sum(F.when(F.col("late") & ~F.col("dropped"), F.col("n")).otherwise(0)).alias("late"),
        F.sum(F.when(F.col("dropped"), F.col("n")).otherwise(0)).alias("dropped"),
    )


def _fold_columns() -> list[Column]:
    return [
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.min("first_us").alias("first_us"),
        F.max("last_us").alias("last_us"),
    ]


def default_panes(
    arrivals: DataFrame,
    keys: Sequence[str],
    value: str,
    size_seconds: int = 600,
    lateness_seconds: int = 300,
    accumulating: bool = False,
) -> DataFrame:
    """Panes of the default trigger: one on time, then one per late batch.

    Accumulating panes hold all of the window so far, discarding ones only what is new.
    """
    rows = summaries(arrivals, keys, size_seconds, value)
    judged = with_lateness(rows, watermark_clock(rows), size_seconds, lateness_seconds)
    pane = F.when(F.col("late"), F.col("batch_id")).otherwise(F.lit(-1).cast("long"))
    panes = (
        judged.where(~F.col("dropped"))
        .withColumn("_pane", pane)
        .groupBy(*keys, "window_start", "window_end", "_pane")
        .agg(*_fold_columns())
    )
    in_order = Window.partitionBy(*keys, "window_start").orderBy("_pane")
    numbered = panes.withColumn("pane_index", (F.row_number().over(in_order) - 1).cast("long"))
    timed = numbered.withColumn("pane_timing", F.when(F.col("_pane") < 0, "ON_TIME").otherwise("LATE"))
    if accumulating:
        timed = accumulate(timed, keys, "_pane")
    return timed.drop("_pane")


def accumulate(panes: DataFrame, keys: Sequence[str], order: str = "pane_index") -> DataFrame:
    """Discarding panes to accumulating ones."""
    so_far = Window.partitionBy(*keys, "window_start").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return panes.select(
        *[c for c in panes.columns if c not in ("n", "total", "first_us", "last_us")],
        F.sum("n").over(so_far).alias("n"),
        F.sum("total").over(so_far).alias("total"),
        F.min("first_us").over(so_far).alias("first_us"),
        F.max("last_us").over(so_far).alias("last_us"),
    )


def pane_info(panes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``is_first`` and ``is_last`` to the pane's index and timing."""
    last = F.max("pane_index").over(Window.partitionBy(*keys, "window_start"))
    return panes.withColumn("is_first", F.col("pane_index") == 0).withColumn("is_last", F.col("pane_index") == last)


def output_timestamp(panes: DataFrame, combiner: str = "end") -> Column:
    """Timestamp of a pane: ``earliest`` or ``latest`` element, or the ``end`` of the window less 1 ms."""
    choices = {"earliest": panes["first_us"], "latest": panes["last_us"], "end": panes["window_end"] - 1000}
    return choices[combiner]


def watermark_crossings(clock: DataFrame, first_us: Column, size_seconds: int, lateness_seconds: int) -> DataFrame:
    """Per window the batch that brings the watermark to its end and past its lateness.

    Each clock row lists the few window ends its own step of the watermark crosses, so
    windows and clock meet by equality, not by a range join. ``first_us`` is a time no
    later than any window's end.
    """
    size, lateness = size_seconds * SECOND, lateness_seconds * SECOND

    def crossed(low: Column, high: Column) -> Column:
        """Multiples of the size in ``(low, high]``."""
        first = window_start(low, size) + size
        last = window_start(high, size)
        return F.when(first <= last, F.sequence(first, last, F.lit(size))).otherwise(F.array().cast("array<bigint>"))

    before = F.coalesce("wm_before", first_us)
    reached = clock.select(F.explode(crossed(before, F.col("wm_after"))).alias("_end"), F.col("batch_id").alias("ontime_seq"))
    # The end is over when wm > end + lateness, so the bounds move by one microsecond.
    over = clock.select(
        F.explode(crossed(before - lateness - 1, F.col("wm_after") - lateness - 1)).alias("_end"),
        F.col("batch_id").alias("expiry_seq"),
    )
    joined = reached.join(over, "_end", "left")
    return joined.select((F.col("_end") - size).alias("window_start"), "ontime_seq", "expiry_seq")


def replay(fold_rows: DataFrame, keys: Sequence[str], trigger: Trigger, size_us: int, lateness_us: int, tick_us: int) -> DataFrame:
    """Runs a trigger over summary rows with ``ontime_seq`` and ``expiry_seq``; adds the pane of each row.

    Rows of a (key, window) stream through in batch order and only the open pane is held.
    ``pane_index`` is null for rows that a finished trigger or the end of lateness drops.
    """
    group_columns = [*keys, "window_start"]
    columns = fold_rows.columns
    types = {f.name: f.dataType.simpleString() for f in fold_rows.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in columns) + ", pane_index long, pane_timing string, fired_seq long"
    where = {c: i for i, c in enumerate(columns)}
    key_at = [where[c] for c in group_columns]
    start_at, seq_at, n_at = where["window_start"], where["batch_id"], where["n"]
    ontime_at, expiry_at = where["ontime_seq"], where["expiry_seq"]

    class Run:
        def __init__(self, row: tuple):
            self.fold = WindowFold(trigger, row[start_at] + size_us, lateness_us)
            self.marks = [(row[ontime_at], self.fold.end), (row[expiry_at], self.fold.end + lateness_us + 1)]
            self.out: list[tuple] = []

        def emit(self, panes: list, seq: int) -> None:
            for pane in panes:
                self.out.extend((*row, pane.index, pane.timing, seq) for row in pane.items)

        def advance(self, seq: int) -> None:
            """Watermark marks of earlier batches and timers up to this batch, in order."""
            while True:
                timer = self.fold.next_timer()
                # A tick b happens at (b + 1) * tick; the first one strictly after the timer.
                due = (timer // tick_us, 0) if timer is not None else (END_OF_TIME, 0)
                mark = (self.marks[0][0], 2) if self.marks else (END_OF_TIME, 2)
                if (timer is None and not self.marks) or min(due, mark) >= (seq, 1):
                    return
                if due < mark:
                    self.emit(self.fold.advance_clock((due[0] + 1) * tick_us), due[0])
                else:
                    self.emit(self.fold.advance_watermark(self.marks.pop(0)[1]), mark[0])

        def add(self, row: tuple) -> None:
            seq = row[seq_at]
            self.advance(seq)
            self.emit(self.fold.advance_clock((seq + 1) * tick_us), seq)
            held = self.fold.state.count
            panes = self.fold.add(row, row[n_at])
            if not panes and self.fold.state.count == held:
                self.out.append((*row, None, None, None))
            self.emit(panes, seq)

        def finish(self) -> list[tuple]:
            self.advance(END_OF_TIME)
            return self.out

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for _, group in groupby(rows, key=lambda row: tuple(row[i] for i in key_at)):
            running = None
            for row in group:
                running = running or Run(row)
                running.add(row)
                yield from running.out
                running.out = []
            yield from running.finish()

    ordered = fold_rows.repartition(*group_columns).sortWithinPartitions(*group_columns, "batch_id")
    return map_rows(ordered, run, schema)


def assign_panes(
    arrivals: DataFrame,
    keys: Sequence[str],
    value: str,
    trigger: Trigger,
    size_seconds: int = 600,
    lateness_seconds: int = 300,
    tick_seconds: int = TICK_SECONDS,
) -> DataFrame:
    """The summary rows of fixed windows, each with the pane it goes out with (null when dropped)."""
    rows = summaries(arrivals, keys, size_seconds, value)
    clock = watermark_clock(rows)
    edges = rows.agg(F.min("first_us").alias("first_us"))
    ends = clock.agg((F.max("batch_id") + 1).alias("seq"))
    crossings = watermark_crossings(clock, edges.scalar(), size_seconds, lateness_seconds)
    rows = rows.join(crossings, "window_start", "left")
    # Windows the watermark never reaches are closed by the end of the input.
    rows = rows.withColumn("ontime_seq", F.coalesce("ontime_seq", ends.scalar()))
    rows = rows.withColumn("expiry_seq", F.coalesce("expiry_seq", ends.scalar()))
    return replay(rows, keys, trigger, size_seconds * SECOND, lateness_seconds * SECOND, tick_seconds * SECOND)


def panes_of(assigned: DataFrame, keys: Sequence[str], size_seconds: int | None = None) -> DataFrame:
    """Discarding panes out of assigned summary rows."""
    panes = (
        assigned.where(F.col("pane_index").isNotNull())
        .groupBy(*keys, "window_start", "pane_index", "pane_timing", "fired_seq")
        .agg(*_fold_columns())
    )
    return panes if size_seconds is None else panes.withColumn("window_end", _window_end(size_seconds))


def trigger_panes(
    arrivals: DataFrame,
    keys: Sequence[str],
    value: str,
    trigger: Trigger,
    size_seconds: int = 600,
    lateness_seconds: int = 300,
    tick_seconds: int = TICK_SECONDS,
    accumulating: bool = False,
) -> DataFrame:
    """Panes of any trigger over fixed windows."""
    assigned = assign_panes(arrivals, keys, value, trigger, size_seconds, lateness_seconds, tick_seconds)
    panes = panes_of(assigned, keys, size_seconds)
    return accumulate(panes, keys) if accumulating else panes


def global_panes(
    arrivals: DataFrame, keys: Sequence[str], value: str, trigger: Trigger, ts: str, tick_seconds: int = 1
) -> DataFrame:
    """Panes of one window over all time per key; processing time is ``ts`` in ticks.

    What is left at the end of the input goes out as the last pane.
    """
    time = micros(F.col(ts))
    tick = F.floor(time / F.lit(tick_seconds * SECOND)).cast("long")
    rows = arrivals.groupBy(*keys, tick.alias("batch_id")).agg(
        F.count("*").alias("n"), F.sum(value).alias("total"), F.min(time).alias("first_us"), F.max(time).alias("last_us")
    )
    never = F.lit(END_OF_TIME - 2)
    rows = rows.withColumn("window_start", F.lit(0).cast("long"))
    rows = rows.withColumn("ontime_seq", never).withColumn("expiry_seq", never + 1)
    assigned = replay(rows, keys, trigger, END_OF_TIME // 2, 0, tick_seconds * SECOND)
    return panes_of(assigned, keys).drop("window_start")
