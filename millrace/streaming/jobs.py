"""Structured Streaming jobs: windowed aggregates, files by window, load jobs, file watching.

Writes inside ``foreachBatch`` go to a folder of their own per micro-batch and replace
it, so a batch that is run again after a failure leaves no second copy.
"""

from __future__ import annotations

import fnmatch
import re
import threading
import time
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from millrace.functions.text import STORAGE_PATH_PATTERN, matches_whole
from millrace.session import scratch_path


def stream_files(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """Continuous match: files that appear under the path or glob become rows, each file once."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.load(path)


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Processes what is there now, in as many micro-batches as the source limits ask for, and ends."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_triggered(writer: DataStreamWriter) -> StreamingQuery:
    """Runs a writer at its own trigger until all that is there now has been processed."""
    query = writer.start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def stop_when_idle(query: StreamingQuery, idle_seconds: float = 3600, poll_seconds: float = 10) -> None:
    """Stop policy: ends the query once nothing new has come for ``idle_seconds``.

    A start, and a micro-batch with new rows that is still running, are not idle, however long they take. One without
    new rows, as timers cause, is let end if that takes no longer than ``idle_seconds`` more.
    """
    last_rows = time.monotonic()
    seen = -1
    while query.isActive:
        progress = query.lastProgress
        if progress and progress["batchId"] != seen and progress["numInputRows"] > 0:
            seen, last_rows = progress["batchId"], time.monotonic()
        status = query.status
        if status["isDataAvailable"] or status["message"].startswith("Initializing"):
            last_rows = time.monotonic()
        idle = time.monotonic() - last_rows
        if idle >= 2 * idle_seconds or (idle >= idle_seconds and not status["isTriggerActive"]):
            query.stop()
            return
        time.sleep(poll_seconds)


class ObservedMetrics(StreamingQueryListener):
    """The metrics that ``observe(name, …)`` takes in each micro-batch, put together over a stream.

    Columns that end in ``_min`` or ``_max`` are least and largest values, all others are sums; null counts as nothing.
    Only one row for all micro-batches is held. Metrics come with the progress of a micro-batch, after its rows.
    """

    def __init__(self, name: str) -> None:
        self.name, self.totals, self.ended = name, {}, threading.Event()

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        for key, value in (row.asDict() if row is not None else {}).items():
            before = self.totals.get(key)
            if value is None or before is None:
                self.totals[key] = before if value is None else value
            else:
                merge = min if key.endswith("_min") else max if key.endswith("_max") else lambda a, b: a + b
                self.totals[key] = merge(before, value)

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


def run_observed(stream: DataFrame, name: str, metrics: Sequence[Column], write: Callable[[DataFrame], DataStreamWriter]) -> dict:
    """Runs the stream to the end of what is there; its rows pass on to the writer, its metrics are the result."""
    spark, listener = stream.sparkSession, ObservedMetrics(name)
    spark.streams.addListener(listener)
    try:
        run_available(write(stream.observe(name, *metrics)))
        listener.ended.wait(60)
    finally:
        spark.streams.removeListener(listener)
    return listener.totals


def windowed_aggregate(
    stream: DataFrame,
    ts: str,
    keys: Sequence[str],
    aggregates: Sequence[Column],
    size_seconds: int = 300,
    lateness_seconds: int = 300,
    slide_seconds: int | None = None,
) -> DataFrame:
    """Aggregates per key and window, given out once the watermark passes the window."""
    window = F.window(ts, f"{size_seconds} seconds", f"{slide_seconds or size_seconds} seconds")
    grouped = stream.withWatermark(ts, f"{lateness_seconds} seconds").groupBy(window, *keys).agg(*aggregates)
    start, end = F.unix_micros("window.start"), F.unix_micros("window.end")
    return grouped.select(start.alias("window_start"), end.alias("window_end"), *grouped.columns[1:])


def session_aggregate(
    stream: DataFrame, ts: str, keys: Sequence[str], aggregates: Sequence[Column], gap_seconds: int = 120, lateness_seconds: int = 300
) -> DataFrame:
    """Aggregates per key and session.

    Spark joins events exactly one gap apart; here such a pause closes the session, so
    the gap is one microsecond shorter and the reported end moves back by it.
    """
    window = F.session_window(ts, f"{gap_seconds * 1_000_000 - 1} microseconds")
    grouped = stream.withWatermark(ts, f"{lateness_seconds} seconds").groupBy(window, *keys).agg(*aggregates)
    start, end = F.unix_micros("session_window.start"), F.unix_micros("session_window.end") + 1
    return grouped.select(start.alias("window_start"), end.alias("window_end"), *grouped.columns[1:])


def append_files(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> DataStreamWriter:
    """Exactly-once file sink."""
    return stream.writeStream.format(fmt).outputMode("append").option("path", path).option("checkpointLocation", checkpoint)


def each_batch(stream: DataFrame, write: Callable[[DataFrame, str], None], path: str, checkpoint: str) -> DataStreamWriter:
    """Calls ``write(rows, folder)`` per micro-batch with the batch's own folder under ``path``."""

    def run(rows: DataFrame, batch: int) -> None:
        write(rows, f"{path}/load={batch}")

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)


def load_job(stream: DataFrame, path: str, checkpoint: str, shards: int = 5, every: str | None = None) -> DataStreamWriter:
    """Appends what has come as ``shards`` files, ``every`` so often (``"10 minutes"``)."""

    def write(rows: DataFrame, folder: str) -> None:
        rows.repartition(shards).write.mode("overwrite").parquet(folder)

    writer = each_batch(stream, write, path, checkpoint)
    return writer.trigger(processingTime=every) if every else writer


def files_by_window(
    stream: DataFrame, ts: str, key: Column, path: str, checkpoint: str, size_seconds: int = 300, shards: int = 0
) -> DataStreamWriter:
    """Rows to folders named by the close of their window and by key."""
    close = F.window(ts, f"{size_seconds} seconds")["end"]
    named = stream.select(
        "*", F.date_format(close, "yyyy-MM-dd").alias("day"), F.date_format(close, "HH-mm").alias("close"), key.alias("key")
    )

    def write(rows: DataFrame, folder: str) -> None:
        spread = rows.repartition(shards) if shards else rows.hint("rebalance", "day", "close", "key")
        spread.write.mode("overwrite").partitionBy("day", "close", "key").parquet(folder)

    return each_batch(named, write, path, checkpoint)


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path or URI and the place in it; a local place is taken as it is written."""
    if local := re.fullmatch(r"(?:file:/*)?(/.*|[^:]*)", path):
        return fs.LocalFileSystem(), "/" + local[1].lstrip("/")
    return fs.FileSystem.from_uri(quote(path, safe=":/?=&*[]"))


def _files_of(path: str) -> list[tuple[fs.FileSystem, str]]:
    """The files that a path or glob names; an error when there are none."""
    store, place = _place(path)
    if not re.search(r"[*?\[]", place):
        found = [place] if store.get_file_info(place).type == fs.FileType.File else []
    else:
        base = re.split(r"[^/]*[*?\[]", place, maxsplit=1)[0]
        whole = re.compile("/".join(fnmatch.translate(part)[:-2].replace(".*", "[^/]*") for part in place.split("/")) + r"\Z")
        within = store.get_file_info(fs.FileSelector(base, recursive="/" in place[len(base) :], allow_not_found=True))
        found = sorted(f.path for f in within if f.type == fs.FileType.File and whole.match(f.path))
    if not found:
        raise FileNotFoundError(f"no file for {path}")
    return [(store, f) for f in found]


def _count_lines(store: fs.FileSystem, place: str, piece: int = 8 << 20) -> int:
    """Lines of a file, read piece by piece; a last line needs no line feed, an empty file has none."""
    lines, last = 0, b"\n"
    with store.open_input_stream(place) as file:
        while data := file.read(piece):
            lines, last = lines + data.count(b"\n"), data[-1:]
    return lines + (last != b"\n")


def count_lines_of_paths(messages: DataFrame, path: str, ts: str, pattern: str = STORAGE_PATH_PATTERN) -> DataFrame:
    """One row (path, ts, lines) for each message that names a file or a glob.

    Texts that are no path are left out; a path or glob without a file is an error. Globs
    are expanded and files read in the tasks that hold the messages, in bounded pieces.
    """
    valid = messages.where(matches_whole(F.col(path), pattern)).select(F.col(path).alias("path"), F.col(ts).alias("ts"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [sum(_count_lines(*file) for file in _files_of(p)) for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())], names=["path", "ts", "lines"])

    kind = valid.schema["ts"].dataType.simpleString()
    return valid.mapInArrow(read, f"path string, ts {kind}, lines long")


def new_checkpoint(spark: SparkSession) -> str:
    return scratch_path(spark, "stream-checkpoint")
