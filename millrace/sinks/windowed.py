"""Files of a stream that are named by the close of their window, key, pane and shard.

``writeStream.format("windowed_files")`` is a Spark data source: tasks write drafts, and the commit of a micro-batch
gives them their names, when the number of a window's shards is known.
"""

from __future__ import annotations

from collections import OrderedDict, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from millrace.functions.places import Drafts

OPEN_FILES = 16


class Shards(WriterCommitMessage):
    """A task's drafts with the name of the window and key of each."""

    def __init__(self, task: int, drafts: list[tuple[str, str]]) -> None:
        self.task, self.drafts = task, drafts


class WindowedFiles(DataSourceStreamArrowWriter):
    """Columns ``name`` and ``record``. A task holds at most ``OPEN_FILES`` files open; one closed early is a shard more."""

    def __init__(self, path: str) -> None:
        self.drafts = Drafts(path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        done: list[tuple[str, str]] = []
        writers: OrderedDict[str, tuple] = OrderedDict()

        def close(name: str) -> None:
            sink, writer = writers.pop(name)
            writer.close()
            sink.close()

        for batch in iterator:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            for name in pc.unique(rows["name"]).to_pylist():
                record = rows.filter(pc.equal(rows["name"], name))["record"].combine_chunks()
                part = pa.Table.from_arrays(record.flatten(), names=[f.name for f in record.type])
                if name not in writers:
                    if len(writers) == OPEN_FILES:
                        close(next(iter(writers)))
                    store, draft = self.drafts.create()
                    sink = store.open_output_stream(draft)
                    writers[name] = (sink, pq.ParquetWriter(sink, part.schema, compression="zstd"))
                    done.append((draft, name))
                writers.move_to_end(name)
                writers[name][1].write_table(part)
        for name in list(writers):
            close(name)
        context = TaskContext.get()
        return Shards(context.partitionId() if context else 0, done)

    def commit(self, messages: list, batchId: int) -> None:
        shards: dict[str, list[str]] = defaultdict(list)
        for message in sorted((m for m in messages if m is not None), key=lambda m: m.task):
            for draft, name in message.drafts:
                shards[name].append(draft)
        moves = [
            (draft, f"{name}-pane-{batchId:06d}-{i:05d}-of-{len(drafts):05d}.parquet")
            for name, drafts in shards.items()
            for i, draft in enumerate(drafts)
        ]
        # A micro-batch that is run again has the rows of the first run, so its windows' folders are all there are.
        self.drafts.publish(moves, rf".*-pane-{batchId:06d}-\d+-of-\d+\.parquet$", {name.rpartition("/")[0] for name in shards})

    def abort(self, messages: list, batchId: int) -> None:
        self.drafts.clear()


class WindowedSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "windowed_files"

    def streamWriter(self, schema: StructType, overwrite: bool) -> WindowedFiles:
        return WindowedFiles(self.options["path"])


def windowed_files(
    stream: DataFrame, ts: str, key: Column, path: str, checkpoint: str, size_seconds: int = 300, shards: int = 4
) -> DataStreamWriter:
    """Rows to ``yyyy/MM/dd/HH-mm--<key>-pane-<p>-<shard>-of-<n>.parquet`` by the close of their window (UTC).

    A pane is what one micro-batch has of a window and key. Its rows go to ``shards`` tasks, so a window that holds
    most of the rows is not one task's work. Signs that a file name cannot have stand as their codes. A row without a
    time is in a window ``none``, one without a key has the key ``none``.
    """
    stream.sparkSession.dataSource.register(WindowedSink)
    # Not ``window``, which leaves out rows without a time.
    close = (F.floor(F.unix_micros(ts) / F.lit(size_seconds * 1_000_000)) + 1) * size_seconds
    at = F.coalesce(F.date_format(F.timestamp_seconds(close), "yyyy/MM/dd/HH-mm"), F.lit("none/none"))
    safe = F.regexp_replace(F.url_encode(F.coalesce(key.cast("string"), F.lit("none"))), r"\+", "%20")
    name = F.concat(at, F.lit("--"), safe).alias("name")
    record = F.struct(*[F.col(f"`{c}`") for c in stream.columns])
    rows = stream.select(name, record.alias("record"))
    spread = rows.repartition("name", F.pmod(F.xxhash64("record"), F.lit(shards)))
    writer = spread.writeStream.format("windowed_files").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.option("path", path)
