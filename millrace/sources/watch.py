"""Continuous file match as a streaming data source, ``readStream.format("file_watch")``.

Rows are files, not their content: each file that appears under a path or glob comes once, also after a restart.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from hashlib import blake2b

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from millrace.functions.places import files_under, matching_files, place_of

FILES_PER_TASK = 256

COLUMNS = "path string, size long, modified timestamp, matched timestamp"


class Found(InputPartition):
    """Lines [begin, end) of one listing."""

    def __init__(self, listing: int, begin: int, end: int) -> None:
        self.listing, self.begin, self.end = listing, begin, end


class WatchReader(DataSourceStreamReader):
    """Offsets count listings. A listing is a small file in the folder ``log`` with the new files of one poll.

    It is complete before its number is given to Spark, so the files of an offset are the same in every attempt.
    At a start the listings tell which files have come. The driver holds 16 bytes for each; tasks get line ranges.
    """

    def __init__(self, pattern: str, log: str, interval: float) -> None:
        self.pattern, self.log, self.interval = pattern, log, interval
        self.seen: set[bytes] | None = None
        self.sizes: dict[int, int] = {}
        self.last, self.polled = 0, float("-inf")

    @staticmethod
    def _mark(path: str) -> bytes:
        return blake2b(path.encode(), digest_size=16).digest()

    def _lines(self, listing: int) -> list[dict]:
        store, root = place_of(self.log)
        with store.open_input_stream(f"{root}/{listing:012d}.jsonl") as file:
            return [json.loads(line) for line in file.read().splitlines()]

    def _start(self) -> None:
        self.seen = set()
        for info in files_under(self.log, ".jsonl"):
            listing = int(info.base_name.removesuffix(".jsonl"))
            lines = self._lines(listing)
            self.seen.update(self._mark(line["path"]) for line in lines)
            self.sizes[listing], self.last = len(lines), max(self.last, listing)

    def initialOffset(self) -> dict:
        return {"listing": 0}

    def latestOffset(self) -> dict:
        """Polls, unless the last poll is less than the interval ago."""
        if self.seen is None:
            self._start()
        if time.monotonic() - self.polled >= self.interval:
            self.polled = time.monotonic()
            self._poll()
        return {"listing": self.last}

    def _poll(self) -> None:
        new = []
        for uri, info in matching_files(self.pattern):
            mark = self._mark(uri)
            if mark not in self.seen:
                self.seen.add(mark)
                new.append({"path": uri, "size": info.size, "modified": (info.mtime_ns or 0) // 1000, "matched": time.time_ns() // 1000})
        if not new:
            return
        store, root = place_of(self.log)
        store.create_dir(root, recursive=True)
        name = f"{root}/{self.last + 1:012d}.jsonl"
        with store.open_output_stream(f"{root}/_draft") as file:
            file.write("".join(json.dumps(line) + "\n" for line in new).encode())
        store.move(f"{root}/_draft", name)
        self.last += 1
        self.sizes[self.last] = len(new)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if self.seen is None:
            self._start()
        found = []
        for listing in range(start["listing"] + 1, end["listing"] + 1):
            n = self.sizes[listing]
            found += [Found(listing, b, min(b + FILES_PER_TASK, n)) for b in range(0, n, FILES_PER_TASK)]
        return found

    def read(self, partition: Found) -> Iterator[pa.RecordBatch]:
        lines = self._lines(partition.listing)[partition.begin : partition.end]
        times = pa.timestamp("us", "UTC")
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([line["path"] for line in lines], pa.string()),
                pa.array([line["size"] for line in lines], pa.int64()),
                pa.array([line["modified"] for line in lines], times),
                pa.array([line["matched"] for line in lines], times),
            ],
            names=["path", "size", "modified", "matched"],
        )


class WatchSource(DataSource):
    """Data source ``file_watch``; options ``path`` (a folder's prefix or a glob), ``log``, ``interval`` in seconds."""

    @classmethod
    def name(cls) -> str:
        return "file_watch"

    def schema(self) -> str:
        return COLUMNS

    def streamReader(self, schema) -> WatchReader:
        return WatchReader(self.options["path"], self.options["log"], float(self.options.get("interval", 10)))


def watch_files(spark: SparkSession, pattern: str, log: str, interval_seconds: float = 10) -> DataFrame:
    """A stream of the files that the glob names, polled every ``interval_seconds``.

    ``log`` is a folder in the shared store that belongs to this watch, as its checkpoint does: start again with both
    or with neither. A file counts by its path alone; one that is written anew does not come again. Files must
    appear whole, by a move. Hidden files (a name that begins with a dot or underscore) are not matched.
    """
    spark.dataSource.register(WatchSource)
    return spark.readStream.format("file_watch").option("log", log).option("interval", interval_seconds).load(pattern)


def put_whole(write: Callable[[str], None], path: str) -> None:
    """Lets ``write`` make a folder of files aside, then moves it to ``path``, so a watch sees whole files only."""
    store, place = place_of(path)
    parent, _, name = place.rstrip("/").rpartition("/")
    store.create_dir(parent, recursive=True)
    write(f"{path.rstrip('/').rpartition('/')[0]}/_{name}")
    store.move(f"{parent}/_{name}", place)
