"""Streaming row inserts with a retry policy; rows that cannot be inserted come back as data.

``writeStream.format("row_inserts")`` is a Spark data source: a task sends its rows as insert requests of bounded
size, a request that fails is tried again or given up by the policy, and the commit of a micro-batch puts the
accepted rows under ``rows`` and the failed ones (row, error, table) under ``failed``.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from millrace.functions.places import Drafts, place_of
from millrace.sinks.tables import split_rejected

NEVER, TRANSIENT, ALWAYS = "never", "transient", "always"

#: Faults that another attempt can mend: the store or the way to it. Any other fault is the request's own.
PASSING = (ConnectionError, TimeoutError, InterruptedError, BlockingIOError)

FAILED = pa.schema([("row", pa.string()), ("error", pa.string()), ("table", pa.string())])
FAILED_DDL = "row string, error string, table string"


def is_passing(error: BaseException) -> bool:
    """Whether a fault is transient. Arrow's stores report a lost connection as a plain ``OSError`` without a number."""
    return isinstance(error, PASSING) or (type(error) is OSError and error.errno is None)


class Inserted(WriterCommitMessage):
    """What one task has written: (draft, folder) in the order of its requests."""

    def __init__(self, task: int, drafts: list[tuple[str, str]]) -> None:
        self.task, self.drafts = task, drafts


class InsertWriter(DataSourceStreamArrowWriter):
    """Writes the requests of a task as files, and puts them in place when the micro-batch commits.

    A micro-batch that is run again, whatever its number of tasks, replaces its own files: each has a folder of its own,
    in which names carry the task and the request.
    """

    def __init__(self, path: str, retry: str, attempts: int, request_rows: int, wait_seconds: float) -> None:
        if retry not in (NEVER, TRANSIENT, ALWAYS):
            raise ValueError(f"no such retry policy: {retry}")
        self.retry, self.attempts, self.request_rows, self.wait = retry, attempts, request_rows, wait_seconds
        self.drafts = Drafts(path)

    def put(self, rows: pa.Table) -> str:
        """One insert request: the rows as a file of their own."""
        store, draft = self.drafts.create()
        with store.open_output_stream(draft) as file:
            pq.write_table(rows, file, compression="zstd")
        return draft

    def insert(self, rows: pa.Table) -> tuple[str | None, str | None]:
        """The request's draft, or the error with which its rows fail.

        A fault the policy retries ends the task once the attempts are used up; Spark then runs the task anew.
        """
        for attempt in range(1, self.attempts + 1):
            try:
                return self.put(rows), None
            except Exception as error:
                again = self.retry == ALWAYS or (self.retry == TRANSIENT and is_passing(error))
                if not again:
                    return None, f"{type(error).__name__}: {error}"
                if attempt == self.attempts:
                    raise
                time.sleep(self.wait * 2 ** (attempt - 1))
        raise ValueError("at least one attempt")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        drafts: list[tuple[str, str]] = []
        for batch in iterator:
            table = pa.Table.from_batches([batch])
            fits = pc.is_null(table["error"])
            good, bad = table.filter(fits), table.filter(pc.invert(fits))
            for begin in range(0, good.num_rows, self.request_rows):
                request = good.slice(begin, self.request_rows)
                record = request["record"].combine_chunks()
                names = [field.name for field in record.type]
                draft, error = self.insert(pa.Table.from_arrays(record.flatten(), names=names))
                if draft:
                    drafts.append((draft, "rows"))
                else:
                    bad = pa.concat_tables([bad, request.set_column(1, "error", pa.array([error] * request.num_rows))])
            if bad.num_rows:
                drafts.append((self.put(bad.select(FAILED.names)), "failed"))
        context = TaskContext.get()
        return Inserted(context.partitionId() if context else 0, drafts)

    def commit(self, messages: list, batchId: int) -> None:
        moves, mine = [], f"batch-{batchId:012d}"
        for message in sorted((m for m in messages if m is not None), key=lambda m: m.task):
            for request, (draft, folder) in enumerate(message.drafts):
                moves.append((draft, f"{folder}/{mine}/{message.task:06d}-{request:06d}.parquet"))
        # Only this micro-batch's own folders are looked through, however long the stream has been running.
        self.drafts.publish(moves, ".*", [f"rows/{mine}", f"failed/{mine}"])

    def abort(self, messages: list, batchId: int) -> None:
        self.drafts.clear()


class InsertSource(DataSource):
    """Data source ``row_inserts``: ``row``, ``error``, ``table`` and ``record``, as :func:`split_rejected` gives them."""

    @classmethod
    def name(cls) -> str:
        return "row_inserts"

    def streamWriter(self, schema: StructType, overwrite: bool) -> InsertWriter:
        given = json.loads(self.options["requests"])
        return InsertWriter(self.options["path"], **given)


def insert_rows(
    stream: DataFrame,
    target: str | StructType,
    table: str,
    path: str,
    checkpoint: str,
    retry: str = TRANSIENT,
    attempts: int = 4,
    request_rows: int = 50_000,
    wait_seconds: float = 0.5,
) -> DataStreamWriter:
    """Inserts the JSON texts in ``row`` into the table folder ``path``.

    Rows that do not fit ``target`` are failed rows at once. Policies: ``never`` (a request that fails gives failed
    rows), ``transient`` (faults of the store are tried again, ``attempts`` times with doubling waits, others give
    failed rows), ``always``. A null row is a failed row.
    """
    stream.sparkSession.dataSource.register(InsertSource)
    checked = split_rejected(stream.select("row"), target, table).select("row", "error", "table", "record")
    given = {"retry": retry, "attempts": attempts, "request_rows": request_rows, "wait_seconds": wait_seconds}
    writer = checked.writeStream.format("row_inserts").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.option("path", path).option("requests", json.dumps(given))


def inserted_rows(spark: SparkSession, path: str, target: str | StructType) -> DataFrame:
    """The accepted rows; an empty table where none has come yet."""
    return _read(spark, f"{path}/rows", target if isinstance(target, StructType) else StructType.fromDDL(target))


def failed_rows(spark: SparkSession, path: str) -> DataFrame:
    """The failed rows: (row, error, table)."""
    return _read(spark, f"{path}/failed", StructType.fromDDL(FAILED_DDL))


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    store, place = place_of(path)
    if store.get_file_info(place).type != fs.FileType.Directory:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
