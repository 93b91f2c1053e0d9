"""Any number of destinations in one write, each with a schema of its own.

``format("destinations")`` is a Spark data source: rows of a task come sorted by destination, a task has one file open
at a time, and the commit moves all files to ``destination=<name>`` folders at once. The schema of a destination
comes from a table (a side input), so neither names nor schemas need to be known when the job is written.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from millrace.functions.places import Drafts, files_under

UNROUTED = "unrouted"


class Routed(WriterCommitMessage):
    """The drafts of a task with the destination of each."""

    def __init__(self, drafts: list[tuple[str, str]]) -> None:
        self.drafts = drafts


#: Signs that a partition folder's name has as their code.
ESCAPED = re.compile(r"""[\x00-\x1f"#%'*/:=?\\\x7f{}\[\]^]""")


def folder_of(destination: str) -> str:
    """The folder of a destination: any text gives one folder, and Spark reads the text back as a partition value."""
    return "destination=" + ESCAPED.sub(lambda sign: f"%{ord(sign[0]):02X}", destination)


class DestinationWriter(DataSourceArrowWriter):
    """Writes runs of rows of one destination and schema as Parquet files of at most ``file_bytes`` or so."""

    def __init__(self, path: str, file_bytes: int, overwrite: bool) -> None:
        self.drafts, self.file_bytes, self.overwrite = Drafts(path), file_bytes, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        done: list[tuple[str, str]] = []
        key, file, sink, writer = None, None, None, None

        def close() -> None:
            nonlocal writer
            if writer is not None:
                writer.close()
                sink.close()
                writer = None

        for batch in iterator:
            for run in _runs(batch):
                destination, fields = run["destination"][0].as_py(), run["fields"][0].as_py()
                record = run["record"]
                names = [f.name for f in record.type] if fields is None else fields
                rows = pa.table([pc.struct_field(record, [n]) for n in names], names=names)
                if (destination, names) != key or (writer is not None and sink.tell() >= self.file_bytes):
                    close()
                    key = (destination, names)
                if writer is None:
                    store, file = self.drafts.create()
                    sink = store.open_output_stream(file)
                    writer = pq.ParquetWriter(sink, rows.schema, compression="zstd")
                    done.append((file, destination))
                writer.write_table(rows)
        close()
        return Routed(done)

    def commit(self, messages: list) -> None:
        moves = []
        for draft, destination in (d for m in messages if m is not None for d in m.drafts):
            moves.append((draft, f"{folder_of(destination)}/part-{draft.rpartition('/')[2]}.parquet"))
        self.drafts.publish(moves, r"destination=.*\.parquet$" if self.overwrite else None)

    def abort(self, messages: list) -> None:
        self.drafts.clear()


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch cut where destination or schema change."""
    if not batch.num_rows:
        return
    coded = [batch["destination"].dictionary_encode().indices.to_numpy(zero_copy_only=False)]
    listed = pc.binary_join(batch["fields"].cast(pa.list_(pa.string())), "\0").fill_null("\0\0")
    coded.append(listed.dictionary_encode().indices.to_numpy(zero_copy_only=False))
    change = np.flatnonzero((np.diff(coded[0]) != 0) | (np.diff(coded[1]) != 0)) + 1
    cuts = [0, *change.tolist(), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:]):
        yield batch.slice(begin, end - begin)


class DestinationSink(DataSource):
    """Data source ``destinations``: columns ``destination``, ``fields`` (null: all) and the struct ``record``."""

    @classmethod
    def name(cls) -> str:
        return "destinations"

    def writer(self, schema: StructType, overwrite: bool) -> DestinationWriter:
        return DestinationWriter(self.options["path"], int(self.options["fileBytes"]), overwrite)


def write_to_destinations(
    df: DataFrame,
    destination: Column,
    path: str,
    schemas: DataFrame | None = None,
    unrouted: str = UNROUTED,
    file_bytes: int = 256 << 20,
    mode: str = "append",
) -> None:
    """Routes each row to the destination that the expression names, creating those that are not there yet.

    ``schemas`` has ``destination`` and ``fields`` (the columns kept, in order); a destination it does not list gets
    all columns, and a field that the rows have not ends the write. A null or empty name goes to ``unrouted``. Repeated
    rows stay. ``append`` adds files, ``overwrite`` replaces all destinations at the commit.

    Each name has one schema, so adaptive execution can split the rows of a hot name in the join. Then a rebalance puts
    a destination's rows together, and splits a large one by its size.
    """
    spark = df.sparkSession
    spark.dataSource.register(DestinationSink)
    record = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    routed = df.select(F.coalesce(F.nullif(destination.cast("string"), F.lit("")), F.lit(unrouted)).alias("destination"), record.alias("record"))
    if schemas is None:
        routed = routed.withColumn("fields", F.lit(None).cast("array<string>"))
    else:
        # Of several schemas for one name the first in their order holds.
        one = schemas.groupBy("destination").agg(F.min("fields").alias("fields"))
        unknown = F.array_except("fields", F.array(*[F.lit(c) for c in df.columns]))
        fault = F.raise_error(F.concat(F.lit("no such column: "), F.array_join(unknown, ", ")))
        one = one.withColumn("fields", F.when(F.size(unknown) > 0, fault).otherwise(F.col("fields")))
        routed = routed.join(one, "destination", "left")
    sorted_rows = routed.select("destination", "fields", "record").hint("rebalance", "destination")
    sorted_rows = sorted_rows.sortWithinPartitions("destination", "fields")
    sorted_rows.write.format("destinations").option("fileBytes", file_bytes).mode(mode).save(path)


def destinations(path: str) -> list[str]:
    """The destinations that have files."""
    folders = {f.path.rpartition("/destination=")[2].split("/")[0] for f in files_under(path, ".parquet")}
    return sorted(re.sub("%([0-9A-F]{2})", lambda code: chr(int(code[1], 16)), folder) for folder in folders)


def read_destination(spark: SparkSession, path: str, destination: str) -> DataFrame:
    """One destination with its own columns; files written by an older schema give null for newer columns."""
    return spark.read.option("mergeSchema", "true").parquet(f"{path}/{folder_of(destination)}")


def read_destinations(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All destinations in one table: ``destination`` and the columns of ``schema``, null where one has no such column."""
    return spark.read.schema(f"{schema}, destination string").parquet(path)
