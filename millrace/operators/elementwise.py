"""Element-wise transforms: map, flat-map, filters, tagged outputs, decoding, rendering."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, MapType, StructField, StructType, VariantType

from millrace.functions import numbers, text


def create_range(spark: SparkSession, count: int = 10, extra: int | None = None) -> DataFrame:
    """Numbers 0 … count-1 made on the executors, with an optional extra element."""
    made = spark.range(count).select(F.col("id").alias("n"))
    return made if extra is None else made.unionByName(spark.range(extra, extra + 1).select(F.col("id").alias("n")))


def create_rows(spark: SparkSession, rows: list, schema: str | StructType) -> DataFrame:
    """A frame from a short literal list with a stated schema."""
    return spark.createDataFrame(rows, schema)


def double_and_square(df: DataFrame, value: str) -> DataFrame:
    return df.withColumn("doubled", F.col(value) * 2).withColumn("squared", F.col("doubled") * F.col("doubled"))


def split_words(df: DataFrame, value: str, name: str = "word") -> DataFrame:
    """One row per white-space separated word."""
    return df.withColumn(name, F.explode(text.whitespace_words(F.col(value)))).drop(value)


NEAR_BITS = 16
PIECE_PAIRS = 1_000_000


def explode_divisors(df: DataFrame, n: str, name: str = "divisor") -> DataFrame:
    """One row per divisor of ``n``, a whole number; none where it is null or below 1.

    Ranges of ``n`` go to the tasks, a frequent number to several, and each Arrow batch finds the divisors of numbers
    that lie near each other together. So the work grows with the rows, their divisors and the square root of ``n`` once
    for each batch; numbers far from all others cost their own square root.
    """
    kept = [field for field in df.schema.fields if field.name != name]
    hashed = [field.name for field in df.schema.fields if not isinstance(field.dataType, (MapType, VariantType))]
    near = df.where(F.col(n) > 0).repartitionByRange(F.col(n), F.xxhash64(*hashed)).sortWithinPartitions(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.select([field.name for field in kept])
            values = batch.column(n).cast(pa.int64()).to_numpy(zero_copy_only=False)
            distinct, first, which = np.unique(values, return_index=True, return_inverse=True)
            ends = [*(np.flatnonzero(np.diff(distinct >> NEAR_BITS)) + 1).tolist(), len(distinct)]
            begin, found, held = 0, [], 0
            for start, end in zip([0, *ends], ends):
                place, divisor = numbers.divisor_pairs(distinct[start:end])
                found.append((place + (start - begin), divisor))
                held += len(divisor)
                if held < PIECE_PAIRS and end < len(distinct):
                    continue
                # The rows of the numbers begin … end follow each other, as the batch is sorted.
                top = first[end] if end < len(distinct) else batch.num_rows
                yield from paired(rows.slice(first[begin], top - first[begin]), which[first[begin] : top] - begin, found, end - begin)
                begin, found, held = end, [], 0

    def paired(rows: pa.RecordBatch, which: np.ndarray, found: list, count: int) -> Iterator[pa.RecordBatch]:
        """Each row once for each divisor of its number, in pieces of about ``PIECE_PAIRS`` rows."""
        place, divisor = (np.concatenate(part) for part in zip(*found))
        divisor = divisor[np.argsort(place, kind="stable")]
        each = np.bincount(place, minlength=count)
        starts = np.cumsum(each) - each
        times = each[which]
        piece = np.cumsum(times) // PIECE_PAIRS
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(which)]
        for begin, end in zip(cuts, cuts[1:]):
            some = times[begin:end]
            row = np.repeat(np.arange(begin, end), some)
            within = np.arange(len(row)) - np.repeat(np.cumsum(some) - some, some)
            out = rows.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(divisor[starts[which[row]] + within], pa.int64())], names=[*out.schema.names, name]
            )

    return near.mapInArrow(run, StructType([*kept, StructField(name, LongType())]))


def tagged(df: DataFrame, outputs: Mapping[str, Column], tag: str = "tag") -> DataFrame:
    """Several outputs in one pass: a row appears once per output whose condition holds.

    A single output is ``tagged(...).where(col(tag) == name)``.
    """
    tags = F.array(*[F.when(condition, F.lit(name)) for name, condition in outputs.items()])
    return df.withColumn(tag, F.explode(F.array_compact(tags)))


def branches(tagged_df: DataFrame, names: list[str], tag: str = "tag") -> dict[str, DataFrame]:
    return {name: tagged_df.where(F.col(tag) == name).drop(tag) for name in names}


class PartitionFn:
    """Code with a life cycle around the rows of one partition.

    ``setup`` runs before the first batch, ``start_batch`` and ``finish_batch`` around
    each Arrow batch, ``teardown`` at the end also after a failure. The ``finish``
    calls may return more rows.
    """

    def setup(self) -> None: ...

    def start_batch(self) -> None: ...

    def process(self, batch: Any) -> Any:
        return batch

    def finish_batch(self) -> Any: ...

    def teardown(self) -> None: ...


def map_partitions(df: DataFrame, fn: Callable[[], PartitionFn], schema: str | StructType) -> DataFrame:
    """Runs a :class:`PartitionFn` over each partition in Arrow batches (pandas frames)."""

    def run(batches: Iterator) -> Iterator:
        worker = fn()
        worker.setup()
        try:
            for batch in batches:
                worker.start_batch()
                out = worker.process(batch)
                if out is not None and len(out):
                    yield out
                rest = worker.finish_batch()
                if rest is not None and len(rest):
                    yield rest
        finally:
            worker.teardown()

    return df.mapInPandas(run, schema)


def redistribute(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Breaks the partitioning: even partitions whatever the keys."""
    return df.repartition(partitions) if partitions else df.hint("rebalance")


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept."""
    for other in others:
        first = first.unionByName(other)
    return first


def flatten_arrays(df: DataFrame, array: str, name: str = "item") -> DataFrame:
    """One row per array element; an empty or null array gives none."""
    return df.withColumn(name, F.explode(array)).drop(array)


def decode_json(df: DataFrame, value: str, schema: str, required: list[str], strict: bool = False) -> DataFrame:
    """Text or bytes to typed fields; rows that are no such record are dropped, or fail when ``strict``."""
    mode = "FAILFAST" if strict else "PERMISSIVE"
    parsed = F.from_json(F.col(value).cast("string"), schema, {"mode": mode})
    others = [c for c in df.columns if c != value]
    # `inline` parses a text once; a filter on the plain expression would parse it again.
    record = df.select(*others, F.inline(F.array(parsed)))
    for field in required:
        record = record.where(F.col(field).isNotNull())
    return record


def parse_delimited(df: DataFrame, value: str, fields: Mapping[str, str], separator: str = ", ") -> DataFrame:
    """``separator``-joined text to typed fields, given as name → type in order."""
    parts = F.split(F.col(value), separator)
    columns = [parts.getItem(i).cast(kind).alias(name) for i, (name, kind) in enumerate(fields.items())]
    return df.select(*[c for c in df.columns if c != value], *columns)


def map_to_fields(df: DataFrame, fields: Mapping[str, Column | str]) -> DataFrame:
    """A new record: output field → column or expression text."""
    return df.select(*[(F.expr(e) if isinstance(e, str) else e).alias(name) for name, e in fields.items()])


def key_by(df: DataFrame, key: Column, value: Column, key_name: str = "key", value_name: str = "value") -> DataFrame:
    return df.select(key.alias(key_name), value.alias(value_name))


def word_count(df: DataFrame, value: str, letters_only: bool = False) -> DataFrame:
    """Composite transform: split into words, count each."""
    pieces = text.letter_words(F.col(value)) if letters_only else text.words(F.col(value))
    return df.select(F.explode(pieces).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def count_at_least(df: DataFrame, value: str, minimum: int, strict: bool = False) -> DataFrame:
    """Run-time threshold filter, then the count of what is left."""
    kept = df.where(F.col(value) > minimum) if strict else df.where(F.col(value) >= minimum)
    return kept.agg(F.count("*").alias("n"))


def count_comparisons(df: DataFrame, value: str, minimum: int) -> DataFrame:
    """The counts above the threshold, from it on, and of all rows, in one pass: (comparison, n)."""
    counts = df.agg(
        F.count_if(F.col(value) > minimum).alias("strict"), F.count_if(F.col(value) >= minimum).alias("inclusive"), F.count("*").alias("all")
    )
    return counts.unpivot([], ["strict", "inclusive", "all"], "comparison", "n")


def metric_columns(status: str, people: str, cost: str) -> list[Column]:
    """Counters and a distribution over rides: count per status, net people, cost of drop-offs."""
    is_pickup, is_dropoff = F.col(status) == "pickup", F.col(status) == "dropoff"
    net = F.when(is_pickup, 1).when(is_dropoff, -1).otherwise(0) * F.col(people)
    cost_units = F.when(is_dropoff, (F.col(cost) * 1000).cast("long"))
    return [
        F.count_if(is_pickup).alias("pickups"),
        F.count_if(is_dropoff).alias("dropoffs"),
        F.count_if(F.col(status) == "enroute").alias("enroutes"),
        F.sum(net).cast("long").alias("net_people"),
        F.count(cost_units).alias("cost_count"),
        F.sum(cost_units).alias("cost_sum"),
        F.min(cost_units).alias("cost_min"),
        F.max(cost_units).alias("cost_max"),
    ]


def observe_metrics(df: DataFrame, metrics: list[Column], name: str = "metrics") -> tuple[DataFrame, Observation]:
    """Passes the rows on while Spark collects the metrics of the run."""
    observation = Observation(name)
    return df.observe(observation, *metrics), observation
