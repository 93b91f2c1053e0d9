"""Co-grouping, joins of two inputs, side inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregate import CHUNK_ROWS, group_values
from millrace.operators.scale import attach_all, split_join


def cogroup(
    inputs: dict[str, tuple[DataFrame, str, Sequence[str]]], key: str, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Values of every input per key: (key, chunk, one array per input, empty when missing).

    ``inputs`` maps an output name to (frame, value column, order). Keys of all inputs
    appear, null as one key. Chunk *i* holds the *i*-th ``chunk_rows`` values of each input, so a hot
    key is several bounded rows and the full outer join is on (key, chunk).
    """
    joined = None
    for name, (frame, value, order) in inputs.items():
        grouped = group_values(frame, [key], value, order, chunk_rows).withColumnRenamed("values", name)
        if joined is None:
            joined = grouped
            continue
        other = grouped.withColumnsRenamed({key: "_key", "chunk": "_chunk"})
        same = joined[key].eqNullSafe(other["_key"]) & (joined["chunk"] == other["_chunk"])
        # A row that only the second input has lacks the chunk of the first; then its key is the other one.
        keyed = F.when(F.col("chunk").isNull(), F.col("_key")).otherwise(F.col(key))
        full = joined.join(other, same, "full").withColumn(key, keyed).withColumn("chunk", F.coalesce("chunk", "_chunk"))
        joined = full.drop("_key", "_chunk")
    empty = [F.coalesce(F.col(name), F.array().cast(joined.schema[name].dataType)).alias(name) for name in inputs]
    return joined.select(key, "chunk", *empty)


def inner_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return split_join(left, right, key)


def left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return split_join(left, right, key, "left")


def full_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return split_join(left, right, key, "full")


def map_side_input(
    df: DataFrame, lookup: DataFrame, key: str, value: str, default: Column | None = None, first_of_list: bool = False
) -> DataFrame:
    """Adds ``value`` of the row's ``key`` from a lookup collection.

    A key that the lookup lacks takes ``default``; without one it is an error. A key
    given twice is an error too, unless ``first_of_list`` takes its smallest value.
    """
    folded = lookup.groupBy(key).agg(F.min(value).alias("_value"), F.count("*").alias("_n"))
    once = F.col("_value")
    if not first_of_list:
        once = F.when(F.col("_n") == 1, once).otherwise(
            F.raise_error(F.concat(F.lit("duplicate key in the lookup: "), F.col(key).cast("string")))
        )
    side = folded.select(key, once.alias(value), F.lit(True).alias("_found"))
    missing = (
        default
        if default is not None
        else F.raise_error(F.concat(F.lit("key is not in the lookup: "), F.col(key).cast("string")))
    )
    # The lookup has one row per key: adaptive execution broadcasts a small one and splits hot keys of the rows.
    joined = df.join(side, key, "left")
    return joined.withColumn(value, F.when(F.col("_found"), F.col(value)).otherwise(missing)).drop("_found")


def each_with_all(df: DataFrame, side: DataFrame) -> DataFrame:
    """Iterable side input: every row with every element of the side."""
    return attach_all(df, side)


def singleton_side_input(df: DataFrame, side: DataFrame, value: str, name: str) -> DataFrame:
    """Adds the one value of the side to every row; an error unless the side has exactly one row."""
    checked = F.when(F.count("*") == 1, F.first(value)).otherwise(
        F.raise_error(F.concat(F.lit("a single element is needed, found "), F.count("*").cast("string")))
    )
    return df.withColumn(name, side.agg(checked.alias(name)).scalar())
