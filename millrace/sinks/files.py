"""File sinks: text, CSV, JSON, serialised rows, records with a schema, destinations by key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sharded(df: DataFrame, shards: int) -> DataFrame:
    """``shards`` files when given, else as many as there are tasks."""
    return df.repartition(shards) if shards else df


def write_text(df: DataFrame, path: str, value: str = "value", shards: int = 0) -> None:
    _sharded(df.select(F.col(value).cast("string").alias("value")), shards).write.option("lineSep", "\n").text(path)


def write_csv(df: DataFrame, path: str, shards: int = 0, comments: Sequence[str] = ()) -> None:
    """CSV files with a header; ``comments`` are ``#`` lines put before the header of each file."""
    if not comments:
        _sharded(df, shards).write.csv(path, header=True)
        return
    head = [*(f"# {line}" for line in comments), ",".join(df.columns)]

    def with_head(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": head})
        yield from batches

    rows = _sharded(df, shards).select(F.to_csv(F.struct("*")).alias("value"))
    rows.mapInPandas(with_head, "value string").write.option("lineSep", "\n").text(path)


def write_json(df: DataFrame, path: str, shards: int = 0) -> None:
    _sharded(df, shards).write.json(path)


def write_serialised(df: DataFrame, path: str, serialise: Column | None = None, shards: int = 0) -> None:
    """Rows turned to text by ``serialise`` (JSON by default), one per line."""
    text = F.to_json(F.struct("*")) if serialise is None else serialise
    write_text(df.select(text.alias("value")), path, shards=shards)


def write_records(
    df: DataFrame, path: str, fmt: str = "parquet", required: Sequence[str] = (), shards: int = 0, avro_schema: str | None = None
) -> None:
    """Parquet or Avro records; a null in a required field fails the write.

    ``avro_schema`` is the writer's schema as JSON. A format whose connector is missing is an error.
    """
    checked = df
    for name in required:
        fault = F.raise_error(F.lit(f"null in required field {name}"))
        checked = checked.withColumn(name, F.when(F.col(name).isNull(), fault).otherwise(F.col(name)))
    writer = _sharded(checked, shards).write.format(fmt)
    (writer.option("avroSchema", avro_schema) if avro_schema else writer).save(path)


def write_by_key(df: DataFrame, path: str, key: str, fmt: str = "parquet") -> None:
    """One folder ``key=value`` per destination.

    The rebalance groups the rows of a destination so that small ones get one file, and
    splits a large one over as many tasks as its size asks for.
    """
    df.hint("rebalance", key).write.partitionBy(key).format(fmt).save(path)
