"""Catalog tables: by name, typed, by SQL, many requests at once, pinned versions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, *reference: str) -> DataFrame:
    """A table by its name, or by the parts (catalog, database, table)."""
    return spark.table(".".join(f"`{part}`" for name in reference for part in name.split(".")))


def rows_as_json(df: DataFrame, name: str = "row") -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias(name))


def read_typed(df: DataFrame, record: str | StructType) -> DataFrame:
    """Only the fields of the record, cast to its types; an error when one is missing."""
    schema = record if isinstance(record, StructType) else StructType.fromDDL(record)
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing in the table: {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def read_query(spark: SparkSession, query: str, **inputs: DataFrame) -> DataFrame:
    return spark.sql(query, **inputs)


def read_all(spark: SparkSession, requests: list[tuple[str, str, str]], **inputs: DataFrame) -> DataFrame:
    """Queries and tables in one collection of (request_id, row json).

    A request is (id, ``query`` or ``table``, text); the list is short, the rows are not.
    """
    frames = []
    for request, kind, text in requests:
        if kind == "query":
            frame = spark.sql(text, **inputs)
        else:
            frame = inputs[text] if text in inputs else read_table(spark, text)
        frames.append(rows_as_json(frame).select(F.lit(request).alias("request_id"), "row"))
    return reduce(DataFrame.unionByName, frames)


def scan_pushed_down(df: DataFrame, fields: list[str], restriction: str) -> DataFrame:
    """Row restriction and column selection that reach the file scan."""
    return df.where(restriction).select(*fields)


def pinned(spark: SparkSession, path: str) -> DataFrame:
    """The table folder as it is now: every reader made from this DataFrame sees the same files.

    Spark lists a folder once, when the DataFrame is made; files appended later do not show in it, also when it is
    read again. Rows are appended by the sinks here, never changed in place.
    """
    return spark.read.parquet(path)
