"""SQL over collections, with user-defined functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

# The name under which SQL over a single input sees it.
SINGLE_INPUT = "rows"


def sql_over(df: DataFrame, query: str, name: str = SINGLE_INPUT) -> DataFrame:
    """Runs SQL with the frame visible as ``rows``."""
    return sql_over_named(df.sparkSession, query, {name: df})


def sql_over_named(spark: SparkSession, query: str, inputs: dict[str, DataFrame]) -> DataFrame:
    """Runs SQL over several named inputs."""
    for name, frame in inputs.items():
        frame.createOrReplaceTempView(name)
    return spark.sql(query)


@F.pandas_udf(BooleanType())
def is_senior(years: pd.Series) -> pd.Series:
    return years >= 5.0


@F.pandas_udf(StringType())
def joined_sorted(texts: pd.Series) -> str:
    """Joined texts of a group without nulls, sorted because a group has no order.

    The group is held in one task: fold it first.
    """
    return ", ".join(sorted(texts.dropna()))


def register_functions(spark: SparkSession) -> None:
    """Makes the scalar function is_senior and the aggregate joined_sorted known to SQL."""
    spark.udf.register("is_senior", is_senior)
    spark.udf.register("joined_sorted", joined_sorted)


def add_window(df: DataFrame, ts: str, size_seconds: int, slide_seconds: int | None = None) -> DataFrame:
    """Adds the event-time window as columns, so that SQL groups by it without a window function."""
    window = F.window(ts, f"{size_seconds} seconds", f"{slide_seconds or size_seconds} seconds")
    bounds = df.withColumn("_window", window)
    start, end = F.unix_micros("_window.start"), F.unix_micros("_window.end")
    return bounds.withColumn("window_start", start).withColumn("window_end", end).drop("_window")


