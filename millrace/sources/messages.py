"""Message logs: decoding, bad records, attributes and event time, dead letters, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.times import event_time

# Columns of a message log frame, as the Kafka connector gives them.
LOG_SCHEMA = "topic string, key binary, value binary, partition int, offset long, timestamp timestamp"


def read_stream(spark: SparkSession, fmt: str, schema: str | None = None, **options: str) -> DataFrame:
    """Streaming scan: ``kafka`` where the connector is there, else a file format of the same columns."""
    reader = spark.readStream.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load()


def decoded(log: DataFrame) -> DataFrame:
    """Key and value bytes as text."""
    return log.withColumn("key", F.decode("key", "UTF-8")).withColumn("value", F.decode("value", "UTF-8"))


def with_bad_records(log: DataFrame, expected: str = "kafka_") -> DataFrame:
    """Marks each record good or bad; a value is good when it is null or has the expected part."""
    text = F.decode("value", "UTF-8")
    return log.withColumn("good", F.col("value").isNull() | text.contains(expected))


def good_records(marked: DataFrame) -> DataFrame:
    return marked.where("good").drop("good")


def count_bad_records(marked: DataFrame) -> DataFrame:
    return marked.where("NOT good").agg(F.count("*").alias("n"))


def union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """Messages of several subscriptions, each with the name it came from."""
    named = [frame.withColumn("source", F.lit(name)) for name, frame in sources.items()]
    merged = named[0]
    for frame in named[1:]:
        merged = merged.unionByName(frame)
    return merged


def with_event_time(messages: DataFrame, attribute: str = "timestamp") -> DataFrame:
    """Event time from an attribute (ISO text or milliseconds), else the publish time."""
    found = event_time(F.col("attributes")[attribute])
    return messages.withColumn("event_time", F.coalesce(found, F.col("publish_time")))


def greeting(age: Column, country: Column) -> Column:
    """Text that depends on which optional attributes are there."""
    return (
        F.when(age.isNotNull() & country.isNotNull(), F.concat(F.lit("age "), age, F.lit(" from "), country))
        .when(age.isNotNull(), F.concat(F.lit("age "), age))
        .when(country.isNotNull(), F.concat(F.lit("from "), country))
        .otherwise(F.lit("no attributes"))
    )


def split_dead_letters(df: DataFrame, valid: Column) -> DataFrame:
    """Adds ``output`` = main or dead_letter in one pass; a null condition is a dead letter."""
    return df.withColumn("output", F.when(valid, "main").otherwise("dead_letter"))


def with_id(df: DataFrame, columns: Sequence[str], name: str = "uuid") -> DataFrame:
    """Adds an id made of the row's ``columns``, the same whenever the row is computed again."""
    return df.withColumn(name, F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).cast("binary")))


def drop_repeated(df: DataFrame, uuid: Sequence[str] = ("uuid",)) -> DataFrame:
    """One message per id; copies are folded in each task before the shuffle."""
    return df.dropDuplicates(list(uuid))


def drop_repeated_stream(df: DataFrame, event_time_column: str, delay: str, uuid: Sequence[str] = ("uuid",)) -> DataFrame:
    """The streaming form: ids are remembered until the watermark passes."""
    return df.withWatermark(event_time_column, delay).dropDuplicatesWithinWatermark(list(uuid))
