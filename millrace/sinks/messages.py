"""Message sinks: log frames, topics per record, messages with attributes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def log_frame(df: DataFrame, key: Column, value: Column, topic: Column, timestamp: Column | None = None) -> DataFrame:
    """Columns (topic, key, value[, timestamp]) that a message-log sink takes, bytes for key and value."""
    columns = [
        topic.alias("topic"),
        F.encode(key.cast("string"), "UTF-8").alias("key"),
        F.encode(value, "UTF-8").alias("value"),
    ]
    return df.select(*columns, *([timestamp.alias("timestamp")] if timestamp is not None else []))


def write_log(frame: DataFrame, path_or_servers: str, fmt: str = "parquet") -> None:
    """Writes a log frame: to a broker with ``fmt="kafka"``, else to files by topic."""
    if fmt == "kafka":
        frame.write.format("kafka").option("kafka.bootstrap.servers", path_or_servers).save()
    else:
        frame.hint("rebalance", "topic").write.partitionBy("topic").format(fmt).save(path_or_servers)


def attributed(df: DataFrame, data: Column, attributes: Mapping[str, Column]) -> DataFrame:
    """Messages (data bytes, attributes map of texts); an attribute without a value is left out."""
    pairs = [part for name, value in attributes.items() for part in (F.lit(name), value.cast("string"))]
    present = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
    return df.select(F.encode(data, "UTF-8").alias("data"), present.alias("attributes"))


def relay(messages: DataFrame) -> DataFrame:
    """Copies messages from one topic to another, decoded and encoded again."""
    return messages.withColumn("data", F.encode(F.decode("data", "UTF-8"), "UTF-8"))
