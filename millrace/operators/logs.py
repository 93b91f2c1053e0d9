"""Log filtering with a dead-letter output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROCESSED, SKIPPED, DEAD_LETTER = "processed", "skipped", "dead_letter"

LOG_SCHEMA = (
    "insertId long, severity string, jsonPayload struct<message: string>, "
    "resource struct<resourceName: string, event_type: string>, timestamp string"
)


def has_field(line: Column, name: str) -> Column:
    """True when the JSON text is an object with that top-level key."""
    return F.coalesce(F.array_contains(F.json_object_keys(line), name), F.lit(False))


def parse_logs(df: DataFrame, line: str, schema: str = LOG_SCHEMA) -> DataFrame:
    """Adds the parsed record as ``log``; exploded, so that each line is parsed once."""
    return df.withColumn("log", F.explode(F.array(F.from_json(line, schema))))


def route_logs(df: DataFrame, present: Column, severity: Column, level: str = "ERROR") -> DataFrame:
    """Adds ``output``: records with the needed fields are processed when they have the level and
    skipped otherwise; the rest are dead letters."""
    is_level = F.upper(severity) == level
    output = F.when(~present, DEAD_LETTER).when(is_level, PROCESSED).otherwise(SKIPPED)
    return df.withColumn("output", output)


def error_messages(routed: DataFrame) -> DataFrame:
    """Processed logs as messages: text and attributes."""
    kept = routed.where(F.col("output") == PROCESSED)
    text = F.concat(F.lit("Log of level error: "), "log.jsonPayload.message", F.lit(" ["), "log.timestamp", F.lit("]"))
    attributes = F.create_map(F.lit("timestamp"), "log.timestamp", F.lit("message"), "log.jsonPayload.message")
    return kept.select(F.col("log.insertId").alias("event_id"), text.alias("data"), attributes.alias("attributes"))


def dead_letters(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("output") == DEAD_LETTER)
