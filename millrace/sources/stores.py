"""Wide-column cells, entities and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import matches_whole
from millrace.operators.aggregate import CHUNK_ROWS, join_values


def render_rows(cells: DataFrame, chunk_cells: int = CHUNK_ROWS) -> DataFrame:
    """Row key with its cells as text, ordered by family and column, newest cell first.

    ``yyyy/MM/dd HH:mm:ss`` times; a very wide row gives one line per ``chunk_cells``.
    """
    stamp = F.date_format(F.timestamp_micros("ts_micros"), "yyyy/MM/dd HH:mm:ss")
    text = F.concat("family", F.lit(":"), "qualifier", F.lit("="), "value", F.lit(" @ "), stamp)
    newest = cells.withColumn("_age", -F.col("ts_micros")).withColumn("_cell", text)
    order = ["family", "qualifier", "_age", "_cell"]
    return join_values(newest, ["row_key"], "_cell", "; ", order, chunk_cells)


def filter_cells(
    cells: DataFrame, low: str | None = None, high: str | None = None, value: str | None = None, key_part: str | None = None
) -> DataFrame:
    """Cells with ``low <= row_key < high``, a whole-value pattern, and a part of the key."""
    if low is not None:
        cells = cells.where(F.col("row_key") >= low)
    if high is not None:
        cells = cells.where(F.col("row_key") < high)
    if key_part is not None:
        cells = cells.where(F.col("row_key").contains(key_part))
    if value is not None:
        cells = cells.where(matches_whole(F.col("value"), value))
    return cells


def render_entities(df: DataFrame, key: str, properties: str) -> DataFrame:
    """One text per entity that lists its properties by name."""
    entries = F.array_sort(F.map_entries(properties))
    texts = F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return df.select(key, F.concat(F.col(key).cast("string"), F.lit(" {"), F.array_join(texts, ", "), F.lit("}")).alias("line"))


def parse_documents(df: DataFrame, document: str, schema: str) -> DataFrame:
    """JSON documents to the fields of the schema."""
    return df.select(F.from_json(document, schema).alias("d")).select("d.*")
