"""File scans: text, CSV, JSON documents, records with a schema, file listings."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_text(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row ``value`` per line of a file, glob or list of them."""
    return spark.read.text(paths if isinstance(paths, str) else list(paths), lineSep="\n")


def read_all_text(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines of all files and globs with the file they came from."""
    return read_text(spark, paths).select("value", F.col("_metadata.file_path").alias("path"))


def match_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Metadata of the matching files; their content is not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(pattern)
    return listed.select("path", "length", "modificationTime")


def read_csv(spark: SparkSession, path: str, schema: str, comment: str | None = None) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True, comment=comment)


def read_json_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that are each one JSON array of records, not JSON lines."""
    return spark.read.json(path, schema=schema, multiLine=True)


def has_format(spark: SparkSession, name: str) -> bool:
    """Whether the connector of a format is on the class path."""
    try:
        spark.read.format(name).schema("x int").load("")
    except Exception as error:  # the class of the error differs between versions
        return not re.search("DATA_SOURCE_NOT_FOUND|Failed to find", str(error))
    return True


def read_records(
    spark: SparkSession, path: str, fields: Sequence[str] = (), fmt: str = "parquet", avro_schema: str | None = None
) -> DataFrame:
    """Avro or Parquet records, only the named fields read from storage.

    ``avro_schema`` is the reader's schema as JSON. A format whose connector is missing is an error.
    """
    reader = spark.read.format(fmt)
    records = (reader.option("avroSchema", avro_schema) if avro_schema else reader).load(path)
    return records.select(*fields) if fields else records
