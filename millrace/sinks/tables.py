"""Catalog table sinks: dispositions, destinations, layout, rejected rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


class TableNotEmpty(ValueError):
    """The target of an empty-only write has rows."""


def write_table(
    df: DataFrame, table: str, write: str = "append", create_if_needed: bool = True, location: str | None = None
) -> None:
    """Writes to a catalog table; ``write`` is append, truncate or empty.

    ``empty`` accepts a missing or an empty target only. Without ``create_if_needed`` a
    missing target is an error, and so is a column that an existing target has not.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    if not exists and not create_if_needed:
        raise ValueError(f"table {table} does not exist")
    if exists and write == "empty" and not spark.table(table).isEmpty():
        raise TableNotEmpty(f"table {table} has rows")
    mode = "overwrite" if write == "truncate" else "append"
    if exists:
        unknown = set(df.columns) - set(spark.table(table).columns)
        if unknown:
            raise ValueError(f"table {table} has no column {', '.join(sorted(unknown))}")
        df.select(*spark.table(table).columns).write.mode(mode).insertInto(table, overwrite=mode == "overwrite")
        return
    writer = df.write.mode(mode)
    (writer.option("path", location) if location else writer).saveAsTable(table)


def suffix_strings(df: DataFrame, suffix: str = "_example") -> DataFrame:
    """A record writer that changes every string field."""
    return df.select(
        *[
            F.concat(F.col(f.name), F.lit(suffix)).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
            for f in df.schema
        ]
    )


def write_destinations(
    df: DataFrame, destination: str, columns: Mapping[str, Sequence[str]], location: str, fmt: str = "parquet"
) -> dict[str, str]:
    """A list of destinations with a schema each; returns destination → path.

    A row whose destination is not in the list, or null, ends the write with an error.

    The routed rows are written once, partitioned by destination; each target then
    reads only its own partition, so the input is not computed once per target.
    """
    staged = f"{location}/routed"
    stray = F.raise_error(F.concat(F.lit("no such destination: "), F.coalesce(F.col(destination).cast("string"), F.lit("null"))))
    listed = F.when(F.col(destination).isin(*columns), F.col(destination)).otherwise(stray)
    df.withColumn(destination, listed).hint("rebalance", destination).write.partitionBy(destination).parquet(staged)
    routed = df.sparkSession.read.schema(df.schema).parquet(staged)
    paths = {}
    for name, fields in columns.items():
        paths[name] = f"{location}/{name}"
        routed.where(F.col(destination) == name).select(*fields).write.format(fmt).save(paths[name])
    return paths


def write_partitioned(df: DataFrame, path: str, partition: str, cluster: Sequence[str]) -> None:
    """Folders by ``partition``, rows of a file sorted by the cluster columns.

    The rebalance gives a partition value as many tasks as its size asks for, so a hot
    value, or many copies of one row, never make one huge file.
    """
    together = df.hint("rebalance", partition)
    together.sortWithinPartitions(partition, *cluster).write.partitionBy(partition).parquet(path)


def split_rejected(df: DataFrame, target: str | StructType, table: str) -> DataFrame:
    """Checks text rows against the target schema before a write.

    ``row`` is a JSON text. Adds ``error`` (null when the row fits: no unknown field, every
    value castable, no null in a required field), ``table``, and the typed ``record``.
    """
    schema = target if isinstance(target, StructType) else StructType.fromDDL(target)
    fields = F.from_json("row", "map<string,string>")
    known = F.array(*[F.lit(f.name) for f in schema])
    unknown = F.array_except(F.map_keys(fields), known)
    checks: list[Column] = [
        F.when(fields.isNull(), F.lit("not a record")),
        F.when(F.size(unknown) > 0, F.concat(F.lit("no such field: "), F.array_join(F.array_sort(unknown), ", "))),
    ]
    for field in schema:
        value = fields[field.name]
        if not field.nullable:
            checks.append(F.when(value.isNull(), F.lit(f"missing required field: {field.name}")))
        bad = value.isNotNull() & value.try_cast(field.dataType).isNull()
        checks.append(F.when(bad, F.lit(f"wrong type in field: {field.name}")))
    record = F.struct(*[fields[f.name].try_cast(f.dataType).alias(f.name) for f in schema])
    return df.select("*", F.coalesce(*checks).alias("error"), F.lit(table).alias("table"), record.alias("record"))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("error").isNull()).select("record.*")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("error").isNotNull()).select("row", "error", "table")
