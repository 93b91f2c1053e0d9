"""Nested and repeated fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def project_nested(df: DataFrame, record: str, fields: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Keeps some fields of a nested record; a null record stays null."""
    smaller = F.struct(*[F.col(f"{record}.{f}").alias(f) for f in fields])
    return df.select(*keep, F.when(F.col(record).isNotNull(), smaller).alias(record))


def lower_nested_field(df: DataFrame, record: str, field: str, required: Sequence[str]) -> DataFrame:
    """Drops rows in which a required field is null, lower-cases one nested field, keeps the rest."""
    for name in required:
        df = df.where(F.col(name).isNotNull())
    return df.withColumn(record, F.col(record).withField(field, F.lower(f"{record}.{field}")))


def repeated_years(df: DataFrame, array: str, minimum: int, name: str = "years", strict: bool = False) -> DataFrame:
    """Repeated record to repeated year, from ``minimum`` on (after it when ``strict``)."""

    def recent(item):
        return item["year"] > minimum if strict else item["year"] >= minimum

    return df.withColumn(name, F.transform(F.filter(array, recent), lambda item: item["year"]))


def rewrite_cells(df: DataFrame, array: str, above: int = 3) -> DataFrame:
    """Keeps records with a volume above the bound, strips brackets, drops rows left without a record."""
    kept = F.filter(array, lambda c: c["volume_count"] > above)
    clean = F.transform(
        kept,
        lambda c: F.struct(
            F.regexp_replace(c["value"], r"[\[\]]", "").alias("value"), c["volume_count"].alias("volume_count")
        ),
    )
    return df.withColumn(array, clean).where(F.size(array) > 0)
