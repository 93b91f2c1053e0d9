"""Sinks of keyed stores: wide-column cells, row mutations, entities, documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


CELL_KEY = ("row_key", "family", "qualifier", "ts_micros")

# The five row operations.
INSERT, UPDATE, REPLACE, UPSERT, DELETE = "insert", "update", "replace", "insert_or_update", "delete"


def set_cells(df: DataFrame, row_key: Column, family: Column, values: Sequence[Column], ts_micros: Column) -> DataFrame:
    """Rows to set-cell mutations: qualifiers field0, field1, … in the order of ``values``."""
    exploded = df.select(
        row_key.alias("row_key"), family.alias("family"), ts_micros.alias("ts_micros"), F.posexplode(F.array(*values)).alias("_i", "value")
    )
    return exploded.select("row_key", "family", F.concat(F.lit("field"), "_i").alias("qualifier"), "value", "ts_micros")


def apply_cells(cells: DataFrame, mutations: DataFrame, sequence: str) -> DataFrame:
    """Cells after the mutations; the last write of a cell (by ``sequence``) wins."""
    before = cells.withColumn(sequence, F.lit(-1).cast("long"))
    merged = before.unionByName(mutations.select(*CELL_KEY, "value", F.col(sequence).cast("long").alias(sequence)))
    return merged.groupBy(*CELL_KEY).agg(F.max_by("value", sequence).alias("value"))


def judge_mutations(target: DataFrame, mutations: DataFrame, key: str) -> DataFrame:
    """Adds ``found`` and ``valid``: insert needs a free key, update an existing one, all need a key.

    Two mutations of one key in a set are an error, because their order is not defined.
    """
    keys = target.select(key, F.lit(True).alias("_found"))
    twice = F.raise_error(F.concat(F.lit("two mutations for key "), F.col(key).cast("string")))
    counted = mutations.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    once = counted.select(key, F.when(F.col("_n") == 1, True).otherwise(twice).alias("_once"))
    # A mutation without a key stays in the result, as one that is not valid.
    joined = mutations.join(once, key, "left").join(keys, key, "left").where(F.col(key).isNull() | F.col("_once"))
    found = F.coalesce("_found", F.lit(False))
    valid = F.when(F.col("op") == INSERT, ~found).when(F.col("op") == UPDATE, found).otherwise(True)
    valid = F.col(key).isNotNull() & valid
    return joined.withColumn("found", found).withColumn("valid", valid).drop("_found", "_once")


def apply_mutations(target: DataFrame, judged: DataFrame, key: str, set_flags: Mapping[str, str] | None = None) -> DataFrame:
    """The next version of ``target`` after the valid mutations.

    Replace writes the whole row; update and insert-or-update keep a column whose flag in
    ``set_flags`` (column → boolean column of the mutation) is false; delete removes the
    row and ignores a missing key.
    """
    flags = set_flags or {}
    columns = [c for c in target.columns if c != key]
    ops = judged.where("valid").select(
        key, "op", *[F.col(c).alias(f"_new_{c}") for c in columns], *[F.col(f).alias(f"_set_{c}") for c, f in flags.items()]
    )
    joined = target.withColumn("_old", F.lit(True)).join(ops, key, "full").where("op IS NULL OR op <> 'delete'")

    def after(name: str) -> Column:
        new, old = F.col(f"_new_{name}"), F.col(name)
        if name not in flags:
            return F.when(F.col("op").isNull(), old).otherwise(new)
        keeps = F.col("_old").isNotNull() & F.col("op").isin(UPDATE, UPSERT) & ~F.col(f"_set_{name}")
        return F.when(F.col("op").isNull() | keeps, old).otherwise(new)

    return joined.select(key, *[after(c).alias(c) for c in columns])


def judge_groups(judged: DataFrame, group: str, key: str) -> DataFrame:
    """Atomic groups: a mutation is valid only when all of its group are."""
    verdict = judged.groupBy(group).agg(F.every("valid").alias("_all"))
    rejected = verdict.where(~F.col("_all")).select(group, F.lit(False).alias("_ok"))
    # The rejected groups have one row each, so only the mutations can be skewed, and that side Spark splits.
    return judged.join(rejected, group, "left").withColumn("valid", F.coalesce("_ok", F.lit(True))).drop("_ok")


def entities(df: DataFrame, text: Column, properties: Mapping[str, Column], namespace: str) -> DataFrame:
    """Entities with a key derived from a text and a property map."""
    pairs = [part for name, value in properties.items() for part in (F.lit(name), value.cast("string"))]
    return df.select(
        F.lit(namespace).alias("namespace"), F.md5(text.cast("binary")).alias("key"), F.create_map(*pairs).alias("properties")
    )


def upsert_entities(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming entities replace those of the same key; copies within the input are one."""
    merged = existing.withColumn("_rank", F.lit(0)).unionByName(incoming.withColumn("_rank", F.lit(1)))
    content = F.struct("_rank", F.map_entries("properties").alias("entries"))
    return merged.groupBy("namespace", "key").agg(F.max_by("properties", content).alias("properties"))


def documents(df: DataFrame, name: str = "document") -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias(name))
